"""Encoding to and decoding from piece ids by a streaming Viterbi.

Characters arrive in small parts.  A piece that ends in the future begins within the last `longest` positions, so only the best
paths to those positions survive.  Once these paths share a boundary, what lies before it can't change any more: its ids are
committed and its characters dropped.  The window is bounded by the longest piece and by how soon paths meet, not by the text.

Chunks that no piece reaches across (words with the spaces before them) end all paths at one boundary, so their ids are
final; they are remembered in a bounded table per worker.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import Memo, ship
from fleetlens.llm.unigram import Vocabulary, chunk_of, load

#: Characters that are looked at together; then a shared boundary is looked for.
STRIDE = 64

_NONE = float("-inf")


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.ids, self.bytes, self.plain = vocabulary.ids, vocabulary.bytes, vocabulary.plain
        self.longest, self.unknown = vocabulary.longest, vocabulary.unknown
        self.keys = vocabulary.keys_of()
        self.memo = Memo(lambda key: tuple(self.stream([chunk_of(key)])), 500_000)
        self.single = frozenset(piece for piece in self.ids if len(piece) == 1)
        self.automaton = ahocorasick.Automaton()
        for piece, (_, score) in self.ids.items():
            self.automaton.add_word(piece, (len(piece), score))
        if self.ids:
            self.automaton.make_automaton()

    def stream(self, parts: Iterable[str]) -> Iterator[int]:
        """The ids of a normalised text that comes in parts, each as soon as it is certain."""
        window = ""  # characters since the last committed boundary
        best, start = [0.0], [0]  # per position of the window: score of the best path, start of its last piece
        passed = 0  # characters before the window
        matches = None
        for part in (part[i : i + STRIDE] for part in parts for i in range(0, len(part), STRIDE)):
            if not self.ids:
                matches = iter(())
            elif matches is None:
                matches = self.automaton.iter(part)
            else:
                matches.set(part)  # goes on in the state that the part before left
            window += part
            best += [_NONE] * len(part)
            start += [0] * len(part)
            if self.single.issuperset(part):
                for last, (length, score) in matches:  # by end, the longest first; a later one must be better
                    end = last + 1 - passed
                    total = best[end - length] + score
                    if total > best[end]:
                        best[end], start[end] = total, end - length
            else:
                self._with_unknown(window, len(part), matches, passed, best, start)
            if len(window) >= 2 * STRIDE:
                shared = self._shared(start, len(window))
                if shared:
                    yield from self._committed(window, start, shared)
                    window, base, passed = window[shared:], best[shared], passed + shared
                    best = [score - base for score in best[shared:]]
                    start = [max(0, s - shared) for s in start[shared:]]
        yield from self._committed(window, start, len(window))

    def _with_unknown(self, window, added, matches, passed, best, start) -> None:
        """One part, where a character that is no piece can also be passed as its bytes."""
        found = next(matches, None)
        for end in range(len(window) - added + 1, len(window) + 1):
            while found is not None and found[0] + 1 - passed == end:
                length, score = found[1]
                if best[end - length] + score > best[end]:
                    best[end], start[end] = best[end - length] + score, end - length
                found = next(matches, None)
            if window[end - 1] not in self.single and best[end - 1] + self.unknown > best[end]:
                best[end], start[end] = best[end - 1] + self.unknown, end - 1

    def _shared(self, start: list[int], end: int) -> int:
        """The last boundary on all paths to the positions from which a future piece can begin."""
        paths = set(range(max(0, end - self.longest + 1), end + 1))
        while len(paths) > 1:
            last = max(paths)
            paths.discard(last)
            paths.add(start[last])
        return paths.pop()

    def _committed(self, window: str, start: list[int], end: int) -> Iterator[int]:
        pieces = []
        while end:
            pieces.append(window[start[end] : end])
            end = start[end]
        for piece in reversed(pieces):
            known = self.ids.get(piece)
            if known is not None:
                yield known[0]
            else:
                yield from (self.bytes[b] for b in piece.encode())

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        return list(chain.from_iterable(map(self.memo.__getitem__, self.keys(text))))

    def decode(self, ids: Iterable[int]) -> str:
        """The text: without the space that encoding puts in front; bytes that aren't UTF-8 become U+FFFD."""
        data = b"".join(map(self.plain.__getitem__, ids))
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def _shared_encoder(docs: DataFrame, model_path: str):
    ship(docs.sparkSession)
    vocabulary = load(model_path)
    return docs.sparkSession.sparkContext.broadcast((vocabulary.ids, vocabulary.bytes, vocabulary.plain))


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """Every document's columns in `row`, its piece ids, and whether decoding them gives the text back.

    It doesn't only where a text holds U+2581 itself, which stands for a space.  A null text has no ids, and comes back as
    an empty one.
    """
    shared = _shared_encoder(docs, model_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*shared.value))
        for whole in batches:
            for i in range(0, whole.num_rows, 500):
                batch = whole.slice(i, 500)
                texts = pc.struct_field(batch.column("row"), "text").to_pylist()
                found = [encoder.encode(text) for text in texts]
                same = [encoder.decode(ids) == (text or "") for ids, text in zip(found, texts)]
                ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
                values = np.fromiter(chain.from_iterable(found), np.int32, sum(map(len, found)))
                columns = [batch.column("row"), pa.ListArray.from_arrays(ends, pa.array(values)), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "ids", "round_trip"])

    row = F.struct(*[docs[name].alias(name) for name in docs.columns]).alias("row")
    return docs.select(row).mapInArrow(work, f"row {docs.schema.simpleString()}, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """The rows of `encoded` (doc_id, ids) with their texts."""
    shared = _shared_encoder(encoded, model_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(Vocabulary(*shared.value))
        for batch in batches:
            texts = [encoder.decode(ids or ()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    rows = encoded.select(encoded["doc_id"].alias("doc_id"), encoded["ids"].alias("ids"))
    return rows.mapInArrow(work, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")
