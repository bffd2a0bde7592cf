"""Token counts by count-only Viterbi over the matches of an Aho-Corasick automaton.

The automaton enumerates all pieces that end at a character; the best score and its number of pieces are all that is kept
per position, no paths and no ids.  What no piece reaches across, a word with the spaces before it, is counted once and
remembered (a bounded table per worker), as the best path of a text is made of those of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from fleetlens.llm.common import Memo, ship
from fleetlens.llm.unigram import Vocabulary, chunk_of, load


_NONE = float("-inf")


class Counter:
    def __init__(self, vocabulary: Vocabulary):
        self.automaton = ahocorasick.Automaton()
        for piece, (_, score) in vocabulary.ids.items():
            self.automaton.add_word(piece, (len(piece), score))
        if vocabulary.ids:
            self.automaton.make_automaton()
        self.unknown = vocabulary.unknown
        self.single = frozenset(piece for piece in vocabulary.ids if len(piece) == 1)
        self.keys = vocabulary.keys_of()
        self.memo = Memo(lambda key: self.of_chunk(chunk_of(key)), 600_000)

    def of_chunk(self, chunk: str) -> tuple[int, float]:
        """Number of pieces and score of the best path.

        Matches arrive by their end, the longest first; a later one has to be better to count.
        """
        size = len(chunk)
        best, count = [_NONE] * (size + 1), [0] * (size + 1)
        best[0] = 0.0
        if not self.single.issuperset(chunk):
            return self._with_unknown(chunk, best, count)
        for last, (length, score) in self.automaton.iter(chunk):
            start, end = last + 1 - length, last + 1
            total = best[start] + score
            if total > best[end]:
                best[end], count[end] = total, count[start] + 1
        return count[size], best[size]

    def _with_unknown(self, chunk: str, best: list[float], count: list[int]) -> tuple[int, float]:
        """The same, where a character that is no piece can also be passed as its bytes."""
        matches = self.automaton.iter(chunk) if len(self.automaton) else iter(())
        found = next(matches, None)
        for end, char in enumerate(chunk, 1):
            while found is not None and found[0] == end - 1:
                length, score = found[1]
                total = best[end - length] + score
                if total > best[end]:
                    best[end], count[end] = total, count[end - length] + 1
                found = next(matches, None)
            if char not in self.single and best[end - 1] + self.unknown > best[end]:
                best[end], count[end] = best[end - 1] + self.unknown, count[end - 1] + len(char.encode())
        return count[-1], best[-1]

    def __call__(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        found = list(map(self.memo.__getitem__, self.keys(text)))
        return sum(n for n, _ in found), sum(score for _, score in found)


def count_tokens(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, score) per document; repeated rows are counted each."""
    ship(docs.sparkSession)
    vocabulary = load(model_path)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.ids, vocabulary.bytes, vocabulary.plain))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(Vocabulary(*shared.value))
        for batch in batches:
            found = [counter(text) for text in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), pa.array([n for n, _ in found], pa.int64())]
            columns.append(pa.array([score for _, score in found], pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "score"])

    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(count, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, score double")
