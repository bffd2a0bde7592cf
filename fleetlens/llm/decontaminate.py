"""Benchmark decontamination with a generalised suffix automaton over the words of test items.

The automaton holds every run of words of every item.  A document streams through it word by word; the
automaton's state knows the longest run that ends at the current word, so one pass over a text finds
all its runs, whatever their number and length.

Cases: a null or wordless text has no words and is clean; a null or wordless item has no window; items
with equal texts all count; rows with equal `item_id` are one item; repeated documents give repeated rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import checkpointed, ship

# Fixed values of the word rule: A-Z become a-z; a word is a run of ASCII digits, a-z and non-ASCII.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")

#: Item words of one automaton.  A larger benchmark is worked off in blocks, one pass over the documents each.
BLOCK_WORDS = 100_000


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split() if text else []


class SuffixAutomaton:
    """All runs of words of some items, and which items hold a run of `window` words or are shorter than that."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: dict[int, set[str]] = {}
        short: dict[int, set[str]] = {}
        for item, words in items:
            state = 0
            for word in words:
                state = self._extend(state, word)
                ends.setdefault(state, set()).add(item)
            if 0 < len(words) < window:
                short.setdefault(state, set()).add(item)
        self._gather(ends, short)

    def _state(self, length: int, link: int, following: dict[bytes, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, before: int, word: bytes) -> int:
        """The state of exactly the run of `before` plus `word`; made, if `word` leads to longer runs only."""
        old = self.next[before][word]
        if self.length[old] == self.length[before] + 1:
            return old
        new = self._state(self.length[before] + 1, self.link[old], dict(self.next[old]))
        self.link[old] = new
        while before >= 0 and self.next[before].get(word) == old:
            self.next[before][word] = new
            before = self.link[before]
        return new

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._state(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new

    def _gather(self, ends: dict[int, set[str]], short: dict[int, set[str]]) -> None:
        """Per state: the items of its last `window` words, and the short items that end its run."""
        by_length = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        for state in reversed(by_length):  # what ends in a longer run ends in its suffixes
            above = self.link[state]
            if state in ends and self.length[above] >= self.window:
                ends.setdefault(above, set()).update(ends[state])
        self.window_items: dict[int, frozenset[str]] = {}
        self.short_items: dict[int, tuple[tuple[int, frozenset[str]], ...]] = {}
        for state in by_length:
            above = self.link[state]
            if self.length[state] >= self.window:
                deeper = self.length[above] >= self.window
                self.window_items[state] = self.window_items[above] if deeper else frozenset(ends.get(state, ()))
            own = ((self.length[state], frozenset(short[state])),) if state in short else ()
            if found := self.short_items.get(above, ()) + own:
                self.short_items[state] = found
        self.least = min([self.window, *(self.length[state] for state in short)])

    def scan(self, words: list[bytes]) -> tuple[list[int], set[str]]:
        """Hit words as flat [first, last, first, last, ...], ascending and apart, and the items found."""
        following, link, lengths = self.next, self.link, self.length
        window, least, short_items, window_items = self.window, self.least, self.short_items, self.window_items
        spans: list[int] = []
        items: set[str] = set()
        state = length = 0
        for i, word in enumerate(words):
            target = following[state].get(word)
            if target is None:
                while state and target is None:
                    state = link[state]
                    target = following[state].get(word)
                length = lengths[state]
                if target is None:
                    continue
            state = target
            length += 1
            if length < least:
                continue
            first = i + 1
            if length >= window:
                first = i - window + 1
                items |= window_items[state]
            for size, which in short_items.get(state, ()):
                if size <= length:
                    first = min(first, i - size + 1)
                    items |= which
            if first <= i:
                while spans and first <= spans[-1] + 1:
                    spans.pop()
                    first = min(first, spans.pop())
                spans += [first, i]
        return spans, items


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items by ascending id in lists of at most `block_words` words (or of one item)."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").alias("words_of_item")
    )
    block: list[tuple[str, list[bytes]]] = []
    size = 0
    for row in items.orderBy("item", "words_of_item").toLocalIterator():
        words = words_of(row[1])
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((row[0], words))
        size += len(words)
    if block:
        yield block


_FOUND = "n_words bigint, n_hit bigint, spans array<int>, items array<string>, cleaned string"


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """Per document: its columns in `row`, and n_words, n_hit, spans (first and last hit words, flat), items found and
    `cleaned`, the text without its spans (null if there are none).

    Documents are neither shuffled nor gathered.  Each task holds one automaton of at most `block_words` item words;
    beyond that the documents pass once per block, checkpointed in between.
    """
    ship(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    row = F.struct(*[docs[name].alias(name) for name in docs.columns]).alias("row")
    out = docs.select(row, F.array().cast("array<int>").alias("spans"), F.array().cast("array<string>").alias("items"))
    schema = f"row {row_type(docs)}, {_FOUND}"
    passes = 0
    for block in item_blocks(benchmark, block_words):
        if passes:
            out = checkpointed(out)
        out = out.mapInArrow(_matcher(context.broadcast(SuffixAutomaton(block, window))), schema)
        passes += 1
    if not passes:
        out = out.mapInArrow(_matcher(context.broadcast(SuffixAutomaton([], window))), schema)
    return out


def row_type(docs: DataFrame) -> str:
    return docs.schema.simpleString()


def _matcher(automaton):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = automaton.value.scan
        for batch in batches:
            sizes, hits, all_spans, all_items, cleaned = [], [], [], [], []
            columns = (pc.struct_field(batch.column("row"), "text"), batch.column("spans"), batch.column("items"))
            for text, spans, items in zip(*(column.to_pylist() for column in columns)):
                words = words_of(text)
                new, found = scan(words)
                spans = merged(spans, new) if spans else new
                sizes.append(len(words))
                hits.append(sum(spans[1::2]) - sum(spans[::2]) + len(spans) // 2)
                all_spans.append(spans)
                all_items.append(sorted(found.union(items)) if items else sorted(found))
                cleaned.append(without(text, spans) if spans else None)
            columns = {
                "row": batch.column("row"),
                "n_words": pa.array(sizes, pa.int64()), "n_hit": pa.array(hits, pa.int64()),
                "spans": pa.array(all_spans, pa.list_(pa.int32())), "items": pa.array(all_items, pa.list_(pa.string())),
                "cleaned": pa.array(cleaned, pa.string()),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return match


def merged(left: list[int], right: list[int]) -> list[int]:
    """The union of two lists of spans."""
    out: list[int] = []
    for first, last in sorted([*zip(left[::2], left[1::2]), *zip(right[::2], right[1::2])]):
        if out and first <= out[-1] + 1:
            out[-1] = max(out[-1], last)
        else:
            out += [first, last]
    return out


def without(text: str, spans: list[int]) -> str:
    """`text` without the words of the spans and what stands between them; all else stays as it is."""
    data = text.encode()
    places = [match.span() for match in _WORD.finditer(data.translate(_WORD_BYTES))]
    kept, at = [], 0
    for first, last in zip(spans[::2], spans[1::2]):
        kept.append(data[at : places[first][0]])
        at = places[last][1]
    return b"".join([*kept, data[at:]]).decode()


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5) -> DataFrame:
    """Documents, with all their columns, after removal of benchmark passages.

    Runs of `window` item words (or whole shorter items) are cut out; a document with a larger share of hit words than
    `max_coverage` goes.  `n_chars`, if there, follows the new text.  Documents without a hit stay as they are.
    """
    found = contamination(docs, benchmark, window).where(F.col("n_hit") <= F.lit(max_coverage) * F.col("n_words"))
    new = {"text": F.col("cleaned"), "n_chars": F.char_length("cleaned")}
    return found.select(
        *[
            F.when(F.col("n_hit") > 0, new[name]).otherwise(F.col("row")[name]).cast(docs.schema[name].dataType).alias(name)
            if name in new else F.col("row")[name].alias(name)
            for name in docs.columns
        ]
    )
