"""SimHash fingerprints: hashes of weighted terms vote on signed bits; block tables find all close fingerprints.

Terms are words (what white space parts, A-Z as a-z) and pairs of neighbouring words; a term that occurs c times weighs
1 + ln(c), single words half of that.  Each term's 128-bit hash votes with its weight for or against every bit.
The angle between two texts' term vectors is estimated from the Hamming distance h of their fingerprints; the likeness is
its cosine, cos(pi * h / 128), and 0 beyond a right angle.

A null or empty text, or one without words, has the fingerprint of zeros.  Equal texts have equal fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from fleetlens.llm.common import Memo, checkpointed, hash_memo, mixed, ship, word_hashes

BITS = 128
#: Documents of one range of ids, and the most ranges.
RANGE_ROWS, MAX_RANGES = 20_000, 4096


def fingerprint(text: str | None, memo: Memo) -> bytes:
    words = text.encode().lower().split() if text else []
    if not words:
        return bytes(BITS // 8)
    single = word_hashes(memo, words)
    terms, counts = np.unique(single, return_counts=True)
    weights = (1 + np.log(counts)) / 2
    if len(words) > 1:
        pairs, counts = np.unique(mixed(single[:-1]) + single[1:], return_counts=True)
        terms, weights = np.concatenate([terms, pairs]), np.concatenate([weights, 1 + np.log(counts)])
    votes = np.zeros(BITS)
    for i in range(0, len(terms), 4096):
        part = terms[i : i + 4096]
        hashes = np.stack([mixed(part ^ np.uint64(0x5851F42D4C957F2D)), mixed(part + np.uint64(0x14057B7EF767814F))], axis=1)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8), axis=1)
        votes += weights[i : i + 4096].astype(np.float32) @ bits.astype(np.float32)
    return np.packbits(votes > weights.sum() / 2).tobytes()


def distance(a: bytes, b: bytes) -> int:
    return (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()


def likeness(a: bytes, b: bytes) -> float:
    return float(max(0.0, np.cos(np.pi * distance(a, b) / BITS))) if a != b else 1.0


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint in hex) per document."""
    ship(docs.sparkSession)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = hash_memo()
        for batch in batches:
            made = [fingerprint(text, memo).hex() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.string())], names=["doc_id", "fingerprint"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    return rows.mapInArrow(read, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """`text` with its last half replaced by the first half-as-many characters of `following` (or all it has)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_edits(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likeness to it and to the next document's.

    The next document is the next one by doc_id (nulls first), then by a hash of the text; after the last one the first.
    The texts are shuffled once, into ranges in this order, and streamed; a copy of the first document of a range also goes
    to the range before it, as what follows that one's last document.  Ranges begin at documents that exist, found by a
    range partitioning of ids and text hashes alone, so rows without an id or with a repeated one are several ranges too.
    """
    ship(docs.sparkSession)
    rows = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["doc_id"].cast("long"), F.lit(-(2**63))).alias("at"),
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("mark"),
        F.coalesce(docs["text"], F.lit("")).alias("text"),
    )
    order = checkpointed(rows.select("at", "mark"))
    count = order.count()
    if not count:
        return docs.sparkSession.createDataFrame([], _EDITED)
    ranges = int(min(MAX_RANGES, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), count // RANGE_ROWS)))
    starts = order.repartitionByRange(ranges, "at", "mark").groupBy(F.spark_partition_id()).agg(F.min(F.struct("at", "mark")).alias("first"))
    starts = sorted(tuple(row["first"]) for row in starts.collect())  # MAX_RANGES at most
    ats, marks = (np.array(column, np.int64) for column in zip(*starts))

    @pandas_udf("int")
    def range_of(at, mark):
        return pd.Series(ranges_of(at.to_numpy(), mark.to_numpy(), ats, marks))

    placed = rows.select("doc_id", "at", "mark", "text", F.lit(0).alias("copy"), range_of("at", "mark").alias("range"))
    # The document that follows a range, once each.
    followed = [(at, mark, (k - 1) % len(starts)) for k, (at, mark) in enumerate(starts)]
    followed = F.broadcast(docs.sparkSession.createDataFrame(followed, "at long, mark long, range int"))
    firsts = rows.join(followed, ["at", "mark"]).dropDuplicates(["at", "mark"])
    firsts = firsts.select("doc_id", "at", "mark", "text", F.lit(1).alias("copy"), "range")
    streams = placed.union(firsts).repartition(len(starts), "range").sortWithinPartitions("range", "copy", "at", "mark", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = hash_memo()
        waiting = None
        for batch in batches:
            out = []
            names = ("range", "copy", "doc_id", "text")
            for of, copy, doc_id, text in zip(*(batch.column(name).to_pylist() for name in names)):
                made = None
                if waiting is not None:
                    if waiting[0] != of:
                        raise RuntimeError(f"no document follows range {waiting[0]}")
                    made = fingerprint(text, memo)
                    out.append(_row(waiting, text, made, memo))
                    waiting = None
                if copy == 0:
                    waiting = (of, doc_id, text, made or fingerprint(text, memo))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], schema=_SCHEMA)
        if waiting is not None:
            raise RuntimeError(f"no document follows range {waiting[0]}")

    return streams.select("range", "copy", "doc_id", "text").mapInArrow(compare, _EDITED)


def ranges_of(at: np.ndarray, mark: np.ndarray, ats: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """The number of the range of each (at, mark): the last one of the ascending starts (ats, marks) that isn't beyond it."""
    own = np.searchsorted(ats, at, side="right")
    several = own - np.searchsorted(ats, at, side="left") > 0  # a range begins within this id
    for value in np.unique(at[several]):
        low, high = np.searchsorted(ats, value, side="left"), np.searchsorted(ats, value, side="right")
        of = at == value
        own[of] = low + np.searchsorted(marks[low:high], mark[of], side="right")
    return (own - 1).astype(np.int32)


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _row(waiting, following: str, made: bytes, memo: Memo):
    import hashlib

    _, doc_id, text, own = waiting
    new = edited(text, following)
    of_new = own if new == text else fingerprint(new, memo)
    digest = hashlib.sha256(new.encode()).hexdigest()
    return doc_id, len(text), digest, own.hex(), of_new.hex(), likeness(own, of_new), likeness(own, made)


def close_fingerprints(asked: DataFrame, table: DataFrame, radius: int = 3) -> DataFrame:
    """(asked, fingerprint, distance, copies): the distinct fingerprints of `table` within `radius` bits of one of `asked`.

    `asked` has a column asked, `table` a column fingerprint, both in hex.  With radius + 1 blocks of bits, two fingerprints
    within the radius agree in one block at least, so a table permuted to each block first finds all of them.  Equal
    fingerprints are one entry, however many documents have them.
    """
    entries = checkpointed(table.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("copies")))
    asked = asked.select("asked").distinct()
    blocks, digits = radius + 1, BITS // 4
    edges = [round(k * digits / blocks) for k in range(blocks + 1)]

    def blocked(df: DataFrame, name: str) -> DataFrame:
        keys = F.array(
            *[F.concat(F.lit(f"{k}:"), F.substring(name, a + 1, b - a)) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
        )
        return df.select("*", F.explode(keys).alias("block"))

    def bits(part: int):
        pieces = [F.conv(F.substring(name, 8 * part + 1, 8), 16, 10).cast("long") for name in ("asked", "fingerprint")]
        return F.bit_count(pieces[0].bitwiseXOR(pieces[1]))

    apart = sum((bits(part) for part in range(1, digits // 8)), bits(0))
    pairs = blocked(asked, "asked").join(blocked(entries, "fingerprint"), "block")
    pairs = pairs.select("asked", "fingerprint", apart.cast("int").alias("distance"), "copies")
    return pairs.where(F.col("distance") <= radius).distinct()


def neighbours(queries: DataFrame, table: DataFrame, radius: int = 3) -> DataFrame:
    """(query_id, doc_id, distance) for all fingerprints of `table` within `radius` bits of one of `queries`.

    Both are (doc_id, fingerprint in hex).  Matches of distinct fingerprints are found first, and then expanded for the
    queries only.
    """
    asked = queries.select(F.col("fingerprint").alias("asked"))
    found = close_fingerprints(asked, table, radius).join(queries.select(F.col("doc_id").alias("query_id"), F.col("fingerprint").alias("asked")), "asked")
    return found.join(table, "fingerprint").where("query_id <> doc_id").select("query_id", "doc_id", "distance")


def with_neighbours(made: DataFrame, every: int = 50, radius: int = 3) -> DataFrame:
    """`made` (of with_edits) with `n_near`: for documents whose id `every` divides, how many others are within the radius.

    The others are rows of any id, the document's own row left out; null for rows that aren't asked.
    """
    made = checkpointed(made)
    asked = F.col("doc_id") % every == 0
    found = close_fingerprints(made.where(asked).select(F.col("fingerprint").alias("asked")), made, radius)
    near = found.groupBy("asked").agg((F.sum("copies") - 1).alias("n_near"))
    # Rows that aren't asked stay where they are; those that are go to the few fingerprints they ask for.
    few = made.where(asked).join(near.withColumnRenamed("asked", "fingerprint"), "fingerprint", "left").select(*made.columns, "n_near")
    return few.union(made.where(~asked | asked.isNull()).withColumn("n_near", F.lit(None).cast("long")))
