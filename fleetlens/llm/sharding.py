"""Shards of nearly equal bytes by longest-processing-time scheduling; documents with equal texts stay together.

1.  A document weighs the UTF-8 bytes of its text plus 1, a group the sum over its documents.
2.  A group of at least 1 / `grain` of all bytes is an item of its own.  There are at most `grain` of them, whatever the
    input.  All other groups are dealt into `grain` bins by their text's digest; a bin is an item too.  So at most
    2 * `grain` items come to the driver, which grow in weight with the input, not in number.
3.  Items, heaviest first, go to the least loaded shard, which a heap gives (ties: the smaller digest first, the smaller
    shard).  Loads differ by about a bin at the end, 1 / 1024 of a shard by default, unless one group outweighs a shard.
4.  Slots number a shard's documents from 0 in the order of doc_id (nulls first), then digest.  They come from a range
    partitioning over all shards and the number of rows in the partitions before, so neither a shard nor the rows of a
    repeated doc_id are one task's.

A null text counts as an empty one.  Repeated rows are documents of their own with a slot each; rows without a doc_id take
part like others.  An empty table gives no rows.  Other columns of the documents don't matter.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlens.llm.common import checkpointed

#: Items per shard that are placed one by one, at most: large groups, and as many bins of small ones.
ITEMS_PER_SHARD = 1024
#: Rows of one key that are numbered at a time.
_COPIES = 8192


def longest_first(items: Iterable[tuple[int, str]], shards: int) -> dict[str, int]:
    """The shard of each of the (weight, key) items: heaviest first, always to the least loaded shard."""
    loads = [(0, shard) for shard in range(shards)]
    placed = {}
    for weight, key in sorted(items, key=lambda item: (-item[0], item[1])):
        load, shard = loads[0]
        placed[key] = shard
        heapq.heapreplace(loads, (load + weight, shard))
    return placed


def text_digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def bin_of(digest: Column, bins: int) -> Column:
    """A key that groups share at random; a digest is hexadecimal, so no digest equals one."""
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % bins
    return F.concat(F.lit("bin"), F.lpad(number.cast("string"), 8, "0"))


def placement(weighed: DataFrame, shards: int, grain: int) -> DataFrame:
    """(item, shard) for all items of `weighed` (digest, size): digests of large groups, and bins."""
    groups = checkpointed(weighed.groupBy("digest").agg(F.sum("size").alias("weight")))
    total = groups.agg(F.sum("weight")).first()[0] or 0
    large = F.col("weight") >= max(1, -(-total // grain))
    item = F.when(large, F.col("digest")).otherwise(bin_of(F.col("digest"), grain))
    items = groups.groupBy(item.alias("item")).agg(F.sum("weight").alias("weight"))
    placed = longest_first(((row["weight"], row["item"]) for row in items.collect()), shards)  # 2 * grain rows at most
    return weighed.sparkSession.createDataFrame(list(placed.items()), "item string, shard int")


def _with_shard(rows: DataFrame, items: DataFrame, grain: int) -> DataFrame:
    """`rows` with `shard`; the items are at most 2 * grain short rows, so both joins broadcast them."""
    own = F.broadcast(items.select(F.col("item").alias("digest"), F.col("shard").alias("own_shard")))
    bins = F.broadcast(items.select(F.col("item").alias("bin"), F.col("shard").alias("bin_shard")))
    rows = rows.join(own, "digest", "left").withColumn("bin", bin_of(F.col("digest"), grain)).join(bins, "bin", "left")
    return rows.withColumn("shard", F.coalesce("own_shard", "bin_shard")).drop("own_shard", "bin_shard", "bin")


def _weighed(docs: DataFrame) -> DataFrame:
    size = F.coalesce(F.octet_length(docs["text"]), F.lit(0)).cast("long") + 1
    crc = F.crc32(F.coalesce(docs["text"], F.lit("")).cast("binary"))
    return docs.select(
        docs["doc_id"].alias("doc_id"), size.alias("size"), crc.alias("text_crc32"), text_digest(docs["text"]).alias("digest")
    )


def assign(docs: DataFrame, shards: int = 16, items_per_shard: int = ITEMS_PER_SHARD) -> DataFrame:
    """(doc_id, size, text_crc32, digest, shard, slot) per row of `docs` (doc_id, text)."""
    grain = shards * items_per_shard
    rows = checkpointed(_weighed(docs))
    rows = _with_shard(rows, placement(rows, shards, grain), grain)
    return numbered(rows.select("doc_id", "size", "text_crc32", "digest", "shard"))


def numbered(rows: DataFrame) -> DataFrame:
    """`rows` with `slot`, their place within the shard by doc_id, then digest."""
    # Equal rows are told apart by a number, so that they don't stay in one partition.
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))
    blocks = counted.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(_COPIES).cast("long"))).alias("block"))
    last = F.least(F.col("copies"), F.col("block") + _COPIES) - 1
    single = blocks.select(*rows.columns, F.explode(F.sequence("block", last)).alias("copy"))
    ordered = checkpointed(single.orderBy("shard", "doc_id", "digest", "copy"))
    # The number of a row is its partition's number and its place in there; both are fixed by the checkpoint.
    number = F.monotonically_increasing_id()
    placed = ordered.withColumn("part", F.shiftright(number, 33)).withColumn("at", number.bitwiseAND(F.lit((1 << 33) - 1)))
    # One row per partition, and one more per shard that begins within a partition.
    runs = placed.groupBy("shard", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("shard", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    found = placed.join(F.broadcast(runs), ["shard", "part"])
    return found.select(*rows.columns, (F.col("at") + F.col("shift")).cast("long").alias("slot"))


def write_shards(docs: DataFrame, folder: str, shards: int = 16, items_per_shard: int = ITEMS_PER_SHARD) -> None:
    """Writes whole documents as Parquet, one folder `shard=k` per shard; texts are not shuffled."""
    if "shard" in docs.columns:
        raise ValueError("the documents have a column named shard")
    grain = shards * items_per_shard
    items = placement(_weighed(docs).select("digest", "size"), shards, grain)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), text_digest(docs["text"]).alias("digest"))
    _with_shard(rows, items, grain).select("row.*", "shard").write.partitionBy("shard").mode("overwrite").parquet(folder)


def digest(assigned: DataFrame) -> DataFrame:
    """The columns of the report: the law that holds is that of equal bytes, so no shard is foretold for a grown number."""
    return assigned.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
