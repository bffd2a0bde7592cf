"""Helpers that the operators share: tables, checkpoints, words as hashes."""

from __future__ import annotations

import os
import tempfile
import zipfile
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()

#: Rows of one Arrow batch, which both the executor and its Python worker hold whole, several times over as they convert it.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Gives this package to the Python workers of executors on which it isn't installed; once per application.

    Batches of the session get `BATCH_ROWS` rows instead of Spark's 10,000, unless it has a size of its own.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="package-"), os.path.basename(package) + ".zip")
    with zipfile.ZipFile(archive, "w") as file:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    file.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` computed once and cut off from its lineage, in the folder that spark.checkpoint.dir names.

    Without that setting only a local session gets a folder of its own; on a cluster the folder must be shared.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return df.checkpoint()


#: Bits of a filter of keys: the least and the most (a table of 16 MB, which is what a task is sent), and those per key in between.
FILTER_LEAST, FILTER_MOST, FILTER_PER_KEY = 1 << 16, 1 << 26, 32


@dataclass(frozen=True)
class KeyFilter:
    """A Bloom filter with one hash function, as a table (word, bits) of the words that have any bit set.

    Its size is bounded: with more keys than that is meant for, more rows pass that needn't, but none is lost.
    """

    words: DataFrame
    bits: int

    @classmethod
    def of(cls, hashes: DataFrame) -> KeyFilter:
        """The filter of a column of longs."""
        (name,) = hashes.columns
        hashes = checkpointed(hashes)
        bits = max(FILTER_LEAST, min(FILTER_MOST, 1 << (FILTER_PER_KEY * hashes.count()).bit_length()))
        place = F.col(name).bitwiseAND(F.lit(bits - 1)).alias("bit")
        words = hashes.select(place).groupBy(F.shiftright("bit", 6).alias("__word"))
        return cls(checkpointed(words.agg(F.expr("bit_or(shiftleft(1L, cast(bit & 63 as int)))").alias("__bits"))), bits)

    def mark(self, rows: DataFrame, hash: Column) -> DataFrame:
        """`rows` with `__maybe`: true for all keys of the filter, and few others; the words are broadcast."""
        rows = rows.withColumn("__place", hash.bitwiseAND(F.lit(self.bits - 1)))
        marked = rows.join(F.broadcast(self.words), F.shiftright("__place", 6) == F.col("__word"), "left")
        has = F.expr("(shiftright(__bits, cast(__place & 63 as int)) & 1) = 1")
        return marked.withColumn("__maybe", F.coalesce(has, F.lit(False))).drop("__place", "__word", "__bits")


class Memo(dict):
    """Values of a function of one word, kept until there are `limit` of them; then it starts anew."""

    def __init__(self, function, limit: int = 200_000):
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.function(word)
        return value


def word_hashes(memo: Memo, words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def hash_memo() -> Memo:
    return Memo(xxhash.xxh64_intdigest)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
