"""Near-duplicates of documents by HyperMinHash signatures, LSH bands over their registers, and exact verification.

1.  A document's set of word shingles becomes sorted 64-bit hashes.  Equal sets are one *class*, whatever its size.
2.  A class gets K registers of 16 bits.  A register has a hash function of its own and holds, of the least hash of the
    set, the number of leading zeros (6 bits) and the 10 bits that follow the first one.  With a hash function each,
    instead of a share of one function's values, no register is empty, so that sets of a few shingles work too.
3.  Bands of registers are keys.  Their number follows from the threshold: a pair at the threshold shares no key with a
    probability of at most `miss` (a pair of more similar documents with a much smaller one).
4.  A key's classes aren't paired with each other but with one *hub*, the class that shares most keys with others (in a
    group of edited copies that is the text they stem from).  Pairs pass if the Jaccard estimate from the registers,
    corrected for colliding mantissas, isn't far below the threshold, and then by intersection of the full sets.
5.  What links these pairs leave open: pairs of classes that share a key but not a component.  Both are known by their
    differences from the key's hub, and one of them at least isn't linked with it.  Then the two sets of differences must
    have so many elements in common that the rarest ones of either tell: pairs are made where an element of one is among the
    first of the other's, in order of frequency, and its places leave room for enough more.  This loses no link.
6.  Pairs are ids only until they are verified.  Classes lie in blocks of a bounded size; a task holds the registers and sets
    of one block, and the other class of a pair visits each block in which it has partners once, not each partner.

Sets are compared as sets of 64-bit hashes.  Null or wordless texts have an empty set and no link.  Repeated rows give
repeated rows.  Rows without a doc_id take part as copies of a class, but a class of such rows only is linked with none.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlens.llm.common import KeyFilter, Memo, checkpointed, hash_memo, mixed, ship, word_hashes
from fleetlens.llm.components import components

MANTISSA_BITS = 10
#: Registers of one band.
ROWS = 6
#: Hashes that are spread over all registers at a time (bounds memory for very long texts).
_CHUNK = 2048
#: Standard errors below the threshold at which the estimate rules a pair out.
SLACK = 6.0


def bands_for(percent: int, rows: int = ROWS, miss: float = 1e-6) -> int:
    """Bands of `rows` registers, so that a pair at the threshold is missed with a probability of at most `miss`."""
    shared = (percent / 100) ** rows
    return 1 if shared >= 1 else math.ceil(math.log(miss) / math.log(1 - shared))


def shingle_hashes(text: str | None, words: int, memo: Memo) -> np.ndarray:
    """The set of a text's shingles as ascending 64-bit hashes.

    A-Z become a-z; words are what ASCII white space parts.  A text of fewer words is one shingle.
    """
    parts = text.encode().lower().split() if text else []
    if not parts:
        return np.empty(0, np.uint64)
    hashes = word_hashes(memo, parts)
    size = min(words, len(parts))
    runs = np.full(len(parts) - size + 1, size, np.uint64)
    for i in range(size):
        runs = mixed(runs + hashes[i : len(parts) - size + 1 + i])
    return np.unique(runs)


class Registers:
    """HyperMinHash registers of sets of hashes."""

    def __init__(self, count: int, seed: int = 1):
        seeds = mixed(np.arange(seed, seed + 2 * count, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.factor, self.offset = seeds[:count] | np.uint64(1), seeds[count:]

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        least = np.full(len(self.factor), 2**64 - 1, np.uint64)
        for i in range(0, len(hashes), _CHUNK):
            spread = hashes[i : i + _CHUNK, None] * self.factor
            spread += self.offset
            np.minimum(least, spread.min(axis=0), out=least)
        zeros = 64 - np.frexp(least.astype(np.float64))[1]
        zeros = np.clip(zeros, 0, 63).astype(np.uint64)
        after_first_one = (least << zeros) << np.uint64(1)
        return ((zeros << np.uint64(MANTISSA_BITS)) | (after_first_one >> np.uint64(64 - MANTISSA_BITS))).astype(">u2")


def chance_of_collision(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How likely registers of disjoint sets of n and m shingles are equal: same zeros, same mantissa."""
    zeros = np.arange(64)[:, None]

    def share(size):
        return (1 - 2.0 ** -(zeros + 1)) ** size - (1 - 2.0**-zeros) ** size

    return (share(n) * share(m)).sum(axis=0) * 2.0**-MANTISSA_BITS


def estimate(equal_share: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of equal registers, without what collisions add."""
    chance = chance_of_collision(n, m)
    return np.clip((equal_share - chance) / (1 - chance), 0, 1)


def signatures(docs: DataFrame, words: int, registers: int) -> DataFrame:
    """(doc_id, text_hash, n, digest, signature) per document; digest and signature are null for an empty set."""
    ship(docs.sparkSession)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, hashed = hash_memo(), Registers(registers)
        for batch in batches:
            sizes, digests, signed = [], [], []
            for text in batch.column("text").to_pylist():
                found = shingle_hashes(text, words, memo)
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                signed.append(hashed(found).tobytes() if len(found) else None)
            columns = [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64())]
            columns += [pa.array(digests, pa.binary()), pa.array(signed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n", "digest", "signature"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(docs["text"]).alias("text_hash"), docs["text"].alias("text"))
    return rows.mapInArrow(sign, "doc_id long, text_hash long, n long, digest binary, signature binary")


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(digest, shingles) per document with words; rows of one set in one task are one row mostly."""
    ship(docs.sparkSession)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, seen = hash_memo(), Memo(lambda digest: True)
        for batch in batches:
            texts = batch.column("text")
            for i in range(0, len(texts), 500):
                digests, found = [], []
                for text in texts.slice(i, 500).to_pylist():
                    x = shingle_hashes(text, words, memo)
                    digest = hashlib.blake2b(x.tobytes(), digest_size=16).digest()
                    if len(x) and digest not in seen and seen[digest]:
                        digests.append(digest)
                        found.append(x)
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                values = pa.array(np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64))
                columns = [pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), values)]
                yield pa.RecordBatch.from_arrays(columns, names=["digest", "shingles"])

    return docs.select(docs["text"].alias("text")).mapInArrow(gather, "digest binary, shingles array<long>")


class Block:
    """Registers and sets of some classes, against which those of others are held."""

    def __init__(self, registers: int, percent: int):
        self.registers, self.percent = registers, percent
        self.least = percent / 100 - SLACK * math.sqrt(percent / 100 * (1 - percent / 100) / registers)
        self.places, self.signed, self.sets, self.stacked = {}, [], [], None

    def add(self, rep: int, signature: bytes, shingles: np.ndarray) -> None:
        if rep not in self.places:
            self.places[rep] = len(self.sets)
            self.signed.append(np.frombuffer(signature, np.uint16))
            self.sets.append(shingles)

    def measure(self, signature: bytes, shingles: np.ndarray, others: list[int], whole: bool) -> Iterator[tuple]:
        """(rep, set size, size of the intersection, whether it is likely, extra, missing) of `others`; only likely ones if not `whole`.

        The sizes alone rule a pair out if the smaller set, inside the larger one, is too small; then the estimate does.
        """
        if self.stacked is None:
            self.stacked = np.stack(self.signed), np.array([len(x) for x in self.sets])
        signed, sizes = self.stacked
        at, n = np.array([self.places[rep] for rep in others]), len(shingles)
        fits = np.minimum(sizes[at], n) * 100 >= np.maximum(sizes[at], n) * self.percent
        equal = (signed[at] == np.frombuffer(signature, np.uint16)).mean(axis=1)
        likely = fits & (estimate(equal, sizes[at].astype(float), np.full(len(at), float(n))) >= self.least)
        for rep, place, may in zip(others, at.tolist(), likely.tolist()):
            if not (may or whole):
                continue
            other = self.sets[place]
            same = shingles[np.minimum(np.searchsorted(shingles, other), n - 1)] == other
            if whole:
                lost = other[np.minimum(np.searchsorted(other, shingles), len(other) - 1)] != shingles
                yield rep, len(other), int(same.sum()), may, other[~same].view(np.int64), shingles[lost].view(np.int64)
            else:
                yield rep, len(other), int(same.sum()), may, None, None


def measured(pairs: DataFrame, full: DataFrame, registers: int, percent: int, blocks: int, whole: bool = False) -> DataFrame:
    """(a, b, na, nb, both, likely, extra, missing) of `pairs` (a, b): `both` is the exact size of the intersection.

    Only pairs that the estimate takes for likely are measured.  With `whole` all are, and a's differences from b are listed:
    the shingles that only a has (`extra`) and those that only b has (`missing`).

    `full` is (rep, signature, shingles).  Class a lies in a block; b visits the blocks of its partners with its set, once
    each, so no more than blocks * classes sets are shuffled, however many pairs there are.  Of a class with many partners
    the others should be the a.
    """
    block = F.pmod(F.xxhash64("a"), F.lit(blocks)).cast("int").alias("block")
    pairs = checkpointed(pairs.select("a", "b", block))
    asked = pairs.groupBy("b", "block").agg(F.collect_list("a").alias("others"))  # no more than a block's classes
    visits = asked.join(full.withColumnRenamed("rep", "b"), "b").select("block", F.lit(1).alias("visit"), F.col("b").alias("rep"), "signature", "shingles", "others")
    homes = full.join(pairs.select(F.col("a").alias("rep"), "block").distinct(), "rep")
    homes = homes.select("block", F.lit(0).alias("visit"), "rep", "signature", "shingles", F.array().cast("array<long>").alias("others"))
    rows = homes.union(visits).repartition(blocks, "block").sortWithinPartitions("block", "visit")
    kinds = [pa.int64()] * 5 + [pa.bool_()] + [pa.list_(pa.int64())] * 2
    names = ["a", "b", "na", "nb", "both", "likely", "extra", "missing"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, Block(registers, percent)
        for batch in batches:
            of, visit, reps, signed = (batch.column(k).to_pylist() for k in range(4))
            starts, values = batch.column(4).offsets.to_numpy(), batch.column(4).values.to_numpy().view(np.uint64)
            out = []
            for i, others in enumerate(batch.column(5).to_pylist()):
                if of[i] != last:
                    last, held = of[i], Block(registers, percent)
                shingles = values[starts[i] : starts[i + 1]]
                if visit[i]:
                    found = held.measure(signed[i], shingles, others, whole)
                    out += [(a, reps[i], na, len(shingles), both, *rest) for a, na, both, *rest in found]
                else:
                    held.add(reps[i], signed[i], shingles.copy())
            columns = list(zip(*out)) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

    made = "a long, b long, na long, nb long, both long, likely boolean, extra array<long>, missing array<long>"
    return rows.mapInArrow(compare, made)


def linked(pairs: DataFrame, percent: int) -> DataFrame:
    """The measured pairs that reach the threshold."""
    return pairs.where("likely").where(_reaches(percent)).select("a", "b")


def _reaches(percent: int) -> Column:
    return F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, miss: float = 1e-6) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of `docs`: documents are linked if 100 * intersection >= percent * union.

    component_id is the least doc_id that can be reached over links, the document's own included.
    """
    return _grouped(docs, words, percent, miss).select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


#: Bytes of registers and sets that one block holds.
_BLOCK_BYTES = 24 << 20


def _grouped(docs: DataFrame, words: int, percent: int, miss: float = 1e-6) -> DataFrame:
    """(doc_id, text_hash, digest, n_shingles, component, component_id) per row; the last two are null without a class with ids.

    Classes are told apart by a hash of their digest, `rep`, as rows of one doc_id may be of several classes.
    """
    spark = docs.sparkSession
    bands = bands_for(percent, miss=miss)
    registers = bands * ROWS
    signed = checkpointed(signatures(docs, words, registers))

    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))).alias("first")
    classes = signed.where("digest is not null").groupBy("digest", "n", "signature").agg(first).where("first is not null")
    classes = checkpointed(classes.select(F.xxhash64("digest").alias("rep"), "digest", "n", "signature", "first.*"))
    width = 2 * ROWS
    key = F.xxhash64("band", F.expr(f"substring(signature, band * {width} + 1, {width})")).alias("key")
    keyed = classes.select("rep", "n", "signature", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band")).select("rep", "n", key)
    shared = checkpointed(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    members = checkpointed(keyed.join(shared, "key"))

    weights = checkpointed(members.groupBy("rep").agg(F.sum("size").alias("weight")))  # classes that share a key
    full = checkpointed(_full(docs, classes, weights, words))
    total = full.agg(F.sum(F.size("shingles").cast("long") * 8 + 2 * registers + 200)).first()[0] or 0
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // _BLOCK_BYTES + 1)

    weighted = members.select("key", "rep").join(weights, "rep")
    hubs = checkpointed(weighted.groupBy("key").agg(F.max(F.struct("weight", (-F.col("rep")).alias("of"))).alias("hub")))
    hubs = hubs.select("key", (-F.col("hub.of")).alias("b"))
    pairs = members.select("key", F.col("rep").alias("a")).join(hubs, "key").where("a <> b").select("a", "b").distinct()
    to_hub = checkpointed(measured(pairs, full, registers, percent, blocks, whole=True))
    edges = checkpointed(linked(to_hub, percent))
    labels = checkpointed(components(edges))

    pairs = checkpointed(_across(members, hubs, to_hub, full, labels, percent))
    if not pairs.isEmpty():
        more = checkpointed(linked(measured(_lesser_first(pairs), full, registers, percent, blocks), percent))
        if not more.isEmpty():
            labels = components(labels.toDF("a", "b").union(more))
    roots = classes.select("digest", "rep", "doc_id").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    roots = checkpointed(roots)
    least = roots.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    roots = roots.join(least, "component", "left").select(
        "digest", F.coalesce("component", "rep").alias("component"), F.coalesce("least", "doc_id").alias("component_id")
    )
    return signed.select("doc_id", "text_hash", "digest", F.col("n").alias("n_shingles")).join(roots, "digest", "left").select(
        "doc_id", "text_hash", "digest", "n_shingles", "component", "component_id"
    )


def _full(docs: DataFrame, classes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(rep, signature, shingles) of the wanted classes, from the text of one document each.

    A Bloom filter of these documents keeps most other texts out; what passes by mistake goes with the join.
    """
    found = classes.join(wanted.select("rep"), "rep", "left_semi")
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    wanted = KeyFilter.of(found.select(F.xxhash64("doc_id", "text_hash").alias("key")))
    some = wanted.mark(texts, F.xxhash64("doc_id", F.xxhash64("text"))).where("__maybe")
    sets = shingle_sets(some, words).select(F.xxhash64("digest").alias("rep"), "shingles")
    return found.select("rep", "signature").join(sets, "rep").dropDuplicates(["rep"])


def _lesser_first(pairs: DataFrame) -> DataFrame:
    """The pairs (a, b), turned so that a is the class in fewer of them."""
    degrees = checkpointed(pairs.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("of")))
    both = pairs.join(degrees.select(F.col("rep").alias("a"), F.col("of").alias("na")), "a")
    both = both.join(degrees.select(F.col("rep").alias("b"), F.col("of").alias("nb")), "b")
    turned = F.struct("na", "a") > F.struct("nb", "b")
    return both.select(F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"))


def _across(members: DataFrame, hubs: DataFrame, to_hub: DataFrame, full: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes that share a key but no component yet, and may reach the threshold.

    First, shingles that a class has alone among the classes in question are in no intersection, which rules some classes out.

    For the others let d be the number of differences from the key's hub: x shingles that the hub hasn't and m that only it has.
    Two classes differ in da + db - 2 * o shingles, o being their common differences, and may differ in (an + bn) * c with
    c = (100 - percent) / (100 + percent).  A class a that isn't linked with the hub has da > (an + hn) * c.  So for any b
    o > (db + (mb - xb) * c) / 2; with `needed` for the least such o, one of the first db - needed + 1 differences of b, in
    whatever order is common to all, is one of a's.  The order is from rare to frequent.  And if the first common one has the
    places i and j in this order, o is 1 + min(da - i, db - j) at most.
    """
    placed = members.select("key", "rep", "n").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    placed = checkpointed(placed.select("key", "rep", "n", F.coalesce("component", "rep").alias("component")))
    left = checkpointed(placed.join(_mixed_keys(placed), "key"))
    own = full.join(left.select("rep"), "rep", "left_semi").select("rep", F.explode("shingles").alias("shingle"))
    own = own.groupBy("shingle").agg(F.min("rep").alias("rep"), F.max("rep").alias("other")).where("rep = other")
    own = own.groupBy("rep").agg(F.count(F.lit(1)).alias("own"))
    able = left.join(own, "rep", "left").withColumn("most", F.col("n") - F.coalesce("own", F.lit(0)))
    able = able.where(F.col("most") * 100 >= F.col("n") * percent).join(hubs.withColumnRenamed("b", "hub"), "key")
    able = able.select("hub", "rep", "component", "n", "most").distinct()

    known = to_hub.select(
        F.col("a").alias("rep"), F.col("b").alias("hub"), F.concat("extra", "missing").alias("differences"),
        F.size("extra").cast("long").alias("x"), F.size("missing").cast("long").alias("m"), (F.col("likely") & _reaches(percent)).alias("near"),
    )
    able = able.join(known, ["rep", "hub"]).withColumn("d", F.col("x") + F.col("m"))
    told = checkpointed(able.select("hub", "rep", "component", "n", "most", "x", "m", "d", "near", F.explode("differences").alias("shingle")))
    common = told.groupBy("hub", "shingle").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    told = told.join(common, ["hub", "shingle"])
    # Differences that no other class has come first; they match nothing and are counted only.
    of_one = Window.partitionBy("hub", "rep")
    place = F.col("d") - F.count(F.lit(1)).over(of_one) + F.row_number().over(of_one.orderBy("often", "shingle"))
    needed = F.floor((F.col("x") * percent + F.col("m") * 100) / (100 + percent)) + 1
    told = checkpointed(told.select("*", place.alias("place"), (F.col("d") - needed + 1).alias("first")).drop("often", "x", "m"))

    a = told.where(~F.col("near")).select("hub", "shingle", *[F.col(c).alias(f"a{c}") for c in ("rep", "component", "n", "most", "d", "place")])
    b = told.where("place <= first").select("hub", "shingle", *[F.col(c).alias(f"b{c}") for c in ("rep", "component", "n", "most", "d", "place")])
    room = 1 + F.least(F.col("ad") - F.col("aplace"), F.col("bd") - F.col("bplace"))
    close = (F.col("ad") + F.col("bd") - 2 * room) * (100 + percent) <= (F.col("an") + F.col("bn")) * (100 - percent)
    most = F.least("amost", "bmost")
    reachable = most * 100 >= (F.col("an") + F.col("bn") - most) * percent
    same = (a["hub"] == b["hub"]) & (a["shingle"] == b["shingle"])
    pairs = a.join(b, same & (F.col("acomponent") != F.col("bcomponent")) & reachable & close)
    return pairs.select(F.least("arep", "brep").alias("a"), F.greatest("arep", "brep").alias("b")).distinct()


def _mixed_keys(placed: DataFrame) -> DataFrame:
    """Keys whose classes belong to more than one component."""
    ends = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return ends.where("low < high").select("key")


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents, with all their columns, of which one stays for each group: that of the least doc_id.

    Rows of one doc_id may have several texts, each with a group of its own; of rows equal in doc_id and text one stays.  Of rows
    without a doc_id one stays for each set that no row with one has, and for each text without words.

    Rows that go, and repeated ones, are few or at least not all: a Bloom filter of them lets the others stay where they are.
    """
    rows = checkpointed(_grouped(docs, words, percent).select("doc_id", "text_hash", "digest", "component"))
    wordless = F.col("digest").isNull()
    group = [
        F.col("component"), F.when(F.col("component").isNull(), F.col("digest")).alias("set"),
        F.when(wordless, F.col("doc_id")).alias("id"), F.when(wordless, F.col("text_hash")).alias("hash"),
    ]
    able = rows.where("doc_id is not null or component is null")
    kept = able.groupBy(*group).agg(F.min(F.struct("doc_id", "text_hash")).alias("kept")).select("kept.*").distinct()
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("text_hash").alias("kept_hash"), F.lit(True).alias("stays"))
    counted = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash"))
    named = counted.join(kept, same, "left").where("stays is null or copies > 1")
    named = checkpointed(named.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("stays").isNotNull().alias("__stays")))

    hashed = docs.withColumn("__text_hash", F.xxhash64(docs["text"]))
    marked = KeyFilter.of(named.select(F.xxhash64("__id", "__hash").alias("key"))).mark(
        hashed, F.xxhash64(F.col("doc_id").cast("long"), "__text_hash")
    )
    passing = marked.where("__maybe")
    same = passing["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (passing["__text_hash"] == F.col("__hash"))
    some = passing.join(named, same, "left").where(F.coalesce("__stays", F.lit(True)))
    some = some.dropDuplicates(["doc_id", "__text_hash"]).select(*hashed.columns)
    return marked.where("NOT __maybe").select(*hashed.columns).union(some).drop("__text_hash")
