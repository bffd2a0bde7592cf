"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; unlabelled text, toxic or not, is all the learner sees besides.  With the share
`prior` of toxic text the risk of a classifier g is estimated from these two samples alone,

    R(g) = prior * R_p(g, +1) + max(0, R_u(g, -1) - prior * R_p(g, -1)),

where the bracket is the risk on non-toxic text and can't be negative (if it is estimated so, the step goes uphill there).
g is linear in the presence of features: words in lower case and their first 4, 5 and 6 letters, hashed.

Spark counts all features over all positives and all documents outside the held-out fold and selects those that tell
(`margin`, `support` and `features` of train()).  Only the fit has bounded samples: about `max_positive` labelled and `max_unlabelled` other documents by a hash of doc_id, whole
texts.  The driver gets the selected features and, per sampled document, which of them it has, and the fit (numpy) takes
seconds at any size of the corpus.  Every document is scored, where it lies.

Cases: an empty, null or wordless text scores sigmoid(bias), as text without evidence; without any positive label every
score is 0; several labels of a doc_id count as toxic if one is; null labels don't count; repeated rows are scored each.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.llm.common import KeyFilter, Memo, checkpointed, ship

_WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
#: Size of the hashed feature space.
SPACE = 1 << 20


def fold(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 5; 0 is held out.  A null doc_id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5


def features_of(word: str) -> tuple[int, ...]:
    parts = [f"w:{word}", *(f"{k}:{word[:k]}" for k in PREFIXES if len(word) >= k)]
    return tuple(zlib.crc32(part.encode()) % SPACE for part in parts)


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall(text.lower())) if text else set()


@dataclass
class Model:
    """Weights of features, by number; all other features weigh nothing."""

    bias: float = 0.0
    weights: dict[int, float] = field(default_factory=dict)
    trained: bool = False

    def scorer(self):
        weights = self.weights
        known = Memo(lambda word: tuple(f for f in features_of(word) if f in weights))

        def score(text: str | None) -> float:
            if not self.trained:
                return 0.0
            found = set().union(*filter(None, map(known.__getitem__, words_of(text))))
            z = self.bias + sum(weights[f] for f in sorted(found))
            return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))

        return score


class _Matrix:
    """Presence of features by document, as row and column numbers."""

    def __init__(self, rows: list[np.ndarray], size: int):
        self.n, self.size = len(rows), size
        self.columns = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
        self.rows = np.repeat(np.arange(self.n), [len(x) for x in rows])

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.columns], self.n)

    def back(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.columns, errors[self.rows], self.size)


def fit(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], kept: np.ndarray, prior: float, steps: int = 300, l2: float = 2e-4
) -> Model:
    """A model by Adam on the whole risk; deterministic.  Rows hold places in `kept`, the features' numbers."""
    if not positive or not unlabelled:
        return Model()
    p, u = _Matrix(positive, len(kept)), _Matrix(unlabelled, len(kept))
    w, bias = np.zeros(len(kept)), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, steps + 1):
        sp, su = (1 / (1 + np.exp(-np.clip(m.dot(w) + bias, -50, 50))) for m in (p, u))
        # Logistic loss: its slope for label +1 is s - 1, for label -1 it is s.
        negative = np.mean(np.logaddexp(0, u.dot(w) + bias)) - prior * np.mean(np.logaddexp(0, p.dot(w) + bias))
        if negative >= 0:
            ep, eu = (prior * (sp - 1) - prior * sp) / p.n, su / u.n
        else:
            ep, eu = prior * sp / p.n, -su / u.n
        slope = np.append(p.back(ep) + u.back(eu) + l2 * w, ep.sum() + eu.sum())
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return Model(float(bias), {int(k): float(x) for k, x in zip(kept, w) if abs(x) > 1e-6}, True)


def train(
    docs: DataFrame, labels: DataFrame, max_positive: int = 4000, max_unlabelled: int = 8000, prior: float | None = None,
    margin: float = 5.0, support: int = 3, features: int = SPACE,
) -> Model:
    """Fits on rows outside the held-out fold.

    `prior` is the share of toxic text; by default the share of toxic among the labelled rows, between 0.01 and 0.5, or
    0.1 if all of them are toxic.  A feature may weigh if at least `support` positives have it, and more of them than chance
    explains by `margin` standard deviations; of these the `features` most telling ones do (by default all of them).
    """
    ship(docs.sparkSession)
    known = labels.where(fold(labels["doc_id"]) != 0).groupBy(labels["doc_id"].alias("id")).agg(F.max("toxic").alias("toxic"))
    known = checkpointed(known.where("toxic is not null"))
    labelled, toxic = known.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("toxic").cast("long")), F.lit(0))).first()
    if not toxic:
        return Model()
    if prior is None:
        prior = 0.1 if toxic == labelled else min(max(toxic / labelled, 0.01), 0.5)

    def sampled(doc_id: Column, most: int, of: int) -> Column:
        return F.pmod(F.xxhash64(doc_id.cast("string")), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, most / max(of, 1))))

    every = known.where("toxic = 1").select("id")
    # At most about max_positive ids: a bounded table for every task.
    chosen = every.where(sampled(F.col("id"), max_positive, toxic))
    texts = docs.where(fold(docs["doc_id"]) != 0).select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    of_all = sampled(F.col("doc_id"), max_unlabelled, docs.count())
    rows = texts.join(F.broadcast(chosen.withColumn("positive", F.lit(True))), F.col("doc_id") == F.col("id"), "left")
    rows = rows.select("text", F.col("positive").isNotNull().alias("positive"), of_all.alias("unlabelled"), F.xxhash64("doc_id").alias("at"))
    rows = rows.where("positive or unlabelled").mapInArrow(_features, "at long, positive boolean, unlabelled boolean, features array<int>")
    rows = checkpointed(rows)  # as many rows as the samples have, without texts
    kept = _telling(texts, every, margin, support, features)
    samples = _samples(rows, kept, {"positive": 2 * max_positive, "unlabelled": 2 * max_unlabelled})
    return fit(samples["positive"], samples["unlabelled"], kept, prior)


def feature_counts(texts: DataFrame, positives: DataFrame) -> DataFrame:
    """(feature, p, u): how many documents of `texts` have a feature, and how many of those whose id is in `positives`.

    Feature SPACE counts the documents.  All are counted where they lie, a task's before they are shuffled.  Of the texts only
    those that a Bloom filter of the positive ids lets through go through the join that tells which ones are positive.
    """
    known = KeyFilter.of(positives.select(F.xxhash64(F.col("id").cast("string")).alias("key")))
    some = known.mark(texts, F.xxhash64(F.col("doc_id").cast("string"))).where("__maybe")
    toxic = some.join(positives, F.col("doc_id") == F.col("id"), "left_semi")
    u = texts.select("text").mapInArrow(_counts, "feature long, n long").select("feature", F.lit(0).cast("long").alias("p"), F.col("n").alias("u"))
    p = toxic.select("text").mapInArrow(_counts, "feature long, n long").select("feature", F.col("n").alias("p"), F.lit(0).cast("long").alias("u"))
    return u.union(p).groupBy("feature").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def _telling(texts: DataFrame, positives: DataFrame, margin: float, support: int, most: int) -> np.ndarray:
    """Features that positives have more often than chance explains; what positives lack is no evidence against them."""
    counts = checkpointed(feature_counts(texts, positives))
    totals = counts.where(F.col("feature") == SPACE).first()
    if totals is None:
        return np.empty(0, np.int64)
    counts = counts.where(F.col("feature") < SPACE)
    expected = F.lit(totals["p"]) * (F.col("u") + 0.5) / F.lit(totals["u"] + 1)
    gain = ((F.col("p") - expected) / F.sqrt(expected)).alias("gain")
    best = counts.where(F.col("p") >= support).select("feature", gain).where(F.col("gain") >= margin)
    return np.sort(np.array([row[0] for row in best.orderBy(F.desc("gain"), "feature").limit(most).collect()], np.int64))


def _samples(rows: DataFrame, kept: np.ndarray, most: dict[str, int]) -> dict[str, list[np.ndarray]]:
    """The samples as places in `kept`: a few numbers per row."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.flatnonzero(np.isin(kept, np.asarray(x))).astype(np.int32) for x in batch.column("features").to_pylist()]
            columns = [batch.column(name) for name in ("at", "positive", "unlabelled")] + [pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["at", "positive", "unlabelled", "features"])

    # Ordered by a hash and by content, so that the fit doesn't depend on the order of tasks.
    found = sorted((tuple(row) for row in rows.mapInArrow(places, rows.schema).collect()), key=lambda row: (row[0], row[3]))
    return {
        name: [np.array(row[3], np.int64) for row in found if row[k]][: most[name]] for k, name in ((1, "positive"), (2, "unlabelled"))
    }


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents a feature occurs; as feature SPACE, how many there are."""
    memo = Memo(features_of)
    n = np.zeros(SPACE + 1, np.int64)
    for batch in batches:
        for text in batch.column("text").to_pylist():
            found = set().union(*map(memo.__getitem__, words_of(text)), (SPACE,))
            n[np.fromiter(found, np.int64, len(found))] += 1
    some = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["feature", "n"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = Memo(features_of)
    for batch in batches:
        found = [
            np.unique(np.fromiter((f for word in words_of(text) for f in memo[word]), np.int32))
            for text in batch.column("text").to_pylist()
        ]
        columns = [batch.column(name) for name in ("at", "positive", "unlabelled")] + [pa.array(found, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, names=["at", "positive", "unlabelled", "features"])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """Every document's columns in `row`, and its score; the text is read where it lies and not carried on."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights, model.trained))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Model(*shared.value).scorer()
        for batch in batches:
            scores = [scorer(text) for text in pc.struct_field(batch.column("row"), "text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64())], names=["row", "score"])

    row = F.struct(*[docs[name].alias(name) for name in docs.columns]).alias("row")
    return docs.select(row).mapInArrow(score, f"row {docs.schema.simpleString()}, score double")


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents, with all their columns, whose score is below the threshold."""
    kept = scored(docs, train(docs, labels)).where(F.col("score") < threshold)
    return kept.select(*[F.col("row")[name].alias(name) for name in docs.columns])
