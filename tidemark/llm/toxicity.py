"""Toxicity by a factorization machine over hashed terms.

Terms are hashed to a fixed number of buckets. A document's score adds a weight
per bucket it holds and, for every pair of them, the product of two short factor
vectors, so a pair can count for more than its parts, as an insult beside the
mention of a group does.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidemark.llm.common import column_like, lean_batches, smallest_hashes
from tidemark.llm.hashing import byte_class, word_hashes

#: Buckets are 2**BUCKET_BITS; factor vectors have FACTORS entries.
BUCKET_BITS, FACTORS = 18, 4
#: Bounds of the training sample: labelled documents, and their distinct buckets in all.
SAMPLE_DOCS, SAMPLE_TERMS = 6000, 12_000_000
#: Words give terms, and so do the heads of so many bytes of longer words: a stem
#: counts whatever its ending.
HEADS = (4, 5, 6)
#: Buckets in fewer sample documents than this have no weight; in a smaller share, no
#: factors unless they tell the labels apart by themselves.
RARE, COMMON = 3, 0.05
#: Steps of training, and standard deviations of chance that a weight must beat.
STEPS, CHANCE = 100, 3.0
#: Deviations of chance that a bucket must beat on its own to be looked at, if not common.
SCREEN = 2.0
#: Letters and digits make terms; all else parts them.
_TERM = byte_class(b"abcdefghijklmnopqrstuvwxyz0123456789")


def terms(text: str | None) -> np.ndarray:
    """The distinct buckets of a whole text."""
    hashes = word_hashes(text, _TERM, heads=HEADS)
    return np.unique((hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int32))


@dataclass
class Machine:
    """A trained machine: weights and factors of the buckets that have any."""

    bias: float
    buckets: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        weights = np.zeros(1 << BUCKET_BITS)
        factors = np.zeros((1 << BUCKET_BITS, FACTORS))
        weights[self.buckets], factors[self.buckets] = self.weights, self.factors
        return weights, factors

    def margin(self, held: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> float:
        weights, factors = tables
        own = factors[held]
        pairs = ((own.sum(axis=0) ** 2) - (own**2).sum(axis=0)).sum() / 2
        return float(self.bias + weights[held].sum() + pairs)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class _Fit:
    """Full-batch training by Adam; what does not beat chance shrinks to exactly 0.

    In the last part the weights that are left are trained on with hardly any
    shrinkage, so that they are not too small for having been selected.
    """

    def __init__(self, rows: list[np.ndarray], labels: np.ndarray) -> None:
        self.labels, self.n = labels, len(rows)
        flat = np.concatenate(rows)
        row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        counts = np.bincount(flat, minlength=1 << BUCKET_BITS)
        rate = (labels.sum() + 1) / (self.n + 2)
        chance = np.sqrt(counts * rate * (1 - rate))
        excess = np.bincount(flat, (labels - rate)[row], minlength=1 << BUCKET_BITS)
        kept = (np.abs(excess) >= SCREEN * chance) | (counts >= COMMON * self.n)
        self.buckets = np.flatnonzero(kept & (counts >= RARE))
        place = np.full(1 << BUCKET_BITS, -1, dtype=np.int64)
        place[self.buckets] = np.arange(len(self.buckets))
        col = place[flat]
        self.col, self.row, self.m = col[col >= 0], row[col >= 0], len(self.buckets)
        self.shrink = CHANCE * chance[self.buckets] / self.n
        self.bias = float(np.log(rate / (1 - rate)))
        self.w = np.zeros(self.m)
        self.v = np.random.default_rng(7).normal(0, 0.02, (self.m, FACTORS))

    def _margins(self) -> tuple[np.ndarray, np.ndarray]:
        sums = np.stack(
            [np.bincount(self.row, self.v[self.col, f], self.n) for f in range(FACTORS)], axis=1
        )
        squares = np.bincount(self.row, (self.v**2).sum(axis=1)[self.col], self.n)
        linear = np.bincount(self.row, self.w[self.col], self.n)
        return self.bias + linear + ((sums**2).sum(axis=1) - squares) / 2, sums

    def run(self, train: np.ndarray) -> None:
        """Trains on the marked rows, and keeps the step that does best on the others."""
        values = [np.array(self.bias), self.w, self.v]
        first, second = ([np.zeros_like(v) for v in values] for _ in range(2))
        held = ~train if (~train).any() else train
        best, kept = np.inf, (self.bias, self.w, self.v)
        for step in range(1, STEPS + 1):
            margins, sums = self._margins()
            p = np.clip(_logistic(margins), 1e-9, 1 - 1e-9)
            loss = -np.mean(np.where(self.labels[held] > 0, np.log(p[held]), np.log(1 - p[held])))
            if loss < best:
                best, kept = loss, (self.bias, self.w.copy(), self.v.copy())
            g = (p - self.labels) * train / train.sum()
            each = np.bincount(self.col, g[self.row], self.m)
            cross = np.stack(
                [np.bincount(self.col, (g * sums[:, f])[self.row], self.m) for f in range(FACTORS)],
                axis=1,
            )
            grads = [np.array(g.sum()), each, cross - self.v * each[:, None]]
            moves, speeds = [], []
            for i, (grad, rate) in enumerate(zip(grads, (0.1, 0.2, 0.01), strict=True)):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.98 * second[i] + 0.02 * grad**2
                speeds.append(rate / (np.sqrt(second[i] / (1 - 0.98**step)) + 1e-6))
                moves.append(speeds[-1] * first[i] / (1 - 0.9**step))
            late = step > 0.6 * STEPS
            self.bias -= float(moves[0])
            shrink = self.shrink * (0.05 if late else 1)
            moved = self.w - moves[1]
            fresh = np.sign(moved) * np.maximum(np.abs(moved) - speeds[1] * shrink, 0)
            self.w = np.where(self.w == 0, 0, fresh) if late else fresh
            moved = self.v - moves[2]
            spread = np.sqrt((sums**2).mean())
            length = np.sqrt((moved**2).sum(axis=1)) + 1e-12
            cut = speeds[2].mean(axis=1) * self.shrink * spread
            self.v = moved * np.maximum(0, 1 - cut / length)[:, None]
        self.bias, self.w, self.v = kept


def fit(rows: list[np.ndarray], labels: list[int]) -> Machine:
    """A machine for these documents; the rate of label 1 alone if there is but one label."""
    y = np.array(labels, dtype=np.float64)
    if not rows or y.min() == y.max() or not any(map(len, rows)):
        rate = (y.sum() + 1) / (len(y) + 2)
        none = np.zeros((0, FACTORS))
        return Machine(float(np.log(rate / (1 - rate))), np.zeros(0, np.int64), none[:, 0], none)
    work = _Fit(rows, y)
    work.run(np.arange(len(rows)) % 5 != 0)
    used = (work.w != 0) | (np.abs(work.v) > 0).any(axis=1)
    return Machine(work.bias, work.buckets[used], work.w[used], work.v[used])


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learnt from."""
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    return F.coalesce(crc % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """A machine for ``labels.toxic``, from a bounded sample of labelled documents.

    The sample are the SAMPLE_DOCS labelled ids with the smallest hashes that are
    not held out, as far as they hold SAMPLE_TERMS buckets in all. Only their
    bucket sets come to the driver. An id with several labels counts as toxic if
    one of them says so.
    """
    lean_batches(docs.sparkSession)
    labelled = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .withColumn("h", F.xxhash64("doc_id"))
    )
    picked = smallest_hashes(labelled, "h", SAMPLE_DOCS).drop("h")

    def bucketed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["terms"] = [terms(t) for t in batch["text"]]
            yield batch[["doc_id", "toxic", "terms"]]

    id_type = docs.schema["doc_id"].dataType.simpleString()
    sample = (
        docs.select("doc_id", "text")
        .join(F.broadcast(picked), "doc_id")
        .select("doc_id", F.col("toxic").cast("int").alias("toxic"), "text")
        .mapInPandas(bucketed, f"doc_id {id_type}, toxic int, terms array<int>")
        .orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("terms"))
    )
    rows, marks, total = [], [], 0
    for r in sample.limit(SAMPLE_DOCS).toLocalIterator():
        total += len(r["terms"])
        if total > SAMPLE_TERMS:
            break
        rows.append(np.array(r["terms"], dtype=np.int64))
        marks.append(int(r["toxic"] > 0))
    return fit(rows, marks)


def score(docs: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    """``docs`` with the probability that a text is toxic, from its whole text alone.

    NULL, empty and blank texts hold no bucket and get the machine's bias. Equal
    texts get equal scores.
    """
    lean_batches(docs.sparkSession)

    @F.pandas_udf(DoubleType())
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tables = machine.tables()
        for texts in batches:
            margins = np.array([machine.margin(terms(t), tables) for t in texts])
            yield pd.Series(_logistic(margins))

    return docs.withColumn(name, probability("text"))


def flag(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """``docs`` with held_out, score and predicted (1 from ``threshold`` on).

    Labels, language, source and id are no inputs of the score. An empty table
    gives no rows; without labels every row gets the score 0.5. Names that clash
    with columns of ``docs`` get an underscore.
    """
    held, points, predicted = (
        column_like(n, docs.columns) for n in ("held_out", "score", "predicted")
    )
    scored = score(docs, train(docs, labels), points)
    return scored.withColumn(held, held_out(F.col("doc_id"))).withColumn(
        predicted, (F.col(points) >= threshold).cast("int")
    )


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Rows of ``docs`` whose score is below ``threshold``; a NULL text stays if that is.

    All rows stay where nothing was learnt that tells one text from another: without
    usable labels, or with one label only.
    """
    machine = train(docs, labels)
    if not len(machine.buckets):
        return docs
    points = column_like("score", docs.columns)
    return score(docs, machine, points).where(F.col(points) < threshold).select(*docs.columns)
