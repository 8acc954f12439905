"""MinHash near-dedup with odd sketches.

Every document's word shingles give MinHash samples. Bands of them make the keys
under which similar documents meet; folded into a parity bitmap, the samples make
an odd sketch, and the bits in which two sketches differ estimate their
similarity, most precisely where it is high. Candidates that the estimate leaves
are confirmed on their full shingle sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemark.llm.common import column_like, keyed, lean_batches, small_or_shuffled, smallest_hashes
from tidemark.llm.graph import components
from tidemark.llm.hashing import U, mixed, seeds, shingle_set, word_hashes
from tidemark.session import materialised

#: MinHash samples, and how many of them make a band. Two documents at similarity
#: 0.8 share none of the 32 bands with a probability of (1 - 0.8**4)**32 = 5e-8.
SAMPLES, BAND = 128, 4
#: Bits of a sketch.
BITS = 512
#: Standard deviations that the estimate of a true link may be off.
SPREAD = 6.0
#: Documents under one key above which they are joined by rare shingles instead.
FEW = 48
#: Sets of a crowd that tell which shingles are common in it, and most such shingles.
SAMPLE_SETS, MOST_COMMON = 400, 100_000

_FACTORS = seeds(SAMPLES, 101) | U(1)
_TERMS = seeds(SAMPLES, 211)
_PLACES = seeds(SAMPLES, 307)
_BANDS = seeds(SAMPLES // BAND, 401)


def minhashes(shingles: np.ndarray) -> np.ndarray:
    """The smallest of SAMPLES hashes over a set."""
    least = np.full(SAMPLES, np.iinfo(np.uint64).max, dtype=U)
    for start in range(0, len(shingles), 2048):
        block = shingles[start : start + 2048, None] * _FACTORS + _TERMS
        np.minimum(least, block.min(axis=0), out=least)
    return mixed(least)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity of how many samples fall on each of BITS places, as 64-bit words."""
    places = (mixed(samples ^ _PLACES) >> U(64 - BITS.bit_length() + 1)).astype(np.int64)
    parity = (np.bincount(places, minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One key per band, which also tells the band."""
    bands = samples.reshape(-1, BAND) * (seeds(BAND, 503) | U(1))
    return mixed(bands.sum(axis=1, dtype=U) ^ _BANDS).view(np.int64)


def most_different_bits(similarity: float) -> int:
    """Bits in which sketches at ``similarity`` differ at most, SPREAD deviations off."""
    apart = SAMPLES * (1 - similarity)
    apart = min(SAMPLES, apart + SPREAD * math.sqrt(apart * similarity))
    mean = BITS * (1 - (1 - 2 / BITS) ** (2 * apart)) / 2
    return math.ceil(mean + SPREAD * math.sqrt(mean / 2))


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _signer(words: int):
    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                shingles = shingle_set(word_hashes(text), words)
                if not len(shingles):
                    rows.append((0, None, None, None))
                    continue
                samples = minhashes(shingles)
                rows.append(
                    (len(shingles), _digest(shingles), odd_sketch(samples), band_keys(samples))
                )
            signed = pd.DataFrame(rows, columns=["n_shingles", "digest", "sketch", "bands"])
            yield pd.concat([batch[["doc_id", "text_hash"]].reset_index(drop=True), signed], axis=1)

    return sign


def _setter(words: int):
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [shingle_set(word_hashes(text), words) for text in batch["text"]]
            yield pd.DataFrame(
                {"digest": [_digest(s) for s in found], "shingles": [s.view(np.int64) for s in found]}
            )

    return sets


@F.pandas_udf(LongType())
def _common(a: pd.Series, b: pd.Series) -> pd.Series:
    """Size of the intersection of two sorted sets."""
    return pd.Series(
        [
            len(np.intersect1d(x.view(U), y.view(U), assume_unique=True))
            for x, y in zip(a, b, strict=True)
        ],
        dtype="int64",
    )


def _sizes_allow(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The candidate (a, b) that reach the similarity: sketches first, then full sets."""
    marks = classes.select("class_id", "n", "sketch")
    left, right = (
        marks.select(
            F.col("class_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}")
        )
        for x in "ab"
    )
    bits = sum(
        (F.bit_count(F.col("s_a")[i].bitwiseXOR(F.col("s_b")[i])) for i in range(BITS // 64)),
        F.lit(0),
    )
    likely = materialised(
        pairs.join(left, "a")
        .join(right, "b")
        .where(_sizes_allow(F.col("n_a"), F.col("n_b"), percent))
        .where(bits <= most_different_bits(percent / 100))
        .select("a", "b")
    )
    held_a = sets.select(F.col("class_id").alias("a"), F.col("shingles").alias("x"))
    held_b = sets.select(F.col("class_id").alias("b"), F.col("shingles").alias("y"))
    both = (
        likely.join(held_a, "a")
        .join(held_b, "b")
        .select("a", "b", F.size("x").alias("n_x"), F.size("y").alias("n_y"), _common("x", "y").alias("both"))
    )
    union = F.col("n_x") + F.col("n_y") - F.col("both")
    return materialised(both.where(F.col("both") * 100 >= union * percent).select("a", "b"))


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(class_id, shingles) of the wanted classes, from the text of one document each."""
    wanted = materialised(
        classes.select("class_id", "digest", "text_hash").join(wanted, "class_id")
    )
    texts = docs.select("text_hash", "text").join(
        small_or_shuffled(wanted.select("text_hash").distinct(), 16), "text_hash", "left_semi"
    )
    found = texts.select("text").mapInPandas(_setter(words), "digest binary, shingles array<long>")
    return materialised(
        found.join(wanted.select("class_id", "digest"), "digest")
        .select("class_id", "shingles")
        .dropDuplicates(["class_id"])
    )


def _rare_pairs(crowd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidates among the classes of crowded keys: all that can reach the similarity.

    Shingles are in one fixed order, those that are common in the crowd last. Two
    sets at the similarity share one of the first (1 - similarity) of each, and
    where the first shared one stands bounds how much of both is left to share. So
    what a crowd has in common, a passage or a template, makes no candidates: it
    stands too far back in the sets that differ elsewhere. Any order gives all
    pairs; how common a shingle is comes from a bounded sample of the crowd.
    """
    held = materialised(sets.join(crowd, "class_id"))
    sample = smallest_hashes(
        held.select("shingles", F.xxhash64("class_id").alias("h")), "h", SAMPLE_SETS
    )
    often = (
        sample.select(F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("often"))
        .where("often > 1")
        .orderBy(F.col("often").desc(), "shingle")
        .limit(MOST_COMMON)
        .orderBy("shingle")
        .collect()
    )
    common = np.array([r["shingle"] for r in often], dtype=np.int64)
    counts = np.array([r["often"] for r in often], dtype=np.int64)

    def fronts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for class_id, root, shingles in zip(
                batch["class_id"], batch["root"], batch["shingles"], strict=True
            ):
                weight = np.zeros(len(shingles), dtype=np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
                    weight = np.where(common[at] == shingles, counts[at], 0)
                n = len(shingles)
                front = n - -(-n * percent // 100) + 1
                first = np.lexsort((shingles, weight))[:front]
                parts.append(pd.DataFrame({
                    "class_id": class_id, "root": root, "n": n, "place": np.arange(len(first)),
                    "shingle": shingles[first],
                }))
            if parts:
                yield pd.concat(parts)

    early = materialised(
        held.select("class_id", "root", "shingles").mapInPandas(
            fronts, "class_id long, root long, n long, place long, shingle long"
        )
    )
    mixed_keys = (
        early.groupBy("shingle")
        .agg(F.min("root").alias("r1"), F.max("root").alias("r2"))
        .where("r1 <> r2")
        .select("shingle")
    )
    early = early.join(mixed_keys, "shingle")
    a = early.select("shingle", *[F.col(c).alias(f"{c}_a") for c in ("class_id", "root", "n", "place")])
    b = early.select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("class_id", "root", "n", "place")])
    left = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    can = left * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    return (
        a.join(
            b,
            (a["shingle"] == b["shingle"])
            & (F.col("class_id_a") < F.col("class_id_b"))
            & (F.col("root_a") != F.col("root_b"))
            & can,
        )
        .select(F.col("class_id_a").alias("a"), F.col("class_id_b").alias("b"))
        .distinct()
    )


def _with_roots(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(class_id, root) of every class."""
    roots = components(links, "a", "b")
    return classes.select("class_id").join(
        roots, F.col("class_id") == F.col("node"), "left"
    ).select("class_id", F.coalesce("root", "class_id").alias("root"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of percent / 100.

    Returns one row per row of ``docs``: doc_id, text_hash
    (64 bits of the text), n_shingles, component_id (smallest doc_id that links
    reach, the own one included), kept (it is the own one).

    Documents with equal sets are one class, so a group of exact copies is one
    vertex. Links are found in two passes. First every class is held against the
    smallest class under each of its keys: a pair per row, which joins a group of
    near copies to the one they are copies of. Then only keys that still hold
    several components are looked at: where they hold few classes, pairs of
    different components; where they hold many, the classes go through a join on
    rare shingles (:func:`_rare_pairs`), which is exact. No key is dropped or
    capped, and no key's pairs are listed beyond FEW classes.

    Shingles are 64-bit hashes of ``words`` words, A-Z counting as a-z. Fewer
    words are one shingle. NULL, empty and blank texts have no shingles and link
    with nothing. A NULL doc_id is no smallest id, unless its component has no
    other: then component_id is NULL and kept true. Rows that share an id are
    linked by their texts alone. An empty table gives no rows.
    """
    lean_batches(docs.sparkSession)
    named = docs.select("doc_id", "text", F.xxhash64(keyed(F.col("text"))).alias("text_hash"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    signed = materialised(
        named.mapInPandas(
            _signer(words),
            f"doc_id {id_type}, text_hash long, n_shingles long, digest binary, "
            "sketch array<long>, bands array<long>",
        )
    )
    classes = materialised(
        signed.where("digest is not null")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("least_id"),
            F.first("text_hash").alias("text_hash"),
            F.first("n_shingles").alias("n"),
            F.first("sketch").alias("sketch"),
            F.first("bands").alias("bands"),
        )
        .withColumn("class_id", F.monotonically_increasing_id())  # stored, so fixed
    )
    keys = classes.select("class_id", "least_id", "n", F.explode("bands").alias("key"))
    order = F.struct("least_id", "class_id")
    heads = (
        keys.groupBy("key")
        .agg(F.min(order).alias("head"), F.count(F.lit(1)).alias("held"))
        .where("held > 1")
        .select("key", "head.class_id", "held")
    )
    heads = materialised(heads)
    shared = materialised(keys.join(heads.select("key", F.col("class_id").alias("head"), "held"), "key"))
    sets = _sets(named, classes, shared.select("class_id").distinct(), words)
    first = shared.where("class_id <> head").select(
        F.col("head").alias("a"), F.col("class_id").alias("b")
    ).distinct()
    links = _confirmed(first, classes, sets, percent)

    rooted = shared.join(_with_roots(classes, links), "class_id").select(
        "key", "class_id", "n", "held", "root"
    )
    rooted = materialised(rooted)
    open_keys = (
        rooted.groupBy("key")
        .agg(F.min("root").alias("r1"), F.max("root").alias("r2"))
        .where("r1 <> r2")
        .select("key")
    )
    still = materialised(rooted.join(open_keys, "key"))
    few = still.where(F.col("held") <= FEW)
    a = few.select("key", *[F.col(c).alias(f"{c}_a") for c in ("class_id", "root", "n")])
    b = few.select("key", *[F.col(c).alias(f"{c}_b") for c in ("class_id", "root", "n")])
    pairs = a.join(
        b,
        (a["key"] == b["key"])
        & (F.col("class_id_a") < F.col("class_id_b"))
        & (F.col("root_a") != F.col("root_b"))
        & _sizes_allow(F.col("n_a"), F.col("n_b"), percent),
    ).select(F.col("class_id_a").alias("a"), F.col("class_id_b").alias("b"))
    crowd = still.where(F.col("held") > FEW).select("class_id", "root").distinct()
    pairs = pairs.unionByName(_rare_pairs(crowd, sets, percent)).distinct()
    more = _confirmed(pairs.join(first, ["a", "b"], "left_anti"), classes, sets, percent)

    rooted = _with_roots(classes, links.unionByName(more)).join(
        classes.select("class_id", "digest", "least_id"), "class_id"
    )
    rooted = materialised(rooted)
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    per_class = materialised(rooted.join(least, "root").select("digest", "component_id"))
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return signed.join(small_or_shuffled(per_class, 48), "digest", "left").select(
        "doc_id",
        "text_hash",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` whose document is kept: one of every component.

    Rows that repeat both id and text are one document and stay or go together.
    """
    decided = near_duplicates(docs, words, percent)
    gone = materialised(decided.where("not kept").select("doc_id", "text_hash").distinct())
    id_, hash_ = (column_like(n, docs.columns) for n in ("gone_id", "gone_hash"))
    gone = gone.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_))
    return docs.join(
        small_or_shuffled(gone, 24),
        F.col("doc_id").eqNullSafe(F.col(id_))
        & (F.xxhash64(keyed(F.col("text"))) == F.col(hash_)),
        "left_anti",
    )
