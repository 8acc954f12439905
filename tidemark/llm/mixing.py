"""Mixing sources to target weights (native DataFrame operations only).

Every document gets a hash-random key. Within a source the documents are ordered
by it, word counts are summed up along that order, and the source's budget is
cut exactly where the sum reaches it, after as many whole repeats as fit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, column_like, keyed
from tidemark.session import materialised

#: Leading hex digits of the key that make a slice of a source: 16**3 slices.
SLICE_DIGITS = 3


def hash_key(seed: int = 0) -> Column:
    """128 hash-random bits of id and text as hex."""
    salt = [F.lit(str(seed))] if seed else []
    return F.md5(F.concat_ws("|", *salt, F.col("doc_id").cast("string"), F.col("text")))


def word_count() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most_repeats: int = 3
) -> DataFrame:
    """(source, source_size) to the same with weight and target.

    Sources in code-point order, NULL last, weigh ``weights`` in turn and share
    all words by weight. No target exceeds ``most_repeats`` times its source;
    what that leaves over goes to the others by weight, until none is above. That
    is the water level at which the capped and the weighted parts add up: sources
    are ordered by the level at which they are full, and the first level that does
    not fill its source is the one. Works on one row per source.
    """
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    picks = F.array(*[F.lit(w) for w in weights])
    rows = sizes.withColumn(
        "weight",
        F.element_at(picks, (F.row_number().over(by_source) - 1) % len(weights) + 1).cast("long"),
    ).withColumn("cap", F.col("source_size") * most_repeats)
    filling = Window.orderBy(
        F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()
    )
    whole = Window.partitionBy()
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    rows = (
        rows.withColumn("place", F.row_number().over(filling))
        .withColumn(
            "level",
            (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
            / F.sum("weight").over(after),
        )
        .withColumn(
            "fits",
            F.when(
                F.col("level") <= F.col("cap") / F.col("weight"), F.struct("place", "level")
            ),
        )
        .withColumn("water", F.min("fits").over(whole)["level"])
    )
    return rows.select(
        "source",
        "source_size",
        "weight",
        F.least(F.col("cap").cast("double"), F.col("water") * F.col("weight")).alias("target"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    most_repeats: int = 3,
    seed: int = 0,
) -> DataFrame:
    """What a mix takes of each document.

    Returns one row per document: doc_id, source, mix_key, size (words),
    source_size, target (its source's), repeats (whole copies taken), part (words
    of one more copy that the budget cuts) and taken = repeats * size + part. The
    taken words of a source add up to its target, rounded to a whole word.

    A source's documents are summed in slices by leading digits of the key, so a
    source with a third of all rows is spread over 4,096 slices; the sums before a
    slice come from a table of one row per source and slice. Documents are read
    once; the rows that are shuffled hold no text.

    NULL or empty texts have size 0 and nothing of them is taken. A NULL source is
    a source. Equal rows share a key and are taken one after the other. A source
    without words has target 0. An empty table gives no rows.
    """
    narrow = materialised(
        docs.select(
            "doc_id",
            "source",
            keyed(F.col("source")).alias("source_key"),
            word_count().alias("size"),
            hash_key(seed).alias("mix_key"),
        ).withColumn("slice", F.substring("mix_key", 1, SLICE_DIGITS))
    )
    slices = materialised(
        narrow.groupBy("source", "source_key", "slice").agg(F.sum("size").alias("slice_size"))
    )
    sizes = slices.groupBy("source").agg(F.sum("slice_size").alias("source_size"))
    budgets = source_targets(sizes, weights, most_repeats).withColumn(
        "budget", F.floor(F.col("target") + 0.5)
    )
    budgets = budgets.select(
        keyed(F.col("source")).alias("source_key"),
        "source_size",
        "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("budget") / F.col("source_size")))
        .otherwise(0)
        .cast("long")
        .alias("repeats"),
        "budget",
    )
    in_source = Window.partitionBy("source_key").orderBy("slice")
    before = F.sum("slice_size").over(in_source.rowsBetween(Window.unboundedPreceding, -1))
    starts = slices.join(budgets, "source_key").select(
        "source_key",
        "slice",
        "source_size",
        "target",
        "repeats",
        (F.col("budget") - F.col("repeats") * F.col("source_size")
         - F.coalesce(before, F.lit(0))).alias("left"),
    )
    in_slice = Window.partitionBy("source_key", "slice").orderBy("mix_key", "doc_id")
    earlier = F.sum("size").over(in_slice.rowsBetween(Window.unboundedPreceding, -1))
    placed = narrow.withColumn("earlier", F.coalesce(earlier, F.lit(0)))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("earlier")))
    return (
        placed.join(starts, ["source_key", "slice"])
        .withColumn("part", part.cast("long"))
        .select(
            "doc_id",
            "source",
            "mix_key",
            "size",
            "source_size",
            "target",
            "repeats",
            "part",
            (F.col("repeats") * F.col("size") + F.col("part")).alias("taken"),
        )
    )


def mixed_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    most_repeats: int = 3,
    seed: int = 0,
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, columns unchanged.

    The one document of a source that the budget cuts is taken whole if at least
    half of it is within the budget. Everything up to that document in key order
    is taken once more than what follows, so the cut is one key per source: a
    table of one row per source is joined and no text is shuffled. Documents of
    size 0 are kept once each, as they weigh nothing. Cases as in :func:`mix`.
    """
    decided = mix(docs, weights, most_repeats, seed)
    in_or_out = (F.col("part") * 2 >= F.col("size")) & (F.col("part") > 0)
    cuts = materialised(
        decided.groupBy(keyed(F.col("source")).alias("source_key")).agg(
            F.max("repeats").alias("repeats"),
            F.max(F.when(in_or_out, F.col("mix_key"))).alias("cut"),
        )
    )
    taken = docs.columns
    source, key, size = (column_like(n, taken) for n in ("source_key", "mix_key", "mix_size"))
    repeats, cut, copies, copy = (
        column_like(n, taken) for n in ("mix_repeats", "mix_cut", "mix_copies", "mix_copy")
    )
    cuts = cuts.select(
        F.col("source_key").alias(source),
        F.col("repeats").alias(repeats),
        F.col("cut").alias(cut),
    )
    more = F.when(F.col(cut).isNotNull() & (F.col(key) <= F.col(cut)), 1).otherwise(0)
    return (
        docs.withColumn(source, keyed(F.col("source")))
        .withColumn(key, hash_key(seed))
        .withColumn(size, word_count())
        .join(cuts, source)
        .withColumn(copies, F.when(F.col(size) == 0, 1).otherwise(F.col(repeats) + more))
        .where(F.col(copies) > 0)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int"))))
        .select(*taken)
    )
