"""Best and worst rows per measure."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_both_ways(
    df: DataFrame,
    measures: Mapping[str, str],
    tie_breaker: str,
    k: int,
    measure: str = "timeframe",
    value: str = "change_pct",
    category: str = "performance_category",
    rank: str = "rank_in_category",
) -> DataFrame:
    """The ``k`` highest and ``k`` lowest rows of several measures in one scan.

    Each row is unpivoted to (measure, direction); ``row_number`` then has a
    partition key and Spark prunes to ``k`` rows per category on both sides of
    the shuffle (WindowGroupLimit), so a task sends at most ``k`` per category.
    """
    kinds = F.array(
        *[
            F.struct(
                F.lit(label).alias("measure"),
                F.col(column).cast("double").alias("value"),
                F.lit(f"top_{way}_{label}").alias("category"),
                F.lit(sign).alias("sign"),
            )
            for label, column in measures.items()
            for way, sign in (("gainer", -1.0), ("loser", 1.0))
        ]
    )
    kept = [c for c in df.columns if c not in measures.values()]
    long = df.select(*kept, F.explode(kinds).alias("_k")).select(
        *kept,
        F.col("_k.measure").alias(measure),
        F.col("_k.value").alias(value),
        F.col("_k.category").alias(category),
        (F.col("_k.value") * F.col("_k.sign")).alias("_sort"),
    )
    best = Window.partitionBy(category).orderBy(F.col("_sort").asc_nulls_last(), tie_breaker)
    return (
        long.withColumn(rank, F.row_number().over(best))
        .filter(F.col(rank) <= k)
        .withColumn(rank, F.col(rank).cast("bigint"))
        .drop("_sort")
    )


def top_n(df: DataFrame, score: Column, tie_breaker: str, n: int) -> DataFrame:
    """The first ``n`` rows by descending score (a heap per task, no full sort)."""
    return df.orderBy(score.desc_nulls_last(), F.col(tie_breaker)).limit(n)


def tagged_union(df: DataFrame, branches: Mapping[str, Column], tag: str) -> DataFrame:
    """One copy of the matching rows per named condition, without re-scanning.

    Same rows as a UNION ALL of one filtered scan per branch.
    """
    tags = F.array(*[F.when(cond, F.lit(name)) for name, cond in branches.items()])
    return df.withColumn(tag, F.explode(F.filter(tags, lambda t: t.isNotNull())))
