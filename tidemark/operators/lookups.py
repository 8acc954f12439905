"""Joins against small or per-key tables that hold up when one key is hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialised


#: Most bytes of rows that are sent to every executor.
BROADCAST_BYTES = 32 * 2**20
#: What a row takes in memory beside its values.
_ROW_BYTES = 32


def measured_bytes(df: DataFrame) -> int:
    """What the rows take in memory: counted rows times fixed widths, and the bytes of texts.

    One number leaves each task. Meant for stored or materialised tables and small
    aggregates of them.
    """
    fixed, measured = _ROW_BYTES, []
    for name, field in zip(df.columns, df.schema.fields, strict=True):
        column, kind = F.col(f"`{name}`"), field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            measured.append(F.octet_length(column))
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            # the text of a nested value is about as long as the value, or longer
            measured.append(F.octet_length(F.to_json(F.struct(column))))
        else:
            fixed += 16 if isinstance(kind, T.DecimalType) else 8
    texts = [F.coalesce(F.sum(m), F.lit(0)) for m in measured]
    rows, *sizes = df.agg(F.count("*"), *texts).first()
    return rows * fixed + sum(sizes)


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for rows measured to fit, and no hint above the bound.

    Without the hint the join is left to Catalyst and adaptive skew handling.
    """
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def join_broadcast(detail: DataFrame, per_key: DataFrame, key: str) -> DataFrame:
    """Left join with a per-key table known to be small; a NULL key is a key."""
    payload = [c for c in per_key.columns if c != key]
    table = F.broadcast(per_key.withColumnRenamed(key, "_k"))
    joined = detail.join(table, F.col(key).eqNullSafe(F.col("_k")), "left")
    return joined.select(*detail.columns, *payload)


def join_per_key(
    detail: DataFrame,
    per_key: DataFrame,
    key: str,
    weight: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_keys: int = 1000,
) -> DataFrame:
    """Bring a table with one row per key back to the detail rows (left join).

    ``per_key`` is read several times and should be a stored or materialised
    table; ``weight`` is the number of detail rows of a key. A table measured
    small is broadcast whole. Otherwise keys with more than 1/``hot_keys`` of
    all rows, of which there are fewer than ``hot_keys``, are broadcast where they
    fit, and their rows stay where they are; only the others are shuffled. Hot keys
    with values too wide to send are shuffled like the others, for adaptive
    execution to split.
    """
    payload = [c for c in per_key.columns if c not in (key, weight)]
    if fits_broadcast(per_key, broadcast_bytes):
        return join_broadcast(detail, per_key.select(key, *payload), key)
    values = F.struct(*payload)
    total = per_key.agg(F.sum(weight)).scalar()
    table = per_key.withColumn("_hot", F.col(weight) * F.lit(hot_keys) > total)
    hot = table.filter("_hot").select(F.col(key).alias("_hk"), values.alias("_hv"))
    cold = table.filter("NOT _hot").select(F.col(key).alias("_ck"), values.alias("_cv"))
    if not fits_broadcast(hot, max(broadcast_bytes, BROADCAST_BYTES)):
        hot, cold = hot.limit(0), table.select(F.col(key).alias("_ck"), values.alias("_cv"))
    is_hot = F.col(key).eqNullSafe(F.col("_hk"))
    marked = detail.join(F.broadcast(hot), is_hot, "left")
    own = [F.col(c) for c in detail.columns]
    found = marked.filter("_hv IS NOT NULL").select(*own, F.col("_hv").alias("_v"))
    others = (
        marked.filter("_hv IS NULL")
        .join(cold, F.col(key).eqNullSafe(F.col("_ck")), "left")
        .select(*own, F.col("_cv").alias("_v"))
    )
    return found.unionAll(others).select(*own, *[F.col("_v")[c].alias(c) for c in payload])


def join_group_summary(
    df: DataFrame,
    key: str,
    summary: dict[str, Column],
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_keys: int = 1000,
) -> DataFrame:
    """Each row with the aggregates of its own group beside it."""
    per_key = df.groupBy(key).agg(
        F.count("*").alias("_rows"), *[c.alias(n) for n, c in summary.items()]
    )
    return join_per_key(df, materialised(per_key), key, "_rows", broadcast_bytes, hot_keys)
