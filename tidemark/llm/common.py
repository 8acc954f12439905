"""What several operators need: tables, null-safe keys, broadcasts of a checked size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Most bytes of rows that may be broadcast.
BROADCAST_BYTES = 64 * 2**20

#: Rows in a batch of whole texts that goes to Python.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_or_shuffled(df: DataFrame, row_bytes: int) -> DataFrame:
    """``df`` marked for broadcast if its counted rows fit; otherwise as it is.

    Meant for a table that is stored already, whose count costs next to nothing.
    The join gives the same rows either way.
    """
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def lean_batches(spark: SparkSession) -> None:
    """Sends texts to Python a few hundred at a time, unless the session sends fewer.

    Spark's default of 10,000 rows is meant for short ones: of whole documents it
    makes batches of tens or hundreds of megabytes, on both sides of the pipe.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting, "10000")) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))


def keyed(column: Column) -> Column:
    """The value as a string that is never NULL and tells NULL from every value."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def row_key(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """64 bits of id and text. Rows that agree in both are one document."""
    return F.xxhash64(keyed(F.col(id_column)), keyed(F.col(text_column)))


def column_like(name: str, taken: list[str]) -> str:
    """``name``, lengthened until it clashes with none of ``taken`` (case ignored)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def smallest_hashes(df: DataFrame, hash_column: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest values of a 64-bit hash, in order.

    Rows far above what ``n`` of them need are dropped where they are read, so what
    meets in the one task that picks is about 2 * n rows, whatever the row count.
    """
    share = (2 * n + 100) / max(1, df.count())
    if share < 1:
        df = df.where(F.col(hash_column) < int(-(2**63) + share * 2**64))
    rest = [F.xxhash64(c) for c in df.columns if c != hash_column]
    return df.orderBy(hash_column, *rest).limit(n)
