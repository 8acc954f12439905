"""Materialisation: full replace, key merge, dated append and backfill."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tidemark import files
from tidemark.session import materialised


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Full replace of a Parquet table; returns the table as written.

    The rows are written whole beside the table and then take its place, so a failed
    write leaves the old table, and ``df`` may read it. A reader of the path can meet
    the moment between two renames; :mod:`tidemark.sources.published` has none.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    beside = f"{parent}/_next-{name}"
    df.write.mode("overwrite").parquet(beside)
    files.move(df.sparkSession, beside, path)
    return df.sparkSession.read.parquet(path)


def at_once(
    writes: Mapping[str, Callable[[], DataFrame]], workers: int = 4
) -> dict[str, DataFrame]:
    """Write independent tables side by side.

    A small table leaves most of a cluster idle while it is written; a few
    writes at a time fill it. The first failure is raised.
    """
    with ThreadPoolExecutor(max_workers=workers) as pool:
        jobs = {name: pool.submit(write) for name, write in writes.items()}
        return {name: job.result() for name, job in jobs.items()}


def replace_all(builds: Mapping[str, Callable[[], DataFrame]], target: str) -> dict[str, DataFrame]:
    """Replace independent tables side by side, each in a folder of ``target``."""
    return at_once(
        {
            name: (lambda name=name, build=build: replace_table(build(), f"{target}/{name}"))
            for name, build in builds.items()
        }
    )


def latest_per_key(
    tables: Sequence[DataFrame], keys: Sequence[str], newest: str
) -> DataFrame:
    """One row per key, the newest; among equals the row of the later table.

    ``row_number() = 1`` is pruned before the shuffle too, so a key with a
    third of all rows reaches its task as one row per map task.
    """
    tagged = [t.withColumn("_source", F.lit(i)) for i, t in enumerate(tables)]
    both = tagged[0]
    for table in tagged[1:]:
        both = both.unionByName(table, allowMissingColumns=True)
    columns = [c for c in both.columns if c != "_source"]
    order = Window.partitionBy(*keys).orderBy(
        F.col(newest).desc_nulls_last(), F.col("_source").desc(), F.xxhash64(*columns)
    )
    return (
        both.withColumn("_rn", F.row_number().over(order))
        .filter(F.col("_rn") == 1)
        .select(*columns)
    )


# --- merged tables -----------------------------------------------------------
# A merged table is cut into ranges of its keys. A merge writes the ranges it touches
# under a folder of its own, ``version=N/range_from=K``, where K tells the least key;
# the marker that ends the write puts all of them in force at once. A write that was
# interrupted has no marker and is not read.
_VERSION, _RANGE, _WRITTEN = "version=", "range_from", "_SUCCESS"
#: Characters of a text key that a range's least key keeps: a prefix sorts before the key.
_BOUND_CHARS = 40


def _ranges_in_force(spark: SparkSession, path: str) -> dict[str, str]:
    """The folder that holds each range (one entry a range)."""
    held = {}
    for version in files.names(spark, path):
        inside = files.names(spark, f"{path}/{version}") if version.startswith(_VERSION) else []
        if _WRITTEN in inside:
            found = (n.removeprefix(f"{_RANGE}=") for n in inside if n.startswith(_RANGE))
            held |= {name: f"{path}/{version}/{_RANGE}={name}" for name in found}
    return held


def _drop_superseded(spark: SparkSession, path: str, held: Mapping[str, str]) -> None:
    """Remove interrupted writes, and ranges that an earlier merge has replaced."""
    in_force = set(held.values())
    for version in files.names(spark, path):
        at = f"{path}/{version}"
        ranges = [f"{at}/{n}" for n in files.names(spark, at) if n.startswith(_RANGE)]
        old = [r for r in ranges if r not in in_force]
        for place in [at] if len(old) == len(ranges) else old:
            files.remove(files.folder(spark, place))


def _schema(spark: SparkSession, held: Mapping[str, str]) -> StructType:
    """The columns of the newest write, which has all earlier ones too (one footer)."""
    return spark.read.parquet(max(held.values())).schema


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """The table that :func:`merge_latest` keeps at ``path``.

    The frame stays valid during the next merge, not beyond it.
    """
    held = _ranges_in_force(spark, path.rstrip("/"))
    return spark.read.schema(_schema(spark, held)).parquet(*held.values())


def _name(bound: str) -> str:
    """A range's folder name, from its least key as JSON; empty for the first range."""
    return "k" + bound.encode().hex()


def _bound(name: str) -> str:
    return bytes.fromhex(name[1:]).decode()


def _cut_points(df: DataFrame, keys: Sequence[str], ranges: int) -> set[str]:
    """Least keys, as JSON, of about equal ranges of the rows (one row a range)."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    short = [F.left(F.col(k), F.lit(_BOUND_CHARS)).alias(k) if k in texts else k for k in keys]
    parts = df.select(*keys).repartitionByRange(ranges, *keys)
    least = parts.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct(*short)).alias("k"))
    found = least.orderBy("part").select(F.to_json("k")).collect()
    return {r[0] for r in found[1:]}


def _range_of(df: DataFrame, keys: Sequence[str], bounds: Collection[str]) -> Column:
    """The name of the range a row falls into: that of the largest least key not above its own."""
    first = F.lit(_name(""))
    if not bounds:
        return first
    kinds = StructType([df.schema[k] for k in keys])
    entries = [F.struct(F.from_json(F.lit(b), kinds).alias("k"), F.lit(_name(b)).alias("n")) for b in bounds]
    own = F.struct(*keys)
    below = F.array_max(F.filter(F.array(*entries), lambda entry: entry["k"] <= own))
    return F.coalesce(below["n"], first)


def merge_latest(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    keys: Sequence[str],
    newest: str,
    buckets: int = 16,
    range_rows: int = 5_000_000,
) -> DataFrame:
    """Key merge into a table read with :func:`read_merged`, one writer at a time.

    Only ranges that hold a key of ``incoming`` are read, and written once: a batch
    confined to a part of the keys rewrites that part. The merge takes effect as a
    whole when its last file is there; interrupted before, it leaves the table as it
    was and can be repeated. A new table gets ``buckets`` ranges; one that grows beyond
    twice ``range_rows`` is split where it is written, so choose these for some
    thousand ranges at most. An empty batch changes nothing and is returned where
    there is no table.
    """
    path = path.rstrip("/")
    held = _ranges_in_force(spark, path)
    _drop_superseded(spark, path, held)
    batch = materialised(incoming)
    if batch.isEmpty():
        return read_merged(spark, path) if held else incoming
    bounds = {_bound(name) for name in held} - {""} if held else _cut_points(batch, keys, buckets)
    sources = [batch]
    if held:
        # at most one row a range
        touched = dict(batch.groupBy(_range_of(batch, keys, bounds)).count().collect())
        places = {name: held[name] for name in touched if name in held}
        schema = _schema(spark, held)
        stored = spark.read.schema(schema).parquet(*places.values()) if places else spark.createDataFrame([], schema)
        sources = [stored, batch]
        for name, place in places.items():
            rows = touched[name] + spark.read.schema(schema).parquet(place).count()  # from the footers
            if rows > 2 * range_rows:
                inside = stored.select(*keys).unionByName(batch.select(*keys))
                inside = inside.where(_range_of(batch, keys, bounds) == name)
                bounds = bounds | _cut_points(inside, keys, rows // range_rows + 1)
    merged = latest_per_key(sources, keys, newest)
    merged = merged.withColumn(_RANGE, _range_of(merged, keys, bounds))
    versions = [int(n.removeprefix(_VERSION)) for n in files.names(spark, path) if n.startswith(_VERSION)]
    (
        merged.hint("rebalance", _RANGE)
        .write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true")
        .partitionBy(_RANGE)
        .parquet(f"{path}/{_VERSION}{max(versions, default=0) + 1:010d}")
    )
    return read_merged(spark, path)


# --- dated tables ------------------------------------------------------------
def write_days(df: DataFrame, path: str, day: str) -> None:
    """Write whole days; a day written before is replaced, others stay.

    The rebalance hint lets adaptive execution split a day that holds most of
    the rows and join small ones, so file sizes do not follow the skew.
    """
    (
        df.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def append_snapshot(df: DataFrame, path: str, day: str = "snapshot_date") -> None:
    """Add a snapshot under its day, keeping the other days.

    A run that is repeated writes its day again instead of doubling it.
    """
    write_days(df, path, day)


def retained(df: DataFrame, day: str, keep_days: int, as_of: Column) -> DataFrame:
    """The snapshots inside the retention window (prunes day partitions)."""
    return df.filter(F.col(day).cast("date") > F.date_sub(as_of.cast("date"), keep_days))


def stored_days(spark: SparkSession, path: str, day: str) -> list[str]:
    """The days that have a folder."""
    prefix = f"{day}="
    return [n.removeprefix(prefix) for n in files.names(spark, path) if n.startswith(prefix)]


def remove_day(spark: SparkSession, path: str, day: str, name: str) -> None:
    files.remove(files.folder(spark, f"{path}/{day}={name}"))


def drop_expired(spark: SparkSession, path: str, day: str, keep_days: int, as_of: Column) -> None:
    """Delete the snapshots that :func:`retained` leaves out, a folder a day."""
    last = spark.range(1).select(F.date_sub(as_of.cast("date"), keep_days).cast("string")).first()[0]
    for name in stored_days(spark, path, day):
        if name <= last:
            remove_day(spark, path, day, name)


def in_range(df: DataFrame, day: str, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Rows of the backfill interval, both ends included."""
    lower, upper = (F.lit(str(d)).cast("date") for d in (start, end))
    return df.filter(F.col(day).cast("date").between(lower, upper))


def backfill(df: DataFrame, path: str, day: str, start: dt.date | str, end: dt.date | str) -> None:
    """Recompute an interval of days in a day-partitioned table.

    A day of the interval that has no rows any more goes.
    """
    spark, fresh = df.sparkSession, in_range(df, day, start, end)
    write_days(fresh, path, day)
    # one row a day of the interval
    filled = {str(r[0]) for r in fresh.select(F.col(day).cast("string")).distinct().collect()}
    for name in stored_days(spark, path, day):
        if str(start) <= name <= str(end) and name not in filled:
            remove_day(spark, path, day, name)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table; each branch is a partial count, one row leaves each task."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for branch in counts[1:]:
        out = out.unionByName(branch)
    return out
