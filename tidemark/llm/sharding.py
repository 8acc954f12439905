"""Sharding by histogram sort: shards of near equal bytes, contiguous in a sort key.

Documents are ordered by a hash of the text, equal texts by a hash of the id. The
splitters between shards are found by counting the exact bytes below candidate
boundaries, in rounds: each round counts a finer histogram inside the few bins
that still hold a splitter, until a bin is one text or one row. Then the rows are
exchanged once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import keyed
from tidemark.session import materialised

#: Bits of the key that each round of probes resolves.
ROUND_BITS = 12
#: Rows that are numbered as one slice, at most, and least slices of the whole, roughly.
SLICE_ROWS, SLICES = 100_000, 2048
_TOP = 2**63


@dataclass
class Splitter:
    """Rows at or after (text hash, id hash) lie beyond the boundary."""

    text_hash: int
    id_hash: int = -_TOP


def size_bytes() -> Column:
    """UTF-8 bytes of the text plus the 8 of the id."""
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long")


def _refine(
    rows: DataFrame, column: str, targets: dict[int, int], start: dict[int, tuple[int, int]]
) -> dict[int, tuple[int, int, int, int]]:
    """For each target, the one value of ``column`` that the running bytes cross there.

    ``rows`` have a column ``part``; target t is looked for in the part, and from
    the bytes below it, that ``start[t]`` gives. Returns target to (value, bytes
    below it, bytes of it, rows of it). A round groups only rows in bins that hold
    a target, so at most one histogram of 2**ROUND_BITS bins per target comes to
    the driver, whatever the row count.
    """
    bins = {t: (part, 0, below) for t, (part, below) in start.items()}
    held: dict[int, tuple[int, int]] = {}
    shift, scope = 64, rows
    while shift:
        last, shift = shift, max(0, shift - ROUND_BITS)
        if last < 64:
            scope = rows.where(F.shiftright(column, last).isin({b for _, b, _ in bins.values()}))
        counted = (
            scope.groupBy("part", F.shiftright(column, shift).alias("bin"))
            .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
            .collect()
        )
        histogram: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for r in sorted(counted, key=lambda r: r["bin"]):
            parent = r["bin"] >> (last - shift) if last < 64 else 0
            histogram.setdefault((r["part"], parent), []).append((r["bin"], r["bytes"], r["rows"]))
        for t, (part, parent, below) in bins.items():
            inside = histogram[part, parent]
            for bin_, bytes_, rows_ in inside:
                if below + bytes_ > targets[t] or bin_ == inside[-1][0]:
                    bins[t], held[t] = (part, bin_, below), (bytes_, rows_)
                    break
                below += bytes_
    return {t: (value, below, *held[t]) for t, (_, value, below) in bins.items()}


def find_splitters(keys: DataFrame, shards: int, tolerance: float) -> list[Splitter]:
    """The ``shards`` - 1 boundaries over rows (text_hash, id_hash, size).

    A boundary falls before or after the text that crosses its target, whichever
    is nearer, if that text's rows weigh at most ``tolerance`` of a shard; else
    before or after the row that crosses it.
    """
    total = keys.agg(F.sum("size").alias("s")).first()["s"]
    if not total:
        return [Splitter(_TOP)] * (shards - 1)
    targets = {j: total * j // shards for j in range(1, shards)}

    def passed(j: int, below: int, count: int) -> bool:
        return targets[j] - below > below + count - targets[j]

    found: dict[int, Splitter] = {}
    heavy: dict[int, tuple[int, int]] = {}
    whole = keys.withColumn("part", F.lit(0))
    texts = _refine(whole, "text_hash", targets, {j: (0, 0) for j in targets})
    for j, (value, below, count, rows) in texts.items():
        if rows == 1 or count <= tolerance * total / shards:
            found[j] = Splitter(value + passed(j, below, count))
        else:
            heavy[j] = (value, below)
    if heavy:
        groups = keys.where(F.col("text_hash").isin({v for v, _ in heavy.values()}))
        groups = groups.withColumn("part", F.col("text_hash"))
        for j, (place, below, count, _) in _refine(groups, "id_hash", targets, heavy).items():
            found[j] = Splitter(heavy[j][0], place + passed(j, below, count))
    return [found[j] for j in range(1, shards)]


def _shard(splitters: list[Splitter]) -> Column:
    """Number of boundaries at or before the row."""
    passed = F.lit(0)
    for s in splitters:
        if s.text_hash >= _TOP:
            continue
        value = F.lit(s.text_hash).cast("long")
        beyond = F.col("text_hash") > value
        if s.id_hash < _TOP:
            beyond |= (F.col("text_hash") == value) & (
                F.col("id_hash") >= F.lit(s.id_hash).cast("long")
            )
        passed = passed + beyond.cast("int")
    return passed


def shard_documents(docs: DataFrame, shards: int = 24, tolerance: float = 0.02) -> DataFrame:
    """Shard and slot per document: doc_id, size, text_crc32, shard, slot.

    Shards are numbered from 0 and hold near equal bytes: a boundary is off its
    target by at most half a document, or half a group of equal texts where that
    group weighs at most ``tolerance`` of a shard. So equal texts stay in one shard
    unless they weigh too much. Slots run from 0 in each shard without gaps.

    A shard is numbered in slices, by the leading bits of the key and, where one
    text is in very many rows, by the id's hash; only a table of slice counts is
    summed over. Documents are read once; what is exchanged holds no text.

    NULL and empty texts weigh 8 bytes and have CRC 0. Rows that repeat both id
    and text have equal keys: they stay together and their slots follow each
    other. An empty table gives no rows.
    """
    keys = materialised(
        docs.select(
            "doc_id",
            size_bytes().alias("size"),
            F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64(keyed(F.col("text"))).alias("text_hash"),
            F.xxhash64(keyed(F.col("doc_id")), F.lit("id")).alias("id_hash"),
        )
    )
    placed = keys.withColumn("shard", _shard(find_splitters(keys, shards, tolerance)))
    placed = placed.withColumn("bin", F.shiftright("text_hash", 64 - ROUND_BITS))
    slice_rows = min(SLICE_ROWS, max(1, keys.count() // SLICES))
    parts = materialised(
        placed.groupBy("shard", "bin")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            "shard", "bin", F.ceil(F.col("rows") / slice_rows).cast("long").alias("parts")
        )
    )
    placed = placed.join(F.broadcast(parts), ["shard", "bin"]).withColumn(
        "part", F.when(F.col("parts") == 1, 0).otherwise(F.pmod("id_hash", "parts"))
    )
    slice_ = ["shard", "bin", "part"]
    before = Window.partitionBy("shard").orderBy("bin", "part")
    counts = placed.groupBy(*slice_).agg(F.count(F.lit(1)).alias("rows"))
    starts = counts.withColumn(
        "start",
        F.coalesce(
            F.sum("rows").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ),
    ).drop("rows")
    order = Window.partitionBy(*slice_).orderBy("text_hash", "id_hash", "doc_id")
    return (
        placed.withColumn("place", F.row_number().over(order))
        .join(starts, slice_)
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "shard",
            (F.col("start") + F.col("place") - 1).cast("long").alias("slot"),
        )
    )
