"""Product codes of vectors in whole numbers, searched through a Walsh-Hadamard transform.

Vectors are cut into parts, and each part is replaced by the index of the nearest
entry of its codebook. The transform keeps squared distances but for a known factor
and gathers what differs in its first coefficients. Squared differences are added in
sequency order, and an entry goes as soon as its sum exceeds a distance already
reached. Everything is whole numbers, so results are exact and the same everywhere.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import column_like
from tidemark.operators.lookups import join_per_key
from tidemark.session import materialised

#: Vectors that are searched at a time.
BLOCK = 4096
#: Larger components count as this; whole numbers of any size follow from there.
LARGEST = 2**62
_MOST = 2**63 - 1

#: One array of shape (entries, width) per part.
Codebooks = list[np.ndarray]


def sequency_order(n: int) -> np.ndarray:
    """Rows of the natural Hadamard matrix of size ``n``, by their number of sign changes."""
    bits = n.bit_length() - 1
    ordered = np.arange(n)
    gray = ordered ^ (ordered >> 1)
    rows = np.zeros(n, dtype=np.int64)
    for b in range(bits):
        rows |= ((gray >> b) & 1) << (bits - 1 - b)
    return rows


def walsh_hadamard(a: np.ndarray) -> np.ndarray:
    """The transform of each row of ``a``, zero-padded to a power of two, in sequency order.

    Squared distances between rows grow by the padded width.
    """
    rows, width = a.shape
    n = 1 << max(0, width - 1).bit_length()
    out = np.zeros((rows, n), dtype=a.dtype)
    out[:, :width] = a
    half = 1
    while half < n:
        pairs = out.reshape(rows, n // (2 * half), 2, half)
        left, right = pairs[:, :, 0, :], pairs[:, :, 1, :]
        out = np.stack([left + right, left - right], axis=2).reshape(rows, n)
        half *= 2
    return out[:, sequency_order(n)]


def nearest(vectors: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest row of ``entries``, ties to the lower, and squared distance."""
    x, e = walsh_hadamard(vectors), walsh_hadamard(entries)
    n = x.shape[1]
    first = x[:, :1] - e[None, :, 0]
    first = first * first
    guess = e[np.argmin(first, axis=1)]
    reached = ((x - guess) ** 2).sum(axis=1)
    row, entry = np.nonzero(first <= reached[:, None])
    total = first[row, entry]
    for k in range(1, n):
        step = x[row, k] - e[entry, k]
        total = total + step * step
        left = total <= reached[row]
        row, entry, total = row[left], entry[left], total[left]
    # pairs stand by row, then entry, and each row has one left at least
    starts = np.flatnonzero(np.diff(row, prepend=-1))
    least = np.minimum.reduceat(total, starts)
    best = np.flatnonzero(total == least[row])
    best = best[np.flatnonzero(np.diff(row[best], prepend=-1))]
    return entry[best], total[best] // n


def _exact(vectors: np.ndarray, codebooks: Codebooks) -> type:
    """64-bit numbers where no sum of squares can leave them, else numbers of any size."""
    width = codebooks[0].shape[1]
    largest = max([int(np.abs(a).max(initial=0)) for a in (vectors, *codebooks)])
    padded = 1 << max(0, width - 1).bit_length()
    return np.int64 if padded * largest < 2**30 else object


def _encode(vectors: np.ndarray, codebooks: Codebooks) -> Iterator[tuple[np.ndarray, ...]]:
    """Per part: the vectors' part, code and squared distance."""
    kind, width = _exact(vectors, codebooks), codebooks[0].shape[1]
    for p, entries in enumerate(codebooks):
        part = vectors[:, p * width : (p + 1) * width].astype(kind)
        if width and len(part):
            yield part, *nearest(part, entries.astype(kind))
        else:
            zeros = np.zeros(len(part), dtype=np.int64)
            yield part, zeros, zeros


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix; short lists are padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width), dtype=values.dtype)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _whole(
    batches: Iterator[pa.RecordBatch], scale: int, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Rows whose vector is there and finite, its components as floor(scale * x)."""
    for batch in batches:
        vectors = batch.column(batch.num_columns - 1)
        lists = vectors.filter(vectors.is_valid())
        values = lists.flatten()
        x = values.fill_null(np.nan).to_numpy(zero_copy_only=False).astype(np.float64)
        sizes = np.diff(lists.offsets.to_numpy())
        ends = np.cumsum(sizes)
        broken = np.append(0, np.cumsum(~np.isfinite(x)))
        fine = broken[ends] == broken[ends - sizes]
        with np.errstate(over="ignore", invalid="ignore"):
            floors = np.clip(np.floor(x * scale), -float(LARGEST), float(LARGEST))
        floors = floors[np.repeat(fine, sizes)].astype(np.int64)
        kept = np.zeros(len(batch), dtype=bool)
        kept[np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))] = fine
        offsets = np.append(0, np.cumsum(sizes[fine])).astype(np.int32)
        out = pa.ListArray.from_arrays(pa.array(offsets), pa.array(floors))
        rest = batch.filter(pa.array(kept)).columns[:-1]
        yield pa.RecordBatch.from_arrays(
            [a.cast(f.type) for a, f in zip([*rest, out], schema, strict=True)], schema=schema
        )


def _sums(
    batches: Iterator[pa.RecordBatch], codebooks: Codebooks
) -> Iterator[pa.RecordBatch]:
    """Per part, entry and position: the vectors assigned in this task and their sum."""
    entries, width = codebooks[0].shape
    counts = np.zeros((len(codebooks), entries), dtype=np.int64)
    sums = np.zeros((len(codebooks), entries, width), dtype=object)
    for batch in batches:
        vectors = _rows(batch.column(0), len(codebooks) * width)
        for start in range(0, len(vectors), BLOCK):
            block = vectors[start : start + BLOCK]
            for p, (part, code, _) in enumerate(_encode(block, codebooks)):
                counts[p] += np.bincount(code, minlength=entries)
                added = np.zeros((entries, width), dtype=part.dtype)
                np.add.at(added, code, part)
                sums[p] += added.astype(object)
    part, entry = np.nonzero(counts)
    part, entry, at = (
        np.repeat(part, width), np.repeat(entry, width), np.tile(np.arange(width), len(part))
    )
    yield pa.RecordBatch.from_pydict(
        {
            "part": pa.array(part, pa.int32()),
            "entry": pa.array(entry, pa.int32()),
            "at": pa.array(at, pa.int32()),
            "rows": pa.array(counts[part, entry], pa.int64()),
            "sum": pa.array([Decimal(int(s)) for s in sums[part, entry, at]], pa.decimal128(38, 0)),
        }
    )


def _codes(
    batches: Iterator[pa.RecordBatch], codebooks: Codebooks, schema: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """The other columns with the code in hex digits and the summed squared distance."""
    width = len(codebooks) * codebooks[0].shape[1]
    digits = np.array([f"{i:02x}" for i in range(256)])
    for batch in batches:
        vectors = _rows(batch.column(batch.num_columns - 1), width)
        texts, errors = [], []
        for start in range(0, len(vectors), BLOCK):
            block = vectors[start : start + BLOCK]
            codes, distance = [], np.zeros(len(block), dtype=object)
            for _, code, squared in _encode(block, codebooks):
                codes.append(digits[code])
                distance = distance + squared.astype(object)
            texts += ["".join(c) for c in zip(*codes, strict=True)]
            errors += [min(int(d), _MOST) for d in distance]
        columns = [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array(errors, pa.int64())]
        yield pa.RecordBatch.from_arrays(
            [a.cast(f.type) for a, f in zip(columns, schema, strict=True)], schema=schema
        )


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def whole_vectors(
    vectors: DataFrame, scale: int = 256, vector_column: str = "embedding"
) -> DataFrame:
    """``vectors`` with the vector, as the last column, in whole numbers floor(scale * x).

    Rows whose vector is NULL or holds NULL or a component that is not finite go.
    Components beyond 2**62 count as 2**62.
    """
    others = [F.col(c) for c in vectors.columns if c != vector_column]
    empty = vectors.limit(0).select(
        *others, F.lit(None).cast("array<long>").alias(vector_column)
    )
    whole = partial(_whole, scale=scale, schema=_arrow(empty.schema))
    return vectors.select(*others, vector_column).mapInArrow(whole, empty.schema)


def first_codebooks(
    whole: DataFrame, parts: int, entries: int, id_column: str, vector_column: str
) -> Codebooks:
    """The parts of the vectors with the smallest ids, equal ids by their vectors, NULL last."""
    first = (
        whole.orderBy(F.col(id_column).asc_nulls_last(), vector_column)
        .limit(entries)
        .select(vector_column)
        .collect()
    )
    size = whole.agg(F.max(F.size(vector_column))).first()[0]
    width = -(-size // parts)
    rows = np.zeros((len(first), parts * width), dtype=np.int64)
    for row, (vector,) in zip(rows, first, strict=True):
        row[: len(vector)] = vector
    return [rows[:, p * width : (p + 1) * width] for p in range(parts)]


def trained(whole: DataFrame, codebooks: Codebooks, vector_column: str) -> Codebooks:
    """The codebooks after one round: each entry the floored mean of the parts nearest to it.

    A task sends one row per part, entry and position; their totals, as many rows as
    the codebooks have numbers, come to the driver. An unused entry stays.
    """
    found = (
        whole.select(vector_column)
        .mapInArrow(
            partial(_sums, codebooks=codebooks),
            "part int, entry int, at int, rows long, sum decimal(38,0)",
        )
        .groupBy("part", "entry", "at")
        .agg(F.sum("rows").alias("rows"), F.sum("sum").alias("sum"))
        .collect()
    )
    moved = [c.copy() for c in codebooks]
    for r in found:
        moved[r["part"]][r["entry"], r["at"]] = int(r["sum"]) // r["rows"]
    return moved


def compress(
    vectors: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> tuple[DataFrame, Codebooks]:
    """Codes of all vectors, and the codebooks that decode them.

    The frame has the other columns of ``vectors`` with ``code`` (two hex digits per
    part) and ``error`` (squared distances summed over the parts), or these names
    with underscores where ``vectors`` has them already. Codebooks start as the parts
    of the ``entries`` smallest ids and move ``rounds`` times.

    Rows without a finite vector go, as :func:`whole_vectors` says. Vectors shorter
    than the longest, or not divisible by ``parts``, count as padded with zeros.
    Repeated ids and rows are rows like others; rows without an id come last among
    the first entries. With fewer rows than ``entries`` the codebooks are shorter. An
    empty table gives no rows and no codebooks. Results are exact for components of
    any size up to 2**62; an error beyond 2**63 - 1 counts as that.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    whole = materialised(whole_vectors(vectors, scale, vector_column))
    others = [c for c in vectors.columns if c != vector_column]
    code = column_like("code", others)
    error = column_like("error", [*others, code])
    empty = whole.limit(0).select(
        *others, F.lit("").alias(code), F.lit(0).cast("long").alias(error)
    )
    if whole.isEmpty():
        return empty, []
    codebooks = first_codebooks(whole, parts, entries, id_column, vector_column)
    for _ in range(rounds):
        codebooks = trained(whole, codebooks, vector_column)
    coded = partial(_codes, codebooks=codebooks, schema=_arrow(empty.schema))
    return whole.mapInArrow(coded, empty.schema), codebooks


def decoded(code: str, codebooks: Codebooks) -> list[int]:
    """The vector of whole numbers that a code stands for."""
    indexes = bytes.fromhex(code)
    return [int(x) for i, book in zip(indexes, codebooks, strict=True) for x in book[i]]


def digest(codebooks: Codebooks) -> str:
    """SHA-256 of all entries' components by part, entry and position."""
    numbers = ",".join(str(int(x)) for book in codebooks for x in book.ravel())
    return hashlib.sha256(numbers.encode()).hexdigest()


def with_group_error(coded: DataFrame, group: str, error: str, name: str) -> DataFrame:
    """``coded`` with the error summed over the rows of equal ``group``, NULLs together.

    ``coded`` is stored, as it is read twice. A sum beyond 2**63 - 1 counts as that.
    """
    total = F.least(F.sum(F.col(error).cast("decimal(38,0)")), F.lit(Decimal(_MOST)))
    rows = column_like("rows", coded.columns)
    per_group = coded.groupBy(group).agg(
        F.count(F.lit(1)).alias(rows), total.cast("long").alias(name)
    )
    return join_per_key(coded, materialised(per_group), group, rows)
