"""Product codes against plain loops over Python integers."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import code_compression as cc
from tidemark.operators import lookups

SCHEMA = "vec_id long, label string, embedding array<double>, code string, error int"


@pytest.mark.parametrize("n", [1, 2, 4, 8, 32])
def test_sequency_order(n):
    square = cc.walsh_hadamard(np.eye(n, dtype=np.int64)).T
    assert [int((np.diff(row) != 0).sum()) for row in square] == list(range(n))
    assert (square @ square.T == n * np.eye(n)).all()


@given(
    st.integers(1, 9), st.integers(1, 12), st.integers(1, 40),
    st.sampled_from([1, 3, 2**20, 2**62]), st.integers(0, 10**6),
)
@settings(deadline=None, max_examples=80)
def test_nearest_against_all_entries(width, entries, rows, largest, seed):
    rng = random.Random(seed)

    def draw(count):
        numbers = [[rng.randint(-largest, largest) for _ in range(width)] for _ in range(count)]
        return np.array(numbers, dtype=object)

    vectors, book = draw(rows), draw(entries)
    kind = cc._exact(vectors, [book])
    code, squared = cc.nearest(vectors.astype(kind), book.astype(kind))
    for x, c, d in zip(vectors, code, squared, strict=True):
        every = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in book]
        assert (int(d), int(c)) == min((v, i) for i, v in enumerate(every))


def by_hand(rows, parts, entries, rounds):
    """Plain rounds over (id, vector): codes and errors in the order kept, and codebooks."""
    kept = []
    for r in rows:
        v = r["embedding"]
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((r, [math.floor(256 * x) for x in v]))
    width = -(-max(len(v) for _, v in kept) // parts)
    for _, v in kept:
        v += [0] * (parts * width - len(v))
    # NULL ids come last; equal ids by their vectors
    kept.sort(key=lambda k: (k[0]["vec_id"] is None, k[0]["vec_id"] or 0, k[1]))
    books = [[v[p * width : (p + 1) * width] for _, v in kept[:entries]] for p in range(parts)]

    def assign(p, v):
        x = v[p * width : (p + 1) * width]
        far = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in books[p]]
        return min((d, i) for i, d in enumerate(far))

    for _ in range(rounds):
        moved = [list(b) for b in books]
        for p in range(parts):
            held = defaultdict(list)
            for _, v in kept:
                held[assign(p, v)[1]].append(v[p * width : (p + 1) * width])
            for i, members in held.items():
                moved[p][i] = [sum(c) // len(members) for c in zip(*members, strict=True)]
        books = moved
    out = []
    for r, v in kept:
        found = [assign(p, v) for p in range(parts)]
        out.append((r["vec_id"], r["label"], "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
    return out, books


@pytest.fixture(scope="module")
def vectors(spark):
    rng = random.Random(6)
    rows = [
        (i, rng.choice(["a", "b", None]), [rng.gauss(0, 0.3) for _ in range(12)], "x", 5)
        for i in range(200)
    ]
    rows += [rows[7], rows[7], (7, "b", [0.25] * 12, "y", 1), (None, "a", [0.5] * 12, None, None)]
    rows += [(900 + i, "hot", [0.125] * 12, "", 0) for i in range(100)]
    rows += [
        (300, "a", None, "", 0), (301, "a", [0.1, None] * 6, "", 0), (302, "a", [math.nan] * 12, "", 0),
        (303, None, [math.inf] * 12, "", 0), (304, "c", [0.0] * 12, "", 0), (305, "c", [-1e-9] * 12, "", 0),
        (-5, "c", [3e4, -3e4] * 6, "", 0),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def check(coded, codebooks, expected, books):
    got = sorted(((r["vec_id"], r["label"], r["code_"], r["error_"]) for r in coded.collect()), key=repr)
    assert got == sorted(expected, key=repr)
    assert [b.tolist() for b in codebooks] == books


@pytest.mark.parametrize(("parts", "entries", "rounds"), [(4, 16, 2), (3, 64, 1), (5, 256, 0), (12, 1, 2)])
def test_against_plain_rounds(vectors, parts, entries, rounds):
    coded, codebooks = cc.compress(vectors, parts=parts, entries=entries, rounds=rounds)
    assert coded.columns == ["vec_id", "label", "code", "error", "code_", "error_"]
    check(coded, codebooks, *by_hand(vectors.collect(), parts, entries, rounds))


def test_huge_components_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, "a", [rng.uniform(-1, 1) * 2.0 ** rng.randint(0, 50) for _ in range(4)], "", 0) for i in range(60)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    coded, codebooks = cc.compress(vectors, parts=2, entries=8)
    expected, books = by_hand(vectors.collect(), 2, 8, 2)
    check(coded, codebooks, [(*e[:3], min(e[3], 2**63 - 1)) for e in expected], books)
    total = cc.with_group_error(coded, "label", "error_", "label_error")
    assert {r["label_error"] for r in total.collect()} == {2**63 - 1}


def test_lengths_that_do_not_fit(spark):
    rows = [(1, "a", [0.5], "", 0), (2, "a", [0.25, 0.5, 0.75], "", 0), (3, "b", [], "", 0)]
    vectors = spark.createDataFrame(rows, SCHEMA)
    coded, codebooks = cc.compress(vectors, parts=2, entries=2)
    check(coded, codebooks, *by_hand(vectors.collect(), 2, 2, 2))
    coded, codebooks = cc.compress(vectors.where("vec_id = 3"), parts=2)
    assert [(r["code_"], r["error_"]) for r in coded.collect()] == [("0000", 0)]


def test_tables_without_vectors(spark, vectors):
    for rows in (vectors.limit(0), vectors.where("vec_id between 300 and 303")):
        coded, codebooks = cc.compress(rows)
        assert coded.count() == 0
        assert codebooks == []
        assert len(cc.digest(codebooks)) == 64
        assert cc.with_group_error(coded, "label", "error_", "label_error").count() == 0


@pytest.mark.parametrize("most", [1, 10**6])
def test_group_errors_on_both_joins(vectors, monkeypatch, most):
    plain = lookups.join_per_key
    monkeypatch.setattr(cc, "join_per_key", lambda *a: plain(*a, broadcast_bytes=most, hot_keys=4))
    coded, _ = cc.compress(vectors, parts=4, entries=16)
    rows = cc.with_group_error(coded, "label", "error_", "label_error").collect()
    assert len(rows) == coded.count()
    sums = defaultdict(int)
    for r in rows:
        sums[r["label"]] += r["error_"]
    assert all(r["label_error"] == sums[r["label"]] for r in rows)


def test_codes_decode_to_the_nearest_entries(vectors):
    coded, codebooks = cc.compress(vectors, parts=4, entries=16)
    held = {r["vec_id"]: r for r in coded.collect()}
    for r in vectors.where("vec_id between 10 and 60").collect():
        near = cc.decoded(held[r["vec_id"]]["code_"], codebooks)
        whole = [math.floor(256 * x) for x in r["embedding"]]
        assert sum((a - b) ** 2 for a, b in zip(near, whole, strict=True)) == held[r["vec_id"]]["error_"]
