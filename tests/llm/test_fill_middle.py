"""Fill-in-the-middle against plain slicing of lists of units."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import fill_middle
from tidemark.llm.fill_middle import SkipList, unit_widths

SCHEMA = "doc_id long, text string, n string, form int, cuts string, output string"


@given(st.lists(st.integers(1, 9), max_size=700))
@settings(deadline=None, max_examples=60)
def test_every_rank_of_a_skip_list(widths):
    units = SkipList(np.array(widths, dtype=np.int64))
    sums = np.append(0, np.cumsum(widths)).astype(int)
    assert [units.code_points_before(r) for r in range(len(widths) + 1)] == sums.tolist()


def test_lanes_thin_out_and_keep_their_widths():
    units = SkipList(np.arange(1, 100_001))
    sizes = [len(lane.units) for lane in units.lanes]
    assert len(sizes) > 4
    assert all(2 * above < below for below, above in zip(sizes, sizes[1:], strict=False))
    assert all(lane.units.sum() == 100_000 for lane in units.lanes)
    assert all(lane.points.sum() == units.n_points for lane in units.lanes)
    for rank in random.Random(2).sample(range(100_001), 500):
        assert units.code_points_before(rank) == rank * (rank + 1) // 2


@pytest.mark.parametrize("unit", [None, r"\w+", r"[^\n]*\n", r"(?=b)|c"])
def test_units_add_up_to_the_text(unit):
    pattern = unit and re.compile(unit)
    for text in ("", "a", "ab c\n\nbé😀 dd", "\n", "bcbc  "):
        widths = unit_widths(text, pattern)
        assert widths.sum() == len(text)
        assert (widths > 0).all()


def by_hand(doc_id, text, unit=None, rewritten=90, spm=20):
    text = text or ""
    if unit is None:
        units = list(text)
    else:  # matches and what lies between them
        ends = {e for m in re.finditer(unit, text) for e in m.span()} | {0, len(text)}
        ends = sorted(ends)
        units = [text[a:b] for a, b in zip(ends, ends[1:], strict=False)]
    name = "" if doc_id is None else str(doc_id)
    digest = hashlib.sha256(f"1:{name}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rewritten:
        return len(units), "plain", None, None, text
    if h[3] % 100 < spm:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(8)
    alphabet = "ab<PSM>é日😀\n\x00 ́"
    texts = [None, "", "x", "a<P>b", "<S>", "z<M>", "<P", "S><", "<<P<S<M", "S>P>M>", "😀"]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(1, 60))) for _ in range(300)]
    texts += ["some words\n" * 30_000, *["the same text"] * 50]
    rows = [(i, t, "n", 1, "c", "o") for i, t in enumerate(texts)]
    rows += [rows[2], rows[2], (None, "without id", None, None, None, None), (2, "same id", "", 1, "", "")]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("unit", [None, r"\w+"])
def test_against_slices(docs, unit):
    cut = fill_middle.fill_in_middle(docs, unit=unit)
    assert cut.columns == [*docs.columns, "n_", "form_", "prefix_chars", "middle_chars", "output_"]
    back = fill_middle.restored(F.col("output_"), F.col("form_"))
    rows = cut.withColumn("back", back).collect()
    assert len(rows) == docs.count()
    for r in rows:
        got = r["n_"], r["form_"], r["prefix_chars"], r["middle_chars"], r["output_"]
        assert got == by_hand(r["doc_id"], r["text"], unit)
        assert r["back"] == (r["text"] or "")
        assert (r["n"], r["output"]) in {("n", "o"), (None, None), ("", "")}
    assert {r["form_"] for r in rows} == {"plain", "psm", "spm"}


def test_empty_table_and_rates(spark, docs):
    assert fill_middle.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0
    none = fill_middle.fill_in_middle(docs.select("doc_id", "text"), rewritten=0)
    assert {r["form"] for r in none.collect()} == {"plain"}
    every = fill_middle.fill_in_middle(docs.select("doc_id", "text"), suffix_first=100)
    assert {r["form"] for r in every.collect()} == {"plain", "spm"}
