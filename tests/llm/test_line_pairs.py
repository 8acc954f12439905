"""What long lines that share a passage, and little else, leave in stored tables."""

from __future__ import annotations

import os
import random

from tidemark.llm import line_dedup


def test_lines_that_share_a_passage_form_no_pairs(spark, monkeypatch):
    rng = random.Random(5)

    def words(n):
        return [f"w{rng.randrange(10**9)}" for _ in range(n)]

    lines = []
    for _ in range(20):
        passage = words(30)
        lines += [passage + words(25) for _ in range(6)]
    near = [*lines[7][:10], "changed", *lines[7][11:50], "again", *lines[7][51:]]
    rows = [(i, " ".join(w)) for i, w in enumerate([*lines, near])]
    stored, paths = [], {}

    def spied(df, store=line_dedup.materialised):
        out = store(df)
        stored.append((out.columns, out.count()))
        paths.update({f.removeprefix("file:"): out.columns for f in out.inputFiles()})
        return out

    monkeypatch.setattr(line_dedup, "materialised", spied)
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"] for r in got.collect() if r["n_dropped"]} == {len(lines)}
    # of 300 pairs with a passage in common and the one that is near, that one alone
    pairs = [n for columns, n in stored if any(c.endswith("_") for c in columns)]
    assert sum(pairs) == 1
    left = [columns for path, columns in paths.items() if os.path.exists("/" + path.lstrip("/"))]
    assert not [columns for columns in left if {"key", "keys"} & set(columns)]


def test_parities_stay_within_two_bits_an_edit(spark):
    rng = random.Random(6)
    base = [f"w{rng.randrange(1000)}" for _ in range(80)]
    rows = [(0, base)]
    for n in range(1, 9):
        edited = list(base)
        for at in rng.sample(range(80), n):
            edited[at] = f"other{rng.random()}"
        rows += [(n, edited), (n, base[n:])]
    lines = spark.createDataFrame(rows, "edits int, words array<string>")
    got = line_dedup._runs(lines, with_parities=True).collect()
    for r in got:
        changed = sum(((r[c] ^ got[0][c]) % 2**64).bit_count() for c in ("odd0", "odd1"))
        assert changed <= 2 * r["edits"]
        assert changed > 0 or not r["edits"]
