"""What line dedup cuts, shuffles and keeps on disk while it compares long lines."""

from __future__ import annotations

import os
import random

from pyspark.sql import functions as F

from tidemark.llm import line_dedup


def test_a_text_is_cut_once_for_all_its_lines(spark):
    docs = spark.createDataFrame([(1, "a b\nc\nd  e"), (2, None)], "doc_id long, text string")
    got = line_dedup._read(docs, line_dedup._occurrences(docs, 1, 1).select("at"))
    # a lambda would cut the text again for each line number
    assert "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["words"] for r in got.collect()) == [["a", "b"], ["c"], ["d", "e"]]


def test_any_white_space_parts_words(spark):
    lines = [" a\tb ", "a b", "a \x0b\r\f b", "a b", "a  b\r", "\t", "", "ab"]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, line string")
    got = df.select("i", line_dedup._words(line_dedup._spaced(F.col("line"))).alias("w")).collect()
    ab = ["a", "b"]
    assert [r["w"] for r in sorted(got)] == [ab, ab, ab, ["a b"], ab, [], [], ["ab"]]


def test_keys_of_lines_are_gone_before_lines_are_numbered(spark, monkeypatch):
    rng = random.Random(11)
    base = [[f"w{rng.randrange(10**9)}" for _ in range(60)] for _ in range(6)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    rows += [(10 + i, " ".join([*w[:30], "other", *w[31:]])) for i, w in enumerate(base)]
    keyed, left, shares = [], [], []

    def spied(df, store=line_dedup.materialised):
        if "odd0" in df.columns and "key" not in df.columns:
            left.extend(p for p in keyed if os.path.exists(p))
        out = store(df)
        if "keys" in out.columns:
            keyed.extend("/" + f.removeprefix("file:").lstrip("/") for f in out.inputFiles())
        shares.extend([1] if set(out.columns) == {"h1", "key"} else [])
        return out

    monkeypatch.setattr(line_dedup, "materialised", spied)
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"] for r in got.collect() if r["n_dropped"]} == set(range(10, 16))
    assert keyed and not left
    # so few keys are shuffled at once
    assert len(shares) == 1


def test_words_that_share_a_code_are_told_apart(spark):
    words = [f"w{i}" for i in range(50)]
    pairs = spark.createDataFrame(
        [(words, ["x", *words[1:]], "abc", "abc"), (words, [f"v{i}" for i in range(50)], "abc", "abc")],
        "words array<string>, words_ array<string>, spelt string, spelt_ string",
    )
    assert [r["words_"][0] for r in line_dedup._within_a_tenth(pairs).collect()] == ["x"]
