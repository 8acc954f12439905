"""What line dedup sends to every executor is measured, and is line numbers alone."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm import line_dedup


def test_numbers_are_counted_before_they_are_sent(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 2_000)
    few = spark.range(2).select("id", F.sequence(F.lit(1), F.lit(3)).alias("picks"))
    many = spark.range(2).select("id", F.sequence(F.lit(1), F.lit(900)).alias("picks"))

    def sent(df):
        return "broadcast" in line_dedup._sent_if_small(df, "picks")._jdf.queryExecution().logical().toString()

    assert sent(few) and not sent(many)


def test_lines_are_read_by_number(spark):
    rows = [(1, "a b\n\n c  d "), (None, "x"), (1, "other"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lines = line_dedup._occurrences(docs, 0, 1)
    got = line_dedup._read(docs, lines.select("at"))
    known = lines.select("at", "h1", "h2")
    assert got.select("at", "h1", "h2").exceptAll(known).isEmpty()
    assert sorted(r["words"] for r in got.collect()) == [[], ["a", "b"], ["c", "d"], ["other"], ["x"]]
    assert known.exceptAll(got.select("at", "h1", "h2")).isEmpty()
