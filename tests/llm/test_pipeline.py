"""The stages in order, the registered names, and queries on whole small tables."""

from __future__ import annotations

import hashlib

import corpus_pipeline
from tests.conftest import SF
from tidemark.llm.queries import QUERIES


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def test_stages_hand_on_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, ids = docs.columns, {r["doc_id"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        path = folder(name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert now <= ids
        ids = now
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    assert docs.where("not round_trip").count() == 0


def test_stages_take_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_short_lines_repeat_in_query_and_stage(spark, folder):
    rows = [
        (1, "one\n\na b c d\nsix words stand in this line"),
        (2, "one\n\na b c d\nsix words stood in this line\nnew"),
        (3, "one\na b c e\nfive other words are here"),
    ]
    docs = spark.createDataFrame(
        [(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars long"
    )
    kept = {1: rows[0][1], 2: "\nnew", 3: "a b c e\nfive other words are here"}
    stage = dict(corpus_pipeline.STAGES)["line_dedup"]
    assert {r["doc_id"]: r["text"] for r in stage(spark, docs, SF).collect()} == kept
    path = folder("short")
    docs.write.parquet(f"{path}/documents.parquet")
    found = QUERIES["op6_line_dedup"](spark, path).collect()
    assert {r["doc_id"]: r["text_md5"] for r in found} == {
        i: hashlib.md5(t.encode()).hexdigest() for i, t in kept.items()
    }


def test_toxicity_stage_keeps_all_where_nothing_is_learnt(spark, folder):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(8)], "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["toxicity"]
    schema = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic").schema
    for rows in ([], [(0, 0)], [(i, 1) for i in range(8)]):
        path = folder("labels")
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/labels.parquet")
        assert {r["doc_id"] for r in stage(spark, docs, path).collect()} == set(range(8))
