"""The query and the stage of sampled segmentations give the segmentations themselves."""

from __future__ import annotations

import hashlib

import numpy as np

import corpus_pipeline
from tests.conftest import SF
from tidemark.llm import queries, segment_sampling

TEXTS = [(1, "two words"), (2, "é ▁ \U0001f600 \n"), (3, ""), (4, None), (None, "no id"), (1, "two words")]


def _whole(rows, model, spark):
    assert {r["doc_id"] for r in rows} == {1, 2, 3, 4, None}
    for r in rows:
        assert len(r["ids"]) == r["n_pieces"]
        assert hashlib.md5(np.array(r["ids"], "<i4").tobytes()).hexdigest() == r["ids_md5"]
    frame = spark.createDataFrame(
        [(r["doc_id"], r["ids"]) for r in rows], "doc_id long, ids array<int>"
    )
    texts = segment_sampling.decode(frame, model).collect()
    assert {(r["doc_id"], r["text"]) for r in texts} == {(i, t or "") for i, t in TEXTS}


def test_query_and_stage_give_the_ids(spark, folder):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    model, _ = queries.tokenizer(queries.PIECES)
    path = folder("segments")
    docs.write.parquet(f"{path}/documents.parquet")
    _whole(queries.op10_gumbel_segments(spark, path).collect(), model, spark)
    stage = dict(corpus_pipeline.STAGES)["sentencepiece"]
    _whole(stage(spark, docs, SF).collect(), model, spark)
