"""Queries on tables with more columns, named like everything they add or use inside."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries
from tidemark.session import fresh_path
from tests.conftest import SF
from tests.helpers import rows

TAKEN = """
    n_tokens leaf_ends leaf_tokens edits n_leaves n_edits n_tokens_after chars_encoded counted updated
    size source_size target taken key rank score query_id vector copies block held_out predicted
    n_lines n_dropped text_md5 h1 h2 at words text_crc32 law shard slot grown_shard text_hash id_hash
    n_email n_ip n_card n_phone base_sha256 base_spans spans n_shingles component_id kept rid
    start length ids ids_crc32 doc_tokens sequence_id offset id task
    n form prefix_chars middle_chars output output_sha256 restored_sha256 cuts
    code error label_error codebooks_sha256 rows n_links toxic
""".split()


@pytest.fixture(scope="module")
def folders(spark):
    """The same few rows twice, once with all these columns."""
    plain, wide = fresh_path(spark, "plain"), fresh_path(spark, "wide")
    for name, key in (("documents", "doc_id"), ("embeddings", "vec_id"), ("labels", "doc_id")):
        few = spark.read.parquet(f"{SF}/{name}.parquet").where(F.col(key) < 70).coalesce(1)
        few.write.parquet(f"{plain}/{name}.parquet")
        own = spark.read.parquet(f"{plain}/{name}.parquet")
        taken = [c for c in TAKEN if c not in own.columns]
        own.select("*", *[F.lit("other").alias(c) for c in taken]).write.parquet(f"{wide}/{name}.parquet")
    return plain, wide


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_more_columns_change_nothing(spark, folders, name):
    plain, wide = (queries.QUERIES[name](spark, folder) for folder in folders)
    assert plain.columns == wide.columns
    # the place of a row in a file may differ, and with it the number of its task
    left, right = (df.drop("sequence_id") for df in (plain, wide))
    assert rows(left) == rows(right)
    assert left.count() > 0
