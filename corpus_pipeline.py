"""From raw documents to sampled segmentations: the stages of a training corpus, in order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of
``documents``. SQL cannot express the learnt and the sampled stages, so the whole is
tested against brute-force versions and ORACLE_SQL is None.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, mixing, odd_sketch, segment_sampling, toxicity
from tidemark.llm.common import table
from tidemark.llm.queries import PIECES, tokenizer
from tidemark.session import materialised


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document or line has; emptied ones go."""
    shorter = line_dedup.without_repeated_lines(docs, min_words=1, near_words=5)
    return shorter.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group that shares 0.8 of its five-word shingles."""
    return odd_sketch.without_near_duplicates(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weights of their sources ask for."""
    return mixing.mixed_documents(docs, weights=(1, 2, 3), most_repeats=3)


def sample_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every document, as piece ids, with their decoding checked."""
    model, _ = tokenizer(PIECES)
    return segment_sampling.sample_segmentations(docs, model, k=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("minhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", sample_pieces),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialised(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
