"""Packing by powers of two against a plain loop over whole texts."""

from __future__ import annotations

import json
import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.queries import WORDS, op11_binary_packing, tokenizer
from tidemark.session import fresh_path
from tests.conftest import SF

SCHEMA = "doc_id long, text string, start int, sequence_id string, ids string, task int"
ODD = [
    None, "", " \t\n\r\x0b\x0c", "one", "It's THEY'LL we'd 123 45", "été café",
    "a b c\u0085d\x1ce", "ΣΑΣ ΟΔΟΣ", "İstanbul ǅ ﬁ", "日本語のテキスト 😀👩‍👩‍👧 x",
    "<|endoftext|> x<|startoftext|>y", "́ ́a ̈", "à̖ b", "x" * 5000,
    "!!! ... '' 's 't", "\x00 null \x7f", "word-word_word/word's", "٣٤٥ Ⅻ ½", "​﻿ z",
]


@pytest.fixture(scope="module")
def words():
    return tokenizer(WORDS)[0]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    letters = "abcdeéßñ漢字1 2.,'’\n\t 😀Σ"
    texts = ODD + ["".join(rng.choices(letters, k=rng.randint(1, 400))) for _ in range(60)]
    texts += [" ".join(rng.choices(["Alpha", "beta", "gamma,", "it's"], k=9000))] + ["hot text"] * 40
    rows = [(i, t, 7, "s", "i", 1) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, "no id", None, None, None, None), (3, "same id", 1, "", "", 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def plain(words, text):
    return [*reference(words).encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("known", [0, 50, 10**6])
def test_chunks_encode_as_the_whole_text(words, docs, known):
    encode = packing.ChunkEncoder(words, known)
    texts = [r["text"] or "" for r in docs.collect()]
    for _ in range(2):  # unknown, then known
        for start in range(0, len(texts), 30):
            batch = texts[start : start + 30]
            for text, ids in zip(batch, encode(batch), strict=True):
                assert [*ids, 1] == plain(words, text), text


def test_another_tokenizer_encodes_whole_chunks(words):
    told = json.loads(words)
    told["normalizer"] = {"type": "Lowercase"}
    other = json.dumps(told).encode()
    encode = packing.ChunkEncoder(other)
    texts = ["Some words, it's", "", "été x"]
    assert [[*ids, 1] for ids in encode(texts)] == [plain(other, t) for t in texts]


@given(st.text(st.sampled_from("abZ'sStTreVEmlLd0129.,<|>endoftxÀÿßØ×é \n-\x7f\x1f"), max_size=60))
@settings(deadline=None, max_examples=400)
def test_words_of_simple_chunks(words, text):
    encode = packing._encoder(words)
    assert [*encode([text])[0], 1] == [*reference(words).encode(text, add_special_tokens=False).ids, 1]


@lru_cache
def reference(words):
    return Tokenizer.from_buffer(words)


@pytest.mark.parametrize("longest", [1, 8, 2048])
def test_binary_pieces(longest):
    for n in [*range(1, 70), 2047, 2048, 2049, 6000]:
        pieces = packing.binary_pieces(n, longest)
        assert sum(pieces) == n
        assert all(p & (p - 1) == 0 and p <= longest for p in pieces)
        assert pieces == sorted(pieces, reverse=True)
        assert all(c == 1 for p, c in Counter(pieces).items() if p < longest)


@pytest.mark.parametrize("longest", [4, 64, 2048])
def test_each_token_lies_in_one_piece(words, docs, longest):
    rows = packing.pack(docs, words, longest=longest).collect()
    expected = Counter()
    for r in docs.collect():
        ids, start = plain(words, r["text"]), 0
        for length in packing.binary_pieces(len(ids), longest):
            held = np.array(ids[start : start + length], dtype="<u4").tobytes()
            expected[r["doc_id"], start, length, held, len(ids)] += 1
            start += length
    assert expected == Counter(
        (r["doc_id"], r["start"], r["length"], bytes(r["ids"]), r["doc_tokens"]) for r in rows
    )
    assert {r["offset"] for r in rows} == {0}
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    # a bucket is a range of sequence ids, the longest first
    by_length = defaultdict(list)
    for r in rows:
        by_length[r["length"]].append(r["sequence_id"])
    ranges = [(min(s), max(s)) for _, s in sorted(by_length.items(), reverse=True)]
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_reruns_and_empty_tables(spark, words, docs):
    stored = fresh_path(spark, "docs")
    docs.write.parquet(stored)
    twice = [
        sorted(packing.pack(spark.read.parquet(stored), words).collect(), key=repr)
        for _ in range(2)
    ]
    assert twice[0] == twice[1]
    none = packing.pack(spark.createDataFrame([], SCHEMA), words)
    assert none.count() == 0
    assert none.columns == [
        "doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"
    ]
    with pytest.raises(ValueError):
        packing.pack(docs, words, longest=1000)


def test_buckets_are_folders(spark, words, docs):
    path = fresh_path(spark, "buckets")
    packed = packing.pack(docs, words, longest=64)
    packing.store_buckets(packed, path)
    bucket = spark.read.parquet(f"{path}/length=64")
    assert bucket.count() == packed.where("length = 64").count()
    assert {len(r["ids"]) for r in bucket.collect()} == {256}


def test_query_over_documents(spark, words):
    rows = op11_binary_packing(spark, SF).collect()
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    found = {(r["doc_id"], r["start"]): r for r in rows}
    assert len(found) == len(rows)
    for doc_id, text in texts:
        ids, start = plain(words, text), 0
        while start < len(ids):
            r = found.pop((doc_id, start))
            held = np.array(ids[start : start + r["length"]], dtype="<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(held)
            assert r["doc_tokens"] == len(ids)
            start += r["length"]
    assert not found
