"""Packing by powers of two: whole sequences of one document each, and no padding.

A document's token ids are split at the binary digits of their number: as many
pieces of the longest length as fit, then one piece for each digit of the rest.
Every piece is a sequence of its own. Its length is a power of two, so it needs no
padding, and sequences of equal length form a bucket that batches are drawn from.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, lean_batches

#: Bits of a sequence id that hold the place in a task's bucket, and those that hold the task.
PLACE_BITS, TASK_BITS = 34, 24
#: Most chunks and words that a Python worker remembers; then it starts anew.
KNOWN = 1_000_000
#: Ids that a task sends back at a time, about.
SENT_IDS = 1_000_000

_CHUNK = re.compile(WORD)
#: White space to ``str.split`` that is none to the tokenizers.
_NOT_SPACE = "\x1c\x1d\x1e\x1f"

# The steps of the tokenizers whose words are told apart here.
_STEPS = {
    "normalizer": ["NFC", "Replace", "Lowercase"],
    "pre_tokenizer": ["Split", "ByteLevel"],
}
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

#: Characters on which those steps say nothing but lower case, and their words.
_SIMPLE = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\n]+|\n")
_BREAK = "\n"


class Known:
    """Ids of strings met before, in one array that grows by doubling."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self._starts = np.zeros(1024, dtype=np.int64)
        self._ids = np.empty(4096, dtype="<u4")

    def add(self, names: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        first = len(self.number)
        ends = self._starts[first] + np.cumsum(sizes)
        self.number.update(zip(names, range(first, first + len(names)), strict=True))
        self._starts = _roomy(self._starts, len(self.number) + 1)
        self._starts[first + 1 : len(self.number) + 1] = ends
        self._ids = _roomy(self._ids, int(ends[-1]))
        self._ids[ends[-1] - len(ids) : ends[-1]] = ids

    def take(self, names: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of the strings in a row, how many each has, and the strings' numbers."""
        at = np.fromiter(map(self.number.__getitem__, names), np.int64, len(names))
        starts, sizes = self._starts[at], self._starts[at + 1] - self._starts[at]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0)
        return self._ids[places + np.repeat(starts - ends + sizes, sizes)], sizes, at


def _roomy(a: np.ndarray, size: int) -> np.ndarray:
    if size <= len(a):
        return a
    out = np.empty(max(size, 2 * len(a)), dtype=a.dtype)
    out[: len(a)] = a
    return out


class ChunkEncoder:
    """Ids of whole texts, one distinct chunk between white space at a time.

    Fit for tokenizers that drop white space and never look across it: the ids of a
    text are then those of its chunks in a row, and a chunk met before costs a lookup.
    Where the tokenizer's steps are the ones known here, a new chunk of plain Latin
    letters is cut into its words, and only new words go through the merges.
    """

    def __init__(self, tokenizer_json: bytes, known: int = KNOWN) -> None:
        # tasks share the cores already; read when the first batch is encoded
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_buffer(tokenizer_json)
        self._merges, self._special = None, ()
        told = json.loads(tokenizer_json)
        if _known_steps(told):
            told |= {"normalizer": None, "pre_tokenizer": None, "added_tokens": []}
            self._merges = Tokenizer.from_str(json.dumps(told))
            letters = [chr(c) for c in range(256) if _SIMPLE.fullmatch(chr(c))]
            level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self._bytes = {ord(c): level.pre_tokenize_str(c)[0][0] for c in letters}
            self._special = tuple(
                t.content for t in self._tokenizer.get_added_tokens_decoder().values()
            )
        self._most = known
        self._forget()

    def _forget(self) -> None:
        self._chunks, self._words = Known(), Known()
        self._words.add([_BREAK], np.empty(0, dtype=np.int64), np.zeros(1, dtype=np.int64))

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        split = [
            _CHUNK.findall(t) if any(c in t for c in _NOT_SPACE) else t.split() for t in texts
        ]
        if len(self._chunks.number) + len(self._words.number) > self._most:
            self._forget()
        number = self._chunks.number
        unseen = [c for c in dict.fromkeys(chain.from_iterable(split)) if c not in number]
        if unseen:
            simple = [c for c in unseen if self._is_simple(c)]
            if simple:
                self._learn_words(simple)
            if others := [c for c in unseen if c not in number]:
                found = [
                    e.ids for e in self._tokenizer.encode_batch(others, add_special_tokens=False)
                ]
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                flat = np.fromiter((i for f in found for i in f), np.int64, int(sizes.sum()))
                self._chunks.add(others, flat, sizes)
        return [self._chunks.take(chunks)[0] for chunks in split]

    def _is_simple(self, chunk: str) -> bool:
        return (
            self._merges is not None
            and _SIMPLE.fullmatch(chunk) is not None
            and not ("<" in chunk and any(s in chunk for s in self._special))
        )

    def _learn_words(self, chunks: list[str]) -> None:
        words = _WORDS.findall(_BREAK.join(chunks).lower())
        unseen = [w for w in dict.fromkeys(words) if w not in self._words.number]
        if unseen:
            found = self._merges.encode(
                [w.translate(self._bytes) for w in unseen],
                is_pretokenized=True,
                add_special_tokens=False,
            )
            sizes = np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(unseen))
            self._words.add(unseen, np.array(found.ids, dtype=np.int64), sizes)
        ids, sizes, number = self._words.take(words)
        starts = np.append(0, np.flatnonzero(number == 0) + 1)  # the break was the first word
        self._chunks.add(chunks, ids, np.add.reduceat(sizes, starts))


def _known_steps(told: dict) -> bool:
    """Whether a tokenizer file has the steps that :data:`_WORDS` stands for."""
    normalizers = (told["normalizer"] or {}).get("normalizers", [])
    splitters = (told["pre_tokenizer"] or {}).get("pretokenizers", [])
    return (
        [n["type"] for n in normalizers] == _STEPS["normalizer"]
        and [s["type"] for s in splitters] == _STEPS["pre_tokenizer"]
        and splitters[0]["pattern"] == {"Regex": _SPLIT}
        and splitters[0]["behavior"] == "Removed"
        and splitters[0]["invert"]
        and not splitters[1]["add_prefix_space"]
        and not splitters[1]["use_regex"]
    )


@lru_cache(maxsize=1)
def _encoder(tokenizer_json: bytes) -> ChunkEncoder:
    """One encoder per Python worker: its next task goes on with what it knows."""
    return ChunkEncoder(tokenizer_json)


def binary_pieces(tokens: int, longest: int) -> list[int]:
    """Lengths that add up to ``tokens``: powers of two from ``longest`` down."""
    whole, rest = divmod(tokens, longest)
    digits = (1 << b for b in reversed(range(longest.bit_length() - 1)))
    return [longest] * whole + [d for d in digits if rest & d]


def _packed(
    batches: Iterator[pa.RecordBatch],
    tokenizer_json: bytes,
    end_id: int,
    longest: int,
    schema: pa.Schema,
) -> Iterator[pa.RecordBatch]:
    encode = _encoder(tokenizer_json)
    end = np.array([end_id], dtype="<u4")
    places = [0] * longest.bit_length()  # sequences so far of each bucket in this task

    def sent(batch: pa.RecordBatch, held: list[tuple[int, int, int, bytes, int, int]]):
        row, *columns = zip(*held, strict=True)
        values = [batch.column(0).take(pa.array(row, pa.int64())), *columns, [0] * len(row)]
        arrays = [
            pa.array(v, f.type) if not isinstance(v, pa.Array) else v.cast(f.type)
            for v, f in zip(values, schema, strict=True)
        ]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    for batch in batches:
        task = (batch.column(2)[0].as_py() if len(batch) else 0) << PLACE_BITS
        held, size = [], 0
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for row, own in enumerate(encode(texts)):
            ids = np.concatenate([own, end])
            start = 0
            for length in binary_pieces(len(ids), longest):
                bucket = longest.bit_length() - length.bit_length()
                number = (bucket << (PLACE_BITS + TASK_BITS)) + task + places[bucket]
                places[bucket] += 1
                piece = ids[start : start + length].tobytes()
                held.append((row, start, length, piece, len(ids), number))
                start += length
            size += len(ids)
            if size > SENT_IDS:
                yield sent(batch, held)
                held, size = [], 0
        if held:
            yield sent(batch, held)


def pack(
    docs: DataFrame,
    tokenizer_json: bytes,
    end_id: int = 1,
    longest: int = 2048,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit numbers;
    ``start`` counts the document's ids before it, ``doc_tokens`` all of them, with
    the closing ``end_id``. A piece is a sequence of its own, so ``offset`` is 0.
    Sequence ids are unique and run through the buckets, longest first: a bucket is
    the range of ids with the same leading bits, then come task and place. Nothing
    is shuffled, counted or stored: a task that runs again gives the same numbers.

    ``longest`` is a power of two of at most 2**30. NULL and empty texts have the
    ``end_id`` alone, one piece of length 1. Rows that repeat, and rows without an
    id, are documents of their own. Very long texts are encoded chunk by chunk and
    sent back in parts. An empty table gives no rows; other columns are not read.
    """
    if longest < 1 or longest & (longest - 1) or longest > 2**30:
        raise ValueError("longest must be a power of two of at most 2**30")
    lean_batches(docs.sparkSession)
    read = docs.select(
        F.col(id_column).alias("id"),
        F.col(text_column).alias("text"),
        F.spark_partition_id().cast("long").alias("task"),
    )
    out = read.sparkSession.createDataFrame([], read.select("id").schema).select(
        F.col("id"),
        *[
            F.lit(None).cast(kind).alias(name)
            for name, kind in (
                ("start", "long"), ("length", "long"), ("ids", "binary"),
                ("doc_tokens", "long"), ("sequence_id", "long"), ("offset", "long"),
            )
        ],
    )
    schema = out.schema
    packed = partial(
        _packed, tokenizer_json=tokenizer_json, end_id=end_id, longest=longest,
        schema=_arrow(schema),
    )
    return read.mapInArrow(packed, schema).withColumnRenamed("id", id_column)


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def store_buckets(packed: DataFrame, path: str) -> None:
    """Write the sequences as one folder per length, which a batch is read from."""
    packed.write.partitionBy("length").parquet(path)
