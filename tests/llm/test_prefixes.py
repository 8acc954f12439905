"""The table of the beginnings of pieces, built at once, and ids of a batch at once."""

from __future__ import annotations

import numpy as np

from tidemark.llm import segment_sampling as S


def _vocabulary() -> S.Vocabulary:
    pieces = ["<s>", "a", "ab", "abcd", "▁", "▁the", "b", "ab", "\U0001f600", "\U0001f601x", "é", "<0x0A>"]
    normal = np.array([p[0] != "<" for p in pieces])
    byte_ids = np.full(256, -1, dtype=np.int64)
    byte_ids[10] = 11
    return S.Vocabulary(pieces, -np.log(np.arange(12) + 2.0), normal, byte_ids, -3.0)


def test_beginnings_are_hashed_at_once(monkeypatch):
    calls, sums = [], S._sums
    monkeypatch.setattr(S, "_sums", lambda codes: calls.append(len(codes)) or sums(codes))
    vocabulary = _vocabulary()
    table = S.Prefixes(vocabulary)
    assert len(calls) <= 2  # not one for each beginning
    whole = {p: i for i, p in enumerate(vocabulary.pieces) if vocabulary.normal[i]}
    begun = {p[:n] for p in whole for n in range(1, len(p) + 1)}
    assert table.longest == 4
    for text in [*begun, "abd", "x", "▁tha", "\U0001f602", "abcde"]:
        codes = np.array([ord(c) for c in text], dtype=np.uint32)
        hit, i = table.find(sums(codes)[-1:])
        assert (bool(hit[0]), int(i[0])) == (text in begun, whole.get(text, -1))
        opens, one = table.find_one(codes[:1])
        longer = any(p[0] == text[0] and len(p) > 1 for p in whole)
        assert (bool(opens[0]), int(one[0])) == (longer, whole.get(text[0], -1))


def test_no_piece_at_all():
    vocabulary = _vocabulary()
    vocabulary.normal[:] = False
    table = S.Prefixes(vocabulary)
    assert table.find(np.array([5], dtype=S.U))[1].tolist() == [-1]
    assert table.find_one(np.array([97, 0x1F600], dtype=np.uint32))[1].tolist() == [-1, -1]
