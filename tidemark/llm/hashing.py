"""Hashes of words and word runs of a whole text, by numpy over its UTF-8 bytes.

A word's hash is a polynomial in its bytes modulo 2**64, read off prefix sums, so
the cost per byte is the same for any word length. It depends on nothing but the
bytes: every executor and every run gives the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
#: Bytes hashed at a time: bounds memory for very long texts.
BLOCK = 1 << 20
_BASE = U(0x5851F42D4C957F2D)
_INVERSE = U(pow(0x5851F42D4C957F2D, -1, 2**64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values whose every output bit depends on all input bits."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def seeds(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    with np.errstate(over="ignore"):
        return mixed(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed))


_BYTE = seeds(256, 17)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for at least ``n`` positions."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _powers:
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, dtype=U)
            steps[0] = 1
            tables.append(np.cumprod(steps))
        _powers[size] = (tables[0], tables[1])
    return _powers[size]


def byte_class(letters: bytes | None = None) -> np.ndarray:
    """Which bytes belong to words: all but ASCII white space, or ``letters`` and all above 127."""
    inside = np.ones(256, dtype=bool)
    if letters is None:
        inside[[0x20, *range(0x09, 0x0E)]] = False
    else:
        inside[:128] = False
        inside[np.frombuffer(letters, dtype=np.uint8)] = True
    return inside


SPACED = byte_class()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _blocks(data: np.ndarray, inside: np.ndarray) -> Iterator[np.ndarray]:
    """``data`` cut between words into pieces of about BLOCK bytes."""
    start = 0
    while len(data) - start > BLOCK:
        end = start + BLOCK
        while end < len(data):  # a word longer than a block stays whole
            outside = np.flatnonzero(~inside[data[end : end + BLOCK]])
            if len(outside):
                end += int(outside[0])
                break
            end = min(len(data), end + BLOCK)
        yield data[start:end]
        start = end
    yield data[start:]


def word_hashes(
    text: str | None,
    inside: np.ndarray = SPACED,
    lower: bool = True,
    heads: tuple[int, ...] = (),
) -> np.ndarray:
    """One 64-bit hash per word, in order; A-Z count as a-z if ``lower``.

    ``heads`` adds, after a block's words, the hashes of the first bytes of those
    words that are longer than so many bytes.
    """
    if not text:
        return np.empty(0, dtype=U)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if lower:
        data = _LOWER[data]
    found = []
    for block in _blocks(data, inside):
        marks = np.zeros(len(block) + 2, dtype=np.int8)
        marks[1:-1] = inside[block]
        edges = np.flatnonzero(np.diff(marks))
        starts, ends = edges[::2], edges[1::2]
        power, inverse = _power_tables(len(block))
        prefix = np.zeros(len(block) + 1, dtype=U)
        np.cumsum(_BYTE[block] * power[: len(block)], out=prefix[1:])
        found.append(mixed((prefix[ends] - prefix[starts]) * inverse[starts]))
        for n, salt in zip(heads, seeds(len(heads), 43), strict=True):
            at = starts[ends - starts > n]
            found.append(mixed((prefix[at + n] - prefix[at]) * inverse[at] + salt))
    return np.concatenate(found) if len(found) > 1 else found[0]


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; fewer words make one run."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    factors = seeds(size, 29) | U(1)
    total = np.zeros(len(words) - size + 1, dtype=U)
    for j in range(size):
        total += words[j : len(words) - size + 1 + j] * factors[j]
    return np.unique(mixed(total))
