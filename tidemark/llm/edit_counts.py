"""Token counts that follow edits.

A text is cut into leaves of whole pre-tokens, and the token counts of the leaves
are the bottom of a tree of sums. An edit re-encodes only the leaves it touches,
with a neighbour where the cut between them may no longer hold, and updates the
sums above them.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column_like, lean_batches

#: Characters after which a leaf ends at the next cut.
LEAF = 512
#: A single space between two of these parts pre-tokens, whatever stands around it.
_CUT = re.compile(r"(?<=[A-Za-z0-9.,;:!?]) (?=[A-Za-z0-9])")
_BEFORE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789.,;:!?")
_AFTER = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")

Count = Callable[[str], int]


def byte_pair_counter(ranks: bytes, pattern: str) -> Count:
    """Counts tokens by the vocabulary in ``ranks`` (lines of base64 token and rank)."""
    import tiktoken

    pairs = (line.split() for line in ranks.splitlines() if line)
    vocabulary = {base64.b64decode(token): int(rank) for token, rank in pairs}
    encoding = tiktoken.Encoding(
        "given", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens={}
    )
    return lambda text: len(encoding.encode_ordinary(text))


def leaf_ends(text: str) -> list[int]:
    """Where the leaves of a text end. Leaves start with the space of a cut."""
    ends, at = [], LEAF
    while at < len(text):
        cut = _CUT.search(text, at)
        if cut is None:
            break
        ends.append(cut.start())
        at = cut.start() + LEAF
    return [*ends, len(text)] if text else []


class SumTree:
    """Counts of leaves and the sums above them, in one array; the root is the total."""

    def __init__(self, counts: list[int] | np.ndarray) -> None:
        self.width = 1 << max(0, len(counts) - 1).bit_length()
        self.sums = np.zeros(2 * self.width, dtype=np.int64)
        self.sums[self.width : self.width + len(counts)] = counts
        for i in range(self.width - 1, 0, -1):
            self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    @property
    def total(self) -> int:
        return int(self.sums[1])

    def set(self, leaf: int, count: int) -> None:
        i = leaf + self.width
        change = count - self.sums[i]
        while i:
            self.sums[i] += change
            i //= 2


class CountedText:
    """A text with the tree of its leaf counts, open to edits."""

    def __init__(self, text: str, ends: list[int], counts: list[int], count: Count) -> None:
        starts = [0, *ends][: len(ends)]
        self.leaves = [text[a:b] for a, b in zip(starts, ends, strict=True)]
        self.starts = np.array(starts, dtype=np.int64)
        self.tree, self.count, self.encoded = SumTree(counts), count, 0

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace the ranges [start, end) of the text as it was first; ranges are disjoint.

        Ranges that touch the same or neighbouring leaves are taken together, so an
        untouched leaf stands between two groups and its cuts stop both. Groups go
        from the last to the first: what stands before one is still as it was.
        """
        for first, last, inside in reversed(self._regions(sorted(edits))):
            base = int(self.starts[first])
            old = "".join(self.leaves[first : last + 1])
            parts, at = [], 0
            for start, end, put in inside:
                parts += [old[at : start - base], put]
                at = end - base
            fresh = "".join([*parts, old[at:]])
            while last + 1 < len(self.leaves) and not self._holds(fresh, self.leaves[last + 1]):
                last += 1
                fresh += self.leaves[last]
            while first and not self._holds(self.leaves[first - 1], fresh):
                first -= 1
                fresh = self.leaves[first] + fresh
            self.leaves[first : last + 1] = [fresh] + [""] * (last - first)
            self.encoded += len(fresh)
            self.tree.set(first, self.count(fresh) if fresh else 0)
            for leaf in range(first + 1, last + 1):
                self.tree.set(leaf, 0)

    def _regions(
        self, edits: list[tuple[int, int, str]]
    ) -> list[tuple[int, int, list[tuple[int, int, str]]]]:
        """First and last leaf of each group of edits, and the edits."""
        out: list[tuple[int, int, list[tuple[int, int, str]]]] = []
        for edit in edits:
            if not self.leaves:  # an empty text has one place, its start
                self.leaves, self.starts = [""], np.zeros(1, dtype=np.int64)
            first = max(0, int(np.searchsorted(self.starts, edit[0], side="right")) - 1)
            last = max(first, int(np.searchsorted(self.starts, edit[1], side="left")) - 1)
            if out and first <= out[-1][1] + 1:
                out[-1] = (out[-1][0], max(last, out[-1][1]), [*out[-1][2], edit])
            else:
                out.append((first, last, [edit]))
        return out

    @staticmethod
    def _holds(left: str, right: str) -> bool:
        """Whether pre-tokens are still parted between two pieces."""
        return (
            len(right) > 1
            and right[0] == " "
            and right[1] in _AFTER
            and left[-1:] in _BEFORE
            and left != ""
        )

    @property
    def text(self) -> str:
        return "".join(self.leaves)


def count_tokens(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``docs`` with n_tokens, leaf_ends and leaf_tokens of the whole text.

    The two arrays are the stored form of the tree. NULL and empty texts have no
    leaves and 0 tokens.
    """
    lean_batches(docs.sparkSession)
    n, ends, counts = (
        column_like(c, docs.columns) for c in ("n_tokens", "leaf_ends", "leaf_tokens")
    )

    @F.pandas_udf("tokens long, ends array<int>, counts array<int>")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        count = byte_pair_counter(ranks, pattern)
        for texts in batches:
            rows = []
            for text in texts:
                stops = leaf_ends(text or "")
                held = [count(text[a:b]) for a, b in zip([0, *stops], stops, strict=False)]
                rows.append((sum(held), stops, held))
            yield pd.DataFrame(rows, columns=["tokens", "ends", "counts"])

    found = column_like("counted", docs.columns)
    return docs.withColumn(found, counted("text")).select(
        *docs.columns,
        F.col(f"{found}.tokens").alias(n),
        F.col(f"{found}.ends").alias(ends),
        F.col(f"{found}.counts").alias(counts),
    )


def recount(counted: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """Counts after edits: n_tokens_after and chars_encoded beside the columns given.

    ``counted`` is :func:`count_tokens` with a column ``edits``, an array of
    (start, end, put): code points [start, end) of the text give way to ``put``.
    Ranges of one text are disjoint. A text without edits, or NULL edits, keeps
    its count and encodes nothing; a NULL text counts as empty.
    """
    lean_batches(counted.sparkSession)

    @F.pandas_udf("tokens long, encoded long")
    def updated(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        count = byte_pair_counter(ranks, pattern)
        for texts, ends, counts, edits in batches:
            rows = []
            for text, stops, held, changes in zip(texts, ends, counts, edits, strict=True):
                if changes is None or len(changes) == 0:
                    rows.append((int(np.sum(held)), 0))
                    continue
                tree = CountedText(text or "", list(stops), list(held), count)
                tree.apply([(c["start"], c["end"], c["put"]) for c in changes])
                rows.append((tree.tree.total, tree.encoded))
            yield pd.DataFrame(rows, columns=["tokens", "encoded"])

    after, encoded = (
        column_like(c, counted.columns) for c in ("n_tokens_after", "chars_encoded")
    )
    found = column_like("updated", counted.columns)
    return counted.withColumn(
        found, updated("text", "leaf_ends", "leaf_tokens", "edits")
    ).select(
        *counted.columns,
        F.col(f"{found}.tokens").alias(after),
        F.col(f"{found}.encoded").alias(encoded),
    )


#: Runs of digits that are long enough to be somebody's number.
_NUMBERS = re.compile(r"[0-9]{7,}")


def number_edits(docs: DataFrame) -> DataFrame:
    """``docs`` with edits that put a 0 for each run of seven digits or more."""

    @F.pandas_udf("array<struct<start: int, end: int, put: string>>")
    def masks(texts: pd.Series) -> pd.Series:
        return pd.Series(
            [
                [
                    {"start": m.start(), "end": m.end(), "put": "0"}
                    for m in _NUMBERS.finditer(text or "")
                ]
                for text in texts
            ]
        )

    return docs.withColumn("edits", masks("text"))
