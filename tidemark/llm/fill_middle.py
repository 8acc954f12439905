"""Fill-in-the-middle: documents rewritten so that a model learns to fill gaps.

A text is a row of units, and two random ranks cut it into prefix, middle and
suffix. The place of a rank comes from an indexable skip list: every link of a lane
carries how many units and how many code points it spans, so a walk down the lanes
that adds up widths ends at the rank's unit and knows its code point.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import column_like, lean_batches
from tidemark.llm.hashing import seeds

#: Marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: One node in 2**RISE of a lane also stands in the lane above.
RISE = 3


class Lane(NamedTuple):
    """Links of one lane: widths in units and code points, and where each node stands below."""

    units: np.ndarray
    points: np.ndarray
    below: np.ndarray


_heights = np.empty(0, dtype=np.int8)


def _tower_heights(n: int) -> np.ndarray:
    """Fixed random tower heights of ``n`` nodes; the first stands in every lane."""
    global _heights
    if len(_heights) < n:
        draws = seeds(1 << max(12, (n - 1).bit_length()), 61)
        lowest = draws & (~draws + np.uint64(1))
        _heights = (np.log2(lowest.astype(np.float64)) // RISE).astype(np.int8)
        _heights[0] = 64
    return _heights[:n]


class SkipList:
    """Units of a text by rank; ``points`` are the code points of each unit."""

    def __init__(self, points: np.ndarray) -> None:
        self.n, self.n_points = len(points), int(points.sum())
        self.lanes = [Lane(np.ones(self.n, dtype=np.int64), points, np.arange(self.n))]
        heights, level = _tower_heights(self.n), 1
        while len(self.lanes[-1].units) > 1 << RISE:
            lower = self.lanes[-1]
            risen = np.flatnonzero(heights >= level)
            heights = heights[risen]
            if len(risen) < len(lower.units):
                self.lanes.append(
                    Lane(
                        np.add.reduceat(lower.units, risen),
                        np.add.reduceat(lower.points, risen),
                        risen,
                    )
                )
            level += 1

    def code_points_before(self, rank: int) -> int:
        """Code points of the first ``rank`` units, for ranks up to the number of units."""
        if rank >= self.n:
            return self.n_points
        node = units = points = 0
        for lane in reversed(self.lanes):
            while units + (width := int(lane.units[node])) <= rank:
                units += width
                points += int(lane.points[node])
                node += 1
            node = int(lane.below[node])
        return points


def unit_widths(text: str, unit: re.Pattern[str] | None) -> np.ndarray:
    """Code points of each unit; what lies between two matches is a unit as well."""
    if unit is None:
        return np.ones(len(text), dtype=np.int64)
    ends, at = [], 0
    for found in unit.finditer(text):
        if found.start() > at:
            ends.append(found.start())
        if found.end() > found.start():
            ends.append(found.end())
        at = found.end()
    if at < len(text):
        ends.append(len(text))
    return np.diff(np.array([0, *ends], dtype=np.int64))


def _draws(seed: int, key: Column) -> list[Column]:
    """The first four groups of 8 hex digits of a hash of seed and key, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [
        F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)
    ]


def fill_in_middle(
    docs: DataFrame,
    seed: int = 1,
    rewritten: int = 90,
    suffix_first: int = 20,
    unit: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and output.

    ``unit`` is a pattern whose matches are units, as are the stretches between
    them; without one every code point is a unit. ``n`` counts units. Two hashes of
    ``seed`` and id modulo n + 1 are the ranks of the cuts. ``rewritten`` percent of
    the documents take the form psm (prefix, suffix, middle), of which
    ``suffix_first`` percent take spm (suffix, prefix, middle); the others, empty
    texts and texts that hold a mark stay plain and have NULL widths.

    NULL counts as the empty text. Rows with equal ids and texts get equal results;
    a NULL id counts as an empty one. Very long texts are cut like others, with some
    twenty bytes of lanes a unit. An empty table gives no rows. Where ``docs`` has a
    column of one of these names, the added one gets underscores.
    """
    lean_batches(docs.sparkSession)
    names = [
        column_like(c, docs.columns)
        for c in ("n", "form", "prefix_chars", "middle_chars", "output")
    ]

    @F.pandas_udf("units long, prefix long, middle long")
    def cuts(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        pattern = None if unit is None else re.compile(unit)
        for texts, *ranks in batches:
            rows = []
            for text, first, second in zip(texts, *ranks, strict=True):
                units = SkipList(unit_widths(text, pattern))
                low, high = sorted((first % (units.n + 1), second % (units.n + 1)))
                prefix = units.code_points_before(low)
                rows.append((units.n, prefix, units.code_points_before(high) - prefix))
            yield pd.DataFrame(rows, columns=["units", "prefix", "middle"])

    h1, h2, h3, h4 = _draws(seed, F.col(id_column))
    text = F.coalesce(F.col(text_column), F.lit(""))
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= F.contains(text, F.lit(mark))
    found = F.col(column_like("cuts", docs.columns))
    plain = (text == "") | marked | (F.pmod(h3, F.lit(100)) >= rewritten)
    form = (
        F.when(plain, "plain")
        .when(F.pmod(h4, F.lit(100)) < suffix_first, "spm")
        .otherwise("psm")
    )
    prefix = F.left(text, found["prefix"].cast("int"))
    middle = F.substring(text, (found["prefix"] + 1).cast("int"), found["middle"].cast("int"))
    suffix = F.substring(text, (found["prefix"] + found["middle"] + 1).cast("int"), F.length(text))
    n, form_name, prefix_name, middle_name, output = names
    cut = docs.withColumn(column_like("cuts", docs.columns), cuts(text, h1, h2))
    formed = cut.withColumn(form_name, form)
    is_plain = F.col(form_name) == "plain"
    return formed.select(
        *docs.columns,
        found["units"].alias(n),
        form_name,
        F.when(~is_plain, found["prefix"]).alias(prefix_name),
        F.when(~is_plain, found["middle"]).alias(middle_name),
        F.when(is_plain, text)
        .when(
            F.col(form_name) == "psm",
            F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle),
        )
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .alias(output),
    )


def restored(output: Column, form: Column) -> Column:
    """The text that :func:`fill_in_middle` made ``output`` from.

    A rewritten text holds no mark of its own, and marks cannot overlap, so the
    parts end where the marks stand.
    """

    def between(start: str, end: str | None) -> Column:
        rest = F.split_part(output, F.lit(start), F.lit(2))
        return rest if end is None else F.split_part(rest, F.lit(end), F.lit(1))

    middle = between(MIDDLE, None)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
