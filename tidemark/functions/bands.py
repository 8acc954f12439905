"""Classify a number into labelled bands."""

from __future__ import annotations

from dataclasses import dataclass
from operator import ge, gt, le, lt
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {">=": ge, ">": gt, "<=": le, "<": lt}


@dataclass(frozen=True)
class Bands:
    """Steps tried in order; the first one that holds gives the label.

    ``other`` takes what no step holds for, a NULL input included.
    """

    op: str
    steps: tuple[tuple[float, Any], ...]
    other: Any

    @property
    def labels(self) -> list[Any]:
        return [label for _, label in self.steps] + [self.other]


def banded(value: Column, bands: Bands) -> Column:
    compare = _COMPARE[bands.op]
    out = F
    for edge, label in bands.steps:
        out = out.when(compare(value, F.lit(edge)), F.lit(label))
    return out.otherwise(F.lit(bands.other))


def mislabelled(label: Column, value: Column, bands: Bands) -> Column:
    """True where a known label does not belong to the value beside it.

    A label outside the table or a NULL value is not judged.
    """
    return label.isin(bands.labels) & value.isNotNull() & (banded(value, bands) != label)
