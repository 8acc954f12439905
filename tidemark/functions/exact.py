"""Sums and means of doubles that do not depend on the order of adding.

A double is taken as its decimal text, as ``round`` takes it, and cut at
the decimal point: whole numbers and 18 decimals are added apart, each exactly, so
partial sums merge in any order and the result is rounded once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: From here on a double has no decimals, and its decimals would not fit beside it.
_WHOLE_FROM = 1e18
_UNIT = "decimal(1,0)"


class ExactSum:
    """Mergeable state of an exact sum, as aggregates or as columns that hold them.

    ``whole`` and ``part`` add up to the sum of the finite values, ``other`` is the
    plain sum of the others (NULL without any) and ``n`` counts all values.
    """

    FIELDS = ("whole", "part", "other", "n")

    def __init__(self, whole: Column, part: Column, other: Column, n: Column) -> None:
        self.whole, self.part, self.other, self.n = whole, part, other, n

    @classmethod
    def of(cls, value: Column | str) -> ExactSum:
        """Aggregates over rows; NULL is no value."""
        x = (F.col(value) if isinstance(value, str) else value).cast("double")
        size = F.abs(x)
        finite = size < float("inf")  # NaN counts as larger
        text = F.when(size < _WHOLE_FROM, x).cast("decimal(38,18)")
        whole = F.when(size < _WHOLE_FROM, F.floor(text).cast("decimal(38,0)")).when(
            finite, F.when(finite, x).try_cast("decimal(38,0)")
        )
        part = F.pmod(text, F.lit(1).cast(_UNIT)).cast("decimal(38,18)")
        return cls(F.sum(whole), F.sum(part), F.sum(F.when(~finite, x)), F.count(x))

    @classmethod
    def merged(cls, prefix: str) -> ExactSum:
        """Aggregates over rows that hold states in columns named after ``prefix``."""
        return cls(*(F.sum(f"{prefix}_{field}") for field in cls.FIELDS))

    @classmethod
    def held(cls, prefix: str) -> ExactSum:
        """A state that stands in columns named after ``prefix``."""
        return cls(*(F.col(f"{prefix}_{field}") for field in cls.FIELDS))

    def columns(self, prefix: str) -> list[Column]:
        """The state as columns named after ``prefix``."""
        return [getattr(self, field).alias(f"{prefix}_{field}") for field in self.FIELDS]

    def _carried(self) -> tuple[Column, Column]:
        """The finite sum as a whole number and a part from 0 up to 1."""
        part = F.coalesce(self.part, F.lit(0).cast("decimal(38,18)"))
        whole = (self.whole + F.floor(part)).cast("decimal(38,0)")
        return whole, F.pmod(part, F.lit(1).cast(_UNIT))

    def total(self) -> Column:
        """The sum as a double; NULL without any value."""
        whole, part = self._carried()
        near = (whole.cast("decimal(37,18)") + part.cast("decimal(37,18)")).cast("double")
        finite = F.when(F.abs(whole) < _WHOLE_FROM, near).otherwise(whole.cast("double"))
        return F.when(
            self.other.isNull(), finite
        ).otherwise(self.other + F.coalesce(finite, F.lit(0.0)))

    def mean(self, digits: int) -> Column:
        """The mean rounded half-up to ``digits`` decimals (6 at most), decided on the exact sum."""
        whole, part = self._carried()
        n = F.nullif(self.n, F.lit(0)).cast("decimal(19,0)")
        scale = F.lit(10**digits).cast("decimal(7,0)")
        over = F.pmod(whole, n).cast("decimal(19,0)")
        quotient = ((whole - over) / n).cast("decimal(30,0)")
        scaled = part * scale
        units = (over * scale + F.floor(scaled)).cast("decimal(28,0)")
        rest = F.pmod(units, n).cast("decimal(19,0)")
        steps = ((units - rest) / n).cast("decimal(20,0)")
        # twice the rest against n, and what is left below one unit
        twice, below = (rest * 2 - n).cast("decimal(20,0)"), F.pmod(scaled, F.lit(1).cast(_UNIT))
        half = ((twice == 0) & (below == 0)) | ((twice == -1) & (below == F.lit("0.5").cast("decimal(2,1)")))
        above = (twice >= 0) | ((twice == -1) & (below >= F.lit("0.5").cast("decimal(2,1)")))
        up = F.when(above & ~(half & (whole < 0)), 1).otherwise(0)
        rounded = ((quotient * scale + steps + up).cast("decimal(38,0)") / scale).cast("double")
        return F.when(self.other.isNull(), rounded).otherwise(self.total() / self.n)


def exact_total(value: Column | str) -> Column:
    """The sum of doubles, the same for every order of the rows."""
    return ExactSum.of(value).total()


def exact_mean(value: Column | str, digits: int) -> Column:
    """The rounded mean of doubles, the same for every order of the rows."""
    return ExactSum.of(value).mean(digits)
