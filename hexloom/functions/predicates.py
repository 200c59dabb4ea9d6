"""Small value functions: text flags, sentinels, ramps, bands, ordered confidence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Confidence levels from the weakest to the strongest.
CONFIDENCE = ["UNKNOWN", "LOW", "MEDIUM", "HIGH"]
#: Fixed value: the word for a date that is not known.
UNKNOWN = "UNKNOWN"


def truthy(value: Column) -> Column:
    """Whether a text says YES, TRUE or 1; null says no."""
    return F.coalesce(F.upper(F.trim(value.cast("string"))).isin("YES", "TRUE", "1"), F.lit(False))


def cleaned(value: Column) -> Column:
    """Text without the sentinels for missing values: -99, -099 and the empty text become null."""
    text = F.trim(value.cast("string"))
    return F.when(~text.isin("-99", "-099", ""), text)


def non_negative(value: Column) -> Column:
    """A number, or null where it is negative, a sentinel or no number."""
    number = cleaned(value).try_cast("double")
    return F.when(number >= 0, number)


def ramp(x: Column, low: float, high: float) -> Column:
    """0 up to ``low``, 1 from ``high`` on, linear between."""
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (x - low) / (high - low)))


def clip01(x: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))


def band(x: Column, edges: list[float]) -> Column:
    """The number of edges at or below x."""
    return reduce(lambda a, e: a + F.when(x >= e, 1).otherwise(0), edges, F.lit(0))


def band_confidence(x: Column, edges: list[float], number: Column) -> Column:
    """How deep x is in its band: 0 on an edge, 1 from half a band's width on; open bands take the next band's width."""
    last = len(edges)
    out = F.when(number == 0, (edges[0] - x) / ((edges[1] - edges[0] if last > 1 else edges[0]) / 2))
    for k in range(1, last):
        lo, hi = edges[k - 1], edges[k]
        out = out.when(number == k, F.least(x - lo, hi - x) / ((hi - lo) / 2))
    out = out.when(number == last, (x - edges[-1]) / ((edges[-1] - edges[-2] if last > 1 else edges[-1]) / 2))
    return clip01(out)


def confidence_rank(value: Column) -> Column:
    """The place of a confidence level, 0 for unknown words and null."""
    return F.greatest(F.lit(0), F.coalesce(F.array_position(F.array(*map(F.lit, CONFIDENCE)), value), F.lit(0)) - 1)


def worst_confidence(value: Column) -> Column:
    """The weakest level of a group; an aggregate. An empty group is UNKNOWN."""
    return F.element_at(F.array(*map(F.lit, CONFIDENCE)), (F.coalesce(F.min(confidence_rank(value)), F.lit(0)) + 1).cast("int"))


def valid_on(valid_from: Column, valid_to: Column, day: str) -> Column:
    """Whether a fact holds on a day; null or unknown ends never match. Dates are ISO texts and compare as such."""
    known = valid_from.isNotNull() & valid_to.isNotNull() & (valid_from != UNKNOWN) & (valid_to != UNKNOWN)
    return F.coalesce(known & (valid_from <= day) & (valid_to >= day), F.lit(False))


def named_id(name: Column, names: list[str]) -> Column:
    """The stable number of an enum's name: its place in the list."""
    return (F.array_position(F.array(*map(F.lit, names)), name) - 1).cast("int")
