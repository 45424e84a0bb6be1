"""Numeric expressions. Division never raises: an unusable denominator gives null."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(value: Column) -> Column:
    """Tolerant cast: what is not a number becomes null, and so does NaN."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def half_even(value: Column, places: int = 0) -> Column:
    """Round ties to the even neighbour, as numeric Python libraries do."""
    scale = float(10**places)
    return F.rint(value.cast("double") * F.lit(scale)) / F.lit(scale)


def percent_of(part: Column, whole: Column) -> Column:
    """100 * part / whole as double, unrounded; null when `whole` is zero or unknown."""
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))


def utilisation(spent: Column, budget: Column) -> Column:
    """spent / budget in percent, two places, only for a positive budget."""
    budget = budget.cast("double")
    ratio = spent.cast("double") / F.when(budget > 0, budget)
    return half_even(ratio * F.lit(100.0), 2)


def known(flag: Column) -> Column:
    """Treat an unknown condition as False."""
    return F.coalesce(flag, F.lit(False))


def off_range(value: Column, limits: tuple) -> Column:
    """Known to be below the first or above the second limit."""
    low, high = limits
    return known((value < F.lit(low)) | (value > F.lit(high)))


def _limit(category: Column, bands: Mapping[str, tuple], side: int) -> Column:
    pairs = [item for name, band in bands.items() for item in (F.lit(name), F.lit(band[side]))]
    return F.create_map(*pairs)[category]


def off_band(value: Column, category: Column, bands: Mapping[str, tuple]) -> Column:
    """Outside the band of its category; a category without a band never is."""
    return known(
        (value < _limit(category, bands, 0)) | (value > _limit(category, bands, 1))
    )


def in_band(value: Column, category: Column, bands: Mapping[str, tuple]) -> Column:
    """Inside the band of its category, both ends included."""
    return known(
        (value >= _limit(category, bands, 0)) & (value <= _limit(category, bands, 1))
    )
