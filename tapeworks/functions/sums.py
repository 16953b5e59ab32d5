"""Sums of doubles that do not depend on the order of the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whole numbers up to 2^53 are exact in a double.
EXACT_DOUBLE_LIMIT = 9007199254740992.0
# One unit in the last place of a value is at most this share of it.
LAST_PLACE = 2.0**-52
# What is finer than a unit goes into steps of 2^-30 and 2^-60 of a unit: sums of 2^33 rows still fit a long.
STEP = float(1 << 30)


def exact_sum(x: Column, scale: int = 4) -> Column:
    """Sum a double column, the same on every run, right to the last place.

    Prices and quantities carry two decimals, their product four. Each value becomes a whole number of
    10^-scale units held in two longs (high part and low 20 bits), so that no realistic sum overflows and the
    hash aggregate keeps fixed-width buffers. Digits finer than a unit go into two more longs, of ever finer
    steps, and what is finer still (1e-22 and less, for four decimals) into a double, whose last digits depend on the
    order; none is dropped for being small. Left out is only what lies
    within one unit in the last place of the value itself: a product of doubles is rounded by as much. What is too
    large for units (from 9e11 on, for four decimals), NaN and infinities are summed as doubles beside that, in
    the order in which they come. NULL when there is no value, as ``sum``.
    """
    unit = float(10**scale)
    scaled = F.rint(x * unit)
    fits = F.abs(scaled) < EXACT_DOUBLE_LIMIT
    whole = F.when(fits, scaled).cast("bigint")
    left_over = x - scaled / unit
    fine = F.when(fits & (F.abs(left_over) > F.lit(LAST_PLACE) * F.abs(x)), left_over) * F.lit(unit * STEP)
    steps = F.rint(fine)
    finer = (fine - steps) * F.lit(STEP)
    rest = finer - F.rint(finer)
    large = F.sum(F.when(~fits, x))
    high = F.sum(F.shiftright(whole, 20))
    low = F.sum(whole.bitwiseAND(F.lit((1 << 20) - 1)))
    # Below 2^53 units one division of doubles is already the nearest double; above, decimals are.
    small = (F.abs(high) < (1 << 32)) & (low < (1 << 52))
    one_unit = F.lit(f"{10 ** -scale:.{scale}f}").cast(f"decimal({scale + 1},{scale})")
    wide = high.cast("decimal(19,0)") * F.lit(1 << 20).cast("decimal(7,0)") + low.cast("decimal(19,0)")
    units = F.when(small, (F.shiftleft(high, 20) + low).cast("double") / unit).otherwise(
        (wide * one_unit).cast("double")
    )
    below = (F.sum(steps.cast("bigint")).cast("double")
             + (F.sum(F.rint(finer).cast("bigint")).cast("double") + F.sum(rest)) / STEP) / (unit * STEP)
    return F.coalesce(units + F.coalesce(below, F.lit(0.0)) + F.coalesce(large, F.lit(0.0)), large)


def exact_avg(x: Column, scale: int = 4) -> Column:
    """Mean built on :func:`exact_sum`; NULL without values."""
    return F.when(F.count(x) > 0, exact_sum(x, scale) / F.count(x))
