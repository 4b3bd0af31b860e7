"""Speed averages that do not depend on the order of summation.

Ordinary speeds are summed as whole micro-units, so partial sums merge exactly however the
rows are partitioned, and the average is one division at the end. Speeds that these units
cannot hold exactly (very small, very large, NaN, infinite) are summed as doubles beside
them, so that nothing is rounded away and no cast can fail.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = 1_000_000
_UNITS_PER_CENT = UNITS // 100
#: Up to here, 900 million speeds of a window and monitor fit the sum.
_LARGEST = 10_000.0


def speed_parts(speed: Column) -> tuple[Column, Column, Column]:
    """Whole micro-units, the speed itself where these do not hold it, and whether so."""
    small = F.when(F.abs(speed) <= _LARGEST, speed)
    units = F.rint(small * F.lit(float(UNITS))).cast("bigint")
    exact = F.coalesce(units.cast("double") / F.lit(float(UNITS)) == speed, F.lit(False))
    return (
        F.when(exact, units).otherwise(F.lit(0).cast("bigint")),
        F.when(exact, F.lit(0.0)).otherwise(speed),
        F.when(exact, F.lit(0)).otherwise(F.lit(1)).cast("bigint"),
    )


def _with_rest(units: Column, rest: Column, n: Column) -> Column:
    return (units.cast("double") / F.lit(float(UNITS)) + rest) / n


def mean_speed(units: Column, rest: Column, n_rest: Column, n: Column) -> Column:
    exact = units.cast("double") / (n * F.lit(UNITS)).cast("double")
    return F.when(n_rest == 0, exact).otherwise(_with_rest(units, rest, n))


def mean_speed_2dp(units: Column, rest: Column, n_rest: Column, n: Column) -> Column:
    """Average with two decimals, exact halves rounded away from zero; NaN and infinite
    averages stay as they are."""
    half = n * F.lit(_UNITS_PER_CENT)
    cents = F.call_function("div", F.abs(units) * 2 + half, half * 2)
    exact = F.signum(units) * cents.cast("double") / F.lit(100.0)
    return F.when(n_rest == 0, exact).otherwise(F.round(_with_rest(units, rest, n), 2))
