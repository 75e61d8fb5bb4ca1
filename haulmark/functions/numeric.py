"""Column helpers for sums, means and ratios.

``steady_sum`` and ``steady_avg`` add up whole units and millionths of values
below ``LARGE`` as two ``bigint`` sums. For values of up to six decimals the
result does not depend on the order in which partitions arrive, so a re-run
after a lost executor gives the same digits. What the two sums leave out, that
is what lies below a millionth, values from ``LARGE`` on, NaN and Infinity, is
added up as doubles, so nothing is lost and nothing overflows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICRO = 1_000_000
LARGE = 1e6  # 9e12 values below it fit into a bigint sum
NOISE = 4.5e-16  # two units in the last place of a double


def _near(c: Column) -> Column:
    return F.abs(c) < LARGE


def whole(c: Column) -> Column:
    c = c.cast("double")
    return F.when(_near(c), F.floor(c))


def micro(c: Column) -> Column:
    c = c.cast("double")
    return F.when(_near(c), F.floor((c - F.floor(c)) * float(MICRO) + F.lit(0.5)))


def remainder(c: Column) -> Column:
    """What whole and micro leave out; 0 if it is only the rounding of a six-digit decimal."""
    c = c.cast("double")
    left = (c - F.floor(c)) - F.floor((c - F.floor(c)) * float(MICRO) + F.lit(0.5)) / float(MICRO)
    size = F.abs(c) + F.when(c < 0, 1.0).otherwise(0.0)
    return F.when(_near(c), F.when(F.abs(left) <= size * NOISE, 0.0).otherwise(left)).otherwise(c)


def _join_sums(wholes: Column, micros: Column, rest: Column) -> Column:
    exact = (F.coalesce(wholes, F.lit(0)).cast("double") * float(MICRO) + F.coalesce(micros, F.lit(0))) / float(MICRO)
    return F.when(rest.isNotNull(), F.when(rest == 0, exact).otherwise(exact + rest))


def steady_sum(c: Column) -> Column:
    return _join_sums(F.sum(whole(c)), F.sum(micro(c)), F.sum(remainder(c)))


def steady_avg(c: Column) -> Column:
    return F.try_divide(steady_sum(c), F.count(c))


def avg_parts(name: str, c: Column, weight: Column | None = None) -> list[Column]:
    """Partial sums of one measure, to be merged by ``merged_avg`` after a join; a row may count several times."""
    w = F.lit(1) if weight is None else weight
    return [
        F.sum(whole(c) * w).alias(f"{name}_whole"),
        F.sum(micro(c) * w).alias(f"{name}_micro"),
        F.sum(remainder(c) * w).alias(f"{name}_rest"),
        F.sum(F.when(c.isNotNull(), w).otherwise(0)).alias(f"{name}_n"),
    ]


def parts_avg(name: str) -> Column:
    """Mean of one row of partial sums."""
    parts = [F.col(f"{name}_{part}") for part in ("whole", "micro", "rest")]
    return F.try_divide(_join_sums(*parts), F.col(f"{name}_n"))


def merged_sum(name: str, weight: Column | None = None) -> Column:
    w = F.lit(1) if weight is None else weight
    return _join_sums(*[F.sum(F.col(f"{name}_{part}") * w) for part in ("whole", "micro", "rest")])


def merged_avg(name: str, weight: Column | None = None) -> Column:
    w = F.lit(1) if weight is None else weight
    return F.try_divide(merged_sum(name, weight), F.sum(F.col(f"{name}_n") * w))


def ratio(num: Column, den: Column, factor: float = 1.0) -> Column:
    """``num / den * factor``; 0 when the denominator is 0 or a side is missing."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")) * factor, F.lit(0.0))


def clip(c: Column, low: float, high: float) -> Column:
    """Bound a value; NULL stays NULL."""
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def gaussian_pdf(x: Column, mean: Column, std: Column) -> Column:
    variance = std * std
    return F.exp(-((x - mean) * (x - mean)) / (variance * 2.0)) / F.sqrt(variance * 2.0 * F.pi())


def sample_corr(x: Column, y: Column) -> Column:
    """Pearson correlation; NULL for fewer than two pairs or a constant side.

    ``corr`` itself divides by zero for a constant side, an error in ANSI mode.
    """
    paired_x = F.when(y.isNotNull(), x)
    paired_y = F.when(x.isNotNull(), y)
    varies = (F.min(paired_x) < F.max(paired_x)) & (F.min(paired_y) < F.max(paired_y))
    spread = F.stddev_pop(paired_x) * F.stddev_pop(paired_y)
    return F.when(varies, F.try_divide(F.covar_pop(x, y), spread))
