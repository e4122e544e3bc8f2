"""Arithmetic that keeps NULLs, plus window scores."""
from pyspark.sql import Column, Window, functions as F


def _c(x):
    return x if isinstance(x, Column) else F.col(x)


def safe_divide(num, den, fallback=None) -> Column:
    """num / den, or the fallback (NULL by default) where den is NULL or zero."""
    quotient = F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
    if fallback is None:
        return quotient
    bad = F.coalesce(_c(den).cast("double"), F.lit(0.0)) == 0
    return F.when(bad, F.lit(fallback)).otherwise(quotient)


def pct_change(new, old) -> Column:
    """(new - old) / old, NULL where old is zero."""
    return F.try_divide(_c(new) - _c(old), _c(old))


def ratio_of(condition) -> Column:
    """Share of rows for which a condition is true."""
    return F.try_divide(F.count_if(condition).cast("double"), F.count(F.lit(1)).cast("double"))


def stable_round(x, digits: int) -> Column:
    """Half-up rounding that first drops float noise six digits further down.

    A mean that is mathematically a tie comes out of a distributed sum as
    88.44499999999999 or 88.44500000000001 by chance of merge order. Rounding
    the noise away first gives one answer for any partitioning.
    """
    return F.round(F.round(_c(x), digits + 6), digits)


def exact_avg(x, digits: int) -> Column:
    """Mean of numbers that have at most `digits` decimals, summed as integers.

    Integer sums do not depend on the order in which partial results merge.
    """
    unit = 10 ** digits
    return F.try_divide(
        F.sum(F.round(_c(x) * unit).cast("bigint")).cast("double"),
        (F.count(_c(x)) * unit).cast("double"),
    )


def greatest_or_null(*cols) -> Column:
    """Greatest value, NULL as soon as one argument is NULL."""
    cols = [_c(c) for c in cols]
    some_null = cols[0].isNull()
    for c in cols[1:]:
        some_null = some_null | c.isNull()
    return F.when(~some_null, F.greatest(*cols))


def linear_score(x, free, span) -> Column:
    """100 up to `free`, then falling linearly to 0 over the next `span`."""
    over = F.greatest(F.lit(0.0), _c(x) - F.lit(float(free)))
    return F.greatest(F.lit(0.0), F.lit(100.0) - over / F.lit(float(span)) * 100)


def rolling_zscore(x, partition_by, order_by, rows: int = 30) -> Column:
    """z of a row against the `rows` rows before it. For keys with bounded history;
    `operators.ordered.rolling_stats` does the same for keys of any size."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by).rowsBetween(-rows, -1)
    return F.try_divide(_c(x) - F.avg(_c(x)).over(w), F.stddev_pop(_c(x)).over(w))


def zscore(x, partition_by) -> Column:
    """z of a row within its whole partition, population deviation. For keys with bounded
    history; `operators.baseline.zscore_by` does the same for keys of any size."""
    w = Window.partitionBy(*partition_by)
    return F.try_divide(_c(x) - F.avg(_c(x)).over(w), F.stddev_pop(_c(x)).over(w))
