"""Column expressions shared by the operators.

All are built-in Catalyst expressions, so they stay inside whole-stage
codegen; none of them needs a UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def positive_or_null(c: Column) -> Column:
    """Keep a value only if it is > 0.  Zero and negatives become NULL,
    NULL stays NULL and NaN (which Spark orders above every number) is kept."""
    return F.when(c > 0, c)


def pct_change(current: Column, previous: Column) -> Column:
    """(current - previous) / previous * 100; NULL when previous is NULL or 0."""
    return F.try_divide(current - previous, previous) * F.lit(100)


def above_flag(value: Column, trend: Column) -> Column:
    """1 when value >= trend, else -1 (a NULL comparison also gives -1)."""
    return F.when(value >= trend, F.lit(1)).otherwise(F.lit(-1))


def crossover_sign(flag: Column, previous_flag: Column) -> Column:
    """+1 on a change to above, -1 on a change to below, 0 otherwise
    (including the first row, where the previous flag is NULL)."""
    changed = flag != previous_flag
    return (F.when((flag > 0) & changed, F.lit(1))
            .when((flag < 0) & changed, F.lit(-1))
            .otherwise(F.lit(0)))


def to_decimal_10_3(c: Column) -> Column:
    """Output rounding of the price alert: DECIMAL(10,3), half up; a value
    that does not fit becomes NULL instead of failing the query."""
    return c.try_cast("decimal(10,3)")


def rounded(c: Column, places: int = 6) -> Column:
    """Stable rounding for comparing DOUBLE results across engines: a 1e-8
    nudge moves exact .5 ties (means of cent prices) off the boundary so two
    engines that sum in a different order still round the same way."""
    return F.round(c + F.lit(1e-8), places)
