"""Moving averages of doubles without rounding.

A sliding frame of doubles adds up rounding that depends on the order of its
values: the mean of twenty values 0.1 may come out above 0.1, which reads as a
crossover that never was.  Here a value is split into 32-bit limbs of one
fixed-point grid that covers all values of the column, each limb a signed
integer.  Sums of limbs are sums of integers: exact, in any order, and the
sum of a frame is one running sum less an earlier one, so a row costs the same
whatever the frame's length.

* ``above``, the flag behind a crossover, compares count * value with the sum,
  limb by limb, exactly.
* The mean is the exact quotient, 64 bits beyond the grid, added up from the
  lowest limb: a mean that is a double comes out as that double, any other
  within one unit in the last place.

The grid is found by one aggregate over exponents (its limbs: 3 or 4 for
prices, at most 68 for any doubles).  Running sums hold for 2**30 rows of a
series; ``compute_metrics_exact_long`` runs them within blocks.

Edge cases: nulls are ignored, like ``avg`` does; a frame with NaN, or with
infinities of both signs, has mean NaN, with one infinity that infinity; a
frame without values has a null mean and the flag -1, like the batch
operators; a column without finite values other than zero has a grid of one
limb.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.config import DEFAULT_ALERTS
from barlake.functions.exprs import crossover_sign, pct_change
from barlake.functions.names import change_name, crossover_name, previous_name, sma_name
from barlake.operators.metrics import lookback_rows, metric_columns, series_window
from barlake.operators.segmented import SEG, blocks_with_halo, drop_halo
from barlake.schema import KEY, ORDER

LIMB = 32
#: The lowest bit of any double.
LOWEST = -1074
INF = float("inf")


class Grid:
    """Fixed-point numbers of 32-bit limbs from bit ``base`` up."""

    def __init__(self, base: int, limbs: int):
        self.base, self.limbs = base, limbs

    def split(self, v: Column) -> list[Column]:
        """The signed limbs of a value; null and non-finite values give zero.

        All steps are exact: scaling by a power of two, and remainders."""
        size, sign = F.abs(v), F.when(v < 0, F.lit(-1)).otherwise(F.lit(1))
        out = []
        for bit in range(self.base, self.base + LIMB * self.limbs, LIMB):
            scaled = size / F.lit(2.0 ** bit)
            digits = (scaled - scaled % F.lit(1.0)) % F.lit(2.0 ** LIMB)
            # A double spans 53 bits, so limbs far below its first one hold none.
            top = bit + LIMB + 54
            near = (size < F.lit(2.0 ** top if top < 1024 else INF)) & (size >= F.lit(2.0 ** bit))
            out.append(F.when(near, sign * digits.cast("long")).otherwise(F.lit(0).cast("long")))
        return out

    @staticmethod
    def carried(limbs: Column) -> Column:
        """(carry, digits) of an array of limbs: digits in 0 .. 2**32 - 1, lowest
        first, and what is carried beyond, negative for a negative number."""
        start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("digits"))

        def step(acc: Column, x: Column) -> Column:
            now = x + acc["carry"]
            return F.struct(F.shiftright(now, LIMB).alias("carry"),
                            F.array_append(acc["digits"], now.bitwiseAND(F.lit((1 << LIMB) - 1))).alias("digits"))
        return F.aggregate(limbs, start, step)

    @staticmethod
    def not_negative(limbs: Column) -> Column:
        return F.aggregate(limbs, F.lit(0).cast("long"), lambda carry, x: F.shiftright(x + carry, LIMB)) >= 0

    def quotient(self, limbs: Column, n: Column) -> Column:
        """The number over n as a double: long division, then limbs added up
        from the lowest."""
        sign = F.when(self.not_negative(limbs), F.lit(1)).otherwise(F.lit(-1))
        whole = self.carried(F.transform(limbs, lambda x: x * sign))
        zero = F.lit(0).cast("long")
        digits = F.concat(F.array(whole["carry"]), F.reverse(whole["digits"]), F.array(zero, zero))
        start = F.struct(zero.alias("rest"), F.array().cast("array<bigint>").alias("parts"))

        def step(acc: Column, x: Column) -> Column:
            now = acc["rest"] * F.lit(1 << LIMB) + x
            return F.struct((now % n).alias("rest"), F.array_append(acc["parts"], F.call_function("div", now, n)).alias("parts"))
        parts = F.aggregate(digits, start, step)["parts"]
        # Highest first: bits base + 32 * limbs down to base - 64, each as two factors that are doubles.
        bits = [self.base + LIMB * k for k in range(self.limbs, -3, -1)]
        scale = F.array(*[F.struct(F.lit(2.0 ** (b // 2)).alias("x"), F.lit(2.0 ** (b - b // 2)).alias("y")) for b in bits])
        terms = F.zip_with(parts, scale, lambda q, s: q.cast("double") * s["x"] * s["y"])
        return sign * F.aggregate(F.reverse(terms), F.lit(0.0), lambda t, x: t + x)


def grid_of(df: DataFrame, column: str) -> Grid:
    """The grid that holds every finite value of a column (one aggregate)."""
    size = F.abs(F.col(column).cast("double"))
    place = F.floor(F.log2(F.when((size > 0) & (size < F.lit(INF)), size)))
    low, high = df.agg(F.min(place), F.max(place)).first()
    if low is None:
        return Grid(0, 1)
    base = max((low - 54) // LIMB * LIMB, LOWEST)
    return Grid(base, min(high + 1, 1023) // LIMB - base // LIMB + 1)


def _running(value: Column, grid: Grid, w) -> dict[str, Column]:
    """Sums of limbs and counts up to each row."""
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = {f"__limb_{k}": F.sum(x).over(run) for k, x in enumerate(grid.split(value))}
    tells = {"__n": value.isNotNull(), "__nan": F.isnan(value), "__up": value == F.lit(INF), "__down": value == F.lit(-INF)}
    return out | {name: F.sum(F.coalesce(c, F.lit(False)).cast("long")).over(run) for name, c in tells.items()}


def _frame(name: str, back: int, w) -> Column:
    """A running sum less the one before the frame."""
    return F.col(name) - F.coalesce(F.lag(F.col(name), back).over(w), F.lit(0).cast("long"))


def compute_metrics_exact(df: DataFrame, alerts: Iterable[tuple[str, int]] = DEFAULT_ALERTS, value_col: str = "close",
                          key: str | list[str] = KEY, order: str = ORDER, grid: Grid | None = None) -> DataFrame:
    """The columns of every rule, like ``metrics.compute_metrics``, with exact
    averages and crossovers.  One window specification: one exchange and one
    sort, whatever the rules."""
    alerts = list(alerts)
    w, value = series_window(key, order), F.col(value_col).cast("double")
    periods = sorted({int(p) for kind, p in alerts if kind == "sma_crossover"})
    grid = grid or grid_of(df, value_col)
    running = _running(value, grid, w) if periods else {}
    out = df.select("*", *[c.alias(n) for n, c in running.items()])
    lag = F.lag(F.col(value_col), 1).over(w)
    first = {previous_name(value_col): lag, change_name(value_col): pct_change(F.col(value_col), lag)}
    frames = {f"__{n}{name}": _frame(name, n + 1, w) for n in periods for name in running}
    out = out.select("*", *[c.alias(n) for n, c in (first | frames).items()])
    own = grid.split(value)
    for n in periods:
        at = lambda name, n=n: F.col(f"__{n}{name}")
        limbs = F.array(*[at(f"__limb_{k}") for k in range(grid.limbs)])
        odd = (F.when((at("__nan") > 0) | (at("__up") > 0) & (at("__down") > 0), F.lit(float("nan")))
               .when(at("__up") > 0, F.lit(INF)).when(at("__down") > 0, F.lit(-INF)))
        # count * value less the sum, limb by limb.
        over = F.array(*[own[k] * at("__n") - at(f"__limb_{k}") for k in range(grid.limbs)])
        above = F.when(odd.isNotNull(), value >= odd).when((at("__n") > 0) & value.isNotNull(),
                                                           grid.not_negative(over) & ~F.isnan(value) | F.isnan(value))
        mean = F.coalesce(odd, F.when(at("__n") > 0, grid.quotient(limbs, at("__n"))))
        out = out.withColumns({sma_name(value_col, n): mean, f"__above_{n}": F.when(above, F.lit(1)).otherwise(F.lit(-1))})
    for n in periods:
        flag = F.col(f"__above_{n}")
        out = out.withColumn(crossover_name(sma_name(value_col, n)), crossover_sign(flag, F.lag(flag, 1).over(w)))
    return out.select(*df.columns, *metric_columns(alerts, value_col))


def compute_metrics_exact_long(df: DataFrame, alerts: Iterable[tuple[str, int]] = DEFAULT_ALERTS, value_col: str = "close",
                               key: str = KEY, order: str = ORDER, block_rows: int = 1_000_000) -> DataFrame:
    """The same for series of any length, in blocks with a halo; sums run
    within a block, so their bound holds for any series."""
    alerts, grid = list(alerts), grid_of(df, value_col)
    cols = [c for c in df.columns if c != SEG]
    blocked = blocks_with_halo(df, lookback_rows(alerts), key, order, block_rows)
    out = compute_metrics_exact(blocked, alerts, value_col, [key, "__blk"], order, grid)
    return drop_halo(out).select(*cols, *metric_columns(alerts, value_col))
