"""Ratios, threshold levels and KPI rounding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._cols import as_col

# Congestion bands on the current/free-flow speed ratio,
# checked top-down, first match wins; anything below is "severe".
LEVEL_BOUNDS = ((0.9, "free"), (0.7, "moderate"), (0.5, "heavy"))
LEVEL_OTHERWISE = "severe"

# A sample counts as congested below this ratio.
CONGESTED_BELOW = 0.80


def safe_ratio(num, den, scale: int | None = 3) -> Column:
    """``round(num / den, scale)`` when ``den > 0``, else null (never raises)."""
    n, d = as_col(num), as_col(den)
    q = n.cast("double") / d.cast("double")
    if scale is not None:
        q = F.round(q, scale)
    return F.when(d > 0, q)


def level(c, bounds: Sequence[tuple[float, str]] = LEVEL_BOUNDS,
          otherwise: str = LEVEL_OTHERWISE, null_label: str | None = None) -> Column:
    """Label a value by descending lower bounds.

    By default a null value falls through to ``otherwise`` (as the original
    job does); pass ``null_label`` to give nulls their own label.
    """
    x = as_col(c)
    expr = None
    if null_label is not None:
        expr = F.when(x.isNull(), F.lit(null_label))
    for bound, label in bounds:
        expr = F.when(x >= bound, F.lit(label)) if expr is None else expr.when(x >= bound, F.lit(label))
    return expr.otherwise(F.lit(otherwise)) if expr is not None else F.lit(otherwise)


# Decimals kept of every value that enters an exact mean.
MEAN_SCALE = 6


#: exact sums are kept in two halves, units div LIMB and units mod LIMB
LIMB = 1 << 20


def exact_sum_parts(c, scale: int = MEAN_SCALE) -> tuple[Column, Column, Column]:
    """Aggregates (high, low, count) whose sums are ``high * LIMB + low`` units of 10^-scale.

    Whole sums do not depend on the order rows are combined in, unlike a double
    sum, so the rounded mean is the same on any partitioning. Both halves are plain
    longs, which generated code adds without boxing, and hold 10^12 values of 10^9.
    """
    x = as_col(c)
    units = F.rint(x.cast("double") * (10 ** scale)).cast("long")
    low = F.pmod(units, F.lit(LIMB))
    return F.sum(F.shiftright(units, 20)), F.sum(low), F.count(x)


def exact_mean(high: Column, low: Column, n: Column, places: int = 3, scale: int = MEAN_SCALE) -> Column:
    """HALF_UP mean at ``places`` decimals, exactly, as a double; null without a value."""
    units = high.cast("decimal(38,0)") * F.lit(LIMB).cast("decimal(8,0)") + low.cast("decimal(38,0)")
    k = 10 ** (scale - places)
    whole = units.cast("decimal(38,0)")
    # div of whole decimals is a long: the mean itself, not the sum, has to fit
    q = F.call_function("div", 2 * F.abs(whole) + n * k, 2 * n * k) * F.signum(whole)
    return F.when(n > 0, q.cast("double") / float(10 ** places))


def exact_means(df: DataFrame, groups: Sequence[Column | str], means: dict[str, tuple],
                others: Sequence[Column] = ()) -> DataFrame:
    """Group and aggregate with exact means: ``means`` maps a name to (value, decimals)."""
    state, places = mean_state(means)
    out = df.groupBy(*groups).agg(*others, *state)
    return finish_means(out, places)


def mean_state(means: dict[str, tuple]) -> tuple[list[Column], dict[str, tuple[str, int]]]:
    """Aggregates that hold the means, and for each name (the state it reads, its decimals).

    Means of one and the same value share their state.
    """
    state, places, held = [], {}, {}
    for name, (value, decimals) in means.items():
        key = held.setdefault(id(value), name)
        if key == name:
            state += [c.alias(f"__{part}_{name}") for part, c in zip(("high", "low", "n"), exact_sum_parts(value))]
        places[name] = key, decimals
    return state, places


def finish_means(out: DataFrame, places: dict[str, tuple[str, int]]) -> DataFrame:
    """The means in place of their state."""
    keep = [c for c in out.columns if not c.startswith(("__high_", "__low_", "__n_"))]
    return out.select(*keep, *[
        exact_mean(F.col(f"__high_{key}"), F.col(f"__low_{key}"), F.col(f"__n_{key}"), decimals).alias(name)
        for name, (key, decimals) in places.items()])
