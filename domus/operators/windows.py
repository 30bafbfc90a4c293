"""Window operators.

Per-group windows (lags, rolling means) partition by the group key, so the
sort runs in parallel across groups; a group is one city's monthly series,
bounded by the calendar.  Windows without a key (W3–W5 on macro tables)
run in one task and are meant for calendar-sized tables only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from domus.functions.columns import month_index  # noqa: F401  (re-exported)
from domus.operators.aggregates import group_share, quantile


def _as_map(cols, suffix: str) -> dict[str, str]:
    if isinstance(cols, dict):
        return cols
    if isinstance(cols, str):
        cols = [cols]
    return {c: f"{c}{suffix}" for c in cols}


def _window(keys, order):
    w = Window.partitionBy(*keys) if keys else Window
    return w.orderBy(*order)


# W1 -------------------------------------------------------------------------
def add_lag(df: DataFrame, cols, keys: list[str], order: list[str], n: int = 1,
            calendar_index: F.Column | None = None) -> DataFrame:
    """Value of the n-th previous **retained** row of the group.

    With ``calendar_index`` (e.g. :func:`month_index`) the lag is kept only
    when that row is exactly n periods earlier, otherwise NULL.
    """
    mapping = _as_map(cols, "_lag")
    w = _window(keys, order)
    out = {}
    for src, dst in mapping.items():
        lagged = F.lag(F.col(src), n).over(w)
        if calendar_index is not None:
            gap = calendar_index - F.lag(calendar_index, n).over(w)
            lagged = F.when(gap == F.lit(n), lagged)
        out[dst] = lagged
    return df.withColumns(out)


# W2 -------------------------------------------------------------------------
def add_rolling_mean(df: DataFrame, cols, keys: list[str], order: list[str], window: int = 6) -> DataFrame:
    """Mean of the current and ``window-1`` previous rows; NULL until the
    frame holds ``window`` non-null values."""
    mapping = _as_map(cols, f"_rolling_{window}")
    w = _window(keys, order).rowsBetween(-(window - 1), 0)
    return df.withColumns({
        dst: F.when(F.count(F.col(src)).over(w) == F.lit(window), F.avg(F.col(src)).over(w))
        for src, dst in mapping.items()
    })


# W3 -------------------------------------------------------------------------
def add_differences(df: DataFrame, col: str, order: list[str], keys: list[str] | None = None,
                    first: str | None = None, second: str | None = None) -> DataFrame:
    """First difference ``x - lag(x)`` and second difference
    ``x - 2·lag(x) + lag(x, 2)`` in ``order``."""
    w = _window(keys, order)
    x = F.col(col)
    return df.withColumns({
        first or f"{col}_change": x - F.lag(x, 1).over(w),
        second or f"{col}_acceleration": x - F.lit(2) * F.lag(x, 1).over(w) + F.lag(x, 2).over(w),
    })


# W4 -------------------------------------------------------------------------
def add_time_rolling_mean(df: DataFrame, col: str, months: int = 6, out: str | None = None,
                          year: str = "year", month: str = "month",
                          keys: list[str] | None = None) -> DataFrame:
    """Mean over the half-open calendar interval ``(t - months, t]`` on
    monthly rows; gaps in the calendar are respected, partial windows are
    allowed and NULLs are skipped."""
    idx = month_index(year, month)
    w = (Window.partitionBy(*keys) if keys else Window).orderBy(idx).rangeBetween(-(months - 1), 0)
    return df.withColumn(out or f"{col}_rolling_{months}m", F.avg(F.col(col)).over(w))


def add_date_rolling_mean(df: DataFrame, col: str, date_col: str, months: int = 6, out: str | None = None,
                          keys: list[str] | None = None) -> DataFrame:
    """Mean over the half-open calendar interval ``(d - months, d]`` on rows
    with arbitrary dates.  The interval frame ``RANGE … PRECEDING`` is
    closed at its lower end, so the rows lying exactly at ``d - months`` are
    subtracted with a second, one-point frame.  Partial windows are allowed
    and NULLs are skipped."""
    part = f"PARTITION BY {', '.join(f'`{k}`' for k in keys)} " if keys else ""
    order = f"ORDER BY `{date_col}`"
    full = f"RANGE BETWEEN INTERVAL {months} MONTHS PRECEDING AND CURRENT ROW"
    edge = f"RANGE BETWEEN INTERVAL {months} MONTHS PRECEDING AND INTERVAL {months} MONTHS PRECEDING"

    def over(agg, frame):
        return F.expr(f"{agg}(`{col}`) OVER ({part}{order} {frame})")

    s_all, n_all = over("sum", full), over("count", full)
    s_edge = F.coalesce(over("sum", edge), F.lit(0))
    n_edge = F.coalesce(over("count", edge), F.lit(0))
    return df.withColumn(out or f"{col}_rolling_{months}m",
                         F.try_divide(s_all - s_edge, (n_all - n_edge).cast("double")))


# W5 -------------------------------------------------------------------------
def forward_fill(df: DataFrame, cols, order: list[str], keys: list[str] | None = None) -> DataFrame:
    """Replace NULLs with the last non-null value earlier in ``order``."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    w = _window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({c: F.last(F.col(c), ignorenulls=True).over(w) for c in cols})


# W6 -------------------------------------------------------------------------
def flag_top_quantile(df: DataFrame, col: str, q: float, out: str, method: str = "exact") -> DataFrame:
    """1 when the value is strictly above the global q-quantile, else 0."""
    thr = quantile(df, col, q, method=method).withColumnRenamed("value", "_thr")
    return (df.crossJoin(F.broadcast(thr))  # one row
            .withColumn(out, F.when(F.col(col) > F.col("_thr"), F.lit(1)).otherwise(F.lit(0)))
            .drop("_thr"))


def city_demand_flag(stats: DataFrame, out: str = "city_requested", q: float = 0.8,
                     count_col: str = "num_transactions_month",
                     keys=("department", "transaction_year", "transaction_month")) -> DataFrame:
    """A3 ∘ W6: a city-month is 'in demand' when its share of the
    department-month transactions is above the q-quantile of all shares."""
    shared = group_share(stats, count_col, list(keys), "_city_share")
    return flag_top_quantile(shared, "_city_share", q, out).drop("_city_share")


# W7 -------------------------------------------------------------------------
def select_by_cumulative_share(df: DataFrame, name: str, weight: str, threshold: float = 0.8,
                               normalise: bool = True) -> DataFrame:
    """Rows by decreasing weight (ties by name) until the cumulative weight
    reaches ``threshold``, the crossing row included.  ``normalise`` turns
    weights into shares of their total first.

    Built on :func:`~domus.operators.ordering.prefix_sums`, so a feature
    table is ordered in one small task and a large table in buckets.
    """
    from domus.operators.ordering import prefix_sums

    if normalise:
        total = df.agg(F.sum(weight).alias("_total"))
        df = df.crossJoin(F.broadcast(total)).withColumn("share", F.col(weight) / F.col("_total")).drop("_total")
    else:
        df = df.withColumn("share", F.col(weight))
    cum = prefix_sums(df, weight, ["share"], descending=True, tie_cols=[name], exclusive=True, prefix="_before_")
    return cum.where(F.col("_before_share") < F.lit(threshold)).drop("_before_share")
