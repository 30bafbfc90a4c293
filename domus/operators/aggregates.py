"""Aggregations (A1–A11) and sorts / top-k."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from domus.operators.joins import join_small
from domus.operators.ordering import discrete_quantiles

CITY_KEY = ["department", "city", "city_id"]
CITY_MONTH_KEY = CITY_KEY + ["transaction_year", "transaction_month"]


# A1 -------------------------------------------------------------------------
def city_month_stats(df: DataFrame, keys: list[str] | None = None, value: str = "price_per_m2",
                     min_count: int = 4, mean_col: str = "avg_price_per_m2",
                     count_col: str = "num_transactions_month",
                     with_row_count: bool = False) -> tuple[DataFrame, DataFrame]:
    """Mean and non-null count of ``value`` per group → (kept, all), where
    kept has ``count > min_count``.  Partial aggregation runs map-side, so a
    hot group costs one row per input partition in the shuffle."""
    keys = keys or CITY_MONTH_KEY
    aggs = [F.avg(value).alias(mean_col), F.count(value).alias(count_col)]
    if with_row_count:
        aggs.append(F.count(F.lit(1)).alias("num_rows"))
    all_groups = df.groupBy(*keys).agg(*aggs)
    kept = all_groups.where(F.col(count_col) > F.lit(min_count))
    return kept, all_groups


# A2 -------------------------------------------------------------------------
def city_min_monthly_count(stats: DataFrame, keys: list[str] | None = None,
                           count_col: str = "num_transactions_month",
                           out: str = "min_num_transactions_month") -> DataFrame:
    """Per city, the smallest monthly transaction count."""
    return stats.groupBy(*(keys or CITY_KEY)).agg(F.min(count_col).alias(out))


def city_coverage(kept: DataFrame, all_groups: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Share (×100) of distinct cities that keep at least one month."""
    keys = keys or CITY_KEY
    k = kept.select(*keys).distinct().agg(F.count(F.lit(1)).alias("kept_cities"))
    a = all_groups.select(*keys).distinct().agg(F.count(F.lit(1)).alias("all_cities"))
    return k.crossJoin(a).withColumn(
        "pct_cities", F.lit(100.0) * F.try_divide(F.col("kept_cities"), F.col("all_cities")))


# A3 -------------------------------------------------------------------------
def group_share(df: DataFrame, value: str, keys: list[str], out: str) -> DataFrame:
    """``100 * value / sum(value) per group``.

    Written as partial aggregate + join back instead of a window: a hot
    group is pre-aggregated map-side and the join replicates one total row.
    """
    totals = df.groupBy(*keys).agg(F.sum(value).alias("_group_total"))
    return (join_small(df, totals, keys, "left")
            .withColumn(out, F.lit(100.0) * F.try_divide(F.col(value).cast("double"),
                                                         F.col("_group_total").cast("double")))
            .drop("_group_total"))


# A4 -------------------------------------------------------------------------
def quantile(df: DataFrame, col: str, q: float, method: str = "exact",
             accuracy: int = 10000) -> DataFrame:
    """Global quantile as a one-row frame ``(value)``.

    * ``exact`` — discrete (``percentile_disc``): smallest value whose
      cumulative share reaches q.  Distributed: a sketch brackets the rank,
      two counting passes narrow the bracket, only its values are ordered.
    * ``approx`` — ``percentile_approx`` (bounded memory sketch).
    * ``linear`` — interpolated between the two neighbouring ranks, exact
      and distributed (``ordering.linear_quantiles``).
    """
    if method == "approx":
        return df.agg(F.percentile_approx(col, q, accuracy).alias("value"))
    if method == "linear":
        from domus.operators.ordering import linear_quantiles

        return linear_quantiles(df, col, [q]).agg(F.min("value").alias("value"))  # one row, NULL without values
    return discrete_quantiles(df, col, [q]).agg(F.min("value").alias("value"))


# A5 -------------------------------------------------------------------------
def value_counts(df: DataFrame, cols: list[str] | str, out: str = "count") -> DataFrame:
    cols = [cols] if isinstance(cols, str) else cols
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out))


# A6 / D5 --------------------------------------------------------------------
def class_evolution(df: DataFrame, period: str, target: str, pivot_values: list | None = None) -> DataFrame:
    """Rows per (period, class); with ``pivot_values`` one column per class."""
    if pivot_values is not None:
        return (df.groupBy(period).pivot(target, pivot_values).agg(F.count(F.lit(1)))
                .na.fill(0, [str(v) for v in pivot_values]))
    return df.groupBy(period, target).agg(F.count(F.lit(1)).alias("count"))


# A7 -------------------------------------------------------------------------
def drop_small_groups(df: DataFrame, key: str, q: float = 0.25,
                      counts: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Keep rows of groups whose size is strictly above the q-quantile
    (discrete) of the group sizes → (rows, kept keys).

    ``counts`` (key, count) may be passed when the sizes are already known
    from an upstream aggregate, which saves a pass over ``df``.
    """
    counts = counts if counts is not None else value_counts(df, key)
    thr = quantile(counts, "count", q).withColumnRenamed("value", "_thr")
    kept = (counts.crossJoin(F.broadcast(thr))  # one row
            .where(F.col("count") > F.col("_thr")).select(key, "count"))
    return join_small(df, kept.select(key), key, "left_semi"), kept


# A8 -------------------------------------------------------------------------
DESCRIBE_STATS = ["count", "null_count", "mean", "std", "min", "q25", "q50", "q75", "max"]


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that may be NULL (NULL matches NULL)."""
    if not keys:
        return left.crossJoin(right)
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = [left[k].eqNullSafe(r[f"_r_{k}"]) for k in keys]
    return left.join(r, cond, "left").drop(*[f"_r_{k}" for k in keys])


def describe_columns(df: DataFrame, cols: list[str], by: list[str] | None = None,
                     approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """Long-form describe: one row per (by…, column) with count, nulls, mean,
    sample std, min, linear quartiles, max.

    Moments come from one aggregation pass.  Quartiles are exact and
    distributed (:func:`~domus.operators.ordering.linear_quantiles` over the
    stacked columns, without holding a group in one buffer); ``approx=True`` uses ``percentile_approx`` sketches instead.
    """
    from domus.operators.ordering import linear_quantiles

    by = by or []
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"{c}__count"),
            F.sum(F.when(x.isNull(), 1).otherwise(0)).alias(f"{c}__null_count"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__std"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
        if approx:
            aggs.append(F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy).alias(f"{c}__qs"))
    wide = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)

    def fields(c):
        f = [F.lit(c).alias("column"),
             F.col(f"{c}__count").cast("long").alias("count"),
             F.col(f"{c}__null_count").cast("long").alias("null_count"),
             F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
             F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max")]
        if approx:
            f += [F.col(f"{c}__qs")[i].cast("double").alias(n) for i, n in enumerate(("q25", "q50", "q75"))]
        return f

    long = wide.select(*by, F.inline(F.array(*[F.struct(*fields(c)) for c in cols])))
    order = [*by, "column", "count", "null_count", "mean", "std", "min", "q25", "q50", "q75", "max"]
    if approx:
        return long.select(*order)
    stacked = df.select(*by, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])))
    qs = linear_quantiles(stacked, "value", [0.25, 0.5, 0.75], [*by, "column"])
    piv = qs.groupBy(*by, "column").agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(n)
                                          for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))])
    return _null_safe_join(long, piv, [*by, "column"]).select(*order)


# A9 -------------------------------------------------------------------------
def group_series(df: DataFrame, keys: list[str], order: list[str], lags: dict[str, str] | None = None,
                 rolling: dict[str, str] | None = None, window: int = 6) -> DataFrame:
    """Per-group time series features computed in place (no list building):
    ``lags`` maps source → output for a one-row lag, ``rolling`` source →
    output for a ``window``-row mean.  The time key stays on every row."""
    from domus.operators.windows import add_lag, add_rolling_mean

    out = df
    if lags:
        out = add_lag(out, lags, keys, order)
    if rolling:
        out = add_rolling_mean(out, rolling, keys, order, window)
    return out


# A10 ------------------------------------------------------------------------
def correlation_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson r for every unordered pair, pairwise-complete, with the number
    of rows used → (a, b, r, n); NaN counts as missing, r is NULL where a side
    is constant.  All pairs in one pass of matrix products over Arrow batches
    (:func:`~domus.operators.matrices.cross_products`), however many columns."""
    from domus.operators.matrices import cross_products

    names = F.array(*[F.lit(c) for c in cols])
    sums = cross_products(df, cols).where(F.col("a") < F.col("b"))
    va = F.col("saa") - F.try_divide(F.col("sa") * F.col("sa"), F.col("n"))
    vb = F.col("sbb") - F.try_divide(F.col("sb") * F.col("sb"), F.col("n"))
    cov = F.col("sab") - F.try_divide(F.col("sa") * F.col("sb"), F.col("n"))
    # what rounding leaves of a constant column is no variance
    real = (va > F.lit(1e-12) * F.col("saa")) & (vb > F.lit(1e-12) * F.col("sbb"))
    r = F.when(real, F.least(F.greatest(cov / F.sqrt(va * vb), F.lit(-1.0)), F.lit(1.0)))
    return sums.select(F.element_at(names, F.col("a") + 1).alias("a"), F.element_at(names, F.col("b") + 1).alias("b"), r.alias("r"), "n")


# A11 ------------------------------------------------------------------------
def prune_correlated(pairs: DataFrame, order: list[str], threshold: float) -> list[str]:
    """Greedy keep-first: walk ``order``; drop a feature when |r| exceeds
    ``threshold`` with one already kept.  ``pairs`` has k(k-1)/2 rows for k
    features (schema-sized), so it is read on the driver."""
    strong = {(r["a"], r["b"]) for r in pairs.where(F.abs("r") > F.lit(threshold)).collect()}
    kept: list[str] = []
    for f in order:
        if not any((f, k) in strong or (k, f) in strong for k in kept):
            kept.append(f)
    return kept


def strong_pairs(pairs: DataFrame, threshold: float) -> DataFrame:
    return pairs.where(F.abs("r") > F.lit(threshold))


# O1 -------------------------------------------------------------------------
def sort_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Output ordering (range shuffle).  Inside operators order is always a
    window's ORDER BY, never a global sort."""
    return df.orderBy(*keys)


# O2 -------------------------------------------------------------------------
def top_groups(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """The k keys with the most rows (ties by key ascending) → (key, count)."""
    counts = value_counts(df.where(F.col(key).isNotNull()), key)
    return counts.orderBy(F.col("count").desc(), F.col(key).asc()).limit(k)


def keep_top_groups(df: DataFrame, key: str, k: int = 5) -> DataFrame:
    """Rows of the k most frequent keys.  The top list has k rows: a
    bounded broadcast for the semi join."""
    return df.join(F.broadcast(top_groups(df, key, k).select(key)), key, "left_semi")


# O5 -------------------------------------------------------------------------
def best_by(df: DataFrame, keys: list[str], metric: str, tie: str | None = None) -> DataFrame:
    """Row with the highest ``metric`` per group (ties: smallest ``tie``,
    then the other orderable columns; a group whose metrics are all NULL
    keeps one of its rows).

    An aggregation, not a window: ``min_by`` with a key that ranks the
    metric descending runs map-side, so a group holding a third of all rows
    costs one partial row per input partition.  The payload may hold maps."""
    rest = [c for c in df.columns if c not in keys]
    m = F.col(metric).cast("double")
    rank = F.when(m.isNull(), F.lit(float("inf"))).otherwise(-m)
    orderable = [f.name for f in df.schema.fields
                 if f.name in rest and f.name != tie and "map<" not in f.dataType.simpleString()]
    order_key = F.struct(rank.alias("_rank"), *([F.col(tie).alias("_tie")] if tie else []),
                         *[F.col(c).alias(f"_o_{c}") for c in orderable])
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), order_key).alias("_best"))
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in rest]).select(*df.columns)


# O6 -------------------------------------------------------------------------
def sample_rows(df: DataFrame, n: int, id_col: str, seed: int = 42, pick=None) -> DataFrame:
    """n rows picked by a seeded hash of the id (stable under repartition), or
    by the column ``pick``; the limit is the feature (a sample)."""
    h = F.xxhash64(F.col(id_col), F.lit(seed)) if pick is None else pick
    return df.withColumn("_h", h).orderBy("_h", id_col).limit(n).drop("_h")


def sample_columns(df: DataFrame, cols: list[str], n: int, id_col: str, seed: int = 42) -> DataFrame:
    """Each column sampled independently: for column j, the n rows with the
    smallest portable hash(id, seed + j) (ties by id), aligned by slot.
    Every pick is a TakeOrdered of n rows, so each branch is bounded."""
    from domus.operators.splits import portable_hash

    parts = []
    for j, c in enumerate(cols):
        picked = (df.select(id_col, c).withColumn("_h", portable_hash(id_col, seed + j))
                  .orderBy("_h", id_col).limit(n))
        slot = Window.orderBy("_h", id_col)  # n rows only
        parts.append(picked.withColumn("slot", F.row_number().over(slot) - 1).select("slot", c))
    return reduce(lambda a, b: a.join(b, "slot"), parts)
