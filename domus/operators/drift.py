"""Drift statistics between a reference and a current period.

Both periods are stacked into one long table (column, value, side), so all
columns are processed by the same distributed jobs: value counts per
(column, value), bucketed prefix sums per column, one aggregation.
"""

from __future__ import annotations

import math
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from domus.operators.aggregates import correlation_pairs
from domus.operators.ordering import prefix_sums
from domus.session import cut_lineage

KS_TERMS = 30
NUM_SIZE_SWITCH = 1000   # above: Wasserstein, else KS (numeric); JS vs chi-square (categorical)
KS_ALPHA = 0.05
WASSERSTEIN_THRESHOLD = 0.1
JS_THRESHOLD = 0.1
CHI_ALPHA = 0.05
EMPTY_SHARE = 1e-4       # share given to a category absent from one side


def _long(ref: DataFrame, cur: DataFrame, cols: list[str], cast: str) -> DataFrame:
    def stack(df, side):
        return df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast(cast).alias("value"), F.lit(side).alias("side"))
            for c in cols])))
    out = stack(ref, "ref").unionByName(stack(cur, "cur")).where(F.col("value").isNotNull())
    if cast == "double":
        out = out.where(~F.isnan("value"))
    return out


def _every_column(st: DataFrame, cols: list[str], method: str) -> DataFrame:
    """A row for the columns without any value on either side, too."""
    names = st.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    out = names.join(st, "column", "left").na.fill(0, ["tot_ref", "tot_cur"])
    return out.withColumn("method", F.coalesce("method", F.lit(method)))


def kolmogorov_sf(x: Column) -> Column:
    """P(K > x) for the Kolmogorov distribution: alternating series for
    x ≥ 0.5, complement of the theta-function form below."""
    big = F.aggregate(F.sequence(F.lit(1), F.lit(KS_TERMS)), F.lit(0.0),
                      lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(F.lit(-2.0) * k * k * x * x))
    small = F.aggregate(F.sequence(F.lit(1), F.lit(KS_TERMS)), F.lit(0.0),
                        lambda acc, k: acc + F.exp(-((F.lit(2.0) * k - 1) * (F.lit(2.0) * k - 1))
                                                   * F.lit(math.pi ** 2) / (F.lit(8.0) * x * x)))
    p = F.when(x <= 0, F.lit(1.0)) \
        .when(x >= 0.5, F.lit(2.0) * big) \
        .otherwise(F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / x * small)
    return F.when(x.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), p)))  # greatest and least skip a NULL


# D1 -------------------------------------------------------------------------
def numeric_drift(ref: DataFrame, cur: DataFrame, cols: list[str], method: str = "auto") -> DataFrame:
    """Per column: two-sample KS statistic and asymptotic p-value, Wasserstein-1
    distance divided by the reference population std, chosen method and
    drift flag (KS: p < 0.05; Wasserstein: ≥ 0.1; auto: Wasserstein when
    the reference has more than 1000 rows).  Where a side has no value the
    statistics, the p-value and the flag are NULL: nothing can be said."""
    long = _long(ref, cur, cols, "double")
    counts = cut_lineage(long.groupBy("column", "value").agg(  # distinct values; everything below reads these
        F.sum(F.when(F.col("side") == "ref", 1).otherwise(0)).alias("n_ref"),
        F.sum(F.when(F.col("side") == "cur", 1).otherwise(0)).alias("n_cur")))
    tot = counts.groupBy("column").agg(
        F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"),
        F.try_divide(F.sum(F.col("n_ref") * F.col("value")), F.sum("n_ref")).alias("ref_mean"))
    off = F.col("value") - F.col("ref_mean")
    std = counts.join(F.broadcast(tot), "column").groupBy("column").agg(  # one row per column
        F.sqrt(F.try_divide(F.sum(F.col("n_ref") * off * off), F.sum("n_ref"))).alias("ref_std"))
    tot = tot.drop("ref_mean").join(F.broadcast(std), "column")
    cum = prefix_sums(counts, "value", ["n_ref", "n_cur"], group_cols=["column"], with_next=True, ready=True)
    cum = cum.join(F.broadcast(tot), "column")  # one row per column
    # NULL statistics where a side has no value
    gap = F.abs(F.try_divide("cum_n_ref", "tot_ref") - F.try_divide("cum_n_cur", "tot_cur"))
    step = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    st = cum.groupBy("column", "tot_ref", "tot_cur", "ref_std").agg(
        F.max(gap).alias("ks_statistic"), F.sum(gap * step).alias("wasserstein"))
    en = F.try_divide(F.col("tot_ref") * F.col("tot_cur"), F.col("tot_ref") + F.col("tot_cur"))
    st = st.withColumn("ks_p_value", kolmogorov_sf(F.col("ks_statistic") * F.sqrt(en)))
    st = st.withColumn("wasserstein_norm", F.try_divide(F.col("wasserstein"), F.col("ref_std")))
    chosen = (F.lit(method) if method != "auto" else
              F.when(F.col("tot_ref") > NUM_SIZE_SWITCH, F.lit("wasserstein")).otherwise(F.lit("ks")))
    st = st.withColumn("method", chosen)
    st = st.withColumn("drifted", F.when(F.col("method") == "ks", F.col("ks_p_value") < KS_ALPHA)
                       .otherwise(F.col("wasserstein_norm") >= WASSERSTEIN_THRESHOLD))
    st = _every_column(st, cols, method if method != "auto" else "ks")
    return st.select(F.col("column"), F.col("tot_ref").alias("n_ref"), F.col("tot_cur").alias("n_cur"),
                     "ks_statistic", "ks_p_value", "wasserstein_norm", "method", "drifted")


# D2 -------------------------------------------------------------------------
@F.pandas_udf(DoubleType())
def chi2_sf(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """Upper tail of the chi-square distribution (regularised gamma Q(k/2, x/2)),
    one value per column — a tiny table."""
    def q(x, k):
        if x is None or k is None or math.isnan(x) or k <= 0:
            return float("nan")
        a, z = k / 2.0, x / 2.0
        if z <= 0:
            return 1.0
        if z < a + 1:  # series for P
            term = total = 1.0 / a
            n = a
            for _ in range(10000):
                n += 1
                term *= z / n
                total += term
                if abs(term) < abs(total) * 1e-15:
                    break
            return max(0.0, 1.0 - total * math.exp(-z + a * math.log(z) - math.lgamma(a)))
        b = z + 1 - a  # continued fraction for Q
        c, d = 1e300, 1 / b
        h = d
        for i in range(1, 10000):
            an = -i * (i - a)
            b += 2
            d = an * d + b
            d = 1e-300 if abs(d) < 1e-300 else d
            c = b + an / c
            c = 1e-300 if abs(c) < 1e-300 else c
            d = 1 / d
            delta = d * c
            h *= delta
            if abs(delta - 1) < 1e-15:
                break
        return min(1.0, math.exp(-z + a * math.log(z) - math.lgamma(a)) * h)
    return pd.Series([q(x, k) for x, k in zip(stat, dof)], dtype="float64")


def categorical_drift(ref: DataFrame, cur: DataFrame, cols: list[str], method: str = "auto",
                      with_p_value: bool = True) -> DataFrame:
    """Per column: Jensen–Shannon distance (natural log) between category
    shares (absent categories get a share of 1e-4, shares renormalised),
    chi-square goodness-of-fit of current counts against reference shares,
    method and drift flag (JS ≥ 0.1; chi-square p < 0.05; auto: JS when the
    reference has more than 1000 rows)."""
    long = _long(ref, cur, cols, "string")
    counts = long.groupBy("column", "value").agg(
        F.sum(F.when(F.col("side") == "ref", 1).otherwise(0)).alias("n_ref"),
        F.sum(F.when(F.col("side") == "cur", 1).otherwise(0)).alias("n_cur"))
    tot = counts.groupBy("column").agg(F.sum("n_ref").alias("tot_ref"), F.sum("n_cur").alias("tot_cur"),
                                       F.count(F.lit(1)).alias("k"))
    c = counts.join(F.broadcast(tot), "column")  # one row per column
    p = F.try_divide("n_ref", "tot_ref")
    q = F.try_divide("n_cur", "tot_cur")
    c = c.withColumn("p", F.when(p == 0, F.lit(EMPTY_SHARE)).otherwise(p)) \
         .withColumn("q", F.when(q == 0, F.lit(EMPTY_SHARE)).otherwise(q))
    c = c.withColumn("exp", F.col("n_ref") * F.try_divide("tot_cur", "tot_ref"))
    sums = c.groupBy("column").agg(F.sum("p").alias("sp"), F.sum("q").alias("sq"))
    c = c.join(F.broadcast(sums), "column")
    pn, qn = F.col("p") / F.col("sp"), F.col("q") / F.col("sq")
    m = (pn + qn) / F.lit(2.0)
    js_term = F.lit(0.5) * pn * F.log(pn / m) + F.lit(0.5) * qn * F.log(qn / m)
    chi_term = F.try_divide((F.col("n_cur") - F.col("exp")) * (F.col("n_cur") - F.col("exp")), F.col("exp"))
    st = c.groupBy("column", "tot_ref", "tot_cur", "k").agg(
        F.sqrt(F.greatest(F.lit(0.0), F.sum(js_term))).alias("js_distance"),
        F.sum(chi_term).alias("chi2_statistic"))
    st = st.withColumn("dof", (F.col("k") - 1).cast("int"))
    chosen = (F.lit(method) if method != "auto" else
              F.when(F.col("tot_ref") > NUM_SIZE_SWITCH, F.lit("jensenshannon")).otherwise(F.lit("chisquare")))
    st = st.withColumn("method", chosen)
    cols_out = [F.col("column"), F.col("tot_ref").alias("n_ref"), F.col("tot_cur").alias("n_cur"),
                "js_distance", "chi2_statistic", "dof", "method"]
    drift = F.col("js_distance") >= JS_THRESHOLD
    if method != "jensenshannon":  # the flag follows the method named in the row
        st = st.withColumn("chi2_p_value", chi2_sf(F.col("chi2_statistic"), F.col("dof").cast("double")))
        drift = F.when(F.col("method") == "chisquare", F.col("chi2_p_value") < CHI_ALPHA).otherwise(drift)
    elif with_p_value:
        st = st.withColumn("chi2_p_value", chi2_sf(F.col("chi2_statistic"), F.col("dof").cast("double")))
    if with_p_value:
        cols_out.append("chi2_p_value")
    st = _every_column(st.withColumn("drifted", drift), cols, method if method != "auto" else "chisquare")
    return st.select(*cols_out, "drifted")


# D3 -------------------------------------------------------------------------
def dataset_drift(*tables: DataFrame, share: float = 0.5) -> DataFrame:
    """Share of drifted columns over the given drift tables; dataset drift
    when the share reaches ``share``.  Columns whose flag is NULL (a side
    without values) are counted apart, in ``n_unknown``, and not in the share."""
    allc = tables[0].select("column", "drifted")
    for t in tables[1:]:
        allc = allc.unionByName(t.select("column", "drifted"))
    agg = allc.agg(F.count(F.lit(1)).alias("n_columns"),
                   F.sum(F.when(F.col("drifted"), 1).otherwise(0)).alias("n_drifted"),
                   F.count(F.when(F.col("drifted").isNull(), 1)).alias("n_unknown"))
    agg = agg.withColumn("share_drifted", F.try_divide("n_drifted", F.col("n_columns") - F.col("n_unknown")))
    return agg.withColumn("dataset_drift", F.col("share_drifted") >= F.lit(share))


# D4 -------------------------------------------------------------------------
def is_class(df: DataFrame, col: str) -> bool:
    """Strings and booleans are class labels; numbers are unless told so."""
    return df.schema[col].dataType.simpleString() in ("string", "boolean")


def target_drift(ref: DataFrame, cur: DataFrame, target: str, prediction: str | None, features: list[str],
                 classes: list[str] | None = None, method: str = "auto",
                 class_method: str = "auto", details: bool = False) -> tuple[DataFrame, DataFrame]:
    """(drift of target and prediction, feature–target correlations per side).

    Columns named in ``classes`` (default: strings and booleans) are compared by
    category shares (:func:`categorical_drift`), the others as numbers; both
    give one row (column, kind, n_ref, n_cur, statistic, method, drifted).
    ``details`` adds the other columns of the two comparisons (both statistics,
    p-values), NULL where a row's comparison has none.
    Correlations use a number target as it is, a class target once per class as
    0/1 (``target_class`` names it, NULL for a number)."""
    cols = [target] + ([prediction] if prediction else [])
    classes = [c for c in cols if is_class(ref, c)] if classes is None else classes
    numbers = [c for c in cols if c not in classes]
    parts = []
    short = ["column", "kind", "n_ref", "n_cur", "statistic", "method", "drifted"]
    if numbers:
        d = numeric_drift(ref, cur, numbers, method)
        stat = F.when(F.col("method") == "ks", F.col("ks_statistic")).otherwise(F.col("wasserstein_norm"))
        parts.append(d.withColumns({"kind": F.lit("number"), "statistic": stat}))
    if [c for c in cols if c in classes]:
        d = categorical_drift(ref, cur, [c for c in cols if c in classes], class_method, with_p_value=details)
        stat = F.when(F.col("method") == "chisquare", F.col("chi2_statistic")).otherwise(F.col("js_distance"))
        parts.append(d.withColumns({"kind": F.lit("class"), "statistic": stat}))
    drift = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    drift = drift if details else drift.select(*short)
    corr = []
    for side, df in (("ref", ref), ("cur", cur)):
        if target in classes:
            # one 0/1 column per class that occurs: a list of labels, not of rows
            labels = [r[0] for r in df.select(F.col(target).cast("string")).where(F.col(target).isNotNull()).distinct().orderBy(target).collect()]
            names = {f"_is_{i}": v for i, v in enumerate(labels)}
            flat = df.select(*features, *[F.when(F.col(target).isNotNull(), (F.col(target).cast("string") == F.lit(v)).cast("double")).alias(n)
                                          for n, v in names.items()])
            pairs = correlation_pairs(flat, [*names, *features])
            label = F.create_map(*[x for n, v in names.items() for x in (F.lit(n), F.lit(v))]) if names else F.create_map().cast("map<string,string>")
            own = pairs.where(F.col("a").isin(list(names)) & ~F.col("b").isin(list(names))).withColumn("target_class", label[F.col("a")])
        else:
            own = correlation_pairs(df, [target] + features).where(F.col("a") == target).withColumn("target_class", F.lit(None).cast("string"))
        corr.append(own.select(F.lit(side).alias("side"), "target_class", F.col("b").alias("feature"), "r", "n"))
    return drift, corr[0].unionByName(corr[1])


# D5 is aggregates.class_evolution over a period column.


# D6 -------------------------------------------------------------------------
def score_by_period(scored: DataFrame, period: str, y: str, yhat: str) -> DataFrame:
    """Classification metrics of frozen-model predictions per period."""
    from domus.operators.evaluation import binary_metrics

    return binary_metrics(scored, y, yhat, by=[period])
