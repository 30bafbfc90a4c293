"""Registered queries: splits, evaluation, drift, run log, SQL-checkable
models (C1–C7, V1–V17, D1–D5, G1–G4, M3, M7, M8, M9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from domus.operators import aggregates as A
from domus.operators import drift as D
from domus.operators import evaluation as V
from domus.operators import runs as G
from domus.operators import splits as S
from domus.operators.encoding import one_hot
from domus.plans.catalog_features import BUILDING_TYPES
from domus.plans.catalog_prep import BASE_CTE, KEPT_CTE, KEYS5, STATS_CTE, base, kept_stats
from domus.plans.registry import oracle, register, rounded
from domus.sources import fixtures as fx

STATS_VIEWS = ["tx", BASE_CTE, STATS_CTE, KEPT_CTE]
KEYS5_L = KEYS5.split(", ")
SPLIT_SQL = "CASE WHEN ((transaction_id % 1000003) * 7919 + 42) % 1000003 % 10000 < 2000 THEN 'test' ELSE 'train' END"

# Drift periods on the driver data (in place of 2020-03 / 2021-07).
REF_END = "1998-03-01"
CUR_END = "1999-08-01"


# ------------------------------------------------------------------ C
@register("c1_train_test_label", oracle(
    f"SELECT transaction_id, {SPLIT_SQL} AS split FROM base", ["tx", BASE_CTE]))
def c1_train_test_label(spark, d):
    return S.train_test_label(base(spark, d).select("transaction_id"), "transaction_id", 0.2, 42)


@register("c2_kfold_label", oracle(
    """SELECT transaction_id, CAST(ntile(5) OVER (ORDER BY transaction_date, transaction_id) - 1 AS INT) AS fold
       FROM base""", ["tx", BASE_CTE]))
def c2_kfold_label(spark, d):
    b = base(spark, d).select("transaction_id", "transaction_date")
    return S.kfold_label(b, ["transaction_date", "transaction_id"], 5).select("transaction_id", "fold")


@register("c3_stratified_kfold_label", oracle(
    """WITH sb AS (SELECT id, d, y, row_number() OVER (ORDER BY d, id) AS rn FROM scored_binary),
       cls AS (SELECT y, count(*) AS nc, min(rn) AS first_rn FROM sb GROUP BY y),
       cs AS (SELECT y, nc, coalesce(sum(nc) OVER (ORDER BY first_rn
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st FROM cls),
       fa AS (SELECT y, f, greatest(0, floor((st + nc - f + 4) / 5)) - greatest(0, floor((st - f + 4) / 5)) AS alloc
              FROM cs, range(0, 5) r(f)),
       fr AS (SELECT y, f, coalesce(sum(alloc) OVER (PARTITION BY y ORDER BY f
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo, alloc FROM fa),
       pos AS (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY d, id) - 1 AS j FROM sb)
       SELECT p.id, p.y, CAST(fr.f AS INT) AS fold FROM pos p JOIN fr ON p.y = fr.y
       AND p.j >= fr.lo AND p.j < fr.lo + fr.alloc""",
    ["scored_binary"]))
def c3_stratified_kfold_label(spark, d):
    sb = fx.scored_binary(spark, d).select("id", "d", "y")
    return S.stratified_kfold_label(sb, "y", ["d", "id"], 5).select("id", "y", "fold")


@register("c4_group_label", oracle(
    "SELECT transaction_id, department, CAST(dense_rank() OVER (ORDER BY department) - 1 AS INT) AS fold FROM base",
    ["tx", BASE_CTE]))
def c4_group_label(spark, d):
    return S.group_label(base(spark, d).select("transaction_id", "department"), "department")


TS_CTE = f"""ts AS (
  SELECT {KEYS5}, avg_price_per_m2, row_number() OVER (ORDER BY transaction_year, transaction_month,
         department, city, city_id) - 1 AS row_index, count(*) OVER () AS n FROM kept),
ts2 AS (
  SELECT *, n // 6 AS t FROM ts),
ts3 AS (
  SELECT {KEYS5}, avg_price_per_m2, row_index,
         CAST(CASE WHEN row_index >= n - 5 * t THEN (row_index - (n - 5 * t)) // t END AS INT) AS test_fold,
         CAST(CASE WHEN greatest(0, floor(5 - (n - row_index) / t) + 1) <= 4
                   THEN greatest(0, floor(5 - (n - row_index) / t) + 1) END AS INT) AS first_train_fold
  FROM ts2)"""


def _ts_folds(spark, d):
    k = kept_stats(spark, d)
    return S.time_series_folds(k, ["transaction_year", "transaction_month", "department", "city", "city_id"], 5)


@register("c5_time_series_folds", oracle(
    f"SELECT {KEYS5}, row_index, test_fold, first_train_fold FROM ts3", STATS_VIEWS + [TS_CTE]))
def c5_time_series_folds(spark, d):
    return _ts_folds(spark, d).select(*KEYS5_L, "row_index", "test_fold", "first_train_fold")


@register("c6_fold_report", oracle(
    """SELECT fold, role, count(*) AS num_rows, min(period) AS first_date, max(period) AS last_date,
              avg(avg_price_per_m2) AS target_mean
       FROM (SELECT f.fold, 'train' AS role, transaction_year * 100 + transaction_month AS period, avg_price_per_m2
             FROM ts3, range(0, 5) f(fold) WHERE first_train_fold IS NOT NULL AND f.fold >= first_train_fold
             UNION ALL
             SELECT test_fold, 'test', transaction_year * 100 + transaction_month, avg_price_per_m2
             FROM ts3 WHERE test_fold IS NOT NULL)
       GROUP BY fold, role""", STATS_VIEWS + [TS_CTE], ["target_mean"], 6))
def c6_fold_report(spark, d):
    roles = S.fold_roles(_ts_folds(spark, d), 5).withColumn(
        "period", F.col("transaction_year") * 100 + F.col("transaction_month"))
    rep = S.fold_report(roles, "period", "avg_price_per_m2")
    return rounded(rep.withColumn("fold", F.col("fold").cast("bigint")), 6)


@register("c7_version_slice", oracle(
    "SELECT transaction_year, count(*) AS n FROM base WHERE transaction_year BETWEEN 1996 AND 1997 GROUP BY 1",
    ["tx", BASE_CTE]))
def c7_version_slice(spark, d):
    return S.version_slice(base(spark, d), "transaction_year", 1996, 1997).groupBy("transaction_year").agg(
        F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ V (regression)
REG_METRICS_SQL = """count(y - prediction) AS n, sqrt(avg((y - prediction) * (y - prediction))) AS rmse,
  avg(abs(y - prediction)) AS mae,
  1.0E0 - sum((y - prediction) * (y - prediction)) / (var_pop(y) * count(y - prediction)) AS r2"""
REG_ROUND = {"rmse": 6, "mae": 6, "r2": 9}


@register("v1_regression_metrics", oracle(
    f"SELECT {REG_METRICS_SQL} FROM scored_regression", ["scored_regression"], ["rmse", "mae", "r2"],
    overrides=REG_ROUND))
def v1_regression_metrics(spark, d):
    return rounded(V.regression_metrics(fx.scored_regression(spark, d), "y", "prediction"), overrides=REG_ROUND)


@register("v1_regression_metrics_by_category", oracle(
    f"SELECT category, {REG_METRICS_SQL} FROM scored_regression GROUP BY category", ["scored_regression"],
    ["rmse", "mae", "r2"], overrides=REG_ROUND))
def v1_regression_metrics_by_category(spark, d):
    out = V.regression_metrics(fx.scored_regression(spark, d), "y", "prediction", by=["category"])
    return rounded(out, overrides=REG_ROUND)


@register("v2_error_describe", oracle(
    """SELECT category, 'abs_error' AS "column", count(e) AS count,
              CAST(sum(CASE WHEN e IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count,
              avg(e) AS mean, stddev_samp(e) AS std, min(e) AS min, quantile_cont(e, 0.25E0) AS q25,
              quantile_cont(e, 0.5E0) AS q50, quantile_cont(e, 0.75E0) AS q75, max(e) AS max
       FROM (SELECT category, abs(y - prediction) AS e FROM scored_regression) GROUP BY category""",
    ["scored_regression"], ["mean", "std", "min", "q25", "q50", "q75", "max"], 4))
def v2_error_describe(spark, d):
    return rounded(V.error_describe(fx.scored_regression(spark, d), "y", "prediction", by=["category"]), 4)


@register("v3_add_error", oracle(
    "SELECT id, y - prediction AS error FROM scored_regression", ["scored_regression"], ["error"]))
def v3_add_error(spark, d):
    return rounded(V.add_error(fx.scored_regression(spark, d), "y", "prediction").select("id", "error"))


@register("v4_box_stats", oracle(
    """WITH e AS (SELECT category, y - prediction AS err FROM scored_regression),
       q AS (SELECT category, count(err) AS n, quantile_cont(err, 0.25E0) AS q1, quantile_cont(err, 0.5E0) AS median,
                    quantile_cont(err, 0.75E0) AS q3 FROM e GROUP BY category)
       SELECT q.category, q.n, q.q1, q.median, q.q3, q.q3 - q.q1 AS iqr,
              min(CASE WHEN err >= q1 - 1.5E0 * (q3 - q1) THEN err END) AS whisker_low,
              max(CASE WHEN err <= q3 + 1.5E0 * (q3 - q1) THEN err END) AS whisker_high,
              CAST(sum(CASE WHEN err < q1 - 1.5E0 * (q3 - q1) OR err > q3 + 1.5E0 * (q3 - q1) THEN 1 ELSE 0 END)
                AS BIGINT) AS n_outliers
       FROM q JOIN e USING (category) GROUP BY ALL""",
    ["scored_regression"], ["q1", "median", "q3", "iqr", "whisker_low", "whisker_high"], 4))
def v4_box_stats(spark, d):
    e = V.add_error(fx.scored_regression(spark, d), "y", "prediction", "err")
    return rounded(V.box_stats(e, "err", ["category"]), 4)


@register("v5_segment_errors", oracle(
    f"SELECT lower(category) AS category, {REG_METRICS_SQL} FROM scored_regression GROUP BY 1",
    ["scored_regression"], ["rmse", "mae", "r2"], overrides=REG_ROUND))
def v5_segment_errors(spark, d):
    oh = one_hot(fx.scored_regression(spark, d), "category", BUILDING_TYPES)
    return rounded(V.segment_errors(oh, "category", "y", "prediction"), overrides=REG_ROUND)


@register("v6_binned_profile", oracle(
    """SELECT CAST(least(greatest(floor((x - lo) / w), 0), 9) AS INT) AS bin, count(*) AS n,
              min(lo) AS range_lo, min(w) AS bin_width, avg(y - prediction) AS mean,
              stddev_pop(y - prediction) AS std
       FROM scored_regression, (SELECT min(x) AS lo, (max(x) - min(x)) / 10 AS w FROM scored_regression)
       WHERE x IS NOT NULL GROUP BY 1""", ["scored_regression"],
    ["range_lo", "bin_width", "mean", "std"], 6))
def v6_binned_profile(spark, d):
    e = V.add_error(fx.scored_regression(spark, d), "y", "prediction", "err")
    return rounded(V.binned_profile(e, "x", "err", 10), 6)


@register("v7_pred_vs_target_limits", oracle(
    """SELECT CAST(least(min(y), min(prediction)) AS DOUBLE) AS axis_min,
              CAST(greatest(max(y), max(prediction)) AS DOUBLE) AS axis_max FROM scored_regression""",
    ["scored_regression"], ["axis_min", "axis_max"]))
def v7_pred_vs_target_limits(spark, d):
    lim, _ = V.pred_vs_target(fx.scored_regression(spark, d), "y", "prediction")
    return rounded(lim)


@register("v7_pred_vs_target_grid", oracle(
    """SELECT CAST(least(greatest(floor((y - mn) / w), 0), 49) AS INT) AS y_bin,
              CAST(least(greatest(floor((prediction - mn) / w), 0), 49) AS INT) AS pred_bin, count(*) AS count
       FROM scored_regression, (SELECT least(min(y), min(prediction)) AS mn,
                                       (greatest(max(y), max(prediction)) - least(min(y), min(prediction))) / 50 AS w
                                FROM scored_regression) GROUP BY 1, 2""", ["scored_regression"]))
def v7_pred_vs_target_grid(spark, d):
    _, grid = V.pred_vs_target(fx.scored_regression(spark, d), "y", "prediction")
    return grid


# ------------------------------------------------------------------ V (classification)
@register("v8_confusion_matrix", oracle(
    """SELECT a.label AS actual, p.label AS predicted, coalesce(c.count, 0) AS count
       FROM (SELECT DISTINCT y AS label FROM scored_binary UNION SELECT DISTINCT prediction FROM scored_binary) a
       CROSS JOIN (SELECT DISTINCT y AS label FROM scored_binary UNION SELECT DISTINCT prediction FROM scored_binary) p
       LEFT JOIN (SELECT y, prediction, count(*) AS count FROM scored_binary GROUP BY ALL) c
         ON c.y = a.label AND c.prediction = p.label""", ["scored_binary"]))
def v8_confusion_matrix(spark, d):
    return V.confusion_matrix(fx.scored_binary(spark, d), "y", "prediction")


@register("v9_classification_report", oracle(
    """WITH cm AS (SELECT y, prediction, count(*) AS c FROM scored_binary GROUP BY ALL),
       lab AS (SELECT y AS l FROM cm UNION SELECT prediction FROM cm),
       t AS (SELECT l, coalesce((SELECT sum(c) FROM cm WHERE y = l), 0) AS support,
                    coalesce((SELECT sum(c) FROM cm WHERE y = l AND prediction = l), 0) AS tp,
                    coalesce((SELECT sum(c) FROM cm WHERE prediction = l), 0) AS npred FROM lab),
       m AS (SELECT l, support, tp,
                    CASE WHEN npred = 0 THEN 0.0E0 ELSE tp / npred END AS precision,
                    CASE WHEN support = 0 THEN 0.0E0 ELSE tp / support END AS recall FROM t),
       f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0E0
                            ELSE 2.0E0 * precision * recall / (precision + recall) END AS f1 FROM m)
       SELECT CAST(l AS VARCHAR) AS label, precision, recall, f1, CAST(support AS BIGINT) AS support FROM f
       UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support),
                        CAST(sum(support) AS BIGINT) FROM f
       UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM f
       UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                        sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM f""",
    ["scored_binary"], ["precision", "recall", "f1"], 9))
def v9_classification_report(spark, d):
    return rounded(V.classification_report(fx.scored_binary(spark, d), "y", "prediction"), 9)


BIN_SQL = """count(*) AS n, CAST(sum(CASE WHEN prediction = 1 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
  CAST(sum(CASE WHEN prediction = 1 AND y <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN prediction <> 1 AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  sum(CASE WHEN y = prediction THEN 1 ELSE 0 END) AS correct"""
BIN_OUT = """{by} n, tp, fp, fn,
  CASE WHEN tp + fp = 0 THEN 0.0E0 ELSE tp / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0.0E0 ELSE tp / (tp + fn) END AS recall,
  CASE WHEN n = 0 THEN 0.0E0 ELSE correct / n END AS accuracy"""
F1_SQL = "CASE WHEN precision + recall = 0 THEN 0.0E0 ELSE 2.0E0 * precision * recall / (precision + recall) END AS f1"


def _bin_sql(src: str, by: str = "") -> str:
    grp = f"GROUP BY {by.rstrip(', ')}" if by else ""
    return (f"SELECT *, {F1_SQL} FROM (SELECT {BIN_OUT.format(by=by)} FROM "
            f"(SELECT {by} {BIN_SQL} FROM {src} {grp}))")


@register("v10_binary_metrics", oracle(_bin_sql("scored_binary", "segment, "), ["scored_binary"],
                                       ["precision", "recall", "accuracy", "f1"], 9))
def v10_binary_metrics(spark, d):
    return rounded(V.binary_metrics(fx.scored_binary(spark, d), "y", "prediction", by=["segment"]), 9)


PTYPE_SQL = """CASE WHEN y = 1 AND prediction = 1 THEN 'true_positive' WHEN y = 0 AND prediction = 0 THEN 'true_negative'
  WHEN y = 0 AND prediction = 1 THEN 'false_positive' WHEN y = 1 AND prediction = 0 THEN 'false_negative' ELSE 'unknown' END"""


@register("v11_prediction_type", oracle(
    f"SELECT {PTYPE_SQL} AS prediction_type, count(*) AS n FROM scored_binary GROUP BY 1", ["scored_binary"]))
def v11_prediction_type(spark, d):
    sb = fx.scored_binary(spark, d).withColumn("prediction_type", V.prediction_type("y", "prediction"))
    return sb.groupBy("prediction_type").agg(F.count(F.lit(1)).alias("n"))


@register("v12_histogram", oracle(
    f"""SELECT prediction_type, CAST(least(greatest(floor((score - lo) / w), 0), 9) AS INT) AS bin, count(*) AS count
        FROM (SELECT *, {PTYPE_SQL} AS prediction_type FROM scored_binary) s,
             (SELECT min(score) AS lo, (max(score) - min(score)) / 10 AS w FROM
                (SELECT score, {PTYPE_SQL} AS pt FROM scored_binary) WHERE pt <> 'true_negative' AND score IS NOT NULL)
        WHERE prediction_type <> 'true_negative' AND score IS NOT NULL GROUP BY 1, 2""", ["scored_binary"]))
def v12_histogram(spark, d):
    sb = fx.scored_binary(spark, d).withColumn("prediction_type", V.prediction_type("y", "prediction"))
    return V.histogram(sb, "score", 10, by=["prediction_type"], where=F.col("prediction_type") != "true_negative")


@register("v13_compare_distributions", oracle(
    """WITH g AS (SELECT 'under' AS "group", x, y, prediction FROM scored_regression WHERE prediction < y
                 UNION ALL SELECT 'all', x, y, prediction FROM scored_regression),
       l AS (SELECT "group", 'x' AS feature, CAST(x AS DOUBLE) AS value FROM g
             UNION ALL SELECT "group", 'y', CAST(y AS DOUBLE) FROM g
             UNION ALL SELECT "group", 'prediction', CAST(prediction AS DOUBLE) FROM g),
       r AS (SELECT feature, min(value) AS lo, (max(value) - min(value)) / 10 AS w FROM l
             WHERE value IS NOT NULL GROUP BY feature),
       c AS (SELECT "group", feature, CAST(least(greatest(floor((value - lo) / w), 0), 9) AS INT) AS bin,
                    count(*) AS count FROM l JOIN r USING (feature) WHERE value IS NOT NULL GROUP BY ALL)
       SELECT *, count / sum(count) OVER (PARTITION BY "group", feature) AS share FROM c""", ["scored_regression"], ["share"]))
def v13_compare_distributions(spark, d):
    sr = fx.scored_regression(spark, d)
    groups = {"under": F.col("prediction") < F.col("y"), "all": F.lit(True)}
    return rounded(V.compare_distributions(sr, ["x", "y", "prediction"], groups, 10))


@register("v14_confident_errors", oracle(
    """SELECT id, y, prediction, score,
              CASE WHEN y = 1 AND prediction = 0 AND score < 0.1E0 THEN 'false_negative' ELSE 'false_positive' END AS error_type
       FROM scored_binary
       WHERE (y = 1 AND prediction = 0 AND score < 0.1E0) OR (y = 0 AND prediction = 1 AND score > 0.9E0)""",
    ["scored_binary"], ["score"]))
def v14_confident_errors(spark, d):
    sb = fx.scored_binary(spark, d).select("id", "y", "prediction", "score")
    return rounded(V.confident_errors(sb, "y", "prediction", "score", 0.1, 0.9))


CURVE_CTE = """cc AS (SELECT score AS threshold, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos,
                    sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg
             FROM scored_binary WHERE score IS NOT NULL GROUP BY score),
cum AS (SELECT *, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp,
               sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM cc)"""


@register("v15_pr_curve", oracle(
    """SELECT threshold, CASE WHEN tp + fp = 0 THEN 0.0E0 ELSE tp / (tp + fp) END AS precision,
              CASE WHEN P = 0 THEN 1.0E0 ELSE tp / P END AS recall FROM cum
       UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0E0, 0.0E0""", ["scored_binary", CURVE_CTE],
    ["threshold", "precision", "recall"], 9))
def v15_pr_curve(spark, d):
    return rounded(V.pr_curve(fx.scored_binary(spark, d), "y", "score"), 9)


@register("v15_pr_auc", oracle(
    """SELECT sum((tp - (tp - pos)) / P * (CASE WHEN tp + fp = 0 THEN 0.0E0 ELSE tp / (tp + fp) END
                 + CASE WHEN (tp - pos) + (fp - neg) = 0 THEN 1.0E0
                        ELSE (tp - pos) / ((tp - pos) + (fp - neg)) END) / 2.0E0) AS pr_auc FROM cum""",
    ["scored_binary", CURVE_CTE], ["pr_auc"], 9))
def v15_pr_auc(spark, d):
    return rounded(V.pr_auc(fx.scored_binary(spark, d), "y", "score"), 9)


@register("v16_roc_curve", oracle(
    """SELECT threshold, fp / N AS fpr, tp / P AS tpr FROM cum
       UNION ALL SELECT CAST(NULL AS DOUBLE), 0.0E0, 0.0E0""", ["scored_binary", CURVE_CTE],
    ["threshold", "fpr", "tpr"], 9))
def v16_roc_curve(spark, d):
    return rounded(V.roc_curve(fx.scored_binary(spark, d), "y", "score"), 9)


@register("v16_roc_auc", oracle(
    "SELECT sum(pos * ((N - fp) + neg / 2.0E0)) / (max(P) * max(N)) AS roc_auc FROM cum",
    ["scored_binary", CURVE_CTE], ["roc_auc"], 9))
def v16_roc_auc(spark, d):
    return rounded(V.roc_auc(fx.scored_binary(spark, d), "y", "score"), 9)


@register("v16_roc_auc_by_segment", oracle(
    """SELECT segment, sum(pos * (neg_below + neg / 2.0E0)) / (sum(pos) * sum(neg)) AS roc_auc FROM (
         SELECT *, coalesce(sum(neg) OVER (PARTITION BY segment ORDER BY threshold
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
         FROM (SELECT segment, score AS threshold, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos,
                      sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg
               FROM scored_binary WHERE score IS NOT NULL GROUP BY ALL)) GROUP BY segment""",
    ["scored_binary"], ["roc_auc"], 9))
def v16_roc_auc_by_segment(spark, d):
    return rounded(V.roc_auc(fx.scored_binary(spark, d), "y", "score", by=["segment"]), 9)


@register("v17_kde", oracle(
    f"""WITH st AS (SELECT category, count(*) AS _n, stddev_samp(x) AS _sd, min(x) AS _lo, max(x) AS _hi,
                  stddev_samp(x) * pow(count(*), -0.2E0) AS _bw, (max(x) - min(x)) / 2000 AS _fw
           FROM scored_regression WHERE x IS NOT NULL GROUP BY category),
       fine AS (SELECT s.category, CAST(least(greatest(floor((x - _lo) / CASE WHEN _fw = 0 THEN 1.0E0 ELSE _fw END), 0),
                                         1999) AS INT) AS _b, count(*) AS _c
                FROM scored_regression s JOIN st USING (category) WHERE x IS NOT NULL GROUP BY ALL),
       pts AS (SELECT f.category, CAST(g.point AS INT) AS point,
                      (_lo - 3.0E0 * _bw) + g.point * (((_hi + 3.0E0 * _bw) - (_lo - 3.0E0 * _bw)) / 199) AS x,
                      _c, _lo + (_b + 0.5E0) * _fw AS _centre, _bw, _n
               FROM fine f JOIN st USING (category), range(0, 200) g(point))
       SELECT category, point, x,
              sum(_c * exp(-0.5E0 * ((x - _centre) / _bw) * ((x - _centre) / _bw))
                  / (_n * _bw * {2.5066282746310002})) AS density
       FROM pts GROUP BY category, point, x""", ["scored_regression"], ["x", "density"], 6))
def v17_kde(spark, d):
    return rounded(V.kde(fx.scored_regression(spark, d), "x", by=["category"]), 6)


# ------------------------------------------------------------------ D
def _periods(spark, d):
    b = base(spark, d)
    ref = b.where(F.col("transaction_date") < F.to_date(F.lit(REF_END)))
    cur = b.where((F.col("transaction_date") >= F.to_date(F.lit(REF_END)))
                  & (F.col("transaction_date") < F.to_date(F.lit(CUR_END))))
    return ref, cur


NUM_DRIFT_COLS = ["price", "living_area", "price_per_m2"]
CAT_DRIFT_COLS = ["building_type", "department"]


def _ks_sql(x: str) -> str:
    big = f"list_sum(list_transform(range(1, 31), lambda k: pow(-1.0E0, k - 1) * exp(-2.0E0 * k * k * {x} * {x})))"
    small = (f"list_sum(list_transform(range(1, 31), lambda k: exp(-((2.0E0 * k - 1) * (2.0E0 * k - 1)) * "
             f"9.869604401089358 / (8.0E0 * {x} * {x}))))")
    return (f"least(1.0E0, greatest(0.0E0, CASE WHEN {x} <= 0 THEN 1.0E0 WHEN {x} >= 0.5E0 THEN 2.0E0 * {big} "
            f"ELSE 1.0E0 - 2.5066282746310002 / {x} * {small} END))")


def _long_sql(cols, cast):
    parts = []
    for side, cond in (("ref", f"transaction_date < DATE '{REF_END}'"),
                       ("cur", f"transaction_date >= DATE '{REF_END}' AND transaction_date < DATE '{CUR_END}'")):
        for c in cols:
            parts.append(f"SELECT '{c}' AS \"column\", CAST({c} AS {cast}) AS value, '{side}' AS side "
                         f"FROM base WHERE {cond}")
    return " UNION ALL ".join(parts)


NUM_DRIFT_SQL = f"""lng AS ({_long_sql(NUM_DRIFT_COLS, "DOUBLE")}),
vc AS (SELECT "column", value, sum(CASE WHEN side = 'ref' THEN 1 ELSE 0 END) AS n_ref,
              sum(CASE WHEN side = 'cur' THEN 1 ELSE 0 END) AS n_cur
       FROM lng WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY ALL),
tt AS (SELECT "column", sum(CASE WHEN side = 'ref' THEN 1 ELSE 0 END) AS tot_ref,
              sum(CASE WHEN side = 'cur' THEN 1 ELSE 0 END) AS tot_cur,
              stddev_pop(CASE WHEN side = 'ref' THEN value END) AS ref_std
       FROM lng WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY ALL),
cs AS (SELECT vc.*, tt.tot_ref, tt.tot_cur, tt.ref_std,
              sum(n_ref) OVER w AS c_ref, sum(n_cur) OVER w AS c_cur,
              lead(value) OVER (PARTITION BY vc."column" ORDER BY value) AS next_value
       FROM vc JOIN tt USING ("column")
       WINDOW w AS (PARTITION BY vc."column" ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ks AS (SELECT "column", tot_ref, tot_cur, ref_std,
              max(abs(c_ref / tot_ref - c_cur / tot_cur)) AS ks_statistic,
              sum(abs(c_ref / tot_ref - c_cur / tot_cur) * coalesce(next_value - value, 0.0E0)) AS wasserstein
       FROM cs GROUP BY ALL),
ks2 AS (SELECT *, ks_statistic * sqrt(tot_ref * tot_cur / (tot_ref + tot_cur)) AS _x,
               wasserstein / NULLIF(ref_std, 0) AS wasserstein_norm,
               CASE WHEN tot_ref > 1000 THEN 'wasserstein' ELSE 'ks' END AS method FROM ks),
numdrift AS (
  SELECT "column", CAST(tot_ref AS BIGINT) AS n_ref, CAST(tot_cur AS BIGINT) AS n_cur, ks_statistic,
         {_ks_sql("_x")} AS ks_p_value, wasserstein_norm, method,
         CASE WHEN method = 'ks' THEN {_ks_sql("_x")} < 0.05E0 ELSE wasserstein_norm >= 0.1E0 END AS drifted
  FROM ks2)"""

CAT_DRIFT_SQL = f"""clng AS ({_long_sql(CAT_DRIFT_COLS, "VARCHAR")}),
cvc AS (SELECT "column", value, sum(CASE WHEN side = 'ref' THEN 1 ELSE 0 END) AS n_ref,
               sum(CASE WHEN side = 'cur' THEN 1 ELSE 0 END) AS n_cur
        FROM clng WHERE value IS NOT NULL GROUP BY ALL),
ctt AS (SELECT "column", sum(n_ref) AS tot_ref, sum(n_cur) AS tot_cur, count(*) AS k FROM cvc GROUP BY ALL),
cp AS (SELECT cvc.*, ctt.tot_ref, ctt.tot_cur, ctt.k,
              CASE WHEN n_ref / tot_ref = 0 THEN 1.0E-4 ELSE n_ref / tot_ref END AS p,
              CASE WHEN n_cur / tot_cur = 0 THEN 1.0E-4 ELSE n_cur / tot_cur END AS q,
              n_ref * (tot_cur / tot_ref) AS ex
       FROM cvc JOIN ctt USING ("column")),
cn AS (SELECT cp.*, p / sum(p) OVER (PARTITION BY "column") AS pn, q / sum(q) OVER (PARTITION BY "column") AS qn
       FROM cp),
catdrift AS (
  SELECT "column", CAST(tot_ref AS BIGINT) AS n_ref, CAST(tot_cur AS BIGINT) AS n_cur,
         sqrt(greatest(0.0E0, sum(0.5E0 * pn * ln(pn / ((pn + qn) / 2.0E0))
                                  + 0.5E0 * qn * ln(qn / ((pn + qn) / 2.0E0))))) AS js_distance,
         sum((n_cur - ex) * (n_cur - ex) / NULLIF(ex, 0)) AS chi2_statistic,
         CAST(k - 1 AS INT) AS dof,
         'jensenshannon' AS method
  FROM cn GROUP BY "column", tot_ref, tot_cur, k)"""


@register("d1_numeric_drift", oracle(
    "SELECT * FROM numdrift", ["tx", BASE_CTE, NUM_DRIFT_SQL],
    ["ks_statistic", "ks_p_value", "wasserstein_norm"], 6))
def d1_numeric_drift(spark, d):
    ref, cur = _periods(spark, d)
    return rounded(D.numeric_drift(ref, cur, NUM_DRIFT_COLS), 6)


@register("d2_categorical_drift", oracle(
    "SELECT *, js_distance >= 0.1E0 AS drifted FROM catdrift", ["tx", BASE_CTE, CAT_DRIFT_SQL],
    ["js_distance", "chi2_statistic"], 6))
def d2_categorical_drift(spark, d):
    ref, cur = _periods(spark, d)
    return rounded(D.categorical_drift(ref, cur, CAT_DRIFT_COLS, method="jensenshannon", with_p_value=False), 6)


@register("d2_categorical_drift_p_value")
def d2_categorical_drift_p_value(spark, d):
    ref, cur = _periods(spark, d)
    return D.categorical_drift(ref, cur, CAT_DRIFT_COLS, method="chisquare")


@register("d3_dataset_drift", oracle(
    """SELECT count(*) AS n_columns, CAST(sum(CASE WHEN drifted THEN 1 ELSE 0 END) AS BIGINT) AS n_drifted,
              count(CASE WHEN drifted IS NULL THEN 1 END) AS n_unknown,
              sum(CASE WHEN drifted THEN 1 ELSE 0 END) / count(*) AS share_drifted,
              sum(CASE WHEN drifted THEN 1 ELSE 0 END) / count(*) >= 0.5E0 AS dataset_drift
       FROM (SELECT "column", drifted FROM numdrift
             UNION ALL SELECT "column", js_distance >= 0.1E0 FROM catdrift)""",
    ["tx", BASE_CTE, NUM_DRIFT_SQL, CAT_DRIFT_SQL], ["share_drifted"]))
def d3_dataset_drift(spark, d):
    ref, cur = _periods(spark, d)
    num = D.numeric_drift(ref, cur, NUM_DRIFT_COLS)
    cat = D.categorical_drift(ref, cur, CAT_DRIFT_COLS, method="jensenshannon", with_p_value=False)
    return rounded(D.dataset_drift(num, cat))


@register("d4_target_correlations", oracle(
    " UNION ALL ".join(
        f"""SELECT '{side}' AS side, CAST(NULL AS VARCHAR) AS target_class, '{f}' AS feature, corr(price, {f}) AS r,
                   count(CASE WHEN price IS NOT NULL AND {f} IS NOT NULL THEN 1 END) AS n
            FROM base WHERE {cond}"""
        for side, cond in (("ref", f"transaction_date < DATE '{REF_END}'"),
                           ("cur", f"transaction_date >= DATE '{REF_END}' AND transaction_date < DATE '{CUR_END}'"))
        for f in ["living_area", "num_rooms", "latitude"]), ["tx", BASE_CTE], ["r"], 6))
def d4_target_correlations(spark, d):
    ref, cur = _periods(spark, d)
    _, corr = D.target_drift(ref, cur, "price", None, ["living_area", "num_rooms", "latitude"])
    return rounded(corr, 6)


@register("d4_target_drift", oracle(
    """SELECT *, 'number' AS kind, CASE WHEN method = 'ks' THEN ks_statistic ELSE wasserstein_norm END AS statistic
       FROM numdrift WHERE "column" = 'price'""", ["tx", BASE_CTE, NUM_DRIFT_SQL],
    ["ks_statistic", "ks_p_value", "wasserstein_norm", "statistic"], 6))
def d4_target_drift(spark, d):
    ref, cur = _periods(spark, d)
    drift, _ = D.target_drift(ref, cur, "price", None, ["living_area"], details=True)
    return rounded(drift, 6)


@register("d5_class_balance_by_period", oracle(
    f"""SELECT CASE WHEN strftime(transaction_date, '%Y-%m') < '1998-03' THEN 'pre'
                    WHEN strftime(transaction_date, '%Y-%m') <= '1999-07' THEN 'during' ELSE 'post' END AS period,
               below_market, count(*) AS count
        FROM labelled GROUP BY ALL""", ["tx", BASE_CTE, STATS_CTE, KEPT_CTE, """labelled AS (
  SELECT b.*, CASE WHEN b.price_per_m2 < k.avg_price_per_m2 - 0.1E0 * k.avg_price_per_m2 THEN 1 ELSE 0 END
         AS below_market FROM base b JOIN kept k USING (department, city, city_id, transaction_year, transaction_month))"""]))
def d5_class_balance_by_period(spark, d):
    from domus.operators.frames import assign_period
    from domus.plans.catalog_prep import labelled

    lab = assign_period(labelled(spark, d), "transaction_date", "1998-03", "1999-07")
    return A.class_evolution(lab, "period", "below_market")


# ------------------------------------------------------------------ G
def _run_log(spark, d):
    """The runs fixture landed as a run log (map-typed metrics) in the shared
    scratch folder and read back."""
    import uuid

    from domus.session import checkpoint_dir

    r = fx.runs(spark, d)
    recs = r.select(
        F.col("run_id").cast("string").alias("run_id"), F.col("experiment"),
        F.concat(F.lit("run-"), F.col("run_id").cast("string")).alias("run_name"), "status",
        F.lit(None).cast("long").alias("start_time"), F.lit(None).cast("long").alias("end_time"),
        F.create_map(F.lit("model"), F.lit("boosting")).alias("params"),
        F.create_map(F.lit("average_test_f1"), F.col("average_test_f1"),
                     F.lit("num_rows"), F.col("num_rows").cast("double")).alias("metrics"),
        F.create_map().cast("map<string,string>").alias("tags"),
        F.col("num_rows").alias("dataset_rows"), F.lit(None).cast("string").alias("dataset_digest"),
        F.lit(None).cast("string").alias("model_path"))
    path = f"{checkpoint_dir(spark)}/runs-{uuid.uuid4().hex}"
    G.append_runs(recs, path)
    return G.read_runs(spark, path)


@register("g1_append_run", oracle(
    """SELECT CAST(run_id AS VARCHAR) AS run_id, experiment, status, average_test_f1 AS metrics_average_test_f1,
              CAST(num_rows AS DOUBLE) AS metrics_num_rows FROM runs""", ["runs"], ["metrics_average_test_f1"]))
def g1_append_run(spark, d):
    out = G.flatten_metrics(_run_log(spark, d), ["average_test_f1", "num_rows"])
    return rounded(out.select("run_id", "experiment", "status", "metrics_average_test_f1", "metrics_num_rows"))


@register("g2_search_runs", oracle(
    "SELECT run_id, experiment, average_test_f1 FROM runs WHERE status = 'FINISHED' AND experiment = 'click'",
    ["runs"], ["average_test_f1"]))
def g2_search_runs(spark, d):
    r = fx.runs(spark, d).withColumn("run_name", F.lit(None).cast("string"))
    return rounded(G.search_runs(r, status="FINISHED", experiment="click").select(
        "run_id", "experiment", "average_test_f1"))


@register("g3_flatten_metrics", oracle(
    """SELECT CAST(run_id AS VARCHAR) AS run_id, average_test_f1 AS metrics_average_test_f1,
              CAST(num_rows AS DOUBLE) AS metrics_num_rows, CAST(NULL AS DOUBLE) AS metrics_missing FROM runs""",
    ["runs"], ["metrics_average_test_f1"]))
def g3_flatten_metrics(spark, d):
    r = fx.runs(spark, d).select(
        F.col("run_id").cast("string").alias("run_id"),
        F.create_map(F.lit("average_test_f1"), F.col("average_test_f1"),
                     F.lit("num_rows"), F.col("num_rows").cast("double")).alias("metrics"))
    return rounded(G.flatten_metrics(r, ["average_test_f1", "num_rows", "missing"]))


@register("g4_best_run", oracle(
    """SELECT run_id, experiment, average_test_f1 FROM (
         SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY average_test_f1 DESC NULLS LAST, run_id) AS rn
         FROM runs WHERE status = 'FINISHED') WHERE rn = 1""", ["runs"], ["average_test_f1"]))
def g4_best_run(spark, d):
    r = fx.runs(spark, d).where(F.col("status") == "FINISHED")
    return rounded(G.best_run(r, "average_test_f1").select("run_id", "experiment", "average_test_f1"))


# ------------------------------------------------------------------ M (SQL-checkable)
@register("m3_simple_regression", oracle(
    """SELECT CAST(g.i AS INT) AS point, lo + g.i * (hi - lo) / 99 AS x, a + b * (lo + g.i * (hi - lo) / 99) AS prediction,
              b AS slope, a AS intercept
       FROM (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a, min(x) AS lo, max(x) AS hi
             FROM scored_regression), range(0, 100) g(i)""", ["scored_regression"],
    ["x", "prediction", "slope", "intercept"], 6))
def m3_simple_regression(spark, d):
    from domus.operators.models import simple_regression

    return rounded(simple_regression(fx.scored_regression(spark, d), "x", "y", 100), 6)


@register("m7_most_frequent", oracle(
    _bin_sql("""(SELECT s.segment, s.y, m.mode AS prediction FROM scored_binary s,
                 (SELECT y AS mode FROM scored_binary GROUP BY y ORDER BY count(*) DESC, y LIMIT 1) m)""",
             "segment, "), ["scored_binary"], ["precision", "recall", "accuracy", "f1"], 9))
def m7_most_frequent(spark, d):
    from domus.operators.models import most_frequent

    sb = fx.scored_binary(spark, d).select("segment", "y")
    scored = most_frequent(sb, sb, "y", out="prediction")
    return rounded(V.binary_metrics(scored, "y", "prediction", by=["segment"]), 9)


@register("m8_rule_baseline", oracle(
    f"SELECT {REG_METRICS_SQL} FROM (SELECT y, x * 1000.0E0 AS prediction FROM scored_regression)",
    ["scored_regression"], ["rmse", "mae", "r2"], overrides=REG_ROUND))
def m8_rule_baseline(spark, d):
    from domus.operators.models import rule_baseline

    scored = rule_baseline(fx.scored_regression(spark, d), F.col("x") * F.lit(1000.0))
    return rounded(V.regression_metrics(scored, "y", "prediction"), overrides=REG_ROUND)


@register("m9_fit_by_segment_linear", oracle(
    f"""SELECT category, {REG_METRICS_SQL} FROM (
          SELECT s.category, s.y, c.a + c.b * s.x AS prediction FROM scored_regression s
          JOIN (SELECT category, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM scored_regression
                GROUP BY category) c USING (category)) GROUP BY category""",
    ["scored_regression"], ["rmse", "mae", "r2"], overrides=REG_ROUND))
def m9_fit_by_segment_linear(spark, d):
    from domus.operators.models import fit_linear_by_segment, score_linear_by_segment

    sr = fx.scored_regression(spark, d).select("category", "x", "y")
    coefs = fit_linear_by_segment(sr, "category", "y", "x")
    scored = score_linear_by_segment(sr, coefs, "category", "x")
    return rounded(V.regression_metrics(scored, "y", "prediction", by=["category"]), overrides=REG_ROUND)
