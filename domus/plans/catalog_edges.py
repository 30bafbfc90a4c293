"""Registered queries for missing values and one-sided data (NULL groups, NULL
classes, constant columns, a side without values), for comparisons of fixed
predictions, and for the parts of model operators that SQL can express.  All
derive their NULLs from the whole fixture tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from domus.operators import aggregates as A
from domus.operators import drift as D
from domus.operators import evaluation as V
from domus.operators import models as M
from domus.operators import runs as G
from domus.operators import splits as S
from domus.plans.catalog_eval import BASE_CTE, CUR_END, REF_END, _periods
from domus.plans.registry import oracle, register, rounded
from domus.session import checkpoint_dir
from domus.sources import fixtures as fx

# ------------------------------------------------------------------ NULL groups, NULL labels
#: a third of the categories are unknown; labels and predictions are missing on some rows
GAPS_CTE = """gaps AS (
  SELECT id, d, x, y AS target, CASE WHEN category LIKE 'S%' THEN NULL ELSE category END AS category,
         CASE WHEN x > 10 THEN y END AS y_gap, CASE WHEN category LIKE 'P%' THEN 5.0E0 ELSE x END AS x_flat
  FROM scored_regression)"""
LABELS_CTE = """labels_gap AS (
  SELECT id, CASE WHEN score > 0.9E0 THEN NULL ELSE y END AS y, CASE WHEN score < 0.1E0 THEN NULL ELSE prediction END AS prediction,
         segment, score, y AS y_all FROM scored_binary)"""


def _gaps(spark, d):
    r = fx.scored_regression(spark, d)
    return r.select("id", "d", F.col("x").cast("double").alias("x"), F.col("y").alias("target"),
                    F.when(~F.col("category").startswith("S"), F.col("category")).alias("category"),
                    F.when(F.col("x") > 10, F.col("y")).alias("y_gap"),
                    F.when(F.col("category").startswith("P"), F.lit(5.0)).otherwise(F.col("x")).alias("x_flat"))


def _labels(spark, d):
    b = fx.scored_binary(spark, d)
    return b.select("id", F.when(~(F.col("score") > 0.9), F.col("y")).alias("y"),
                    F.when(~(F.col("score") < 0.1), F.col("prediction")).alias("prediction"), "segment", "score", F.col("y").alias("y_all"))


@register("a8_describe_null_groups", oracle(
    """SELECT category, 'y_gap' AS "column", count(y_gap) AS count, count(*) - count(y_gap) AS null_count, avg(y_gap) AS mean,
              stddev_samp(y_gap) AS std, min(y_gap) AS min, quantile_cont(y_gap, 0.25) AS q25, quantile_cont(y_gap, 0.5) AS q50,
              quantile_cont(y_gap, 0.75) AS q75, max(y_gap) AS max
       FROM gaps GROUP BY category""", ["scored_regression", GAPS_CTE], ["mean", "std", "min", "q25", "q50", "q75", "max"], 4))
def a8_describe_null_groups(spark, d):
    return rounded(A.describe_columns(_gaps(spark, d), ["y_gap"], by=["category"]), 4)


@register("a10_correlation_nulls", oracle(
    " UNION ALL ".join(f"""SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r, count(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1 END) AS n
                           FROM gaps""" for a, b in (("x", "target"), ("x", "y_gap"), ("x", "x_flat"), ("target", "y_gap"),
                                                     ("target", "x_flat"), ("y_gap", "x_flat"))),
    ["scored_regression", GAPS_CTE], ["r"], 6))
def a10_correlation_nulls(spark, d):
    return rounded(A.correlation_pairs(_gaps(spark, d), ["x", "target", "y_gap", "x_flat"]), 6)


@register("c3_stratified_null_class", oracle(
    """WITH sb AS (SELECT id, y, row_number() OVER (ORDER BY id) AS rn FROM labels_gap),
       cls AS (SELECT y, count(*) AS nc, min(rn) AS first_rn FROM sb GROUP BY y),
       cs AS (SELECT y, nc, coalesce(sum(nc) OVER (ORDER BY first_rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st FROM cls),
       fa AS (SELECT y, f, greatest(0, floor((st + nc - f + 4) / 5)) - greatest(0, floor((st - f + 4) / 5)) AS alloc FROM cs, range(0, 5) r(f)),
       fr AS (SELECT y, f, coalesce(sum(alloc) OVER (PARTITION BY y ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo, alloc FROM fa),
       pos AS (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY id) - 1 AS j FROM sb)
       SELECT p.id, p.y, CAST(fr.f AS INT) AS fold FROM pos p JOIN fr ON p.y IS NOT DISTINCT FROM fr.y AND p.j >= fr.lo AND p.j < fr.lo + fr.alloc""",
    ["scored_binary", LABELS_CTE]))
def c3_stratified_null_class(spark, d):
    return S.stratified_kfold_label(_labels(spark, d).select("id", "y"), "y", ["id"], 5).select("id", "y", "fold")


@register("v4_box_null_group", oracle(
    """WITH q AS (SELECT category, count(target) AS n, quantile_cont(target, 0.25) AS q1, quantile_cont(target, 0.5) AS median,
                         quantile_cont(target, 0.75) AS q3 FROM gaps GROUP BY category)
       SELECT q.category, n, q1, median, q3, q3 - q1 AS iqr,
              min(CASE WHEN target >= q1 - 1.5E0 * (q3 - q1) THEN target END) AS whisker_low,
              max(CASE WHEN target <= q3 + 1.5E0 * (q3 - q1) THEN target END) AS whisker_high,
              CAST(sum(CASE WHEN target < q1 - 1.5E0 * (q3 - q1) OR target > q3 + 1.5E0 * (q3 - q1) THEN 1 ELSE 0 END) AS BIGINT) AS n_outliers
       FROM gaps g JOIN q ON g.category IS NOT DISTINCT FROM q.category GROUP BY q.category, n, q1, median, q3""",
    ["scored_regression", GAPS_CTE], ["q1", "median", "q3", "iqr", "whisker_low", "whisker_high"], 4))
def v4_box_null_group(spark, d):
    return rounded(V.box_stats(_gaps(spark, d), "target", ["category"]), 4)


@register("v8_confusion_null_labels", oracle(
    """WITH lab AS (SELECT DISTINCT l FROM (SELECT y AS l FROM labels_gap UNION ALL SELECT prediction FROM labels_gap))
       SELECT a.l AS actual, p.l AS predicted, count(g.id) AS count
       FROM lab a CROSS JOIN lab p LEFT JOIN labels_gap g ON g.y IS NOT DISTINCT FROM a.l AND g.prediction IS NOT DISTINCT FROM p.l
       GROUP BY a.l, p.l""", ["scored_binary", LABELS_CTE]))
def v8_confusion_null_labels(spark, d):
    return V.confusion_matrix(_labels(spark, d), "y", "prediction")


@register("v9_report_null_labels", oracle(
    """WITH lab AS (SELECT DISTINCT l FROM (SELECT y AS l FROM labels_gap UNION ALL SELECT prediction FROM labels_gap)),
       c AS (SELECT l, count(CASE WHEN y IS NOT DISTINCT FROM l THEN 1 END) AS support,
                    count(CASE WHEN y IS NOT DISTINCT FROM l AND prediction IS NOT DISTINCT FROM l THEN 1 END) AS tp,
                    count(CASE WHEN prediction IS NOT DISTINCT FROM l THEN 1 END) AS np FROM lab CROSS JOIN labels_gap GROUP BY l),
       m AS (SELECT l, support, tp, CASE WHEN np = 0 THEN 0.0E0 ELSE tp / np END AS precision,
                    CASE WHEN support = 0 THEN 0.0E0 ELSE tp / support END AS recall FROM c),
       f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0E0 ELSE 2.0E0 * precision * recall / (precision + recall) END AS f1 FROM m)
       SELECT CAST(l AS VARCHAR) AS label, precision, recall, f1, support FROM f
       UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), CAST(sum(support) AS BIGINT) FROM f
       UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM f
       UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                        sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM f""",
    ["scored_binary", LABELS_CTE], ["precision", "recall", "f1"], 9))
def v9_report_null_labels(spark, d):
    return rounded(V.classification_report(_labels(spark, d), "y", "prediction"), 9)


@register("v16_roc_auc_one_class", oracle(
    """WITH s AS (SELECT CASE WHEN y_all = 1 OR segment = 'O' THEN segment ELSE 'F0' END AS segment, score, y_all AS y FROM labels_gap),
       c AS (SELECT segment, score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY ALL),
       w AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY segment ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c)
       SELECT segment, sum(pos * (below + neg / 2.0E0)) / NULLIF(sum(pos) * sum(neg), 0) AS roc_auc FROM w GROUP BY segment""",
    ["scored_binary", LABELS_CTE], ["roc_auc"], 9))
def v16_roc_auc_one_class(spark, d):
    """Segments with one class have no area."""
    s = _labels(spark, d).withColumn("segment", F.when((F.col("y_all") == 1) | (F.col("segment") == "O"), F.col("segment")).otherwise(F.lit("F0")))
    return rounded(V.roc_auc(s, "y_all", "score", by=["segment"]), 9)


@register("v6_profile_constant", oracle(
    """SELECT CAST(0 AS INT) AS bin, count(*) AS n, 5.0E0 AS range_lo, 0.0E0 AS bin_width, avg(target) AS mean, stddev_pop(target) AS std
       FROM gaps WHERE x_flat = 5 AND category LIKE 'P%'""", ["scored_regression", GAPS_CTE], ["mean", "std"], 4))
def v6_profile_constant(spark, d):
    flat = _gaps(spark, d).where(F.col("category").startswith("P"))
    return rounded(V.binned_profile(flat, "x_flat", "target"), 4)


@register("v17_kde_null_group", oracle(
    f"""WITH st AS (SELECT category, count(*) AS _n, min(x) AS _lo, max(x) AS _hi, stddev_samp(x) * pow(count(*), -0.2E0) AS _bw,
                           (max(x) - min(x)) / 2000 AS _fw FROM gaps WHERE x IS NOT NULL GROUP BY category),
       fine AS (SELECT s.category, CAST(least(greatest(floor((x - _lo) / CASE WHEN _fw = 0 THEN 1.0E0 ELSE _fw END), 0), 1999) AS INT) AS _b,
                       count(*) AS _c FROM gaps s JOIN st ON s.category IS NOT DISTINCT FROM st.category WHERE x IS NOT NULL GROUP BY ALL),
       pts AS (SELECT f.category, CAST(g.point AS INT) AS point, (_lo - 3.0E0 * _bw) + g.point * (((_hi + 3.0E0 * _bw) - (_lo - 3.0E0 * _bw)) / 49) AS x,
                      _c, _lo + (_b + 0.5E0) * _fw AS _centre, _bw, _n
               FROM fine f JOIN st ON f.category IS NOT DISTINCT FROM st.category, range(0, 50) g(point))
       SELECT category, point, x, sum(_c * exp(-0.5E0 * ((x - _centre) / _bw) * ((x - _centre) / _bw)) / (_n * _bw * {2.5066282746310002})) AS density
       FROM pts GROUP BY category, point, x""", ["scored_regression", GAPS_CTE], ["x", "density"], 6))
def v17_kde_null_group(spark, d):
    return rounded(V.kde(_gaps(spark, d), "x", by=["category"], grid=50), 6)


# ------------------------------------------------------------------ drift with an empty side, class targets
@register("d1_drift_empty_side", oracle(
    """SELECT 'x' AS "column", count(*) AS n_ref, CAST(0 AS BIGINT) AS n_cur, CAST(NULL AS DOUBLE) AS ks_statistic, CAST(NULL AS DOUBLE) AS ks_p_value,
              CAST(NULL AS DOUBLE) AS wasserstein_norm, CASE WHEN count(*) > 1000 THEN 'wasserstein' ELSE 'ks' END AS method, CAST(NULL AS BOOLEAN) AS drifted
       FROM gaps WHERE d < DATE '1995-01-20' AND x IS NOT NULL""", ["scored_regression", GAPS_CTE]))
def d1_drift_empty_side(spark, d):
    """A small reference side, and a current side whose column is all NULL."""
    g = _gaps(spark, d)
    ref = g.where(F.col("d") < F.to_date(F.lit("1995-01-20")))
    return D.numeric_drift(ref, g.withColumn("x", F.lit(None).cast("double")), ["x"])


@register("d3_dataset_drift_unknown", oracle(
    """SELECT CAST(1 AS BIGINT) AS n_columns, CAST(0 AS BIGINT) AS n_drifted, CAST(1 AS BIGINT) AS n_unknown,
              CAST(NULL AS DOUBLE) AS share_drifted, CAST(NULL AS BOOLEAN) AS dataset_drift FROM (SELECT count(*) FROM gaps)""",
    ["scored_regression", GAPS_CTE]))
def d3_dataset_drift_unknown(spark, d):
    return D.dataset_drift(d1_drift_empty_side(spark, d))


CLASS_COLS = ["building_type", "predicted_type"]
_SIDES = (("ref", f"transaction_date < DATE '{REF_END}'"), ("cur", f"transaction_date >= DATE '{REF_END}' AND transaction_date < DATE '{CUR_END}'"))
#: a fixed rule as the prediction
PREDICTED_CTE = """typed AS (
  SELECT *, CASE WHEN living_area > 40 THEN 'LARGE' WHEN price > 30000 THEN 'STANDARD' ELSE 'SMALL' END AS predicted_type,
         split_part(building_type, ' ', 1) AS kind FROM base)"""
_CLASS_LONG = " UNION ALL ".join(f"""SELECT '{c}' AS "column", {c} AS value, '{side}' AS side FROM typed WHERE {cond}""" for side, cond in _SIDES for c in CLASS_COLS)


def _typed(spark, d):
    rule = F.when(F.col("living_area") > 40, "LARGE").when(F.col("price") > 30000, "STANDARD").otherwise("SMALL")
    kind = F.split("building_type", " ")[0]
    return [df.withColumns({"predicted_type": rule, "kind": kind}) for df in _periods(spark, d)]


@register("d4_class_target_drift", oracle(
    f"""WITH lng AS ({_CLASS_LONG}),
       vc AS (SELECT "column", value, count(CASE WHEN side = 'ref' THEN 1 END) AS n_ref, count(CASE WHEN side = 'cur' THEN 1 END) AS n_cur
              FROM lng WHERE value IS NOT NULL GROUP BY ALL),
       tt AS (SELECT "column", sum(n_ref) AS tot_ref, sum(n_cur) AS tot_cur FROM vc GROUP BY ALL),
       cp AS (SELECT vc.*, tot_ref, tot_cur, CASE WHEN n_ref = 0 THEN 1.0E-4 ELSE n_ref / tot_ref END AS p,
                     CASE WHEN n_cur = 0 THEN 1.0E-4 ELSE n_cur / tot_cur END AS q FROM vc JOIN tt USING ("column")),
       cn AS (SELECT *, p / sum(p) OVER (PARTITION BY "column") AS pn, q / sum(q) OVER (PARTITION BY "column") AS qn FROM cp),
       js AS (SELECT "column", CAST(tot_ref AS BIGINT) AS n_ref, CAST(tot_cur AS BIGINT) AS n_cur,
                     sqrt(greatest(0.0E0, sum(0.5E0 * pn * ln(pn / ((pn + qn) / 2.0E0)) + 0.5E0 * qn * ln(qn / ((pn + qn) / 2.0E0))))) AS statistic
              FROM cn GROUP BY "column", tot_ref, tot_cur)
       SELECT "column", 'class' AS kind, n_ref, n_cur, statistic, 'jensenshannon' AS method, statistic >= 0.1E0 AS drifted FROM js""",
    ["tx", BASE_CTE, PREDICTED_CTE], ["statistic"], 6))
def d4_class_target_drift(spark, d):
    """Drift of a class target and of a prediction of it."""
    ref, cur = _typed(spark, d)
    drift, _ = D.target_drift(ref, cur, "building_type", "predicted_type", ["price"], class_method="jensenshannon")
    return rounded(drift, 6)


@register("d4_class_target_correlations", oracle(
    " UNION ALL ".join(f"""SELECT '{side}' AS side, k AS target_class, '{f}' AS feature, corr(CASE WHEN kind = k THEN 1.0E0 ELSE 0.0E0 END, {f}) AS r,
                                  count({f}) AS n
                           FROM typed CROSS JOIN (SELECT DISTINCT kind AS k FROM typed WHERE {cond}) WHERE {cond} GROUP BY k"""
                       for side, cond in _SIDES for f in ("price", "living_area")),
    ["tx", BASE_CTE, PREDICTED_CTE], ["r"], 6))
def d4_class_target_correlations(spark, d):
    ref, cur = _typed(spark, d)
    _, corr = D.target_drift(ref, cur, "kind", None, ["price", "living_area"], class_method="jensenshannon")
    return rounded(corr, 6)


# ------------------------------------------------------------------ fixed predictions, run log
def _f1_sql(pred: str, role: str) -> str:
    tp, np_, ny = (f"sum(CASE WHEN {c} THEN 1 ELSE 0 END)" for c in (f"{pred} = 1 AND y = 1", f"{pred} = 1", "y = 1"))
    return (f"CASE WHEN {np_} = 0 THEN 0.0E0 ELSE {tp} / {np_} END AS {role}_precision, CASE WHEN {ny} = 0 THEN 0.0E0 ELSE {tp} / {ny} END AS {role}_recall, "
            f"CASE WHEN {np_} + {ny} = 0 THEN 0.0E0 ELSE 2.0E0 * {tp} / ({np_} + {ny}) END AS {role}_f1")


@register("g5_compare_predictions", oracle(
    f"""SELECT *, CASE WHEN challenger_f1 > champion_f1 THEN 'challenger' ELSE 'champion' END AS winner FROM (
          SELECT segment, {_f1_sql("prediction", "champion")}, {_f1_sql("other", "challenger")}
          FROM (SELECT *, CASE WHEN score < 0.3E0 OR score > 0.7E0 THEN 1 ELSE 0 END AS other FROM scored_binary) GROUP BY segment)""",
    ["scored_binary"], [f"{r}_{m}" for r in ("champion", "challenger") for m in ("precision", "recall", "f1")], 9))
def g5_compare_predictions(spark, d):
    b = fx.scored_binary(spark, d)
    b = b.withColumn("other", F.when((F.col("score") < 0.3) | (F.col("score") > 0.7), 1).otherwise(0))
    return rounded(G.champion_challenger(b, "y", "prediction", "other", by=["segment"]), 9)


@register("g1_append_one_run", oracle(
    """SELECT experiment AS experiment, 'best' AS run_name, 'FINISHED' AS status, max(average_test_f1) AS metrics_best_f1,
              CAST(count(*) AS DOUBLE) AS metrics_runs, CAST(sum(num_rows) AS BIGINT) AS dataset_rows
       FROM runs WHERE status = 'FINISHED' GROUP BY experiment""", ["runs"], ["metrics_best_f1"]))
def g1_append_one_run(spark, d):
    """One record per experiment, appended one at a time, and the log read back."""
    path = f"{checkpoint_dir(spark)}/runs-{uuid.uuid4().hex}"
    found = fx.runs(spark, d).where(F.col("status") == "FINISHED").groupBy("experiment").agg(
        F.max("average_test_f1").alias("best"), F.count(F.lit(1)).alias("n"), F.sum("num_rows").alias("rows"))
    for r in found.collect():  # one row per experiment
        G.append_run(spark, path, r["experiment"], "best", {"model": "boosting"}, {"best_f1": r["best"], "runs": r["n"]}, dataset_rows=r["rows"])
    log = G.flatten_metrics(G.read_runs(spark, path), ["best_f1", "runs"])
    return rounded(log.select("experiment", "run_name", "status", "metrics_best_f1", "metrics_runs", "dataset_rows"))


# ------------------------------------------------------------------ cross-validation of a model that SQL can express
@register("c8_cross_validate_dummy", oracle(
    """WITH sb AS (SELECT id, y, row_number() OVER (ORDER BY d, id) AS rn FROM scored_binary),
       cls AS (SELECT y, count(*) AS nc, min(rn) AS first_rn FROM sb GROUP BY y),
       cs AS (SELECT y, nc, coalesce(sum(nc) OVER (ORDER BY first_rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st FROM cls),
       fa AS (SELECT y, f, greatest(0, floor((st + nc - f + 4) / 5)) - greatest(0, floor((st - f + 4) / 5)) AS alloc FROM cs, range(0, 5) r(f)),
       fr AS (SELECT y, f, coalesce(sum(alloc) OVER (PARTITION BY y ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo, alloc FROM fa),
       pos AS (SELECT y, row_number() OVER (PARTITION BY y ORDER BY rn) - 1 AS j FROM sb),
       folds AS (SELECT p.y, fr.f AS fold FROM pos p JOIN fr ON p.y = fr.y AND p.j >= fr.lo AND p.j < fr.lo + fr.alloc),
       roles AS (SELECT m.f AS fold, CASE WHEN folds.fold = m.f THEN 'test' ELSE 'train' END AS role, y FROM folds, range(0, 5) m(f)),
       modes AS (SELECT fold, y AS mode FROM (SELECT fold, y, row_number() OVER (PARTITION BY fold ORDER BY count(*) DESC, y) AS k
                 FROM roles WHERE role = 'train' GROUP BY fold, y) WHERE k = 1)
       SELECT CAST(fold AS INT) AS fold, role, count(*) AS num_rows, sum(CASE WHEN y = mode THEN 1 ELSE 0 END) / count(*) AS accuracy,
              CASE WHEN min(mode) = 0 OR sum(y) = 0 THEN 0.0E0 ELSE 1.0E0 END AS recall,
              CASE WHEN min(mode) = 0 THEN 0.0E0 ELSE sum(y) / count(*) END AS precision
       FROM roles JOIN modes USING (fold) GROUP BY fold, role""", ["scored_binary"], ["accuracy", "recall", "precision"], 9))
def c8_cross_validate_dummy(spark, d):
    """Fold sizes, roles and metrics of the most-frequent dummy."""
    b = fx.scored_binary(spark, d).select("id", "d", "y", F.col("score").cast("double").alias("score"))
    folds = S.stratified_kfold_label(b, "y", ["d", "id"], 5)
    per, _, _ = M.cross_validate(folds, "y", ["score"], "fold", 5, lambda tr: M.MostFrequentModel(tr, "y"), metrics=["accuracy", "recall", "precision"])
    return rounded(per, 9)


@register("m1_ols_collinear", oracle(
    """WITH s AS (SELECT sum(living_area * living_area) AS s11, sum(living_area * num_rooms) AS s12, sum(num_rooms * num_rooms) AS s22,
                         sum(living_area * price) AS r1, sum(num_rooms * price) AS r2, count(*) AS n
                  FROM base WHERE price IS NOT NULL AND living_area IS NOT NULL AND num_rooms IS NOT NULL),
       b AS (SELECT n, (r1 * s22 - r2 * s12) / (s11 * s22 - s12 * s12) AS b1, (s11 * r2 - s12 * r1) / (s11 * s22 - s12 * s12) AS b2 FROM s)
       SELECT 'living_area' AS feature, b1 AS coef, n, false AS dropped FROM b UNION ALL SELECT 'num_rooms', b2, n, false FROM b
       UNION ALL SELECT 'twice', CAST(NULL AS DOUBLE), n, true FROM b UNION ALL SELECT 'zero', CAST(NULL AS DOUBLE), n, true FROM b""",
    ["tx", BASE_CTE], ["coef"], 4))
def m1_ols_collinear(spark, d):
    """A column that repeats another one and one that is all zero are named as dropped."""
    from domus.plans.catalog_prep import base

    b = base(spark, d).withColumns({"twice": F.col("living_area") * 2 - F.col("num_rooms"), "zero": F.lit(0.0)})
    return rounded(M.ols(b, "price", ["living_area", "num_rooms", "twice", "zero"]).select("feature", "coef", "n", "dropped"), 4)
