"""Models as Spark jobs (M1–M11) and cross-validation.

Linear models are solved from the triangular factor of the rows [X y], reduced
over the tasks by QR; the k×k system is solved on the driver.  Trees and
logistic regression are MLlib estimators; over many rows regression forests are
grown from binned rows (:mod:`~domus.operators.binned_trees`).
"""

from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier  # noqa: F401
from pyspark.ml.feature import VectorAssembler  # noqa: F401
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from domus.functions import all_true, not_nan
from domus.operators import binned_trees, packed_trees
from domus.operators.joins import join_small
from domus.operators.matrices import independent_columns, triangular_factor
from domus.session import checkpoint_dir, cut_lineage, remove_folder


# ---------------------------------------------------------------- helpers
def _betacf(a: float, b: float, x: float) -> float:
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
    h = d
    for m in range(1, 1000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1.0 + aa / c if abs(1.0 + aa / c) > 1e-300 else 1e-300
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
        c = 1.0 + aa / c if abs(1.0 + aa / c) > 1e-300 else 1e-300
        de = d * c
        h *= de
        if abs(de - 1.0) < 1e-15:
            break
    return h


def _betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)
    if x < (a + 1) / (a + b + 2):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1 - x) / b


def t_two_sided_p(t: float, dof: float) -> float:
    """Two-sided p-value of Student's t."""
    if dof <= 0 or math.isnan(t):
        return float("nan")
    return _betainc(dof / 2.0, 0.5, dof / (dof + t * t))


def _least_squares(r: np.ndarray, n: int, keep: list[int], names: list[str], intercept: bool) -> tuple[list, float]:
    """Coefficient rows and R² from the factor of [X y] (y last), for the
    columns ``keep`` of X.  Columns that depend on those before them get no
    coefficient."""
    y = r.shape[1] - 1
    free = [keep[i] for i in independent_columns(r[:, keep])]
    f = np.linalg.qr(r[:, [*free, y]], mode="r")
    p = len(free)
    rxx, rxy = f[:p, :p], f[:p, p]
    sse = float(f[p, p] ** 2) if len(f) > p else 0.0
    inv = np.linalg.inv(rxx) if p else np.zeros((0, 0))  # triangular, full rank
    beta, dof = inv @ rxy, n - p
    se = np.sqrt((inv * inv).sum(axis=1) * (sse / dof if dof > 0 else float("nan")))
    sst = float(r[:, y] @ r[:, y])
    if intercept:  # centred: the part of y that the constant column leaves
        one = len(names) - 1
        c = np.linalg.qr(r[:, [one, y]], mode="r")
        sst = float(c[1, 1] ** 2) if len(c) > 1 else 0.0
    r2 = 1.0 - sse / sst if sst > 0 else float("nan")
    found = {}
    for i, j in enumerate(free):
        t = float(beta[i] / se[i]) if se[i] > 0 else (float("nan") if not se[i] == 0 else math.copysign(float("inf"), beta[i]))
        found[j] = (float(beta[i]), float(se[i]), t, t_two_sided_p(t, dof) if math.isfinite(t) else (0.0 if math.isinf(t) else float("nan")))
    return [(names[j], *found.get(j, (None, None, None, None))) for j in keep], r2


def _factored(df: DataFrame, y: str, xs: list[str], intercept: bool) -> tuple[np.ndarray, int, list[str]]:
    names = list(xs) + (["intercept"] if intercept else [])
    cols = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(xs)] + ([F.lit(1.0).alias("one")] if intercept else [])
    data = df.select(*cols, F.col(y).cast("double").alias("y"))
    r, n = triangular_factor(data, data.columns)
    return r, n, names


# M1 -------------------------------------------------------------------------
def ols(df: DataFrame, y: str, xs: list[str], intercept: bool = False) -> DataFrame:
    """Ordinary least squares (through the origin by default) → one row per
    coefficient: (feature, coef, std_err, t_value, p_value, r2, n, dropped).

    The rows are reduced to the triangular factor of [X y]
    (:func:`~domus.operators.matrices.triangular_factor`).  A column that is a
    linear combination of those before it (constant zero, collinear) is dropped:
    ``dropped`` is true and it has no coefficient."""
    r, n, names = _factored(df, y, xs, intercept)
    rows, r2 = _least_squares(r, n, list(range(len(names))), names, intercept)
    return df.sparkSession.createDataFrame([(*x, r2, n, x[1] is None) for x in rows],
                                           "feature string, coef double, std_err double, t_value double, p_value double, "
                                           "r2 double, n long, dropped boolean")


# M2 -------------------------------------------------------------------------
def backward_eliminate(df: DataFrame, y: str, xs: list[str], alpha: float = 0.05,
                       intercept: bool = False) -> DataFrame:
    """Drop the feature with the highest p-value while it exceeds ``alpha``,
    one at a time.  One pass over the data (the triangular factor); every step
    re-solves a sub-system on the driver.  → step log (step, dropped,
    p_value, remaining, r2).  Collinear features go first, without a p-value."""
    r, n, names = _factored(df, y, xs, intercept)
    keep = list(range(len(names)))
    log: list = []
    while True:
        rows, r2 = _least_squares(r, n, keep, names, intercept)
        dependent = [i for x, i in zip(rows, keep) if x[1] is None and names[i] != "intercept"]
        cand = [(x[4], -i) for x, i in zip(rows, keep) if names[i] != "intercept" and x[4] is not None]
        remaining = lambda: ",".join(names[i] for i in keep)
        if dependent:
            worst, p = dependent[-1], None
        elif cand and max(cand)[0] > alpha:
            p, worst = max(cand)[0], -max(cand)[1]
        else:
            log.append((len(log), None, None, remaining(), r2))
            break
        keep.remove(worst)
        log.append((len(log), names[worst], None if p is None else float(p), remaining(), r2))
    return df.sparkSession.createDataFrame(
        log, "step int, dropped string, p_value double, remaining string, r2 double")


# M3 -------------------------------------------------------------------------
def simple_regression(df: DataFrame, x: str, y: str, grid: int = 100) -> DataFrame:
    """Least-squares line of y on x (with intercept) and its predictions on a
    ``grid``-point axis from min(x) to max(x)."""
    st = df.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                F.min(x).cast("double").alias("lo"), F.max(x).cast("double").alias("hi"))
    pts = df.sparkSession.range(grid).select(F.col("id").cast("int").alias("point"))
    j = pts.crossJoin(F.broadcast(st))  # one row
    gx = F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / F.lit(grid - 1)
    return j.select("point", gx.alias("x"), (F.col("intercept") + F.col("slope") * gx).alias("prediction"),
                    "slope", "intercept")


# M4–M6 ----------------------------------------------------------------------
def complete(xs: list[str]):
    """Condition: every column has a value (neither NULL nor NaN)."""
    return all_true(*[not_nan(c) for c in xs])


def assemble(df: DataFrame, xs: list[str], out: str = "features") -> DataFrame:
    """Feature vector of every row; a missing feature becomes NaN in it."""
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=xs, outputCol=out, handleInvalid="keep").transform(df)


def training_rows(df: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """Rows a model can be fitted on: features and label present."""
    return assemble(df.where(complete([*xs, y])), xs)


#: partitions, per core, of the rows a fit reads.  MLlib sends the statistics of
#: every node of a level once per partition and starts a task per partition for
#: every level of every round, so both grow with the partitions, not the rows
FIT_PARTITIONS = 3


def fit_rows(df: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """The training rows in at most ``FIT_PARTITIONS`` partitions per core;
    rows in fewer stay as they lie."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return training_rows(df, y, xs).select("features", y).coalesce(FIT_PARTITIONS * cores)


#: rows of a partition of a tree fit: below the first number more partitions
#: cost more than they save; above the second a core gets several
TREE_ROWS_LEAST = 20_000
TREE_ROWS_MOST = 500_000


def tree_partitions(n: int, cores: int) -> int:
    """Partitions for a tree fit over ``n`` rows; 0 or 1 where they are too few
    to be dealt to several tasks."""
    if n < cores * TREE_ROWS_LEAST:
        return n // TREE_ROWS_LEAST
    return cores * min(FIT_PARTITIONS, math.ceil(n / (cores * TREE_ROWS_MOST)))


def tree_rows(df: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """The training rows dealt evenly to the cores.  MLlib keeps a tree's rows in
    the partitions it is given and passes over them for every level of every
    round, so partitions of few large files or of a filter leave cores idle
    through the whole fit.  A few rows stay as they lie."""
    rows = fit_rows(df, y, xs)
    parts = tree_partitions(rows.count(), df.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(parts) if parts > 1 else rows


def score_rows(model, df: DataFrame, xs: list[str]) -> DataFrame:
    """Every row of ``df`` with the model's outputs; ``prediction`` is NULL
    where a feature is missing."""
    scored = model.transform(assemble(df, xs))
    return scored.withColumn("prediction", F.when(complete(xs), F.col("prediction")))


def packed_predictions(df: DataFrame, packed: packed_trees.PackedTrees, xs: list[str], out: str = "prediction") -> DataFrame:
    """Every row of ``df`` with the prediction of one packed tree model, NULL
    where a feature is missing.  MLlib walks all trees for one row after
    the other; here a batch of rows walks one tree after the other."""
    prediction, _ = packed_trees.predicted(F.col("_margins")[0], packed.kinds[0])
    scored = packed_trees.margins(df, packed, xs, "_margins")
    return scored.withColumn(out, F.when(complete(xs), prediction)).drop("_margins")


def logistic(df: DataFrame, y: str, xs: list[str], c: float = 1.0, max_iter: int = 100):
    """L2 logistic regression with the C-parametrisation (penalty ½‖w‖² +
    C·Σ loss ⇔ regParam = 1 / (C·n), no standardisation)."""
    from pyspark.ml.classification import LogisticRegression

    data = fit_rows(df, y, xs)
    n = data.count()
    lr = LogisticRegression(featuresCol="features", labelCol=y, regParam=1.0 / (c * max(n, 1)),
                            elasticNetParam=0.0, standardization=False, maxIter=max_iter)
    return lr.fit(data)


#: sizes a fit has unless told otherwise: trees of a forest, the deepest that
#: MLlib grows (unlimited is asked for), rounds and depth of boosting
FOREST_TREES = 100
FOREST_DEPTH = 30
BOOSTING_ROUNDS = 1000
BOOSTING_DEPTH = 6
#: MB of node statistics a forest's pass over the rows gathers in a task.  Every
#: pass reads the bag counts and node ids of all rows, and writes the ids anew,
#: from disk where memory does not hold them, so fewer passes matter at size;
#: MLlib's 256 leave the cores' caches.  The trees are the same
FOREST_STATS_MB = 64


#: rows from which a regression forest is grown by :mod:`~domus.operators.binned_trees`
#: instead of MLlib's trainer; with fewer its passes, a job each, take longer
BINNED_FOREST_ROWS = 1_000_000


def forest(df: DataFrame, y: str, xs: list[str], task: str = "regression", trees: int = FOREST_TREES,
           seed: int = 42, max_depth: int = FOREST_DEPTH, max_bins: int = 64):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.regression import RandomForestRegressor

    cls = RandomForestRegressor if task == "regression" else RandomForestClassifier
    est = cls(featuresCol="features", labelCol=y, numTrees=trees, maxDepth=max_depth, maxBins=max_bins,
              seed=seed, featureSubsetStrategy="all" if task == "regression" else "sqrt",
              # rows remember their node instead of walking every tree from its root in each pass; without
              # checkpoints, which would write the nodes of all rows and trees to the shared folder
              cacheNodeIds=True, checkpointInterval=-1, maxMemoryInMB=FOREST_STATS_MB)
    if task == "regression" and max_depth <= binned_trees.MOST_DEPTH and max_bins <= 256:
        rows = df.where(complete([*xs, y])).select(*[F.col(c).cast("double").alias(c) for c in [*xs, y]])
        n = rows.count()
        if n >= BINNED_FOREST_ROWS:
            parts = tree_partitions(n, df.sparkSession.sparkContext.defaultParallelism)
            return binned_trees.forest(est, rows, n, xs, y, trees, max_depth, max_bins, seed, parts)
    return est.fit(tree_rows(df, y, xs))


def boosting(df: DataFrame, y: str, xs: list[str], task: str = "classification", iters: int = BOOSTING_ROUNDS,
             depth: int = BOOSTING_DEPTH, step: float = 0.1, seed: int = 42):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.regression import GBTRegressor

    cls = GBTRegressor if task == "regression" else GBTClassifier
    est = cls(featuresCol="features", labelCol=y, maxIter=iters, maxDepth=depth, stepSize=step, seed=seed)
    return est.fit(tree_rows(df, y, xs))


# M7 -------------------------------------------------------------------------
def most_frequent(train: DataFrame, df: DataFrame, y: str, out: str = "prediction") -> DataFrame:
    """Predict the most frequent training class (ties: smallest label)."""
    mode = (train.groupBy(y).agg(F.count(F.lit(1)).alias("_c"))
            .orderBy(F.col("_c").desc(), F.col(y).asc()).limit(1).select(F.col(y).alias(out)))
    return df.crossJoin(F.broadcast(mode))  # one row


# M8 -------------------------------------------------------------------------
def rule_baseline(df: DataFrame, expr, out: str = "prediction") -> DataFrame:
    return df.withColumn(out, expr)


# M9 -------------------------------------------------------------------------
def fit_linear_by_segment(df: DataFrame, segment: str, y: str, x: str) -> DataFrame:
    """One-feature least squares per segment (one aggregation)."""
    return df.groupBy(segment).agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                                   F.regr_intercept(F.col(y), F.col(x)).alias("intercept"))


def score_linear_by_segment(df: DataFrame, coefs: DataFrame, segment: str, x: str,
                            out: str = "prediction") -> DataFrame:
    return join_small(df, coefs, segment, "left").withColumn(
        out, F.col("intercept") + F.col("slope") * F.col(x)).drop("slope", "intercept")


def fit_by_segment(df: DataFrame, segment: str, segments: list, fit, threads: int = 4) -> dict:
    """Fit one model per segment value (``fit(segment_df) -> model``).  The rows
    are written once, partitioned by segment, and each fit reads its own; the
    fits are submitted concurrently so their Spark jobs overlap.  A segment
    without rows has no model."""
    path = f"{checkpoint_dir(df.sparkSession)}/segments-{uuid.uuid4().hex}"
    own = df.where(F.col(segment).isin(segments)).withColumn("_segment", F.col(segment).cast("string"))
    own.write.partitionBy("_segment").parquet(path)
    schema = StructType([*df.schema.fields, StructField("_segment", StringType())])
    data = df.sparkSession.read.schema(schema).parquet(path)
    present = {r[0] for r in data.select("_segment").distinct().collect()}
    todo = [s for s in segments if str(s) in present]
    with ThreadPoolExecutor(max_workers=min(threads, max(1, len(todo)))) as pool:
        futs = {s: pool.submit(fit, data.where(F.col("_segment") == F.lit(str(s))).drop("_segment")) for s in todo}
        models = {s: f.result() for s, f in futs.items()}
    remove_folder(df.sparkSession, path)
    return models


def score_by_segment(df: DataFrame, segment: str, models: dict, xs: list[str],
                     out: str = "prediction") -> DataFrame:
    """Score each row with its segment's tree model in one pass over the rows
    (:func:`~domus.operators.packed_trees.dispatch`).  Rows of unknown or NULL
    segments and rows with a missing feature are kept with a NULL prediction."""
    if not models:
        return df.withColumn(out, F.lit(None).cast("double"))
    packed = packed_trees.pack(models)
    kinds = set(packed.kinds)
    if len(kinds) > 1:
        raise ValueError(f"the segments' models are of several kinds: {sorted(kinds)}")
    scored = packed_trees.dispatch(df, packed, segment, xs, "_margin")
    prediction, _ = packed_trees.predicted(F.col("_margin"), packed.kinds[0])
    return scored.withColumn(out, F.when(complete(xs), prediction)).drop("_margin")


# M10 / M11 ------------------------------------------------------------------
def class_probability(scored: DataFrame, out: str = "probability_1", cls: int = 1) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    p = vector_to_array(F.col("probability"))[cls]
    return scored.withColumn(out, F.when(F.col("prediction").isNotNull(), p) if "prediction" in scored.columns else p)


def score_batch(df: DataFrame, reg_xs: list[str], regressor, cls_xs: list[str], classifier,
                packed: packed_trees.PackedTrees | None = None) -> DataFrame:
    """Price estimate and class-1 probability / label in one output (two
    ``transform`` calls over the same rows).  With the ``packed`` trees of the
    regressor those give the price estimate."""
    if packed:
        r = assemble(packed_predictions(df, packed, reg_xs, "predicted_price"), cls_xs, "_cls_features")
    else:
        data = assemble(assemble(df, reg_xs, "_reg_features"), cls_xs, "_cls_features")
        r = regressor.copy().setFeaturesCol("_reg_features").setPredictionCol("predicted_price").transform(data)
    c = (classifier.copy().setFeaturesCol("_cls_features").setPredictionCol("predicted_class")
         .setRawPredictionCol("_raw").setProbabilityCol("probability").transform(r))
    c = class_probability(c, "probability_below_market")
    for name, ok in (("predicted_price", complete(reg_xs)), ("predicted_class", complete(cls_xs)),
                     ("probability_below_market", complete(cls_xs))):
        c = c.withColumn(name, F.when(ok, F.col(name)))
    return c.drop("_reg_features", "_cls_features", "_raw", "probability")


# C8 -------------------------------------------------------------------------
CLASS_METRICS = ("f1", "precision", "recall", "accuracy", "roc_auc")
REGRESSION_METRICS = ("rmse", "mae", "r2")


def score_folds(models: list, data: DataFrame, xs: list[str], fold_col: str, y: str) -> DataFrame:
    """(y, prediction, score, role, fold): every row under every fold's model,
    in one pass over the rows whatever the number of folds.  The row's own fold
    label decides whether it is test or train for a model."""
    data = data.where(complete(xs))
    if all(packed_trees.kind_of(m) for m in models):
        packed = packed_trees.pack(dict(enumerate(models)))
        wide = packed_trees.margins(data, packed, xs, "_margins")
        outputs = [packed_trees.predicted(F.col("_margins")[i], kind) for i, kind in enumerate(packed.kinds)]
    else:
        # other models: their transforms chained over the same rows
        wide, outputs = assemble(data, xs, "_x"), []
        for i, m in enumerate(models):
            scored = m.transform(wide.withColumnRenamed("_x", "features"))
            score = vector_to_array(F.col("probability"))[1] if "probability" in scored.columns else F.lit(None).cast("double")
            wide = scored.withColumns({f"_p{i}": F.col("prediction"), f"_s{i}": score}).withColumnRenamed("features", "_x").drop(
                "prediction", "probability", "rawPrediction")
            outputs.append((F.col(f"_p{i}"), F.col(f"_s{i}")))
    role = lambda f: F.when(F.col(fold_col) == F.lit(f), F.lit("test")).otherwise(F.lit("train"))
    each = F.array(*[F.struct(p.alias("prediction"), s.alias("score"), role(f).alias("role"), F.lit(f).alias("cv_fold"))
                     for f, (p, s) in enumerate(outputs)])
    return wide.select(y, F.inline(each))


def cross_validate(df: DataFrame, y: str, xs: list[str], fold_col: str, k: int, fit,
                   task: str = "classification", refit: bool = False, parallel: int | None = None,
                   materialise: bool = True, metrics: tuple | list | None = None):
    """Fit on each fold's train rows, score train and test rows, evaluate all
    folds with one grouped aggregation.

    ``fit(train_df) -> model`` (MLlib model with ``transform``).  ``metrics``
    chooses among f1, precision, recall, accuracy, roc_auc (default: the first
    four) or rmse, mae, r2.  Returns (per-fold metrics, summary with mean and
    population std per metric, refitted model or None); the 2·k metric rows are
    computed here."""
    from domus.operators.evaluation import binary_metrics, regression_metrics, roc_auc

    known = CLASS_METRICS if task == "classification" else REGRESSION_METRICS
    metrics = list(metrics or (known[:4] if task == "classification" else known))
    if not set(metrics) <= set(known):
        raise ValueError(f"unknown metrics {sorted(set(metrics) - set(known))}, known are {known}")
    # every fold fit reads the same rows: materialise them once in the shared checkpoint folder
    data = df.select(y, fold_col, *xs)
    if materialise:  # callers that already checkpointed their folds pass False
        data = cut_lineage(data)

    # the k fold fits (and the refit on all rows) are independent Spark jobs: submit them together
    with ThreadPoolExecutor(max_workers=parallel or (k + 1)) as pool:
        refit_future = pool.submit(fit, data) if refit else None
        models = list(pool.map(lambda f: fit(data.where(F.col(fold_col) != f)), range(k)))
        model = refit_future.result() if refit_future else None
    scored = score_folds(models, data, xs, fold_col, y)
    if task == "classification":
        if "roc_auc" in metrics:  # ranks the scores: a second reader of the scored rows
            scored = cut_lineage(scored)
        per = binary_metrics(scored, y, "prediction", by=["cv_fold", "role"])
        if "roc_auc" in metrics:
            auc = roc_auc(scored.where(F.col("score").isNotNull()), y, "score", by=["cv_fold", "role"])
            per = per.join(auc, ["cv_fold", "role"], "left")
    else:
        per = regression_metrics(scored, y, "prediction", by=["cv_fold", "role"])
    per = per.select(F.col("cv_fold").alias("fold"), "role", F.col("n").alias("num_rows"), *metrics)
    per = df.sparkSession.createDataFrame(per.collect(), per.schema)  # 2·k rows
    summary = per.groupBy("role").agg(*[F.avg(m).alias(f"mean_{m}") for m in metrics],
                                      *[F.stddev_pop(m).alias(f"std_{m}") for m in metrics])
    return per, summary, model


class MostFrequentModel:
    """Most-frequent-class dummy with the MLlib ``transform`` interface (used
    inside :func:`cross_validate`)."""

    def __init__(self, train: DataFrame, y: str):
        row = (train.groupBy(y).agg(F.count(F.lit(1)).alias("_c"))
               .orderBy(F.col("_c").desc(), F.col(y).asc()).limit(1).collect())
        self.value = float(row[0][0]) if row else 0.0

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", F.lit(self.value))

    def save(self, path: str) -> None:
        """The value as a one-row table."""
        spark = SparkSession.builder.getOrCreate()
        spark.createDataFrame([(self.value,)], "value double").write.parquet(path)


def decision_grid(model, df: DataFrame, x1: str, x2: str, steps: int = 100, margin: float = 1.0) -> DataFrame:
    """Predicted class over a ``steps × steps`` grid spanning the two
    features' ranges (± ``margin``): the numbers behind a decision-region
    plot.  The grid is parameter-sized."""
    r = df.agg(F.min(x1).cast("double").alias("lo1"), F.max(x1).cast("double").alias("hi1"),
               F.min(x2).cast("double").alias("lo2"), F.max(x2).cast("double").alias("hi2"))
    axis = F.sequence(F.lit(0), F.lit(steps - 1))
    grid = (r.select("*", F.explode(axis).alias("i")).select("*", F.explode(axis).alias("j"))
            .select(F.col("i"), F.col("j"),
                    ((F.col("lo1") - margin) + F.col("i") * ((F.col("hi1") - F.col("lo1") + 2 * margin) / (steps - 1)))
                    .alias(x1),
                    ((F.col("lo2") - margin) + F.col("j") * ((F.col("hi2") - F.col("lo2") + 2 * margin) / (steps - 1)))
                    .alias(x2)))
    scored = score_rows(model, grid, [x1, x2])
    return scored.select("i", "j", x1, x2, F.col("prediction").cast("int").alias("predicted_class"))
