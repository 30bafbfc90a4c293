"""Splits and cross-validation folds as row-labelling operators.

In Spark a split is a column, not an index array: every row carries its
fold / role, so features and target can never be misaligned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from domus.functions.columns import portable_hash  # noqa: F401  (re-exported)
from domus.operators.joins import join_detail_aggregate, small_side
from domus.operators.ordering import indexed, with_global_index

GROUP_SALTS = 32  # tasks a group's rows are dealt to where the groups are too many to broadcast


# C1 -------------------------------------------------------------------------
def train_test_label(df: DataFrame, id_col: str, test_share: float = 0.2, seed: int = 42,
                     out: str = "split") -> DataFrame:
    """'test' for rows whose hash bucket (of 10 000) falls under the share."""
    bucket = portable_hash(id_col, seed) % 10000
    return df.withColumn(out, F.when(bucket < F.lit(int(round(test_share * 10000))), F.lit("test"))
                         .otherwise(F.lit("train")))


# C2 -------------------------------------------------------------------------
def kfold_label(df: DataFrame, order: list[str], k: int = 5, out: str = "fold") -> DataFrame:
    """Contiguous blocks over ``order`` (unique), the first ``n mod k``
    blocks one row larger — the same as ``ntile(k) - 1``."""
    j = with_global_index(df, order, "_idx", total="_n")  # count from the per-partition sizes
    q = F.floor(F.col("_n") / F.lit(k))
    r = F.col("_n") % F.lit(k)
    big = r * (q + 1)
    fold = F.when(F.col("_idx") < big, F.floor(F.col("_idx") / (q + 1))) \
        .otherwise(r + F.floor((F.col("_idx") - big) / q))
    return j.withColumn(out, fold.cast("int")).drop("_idx", "_n")


# C3 -------------------------------------------------------------------------
def stratified_kfold_label(df: DataFrame, target: str, order: list[str], k: int = 5,
                           out: str = "fold") -> DataFrame:
    """Stratified k folds without shuffling.

    Classes are ranked by first appearance in ``order``; the class-sorted
    sequence is dealt round-robin into k folds (position p → fold p mod k),
    which fixes how many rows of each class every fold receives; each
    class's rows, in ``order``, then fill its folds contiguously.

    Rows meet their class by (class, bucket of the global index): a bucket has a
    bounded number of rows, so a class that holds most of them is still spread
    over tasks, and no table has to be small enough to broadcast.
    """
    idx = with_global_index(df, [target] + order, "_idx", bucket="_bucket")
    spans = idx.groupBy(target, "_bucket").agg(F.count(F.lit(1)).alias("_nb"), F.min(F.struct(*[F.col(c) for c in order])).alias("_first"))
    # one row per class
    classes = spans.groupBy(target).agg(F.sum("_nb").alias("_nc"), F.min("_first").alias("_first"))

    def before(by):
        w = Window.orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_nc").over(w), F.lit(0))

    classes = classes.withColumns({"_start": before("_first"), "_vstart": before(target)}).select(
        F.col(target).alias("_class"), "_nc", "_start", "_vstart")
    spans = small_side(spans.select(F.col(target).alias("_t"), F.col("_bucket").alias("_b"))
                       .join(classes, F.col("_t").eqNullSafe(F.col("_class"))).drop("_class"))
    j = idx.join(spans, F.col(target).eqNullSafe(F.col("_t")) & (F.col("_bucket") == F.col("_b")))

    # rows of the class in fold f: positions p in [start, start + n) with p mod k = f, so
    # n div k, and one more for the n mod k folds from start mod k on, cyclically
    base, extra, first = F.floor(F.col("_nc") / k), F.col("_nc") % k, F.col("_start") % k

    def rows_before(f):  # rows of the class in the folds below f
        more = F.greatest(F.lit(0), F.least(first + extra, f) - first) + F.greatest(F.lit(0), F.least(first + extra - k, f))
        return f * base + more

    pos = F.col("_idx") - F.col("_vstart")
    folds = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda f: rows_before(f) <= pos)
    return j.withColumn(out, (F.array_size(folds) - 1).cast("int")).drop("_idx", "_bucket", "_t", "_b", "_nc", "_start", "_vstart")


# C4 -------------------------------------------------------------------------
def group_label(df: DataFrame, group: str, out: str = "fold") -> DataFrame:
    """Leave-one-group-out: fold = rank of the group value (0-based); fold f
    tests group f and trains on the others.  A NULL group has no fold.

    The table of groups joins back behind the size check; beyond it, rows and
    groups meet by (group, salt), so a few hot groups are spread over tasks."""
    groups = df.select(group).where(F.col(group).isNotNull()).distinct()
    ranked = groups.withColumn(out, (F.row_number().over(Window.orderBy(group)) - 1).cast("int"))  # one row per group
    return join_detail_aggregate(df, ranked, [group], "left", salts=GROUP_SALTS)


# C5 -------------------------------------------------------------------------
def time_series_folds(df: DataFrame, order: list[str], k: int = 5) -> DataFrame:
    """Expanding-window folds.  With n rows and t = n div (k+1), fold f
    (0-based) tests rows [n-(k-f)·t, n-(k-f-1)·t) and trains on every row
    before.  Adds ``row_index``, ``test_fold`` (NULL if never tested) and
    ``first_train_fold`` (the first fold whose train set holds the row;
    NULL if none) — the long form is :func:`fold_roles`.  Fewer rows than
    k + 1 cannot be split: an error."""
    j, n = indexed(df, order, "row_index", total="_n")
    if n < k + 1:
        raise ValueError(f"{k} time-series folds need at least {k + 1} rows, got {n}")
    t = F.floor(F.col("_n") / F.lit(k + 1))
    first_test = F.col("_n") - F.lit(k) * t
    i = F.col("row_index")
    test_fold = F.when(i >= first_test, F.floor((i - first_test) / t))
    # train in fold f iff i < n - (k-f)·t  ⇔  f > k - (n - i)/t
    first_train = F.greatest(F.lit(0), F.floor(F.lit(k) - (F.col("_n") - i) / t) + F.lit(1))
    first_train = F.when(first_train <= F.lit(k - 1), first_train)
    return (j.withColumn("test_fold", test_fold.cast("int"))
            .withColumn("first_train_fold", first_train.cast("int"))
            .drop("_n"))


def fold_roles(folds: DataFrame, k: int = 5) -> DataFrame:
    """Long form of :func:`time_series_folds`: one row per (row, fold, role)."""
    fold_ids = F.sequence(F.lit(0), F.lit(k - 1))
    train = F.filter(fold_ids, lambda f: F.col("first_train_fold").isNotNull() & (f >= F.col("first_train_fold")))
    tests = F.when(F.col("test_fold").isNotNull(), F.array(F.col("test_fold"))).otherwise(F.array().cast("array<int>"))
    roles = F.array_union(
        F.transform(train, lambda f: F.struct(f.alias("fold"), F.lit("train").alias("role"))),
        F.transform(tests, lambda f: F.struct(f.alias("fold"), F.lit("test").alias("role"))))
    return folds.select("*", F.inline(roles)).drop("test_fold", "first_train_fold")


# C6 -------------------------------------------------------------------------
def fold_report(roles: DataFrame, date_col: str, target: str,
                fold: str = "fold", role: str = "role") -> DataFrame:
    """Rows, first/last date and target mean per (fold, role)."""
    return roles.groupBy(fold, role).agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
        F.avg(F.col(target).cast("double")).alias("target_mean"),
    )


# C7 -------------------------------------------------------------------------
def version_slice(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Period / version slice, inclusive bounds (e.g. years 2020–2021)."""
    return df.where(F.col(col).between(F.lit(lo), F.lit(hi)))
