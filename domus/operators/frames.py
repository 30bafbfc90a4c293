"""Projections, filters and predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, NumericType

from domus.functions.columns import month_period, ratio
from domus.operators.joins import join_small

# fixed values: names of the input schema
SURFACE_COLUMNS = [
    "surface_terrains_nature",
    "surface_terrains_sols",
    "surface_terrains_agricoles",
    "surface_locaux_industriels",
    "surface_dependances",
]


def add_ratio(df: DataFrame, num: str, den: str, out: str) -> DataFrame:
    """P1 — ``num / den``; a zero or NULL denominator gives NULL (ANSI-safe)."""
    return df.withColumn(out, ratio(num, den))


def filter_since(df: DataFrame, col: str, since) -> DataFrame:
    """P2 — keep rows with ``col >= since`` (pushed to the Parquet scan)."""
    return df.where(F.col(col) >= F.lit(since))


def keep_plain_rows(df: DataFrame, cols: list[str] | None = None, empty: str = "{}") -> DataFrame:
    """P3 — keep rows where every column equals the ``empty`` marker, then drop
    those columns."""
    cols = cols or SURFACE_COLUMNS
    cond = reduce(lambda a, b: a & b, [F.col(c) == F.lit(empty) for c in cols])
    return df.where(cond).drop(*cols)


def between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """P5 — inclusive range filter."""
    return df.where(F.col(col).between(F.lit(lo), F.lit(hi)))


def keep_members(df: DataFrame, col: str, members: DataFrame, member_col: str | None = None) -> DataFrame:
    """P6 — membership filter by a key table (left-semi join; the key list is
    never collected to the driver)."""
    m = members.select(F.col(member_col or col).alias(col)).distinct()
    return join_small(df, m, col, "left_semi")


def exclude_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """P7 — drop rows whose value is in a short literal list."""
    return df.where(~F.col(col).isin(*values))


def filter_above_quantile(df: DataFrame, col: str, q: float, where: Column | None = None,
                          method: str = "exact", inclusive: bool = False) -> DataFrame:
    """P8 — keep rows (optionally also matching ``where``) whose value is
    above the q-quantile of the **whole** column (strictly, unless
    ``inclusive``)."""
    from domus.operators.aggregates import quantile

    thr = quantile(df, col, q, method=method).withColumnRenamed("value", "_q")
    out = df.crossJoin(F.broadcast(thr))  # one row
    cond = (F.col(col) >= F.col("_q")) if inclusive else (F.col(col) > F.col("_q"))
    if where is not None:
        cond = cond & where
    return out.where(cond).drop("_q")


def _numeric_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (FloatType, DoubleType, IntegerType, LongType))]


def drop_incomplete(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """P9 — drop a row if any of ``cols`` (default: all int/long/float/double
    columns) is NULL or NaN."""
    cols = cols if cols is not None else _numeric_cols(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    conds = []
    for c in cols:
        cond = F.col(c).isNotNull()
        if isinstance(types[c], (FloatType, DoubleType)):
            cond = cond & ~F.isnan(F.col(c))
        conds.append(cond)
    return df.where(reduce(lambda a, b: a & b, conds)) if conds else df


def cast_columns(df: DataFrame, types: dict[str, str], strict: bool = False) -> DataFrame:
    """P10 — cast a set of columns; ``strict=False`` uses ``try_cast`` so an
    unparsable code becomes NULL instead of failing the job."""
    if strict:
        return df.withColumns({c: F.col(c).cast(t) for c, t in types.items()})
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def split_metadata(df: DataFrame, metadata_cols: list[str], key: str,
                   drop_also: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """P11 — (features, metadata): metadata keeps the present metadata
    columns; features drop them (and ``drop_also``) but keep ``key``."""
    present = [c for c in metadata_cols if c in df.columns]
    meta = df.select(*present)
    to_drop = set(present) | set(drop_also or [])
    to_drop.discard(key)
    features = df.drop(*[c for c in df.columns if c in to_drop])
    return features, meta


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P12 — rename (drop is ``DataFrame.drop``)."""
    return df.withColumnsRenamed(mapping)


def below_reference_flag(df: DataFrame, value: str, ref: str, pct: float, out: str) -> DataFrame:
    """P13 — 1 when ``value < ref - pct*ref``, else 0 (NULL comparisons → 0)."""
    cond = F.col(value) < (F.col(ref) - F.lit(float(pct)) * F.col(ref))
    return df.withColumn(out, F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def assign_period(df: DataFrame, date_col: str, start: str, end: str, out: str = "period",
                  labels=("pre", "during", "post")) -> DataFrame:
    """P14 — period label from the month (``yyyy-MM``): before ``start``,
    ``start``..``end`` inclusive, after ``end``."""
    month = month_period(date_col)
    return df.withColumn(
        out,
        F.when(month < F.lit(start), F.lit(labels[0]))
        .when(month <= F.lit(end), F.lit(labels[1]))
        .otherwise(F.lit(labels[2])),
    )


def is_numeric(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, NumericType)
