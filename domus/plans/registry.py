"""Registry of named queries over the driver tables.

A query is a function ``(spark, sf_dir) -> DataFrame`` plus, when the
result is expressible in SQL, the DuckDB text that must give the same rows.
Doubles are rounded on both sides so that summation order cannot change the
comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from domus.sources.fixture_sql import with_views

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def round_half_up(c, digits: int):
    """``floor(x·10^d + 0.5) / 10^d`` — plain IEEE arithmetic, so Spark and
    DuckDB produce bit-identical results from identical inputs (their
    ``round`` functions differ near ties)."""
    scale = float(10 ** digits)
    limit = float(10 ** (18 - digits))  # keep floor() inside the long range
    rounded_ = (F.floor(c * F.lit(scale) + F.lit(0.5)) / F.lit(scale)).cast("double")
    return F.when(F.abs(c) < F.lit(limit), rounded_).otherwise(c)


def rounded(df: DataFrame, digits: int = 8, overrides: dict[str, int] | None = None) -> DataFrame:
    """Round every float/double column (``overrides`` sets digits per column)."""
    overrides = overrides or {}
    fixes = {f.name: round_half_up(F.col(f.name), overrides.get(f.name, digits))
             for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.withColumns(fixes) if fixes else df


def oracle(body: str, views: list[str], round_cols: list[str] | None = None, digits: int = 8,
           overrides: dict[str, int] | None = None) -> str:
    """Wrap ``body`` with the fixture CTEs and round the listed columns."""
    sql = with_views(body, *views)
    cols = list(round_cols or [])
    if not cols:
        return sql
    overrides = overrides or {}
    def expr(c):
        d = overrides.get(c, digits)
        return (f"CASE WHEN abs({c}) < 1e{18 - d} THEN CAST(floor({c} * 1e{d} + 0.5E0) / 1e{d} AS DOUBLE) "
                f"ELSE {c} END AS {c}")

    repl = ", ".join(expr(c) for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS _q"
