"""Scalar column helpers: all built-in Spark expressions, so
they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_MOD = 1000003
HASH_MUL = 7919


def ratio(num: str, den: str) -> Column:
    """``num / den`` as double; NULL when the denominator is 0 or NULL."""
    return F.try_divide(F.col(num).cast("double"), F.col(den).cast("double"))


def month_index(year: str = "transaction_year", month: str = "transaction_month") -> Column:
    """Months since year 0 — consecutive calendar months differ by 1."""
    return F.col(year).cast("int") * 12 + F.col(month).cast("int")


def month_period(date_col: str) -> Column:
    """Monthly period as ``yyyy-MM`` text (sorts chronologically)."""
    return F.date_format(F.col(date_col), "yyyy-MM")


def portable_hash(id_col: str, seed: int = 42) -> Column:
    """Integer hash of an id in plain integer arithmetic (same value in any
    SQL engine, stable under repartitioning): ((id mod p)·m + seed) mod p."""
    return ((F.col(id_col) % HASH_MOD) * HASH_MUL + F.lit(seed)) % HASH_MOD


def all_true(*conds: Column) -> Column:
    """Horizontal AND of predicates."""
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out


def not_nan(col: str) -> Column:
    """Non-null and, for floating columns, not NaN."""
    return F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double"))


def absolute_error(y: str, yhat: str) -> Column:
    return F.abs(F.col(y) - F.col(yhat))
