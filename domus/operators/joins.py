"""Joins (J1–J10) and the size-checked broadcast every small-side join uses.

Rule used throughout the library: a side is broadcast only after its row
count has been measured and found under ``domus.broadcast.maxRows`` (and its
estimated bytes under ``domus.broadcast.maxBytes``).  Above the limit the
join stays a shuffle join and AQE handles coalescing and skew splitting.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domus.session import cut_lineage

DEFAULT_MAX_ROWS = 2_000_000
DEFAULT_MAX_BYTES = 256 * 1024 * 1024


def _limits(df: DataFrame) -> tuple[int, int]:
    conf = df.sparkSession.conf
    rows = int(conf.get("domus.broadcast.maxRows", str(DEFAULT_MAX_ROWS)))
    size = int(conf.get("domus.broadcast.maxBytes", str(DEFAULT_MAX_BYTES)))
    return rows, size


_WIDTHS = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4,
           "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}


def _row_width(df: DataFrame) -> int:
    # Catalyst-like default sizes (strings and nested types 20 bytes) plus a
    # row header.
    return 8 + sum(_WIDTHS.get(f.dataType.simpleString(), 20) for f in df.schema.fields)


# Catalyst's size estimate of a plan is an upper bound for filters, joins
# and aggregates, but file sizes are compressed: require this much headroom
# before trusting it without a count.
ESTIMATE_HEADROOM = 16


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` (no job is run)."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except Exception:  # noqa: BLE001 - estimate unavailable
        return None


def small_side(df: DataFrame) -> DataFrame:
    """The frame of :func:`sized_side`."""
    return sized_side(df)[0]


def sized_side(df: DataFrame) -> tuple[DataFrame, bool]:
    """Return ``df`` and whether it is hinted: it is hinted for broadcast only when its size is proven
    under the limits, otherwise unhinted (a shuffle join).

    Proof 1 (no job): Catalyst's upper-bound size estimate, with a 16×
    headroom for compression, is under ``domus.broadcast.maxBytes`` — e.g. a
    dimension file or an aggregate of a small input.  Proof 2: the side is
    materialised once, in the shared checkpoint folder, and counted; the later
    join reads what was written, so nothing is computed twice and nothing is
    left in the executors' storage.
    """
    max_rows, max_bytes = _limits(df)
    est = estimated_bytes(df)
    if est is not None and est * ESTIMATE_HEADROOM <= max_bytes and est // 8 <= max_rows:
        return F.broadcast(df), True
    kept = cut_lineage(df)
    n = kept.count()
    if n <= max_rows and n * _row_width(kept) <= max_bytes:
        return F.broadcast(kept), True
    return kept, False


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join ``big`` with a side expected to be small (dimension, aggregate,
    key list).  Broadcast only behind the size check of :func:`small_side`."""
    return big.join(small_side(small), on, how)


def salted_join(detail: DataFrame, agg: DataFrame, keys: list[str], salts: int,
                salt_source: list[str] | None = None, how: str = "inner") -> DataFrame:
    """Shuffle join that spreads every key over ``salts`` partitions: each
    aggregate row is replicated once per salt, each detail row gets the salt
    ``hash(salt_source) mod salts`` (deterministic, so a recomputed task
    routes its rows the same way).  A key holding a third of all detail rows
    is split across ``salts`` tasks even without AQE."""
    src = [F.col(c) for c in (salt_source or detail.columns)]
    d = detail.withColumn("_salt", F.pmod(F.xxhash64(*src), F.lit(salts)).cast("int"))
    a = agg.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return d.join(a, [*keys, "_salt"], how).drop("_salt")


# J1 -------------------------------------------------------------------------
def join_detail_aggregate(detail: DataFrame, agg: DataFrame, keys: list[str],
                          how: str = "inner", salts: int | None = None,
                          salt_source: list[str] | None = None) -> DataFrame:
    """Detail rows ⋈ their group aggregate on the full composite key.

    The aggregate has one row per key.  When it fits the broadcast limits no
    detail row is shuffled.  Otherwise it is a shuffle join in which a hot
    key is a replicate-one-row join: AQE's skew join splits the hot
    partition, or — with ``salts`` — the key is salted explicitly
    (:func:`salted_join`).
    """
    small, hinted = sized_side(agg)
    if salts and salts > 1 and not hinted:
        return salted_join(detail, small, keys, salts, salt_source, how)
    return detail.join(small, keys, how)


# J3 -------------------------------------------------------------------------
def join_on_date(a: DataFrame, b: DataFrame, on: str = "date") -> DataFrame:
    """Inner join of two calendar tables on their date key."""
    return join_small(a, b, on, "inner")


# J4 -------------------------------------------------------------------------
def add_region(df: DataFrame, regions: DataFrame, key: str = "department",
               dim_key: str = "department_code") -> DataFrame:
    """Left join of the department → region dimension.

    The dimension's string codes are cast to int for the key and
    ``region_code`` becomes the int ``region`` column.
    """
    dim = (regions.withColumn(key, F.col(dim_key).cast("int"))
           .withColumn("region", F.col("region_code").cast("int")))
    return join_small(df, dim, key, "left")


# J5 -------------------------------------------------------------------------
def add_economic_context(df: DataFrame, annual: DataFrame, monthly: DataFrame,
                         year_col: str = "transaction_year", month_col: str = "transaction_month",
                         annual_key: str = "date", monthly_keys=("year", "month")) -> DataFrame:
    """Left join annual then monthly context; the right-side keys are renamed
    to the left names so no duplicate key column survives."""
    a = annual.withColumnRenamed(annual_key, year_col)
    m = (monthly.withColumnRenamed(monthly_keys[0], year_col)
         .withColumnRenamed(monthly_keys[1], month_col))
    out = join_small(df, a, year_col, "left")
    return join_small(out, m, [year_col, month_col], "left")


# J7 -------------------------------------------------------------------------
def restrict_to_scope(df: DataFrame, scope: DataFrame, columns: list[str] | None = None,
                      casts: dict[str, str] | None = None) -> DataFrame:
    """Keep rows whose scope columns appear in ``scope`` (left-semi join on the
    distinct scope), then project ``columns``."""
    if casts:
        df = df.withColumns({c: F.col(c).cast(t) for c, t in casts.items()})
    keys = scope.columns
    out = join_small(df, scope.distinct(), keys, "left_semi")
    return out.select(*columns) if columns else out


# J8 -------------------------------------------------------------------------
def attach_metadata(df: DataFrame, meta: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Left join of metadata by id; only the asked columns are read.

    Metadata is as large as the fact table, so this is a plain shuffle join
    (no broadcast); AQE picks the strategy from runtime sizes.
    """
    return df.join(meta.select(key, *[c for c in columns if c != key]), key, "left")


# J10 ------------------------------------------------------------------------
def slice_by_value(df: DataFrame, col: str, value) -> DataFrame:
    """Rows where a (one-hot) column equals ``value``; features and target
    stay in the same row, so nothing needs re-aligning."""
    return df.where(F.col(col) == F.lit(value))
