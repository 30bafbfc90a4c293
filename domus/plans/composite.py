"""Composite pipelines (Q1–Q5): what users call.

Each returns lazy DataFrames.  The only jobs run while building a plan are
the size checks of small sides (see ``domus.operators.joins``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from domus.operators import frames as P
from domus.operators import joins as J
from domus.operators import windows as W
from domus.operators.aggregates import CITY_KEY, CITY_MONTH_KEY, city_month_stats, quantile
from domus.operators.encoding import one_hot
from domus.session import cut_lineage

MONTH_KEYS = ["transaction_year", "transaction_month"]


def prepared_base(tx: DataFrame, since: str = "2018-01-01") -> DataFrame:
    """P2 → P3 → month/year → P1 on raw transactions."""
    base = P.filter_since(tx, "transaction_date", F.to_date(F.lit(since)))
    base = P.keep_plain_rows(base)
    base = base.withColumns({
        "transaction_month": F.month("transaction_date"),
        "transaction_year": F.year("transaction_date"),
    })
    return P.add_ratio(base, "price", "living_area", "price_per_m2")


def labelled_transactions(tx: DataFrame, since: str = "2018-01-01", min_count: int = 4,
                          pct_below: float = 0.1, label: str = "below_market") -> DataFrame:
    """Core of Q1 (minimum slice): base ⋈ kept city-month stats, labelled."""
    return labelled_base(prepared_base(tx, since), min_count, pct_below, label)


def labelled_base(base: DataFrame, min_count: int = 4, pct_below: float = 0.1, label: str = "below_market") -> DataFrame:
    """:func:`labelled_transactions` from the prepared base, which is read twice
    (statistics and join)."""
    kept, _ = city_month_stats(base, CITY_MONTH_KEY, min_count=min_count)
    joined = J.join_detail_aggregate(base, kept, CITY_MONTH_KEY)
    return P.below_reference_flag(joined, "price_per_m2", "avg_price_per_m2", pct_below, label)


def prepare_transactions(tx: DataFrame, regions: DataFrame, since: str = "2018-01-01",
                         min_count: int = 4, pct_below: float = 0.1, department_q: float = 0.25,
                         top_regions: int = 5, label: str = "below_market"
                         ) -> tuple[DataFrame, DataFrame]:
    """Q1 — raw transactions → (labelled, pruned transactions; kept city-month stats).

    Department and region pruning are decided on the small city-month table
    (each kept city-month knows its row count), so the fact table is
    scanned once for the statistics and joined once, with every filter
    folded into the statistics side of that join.
    """
    base = prepared_base(tx, since)
    kept, _ = city_month_stats(base, CITY_MONTH_KEY, min_count=min_count, with_row_count=True)
    # the city-month table feeds three branches below: materialise it once
    kept = J.small_side(cut_lineage(kept))

    # A7 on departments: rows per department after the join = Σ num_rows.
    dept_counts = kept.groupBy("department").agg(F.sum("num_rows").alias("count"))
    thr = quantile(dept_counts, "count", department_q).withColumnRenamed("value", "_thr")
    kept_depts = (dept_counts.crossJoin(F.broadcast(thr))  # one row
                  .where(F.col("count") > F.col("_thr")).drop("_thr"))

    # J4 + O2: region of each kept department, top regions by rows.
    dim = (regions.withColumn("department", F.col("department_code").cast("int"))
           .withColumn("region", F.col("region_code").cast("int")))
    dept_region = J.join_small(kept_depts, dim, "department", "inner")
    top = (dept_region.groupBy("region").agg(F.sum("count").alias("n"))
           .orderBy(F.col("n").desc(), F.col("region").asc()).limit(top_regions).select("region"))
    allowed = (dept_region.join(F.broadcast(top), "region", "left_semi")  # ≤ top_regions rows
               .drop("count"))

    stats = J.join_small(kept, allowed, "department", "inner").drop("num_rows")
    out = J.join_detail_aggregate(base, stats, CITY_MONTH_KEY)
    out = P.below_reference_flag(out, "price_per_m2", "avg_price_per_m2", pct_below, label)
    out = P.cast_columns(out, {"transaction_year": "int", "transaction_month": "int",
                               "department": "int", "off_plan": "int"}, strict=True)
    return out, kept.drop("num_rows")


def city_features(stats: DataFrame, q: float = 0.8, window: int = 6) -> DataFrame:
    """Q2 — city-month table → demand flag, previous-month values, rolling
    means over ``window`` retained months, incomplete rows dropped."""
    # the city-month table feeds three branches (group totals, the share
    # quantile, the windows): keep it instead of recomputing it
    stats = cut_lineage(stats)
    flagged = W.city_demand_flag(stats, "city_requested", q)
    order = MONTH_KEYS
    lagged = W.add_lag(flagged, {"avg_price_per_m2": "avg_price_per_m2_previous_month",
                                 "num_transactions_month": "num_transactions_previous_month"},
                       CITY_KEY, order)
    rolled = W.add_rolling_mean(lagged, {"avg_price_per_m2": f"avg_price_per_m2_rolling_{window}m",
                                         "num_transactions_month": f"num_transactions_rolling_{window}m"},
                                CITY_KEY, order, window)
    return P.drop_incomplete(rolled)


def monthly_macro(interest_rate: DataFrame, new_loans: DataFrame, rent_index: DataFrame,
                  months: int = 6) -> DataFrame:
    """Q3 — monthly macro table: J3 inner date join, J6 left join of the
    quarterly index by (year, month), W5 forward fill, W3 differences, W4
    rolling mean of the change over ``months`` calendar months."""
    monthly = J.join_on_date(interest_rate, new_loans, "date")
    monthly = monthly.withColumns({"year": F.year("date"), "month": F.month("date")})
    rent = rent_index.select(F.year("date").alias("year"), F.month("date").alias("month"), "IRL")
    monthly = J.join_small(monthly, rent, ["year", "month"], "left")
    monthly = W.forward_fill(monthly, ["IRL"], ["year", "month"])
    monthly = monthly.withColumnsRenamed({"taux": "interest_rate", "IRL": "rent_reference_index"})
    monthly = W.add_differences(monthly, "interest_rate", ["year", "month"],
                                first="interest_rate_change", second="interest_rate_acceleration")
    return W.add_time_rolling_mean(monthly, "interest_rate_change", months,
                                   out=f"interest_rate_change_rolling_{months}m")


def annual_macro(debt_ratio: DataFrame, financial_assets: DataFrame) -> DataFrame:
    """Q4 — annual macro table: J3 join on year, W3 differences."""
    annual = J.join_on_date(debt_ratio, financial_assets, "date")
    annual = annual.withColumn("date", F.col("date").cast("int"))
    return W.add_differences(annual, "debt_ratio", ["date"],
                             first="debt_ratio_change", second="debt_ratio_acceleration")


# fixed values: names of the input schema that are not features
METADATA_COLUMNS = [
    "transaction_id", "transaction_date", "city_id", "city", "department_code", "department",
    "region_code", "region", "address", "postal_code", "cadastral_parcel_id",
    "price_per_m2", "avg_price_per_m2", "department_name",
]


def engineer_features(transactions: DataFrame, city_stats: DataFrame, annual: DataFrame,
                      monthly: DataFrame, building_types: list[str] | None = None,
                      region_names: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Q5 — labelled transactions + city features + macro context → one-hot
    encoded numeric feature table and its metadata table.

    J2: the city features join on the five city-month keys only; the
    measures already present on the transactions are taken from that side.
    """
    city = city_stats.drop("avg_price_per_m2", "num_transactions_month")
    tx = J.join_detail_aggregate(transactions, city, CITY_MONTH_KEY, "inner")
    tx = J.add_economic_context(tx, annual, monthly)
    tx = one_hot(tx, "building_type", building_types)
    tx = one_hot(tx, "region_name", region_names)
    features, meta = P.split_metadata(tx, METADATA_COLUMNS, "transaction_id", drop_also=["date"])
    return P.drop_incomplete(features), meta
