"""Scans and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType


def read_table(spark: SparkSession, path: str, schema: StructType | None = None,
               columns: list[str] | None = None, nan_as_null: bool = True) -> DataFrame:
    """S1 — read Parquet.  ``columns`` narrows the ReadSchema at the scan.  NaN
    becomes NULL unless ``nan_as_null`` is off (filters on float columns are
    then pushed to the scan)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    if columns:
        df = df.select(*columns)
    return nan_to_null(df) if nan_as_null else df


def read_csv(spark: SparkSession, path: str, schema: StructType,
             date_format: str = "yyyy-MM-dd", sep: str = ",", nan_as_null: bool = True) -> DataFrame:
    """S2 — CSV with a header row and a declared schema; NaN becomes NULL.

    The schema is mandatory: inference costs a full extra pass over the files
    and can change types between runs.
    """
    df = (spark.read.schema(schema)
          .option("header", "true")
          .option("dateFormat", date_format)
          .option("sep", sep)
          .option("mode", "FAILFAST")
          .csv(path))
    return nan_to_null(df) if nan_as_null else df


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """S3 — write Parquet, optionally partitioned (e.g. by year) so later
    period filters prune whole directories."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Normalise float NaN to NULL on ingest (Spark orders NaN above every
    number and treats NaN = NaN, unlike SQL NULL)."""
    fixes = {f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType))
             for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.withColumns(fixes) if fixes else df
