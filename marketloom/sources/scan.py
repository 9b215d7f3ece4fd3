"""Table scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_optional(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where it does not exist."""
    from marketloom.session import path_exists

    return spark.read.parquet(path) if path_exists(spark, path) else None


def scan(df: DataFrame, wanted: list[str], row_filter: Column | None = None) -> DataFrame:
    """Filter, then keep the wanted columns that the table has; both reach the Parquet scan."""
    kept = df if row_filter is None else df.filter(row_filter)
    return kept.select([c for c in wanted if c in df.columns])


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", "true").csv(path)
