"""Batch ingest: validate, enrich, conform, append."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def valid_price() -> Column:
    return (F.coalesce(F.col("coin_id"), F.lit("")) != "") & (F.col("price_usd") > 0) & (F.col("timestamp_ms") > 0)


def valid_sentiment() -> Column:
    return F.col("value").between(0, 100) & (F.col("timestamp") > 0)


def not_empty_record(df: DataFrame) -> Column:
    """False for records in which every field is NULL."""
    present = [F.col(c).isNotNull() for c in df.columns]
    return reduce(lambda a, b: a | b, present)


def enrich(df: DataFrame, source: str, ingested_at: Column) -> DataFrame:
    """Add the ingestion time as an ISO string and the source name."""
    return df.withColumns({"_ingested_at": ingested_at.cast("string"), "_source": F.lit(source)})


def ingest(df: DataFrame, rule: Column | None, source: str, ingested_at: Column) -> DataFrame:
    """Extracted records to bronze rows: drop invalid ones, add metadata."""
    kept = df.filter(F.coalesce(rule, F.lit(False))) if rule is not None else df
    return enrich(kept, source, ingested_at)


def ingest_counts(df: DataFrame, rule: Column) -> DataFrame:
    """Raw, valid and dropped record counts in one pass."""
    ok = F.coalesce(rule, F.lit(False))
    return df.agg(
        F.count(F.lit(1)).alias("raw"), F.count_if(ok).alias("valid"), F.count_if(~ok).alias("dropped")
    )


def stamp(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Add the processing time; tests pass a literal."""
    return df.withColumn("_spark_ingested_at", as_of if as_of is not None else F.current_timestamp())


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns and types of the declared schema; NULL in a required column fails the job."""
    cols = []
    for field in schema.fields:
        col = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            col = F.when(col.isNull(), F.raise_error(F.lit(f"NULL in required column {field.name}"))).otherwise(col)
        cols.append(col.alias(field.name))
    return df.select(*cols)


def append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("append").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
