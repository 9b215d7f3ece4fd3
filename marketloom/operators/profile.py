"""Row counts and samples over several tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_counts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """One row per present table with its row count; missing tables are left out."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
        if df is not None
    ]
    return reduce(DataFrame.unionByName, counts)


def sample(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows by key: the same ones in every run."""
    return df.orderBy(*order).limit(n)


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Value counts, most common first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))
