"""Column helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.session import drop_path, scratch_path


class Stage:
    """Tables written below the shared folder while an operator runs.

    ``keep`` cuts the lineage of a result, so a lost executor costs a reread and not a rerun;
    ``drop`` frees a table once nothing reads it any more.
    """

    def __init__(self, spark, label: str):
        self.spark, self.label, self.paths = spark, label, {}

    def keep(self, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        path = scratch_path(self.spark, f"{self.label}-{name}")
        (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
        self.paths.setdefault(name, []).append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            for path in self.paths.pop(name, []):
                drop_path(self.spark, path)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def free_name(taken: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column has it (Spark ignores case)."""
    lower = {c.lower() for c in taken}
    while wanted.lower() in lower:
        wanted = "_" + wanted
    return wanted


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows in the jobs run inside, for rows that are large."""
    before = spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, if it is not installed.

    Texts come in batches of at most 1,000, a tenth of the default, which bounds a worker's memory.
    """
    if int(spark.conf.get(BATCH_ROWS)) > 1000:
        spark.conf.set(BATCH_ROWS, "1000")
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, [environment.get("PYTHONPATH"), root]))
    return spark
