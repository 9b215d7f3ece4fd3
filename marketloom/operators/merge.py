"""Keyed upsert, incremental load and compaction on partitioned Parquet.

Plain Parquet has no MERGE. An upsert rewrites only the partitions that the updates touch: the
merged rows are written to a table beside the target first, then replace those partitions by
dynamic overwrite, so no path is read and overwritten in the same job. The table beside the target
stays until the overwrite is complete; a run that finds one replays it before anything else, so a
failure inside the overwrite loses no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.session import drop_beside, drop_path, path_exists, scratch_path, staged

PENDING = "__pending"

def merged(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows after MERGE: matched keys take the update, other rows of both sides are kept."""
    return target.join(updates.select(*keys).distinct(), keys, "left_anti").unionByName(updates)


def laid_out(df: DataFrame, partition_by: list[str], sort_by: list[str] | None) -> DataFrame:
    """Rows clustered by table partition and sorted inside each writer task.

    A rebalance, not a repartition: adaptive execution splits a large partition over several
    writers and packs small ones, so no table partition has to fit into one task.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    return df.sortWithinPartitions(*partition_by, *sort_by) if sort_by else df


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str],
    sort_by: list[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """Write partitioned, compressed Parquet."""
    writer = laid_out(df, partition_by, sort_by).write.mode(mode).option("compression", "zstd")
    writer = writer.option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def create_if_missing(spark: SparkSession, path: str, schema: T.StructType, partition_by: list[str]) -> bool:
    """Create an empty table with an explicit schema; False when it exists already."""
    if path_exists(spark, path):
        return False
    empty = spark.createDataFrame([], schema)
    (empty.write.partitionBy(*partition_by) if partition_by else empty.write).parquet(path)
    return True


def upsert(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: list[str],
    partition_by: list[str],
    sort_by: list[str] | None = None,
) -> None:
    """MERGE ``updates`` (one row per key) into the table at ``path``.

    Partition columns must be functions of the key, so that a key never moves between
    partitions. The updates are staged first: they are computed once, and they may derive from
    the table itself.
    """
    if not path_exists(spark, path):
        write_table(updates, path, partition_by, sort_by, "errorifexists")
        return
    recover(spark, path, partition_by, sort_by)
    staged_updates = scratch_path(spark, "updates")
    updates.write.parquet(staged_updates)
    fresh = spark.read.schema(updates.schema).parquet(staged_updates)
    target = spark.read.schema(updates.schema).parquet(path)
    touched = touched_rows(target, fresh, partition_by)
    if touched is not None:
        merged(touched, fresh, keys).write.mode("overwrite").parquet(path + PENDING)
        recover(spark, path, partition_by, sort_by)
    drop_path(spark, staged_updates)


def recover(spark: SparkSession, path: str, partition_by: list[str], sort_by: list[str] | None = None) -> None:
    """Replace partitions by the rows that wait beside the table, if a run left any; a repeat changes nothing."""
    pending = path + PENDING
    if path_exists(spark, f"{pending}/_SUCCESS"):
        _replace_partitions(spark.read.parquet(pending), path, partition_by, sort_by)
    drop_beside(spark, path, PENDING)


def touched_rows(target: DataFrame, updates: DataFrame, partition_by: list[str]) -> DataFrame | None:
    """Target rows of the partitions that occur in the updates; None when there are no updates.

    The values of each partition column, as many as the write makes directories, become a
    literal filter that prunes directories, the NULL one included. With several columns a
    null-safe semi join picks the combinations out of what is left.
    """
    seen = updates.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.collect_set(c).alias(f"v_{c}") for c in partition_by],
        *[F.max(F.col(c).isNull()).alias(f"n_{c}") for c in partition_by],
    ).first()
    if not seen["rows"]:
        return None
    tests = []
    for c in partition_by:
        listed = F.col(c).isin(seen[f"v_{c}"]) if seen[f"v_{c}"] else F.lit(False)
        tests.append(listed | F.col(c).isNull() if seen[f"n_{c}"] else listed)
    pruned = target.filter(reduce(lambda a, b: a & b, tests))
    if len(partition_by) == 1:
        return pruned
    parts = updates.select(*[F.col(c).alias(f"_p_{c}") for c in partition_by]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in partition_by])
    return pruned.join(parts, same, "left_semi")


def _replace_partitions(df: DataFrame, path: str, partition_by: list[str], sort_by: list[str] | None) -> None:
    (
        laid_out(df, partition_by, sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def newer_than(source: DataFrame, target: DataFrame, watermark: str, source_column: str | None = None) -> DataFrame:
    """Source rows past the target's highest watermark; an empty target lets every row through."""
    column = source_column or watermark
    high = target.agg(F.max(watermark).alias("high")).scalar()
    return source.filter(high.isNull() | (F.col(column) > high))


def changed(source: DataFrame, target: DataFrame, keys: list[str], fingerprint: str) -> DataFrame:
    """Keys of source rows that the target lacks or was built from another version of.

    Both sides carry ``fingerprint``, a hash of what the target row is built from. No clock and no
    highest key is involved, so late, restated and lagging rows are all found.
    """
    known = target.select(*keys, F.col(fingerprint).alias("_known"))
    differs = ~F.col(fingerprint).eqNullSafe(F.col("_known"))
    return source.join(known, keys, "left").filter(differs).select(*keys)


def around_changes(source: DataFrame, changes: DataFrame, series: list[str], order: str, reach: int) -> DataFrame:
    """Source rows from the first to the last change of each series, and ``reach`` rows on either side.

    ``_rebuild`` marks the rows whose frames of ``reach`` earlier rows can hold a change. One exchange
    and one sort, for series that the calendar bounds.
    """
    span = changes.groupBy(*series).agg(F.min(order).alias("_first"), F.max(order).alias("_last"))
    whole = Window.partitionBy(*series)
    counted = source.join(span, series).withColumns(
        {
            "_at": F.row_number().over(whole.orderBy(order)),
            "_before": F.count(F.when(F.col(order) < F.col("_first"), 1)).over(whole),
            "_through": F.count(F.when(F.col(order) <= F.col("_last"), 1)).over(whole),
        }
    )
    near = counted.filter((F.col("_at") > F.col("_before") - reach) & (F.col("_at") <= F.col("_through") + reach))
    return near.withColumn("_rebuild", F.col(order) >= F.col("_first")).drop("_first", "_last", "_at", "_before", "_through")


def compact(
    spark: SparkSession,
    path: str,
    partition_by: list[str],
    sort_by: list[str],
    min_input_files: int = 5,
) -> DataFrame:
    """Rewrite partitions made of at least ``min_input_files`` files; returns the file counts before.

    The counts come from a listing as a table, one row per file; no data is read for them.
    """
    recover(spark, path, partition_by, sort_by)
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    counts = staged(listing.groupBy(*partition_by).agg(F.count("path").alias("files")), "file-counts")
    table = spark.read.parquet(path)
    crowded = touched_rows(table, counts.filter(F.col("files") >= min_input_files), partition_by)
    if crowded is not None:
        crowded.write.mode("overwrite").parquet(path + PENDING)
        recover(spark, path, partition_by, sort_by)
    return counts
