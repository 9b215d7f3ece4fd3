"""Row-ordinal chunks: windows over one series without one task per series.

A market has few assets and very long series, so ``Window.partitionBy(asset)`` would put a
third of all rows into one task. Here every row gets its position in its series from
per-bucket counts, positions are cut into fixed-length chunks, and a short halo of the
neighbouring chunk's rows is copied so that bounded frames see the rows they need. Windows
then partition by (series, chunk), whose size is known in advance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

POS = "_pos"
CHUNK = "_chunk"
HALO = "_halo"
LENGTH = "_len"


def with_position(
    df: DataFrame,
    keys: list[str],
    ts: str,
    bucket: str = "day",
    totals: dict[str, str] | None = None,
) -> DataFrame:
    """Add the 0-based position of each row in its series and the series length.

    ``ts`` must be unique per series. ``totals`` maps an output name to a column whose mean
    over the whole series is wanted. Only the counts per (series, bucket) are ordered per
    series, one row per bucket; the rows themselves are ranked inside their bucket. The ranked
    rows are already partitioned and sorted for a merge join with the offsets.
    """
    totals = totals or {}
    tagged = df.withColumn("_bucket", F.date_trunc(bucket, ts))
    counts = tagged.groupBy(*keys, "_bucket").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_sum_{o}") for o, c in totals.items()]
    )
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = counts.select(
        *keys,
        "_bucket",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_n").over(whole).alias(LENGTH),
        *[(F.sum(f"_sum_{o}").over(whole) / F.sum("_n").over(whole)).alias(o) for o in totals],
    )
    inside = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(ts))
    return (
        tagged.withColumn("_in_bucket", inside)
        .join(offsets.hint("merge"), [*keys, "_bucket"])
        .withColumn(POS, F.col("_offset") + F.col("_in_bucket") - 1)
        .drop("_bucket", "_offset", "_in_bucket")
    )


def with_chunks(df: DataFrame, chunk_rows: int, before: int = 0, after: int = 0) -> DataFrame:
    """Assign chunks and copy the last ``before`` / first ``after`` rows to the neighbour chunk."""
    if max(before, after) > chunk_rows:
        raise ValueError("a halo cannot be longer than a chunk")
    chunk = F.floor(F.col(POS) / chunk_rows)
    within = F.col(POS) - chunk * chunk_rows
    copies = [F.struct(chunk.alias("c"), F.lit(False).alias("h"))]
    if before:
        copies.append(F.when(within >= chunk_rows - before, F.struct((chunk + 1).alias("c"), F.lit(True).alias("h"))))
    if after:
        copies.append(
            F.when((within < after) & (chunk > 0), F.struct((chunk - 1).alias("c"), F.lit(True).alias("h")))
        )
    if len(copies) == 1:
        return df.withColumn(CHUNK, chunk).withColumn(HALO, F.lit(False))
    placed = df.withColumn("_copy", F.explode(F.array_compact(F.array(*copies))))
    return placed.withColumn(CHUNK, F.col("_copy.c")).withColumn(HALO, F.col("_copy.h")).drop("_copy")


def chunk_window(keys: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys, CHUNK).orderBy(POS)


def without_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(HALO)).drop(HALO)


def rolling(
    df: DataFrame,
    keys: list[str],
    order: str,
    measures: dict[str, tuple[str, str, int]],
    chunk_rows: int | None = None,
    bucket: str = "day",
) -> DataFrame:
    """Trailing aggregates over the last N rows of a series, current row included.

    ``measures`` maps an output to (function, column, N) with function avg, sum, min, max,
    stddev, stddev_pop or lag (N rows back). Series bounded by the calendar can run unchunked;
    longer ones pass ``chunk_rows``.
    """

    def apply(frame: DataFrame, base: WindowSpec) -> DataFrame:
        cols = {}
        for out, (fn, column, n) in measures.items():
            if fn == "lag":
                cols[out] = F.lag(column, n).over(base)
            else:
                cols[out] = getattr(F, fn)(column).over(base.rowsBetween(-(n - 1), 0))
        return frame.withColumns(cols)

    if chunk_rows is None:
        return apply(df, Window.partitionBy(*keys).orderBy(order))
    reach = max(n if fn == "lag" else n - 1 for fn, _, n in measures.values())
    placed = with_chunks(with_position(df, keys, order, bucket), chunk_rows, before=reach)
    return without_halo(apply(placed, chunk_window(keys))).drop(CHUNK, POS, LENGTH)
