"""Joins that need more than equality: ranges, lookups, missing keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_in_range(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    left_ts: str,
    right_ts: str,
    low_s: float,
    high_s: float,
    left_id: list[str],
    values: list[str],
) -> DataFrame:
    """For each left row the earliest right row with left_ts+low <= right_ts <= left_ts+high.

    Both sides are joined by equality on (keys, time bucket) with buckets as wide as the range,
    so a left row meets at most two buckets. ``right`` must hold one row per key and time (bars),
    which bounds the candidates of a left row by the bars in two buckets. One aggregation by
    ``left_id``, which must be unique, takes the earliest and puts the two probes of a left row
    back together; left rows without a match keep NULL values.
    """
    width = float(high_s - low_s)

    def seconds(ts: str) -> Column:
        return F.unix_micros(F.col(ts)) / F.lit(1e6)

    first = F.floor((seconds(left_ts) + F.lit(float(low_s))) / F.lit(width))
    probes = left.withColumn("_probe", F.explode(F.array(first, first + 1)))
    bars = right.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col(right_ts).alias("_rts"),
        *[F.col(v).alias(f"_r_{v}") for v in values],
        F.floor(seconds(right_ts) / F.lit(width)).alias("_bucket"),
    )
    gap = (F.unix_micros("_rts") - F.unix_micros(F.col(left_ts))) / F.lit(1e6)
    same = (F.col("_probe") == F.col("_bucket")) & gap.between(low_s, high_s)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_k_{k}"))
    rest = [c for c in left.columns if c not in left_id]
    return probes.join(bars, same, "left").groupBy(*left_id).agg(
        *[F.any_value(c).alias(c) for c in rest],
        F.min("_rts").alias("matched_ts"),
        *[F.min_by(f"_r_{v}", "_rts").alias(f"matched_{v}") for v in values],
    )


def lookup_or_self(value: Column, table: dict[str, str]) -> Column:
    """Mapped value where the fixed table has one, else the value itself."""
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent row; NULL keys count as orphans."""
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")
