"""Keep-latest, newest-N and latest-per-key operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.session import staged


def newest_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The ``n`` newest rows of each key; ``order`` lists descending sort columns, tie-breakers included.

    The rank filter plans as a partial group limit below the exchange, so at most ``n`` rows
    per key and input task are shuffled, however many copies a hot key has.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def dedup_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The row of each key with the greatest ``order`` values, compared from left to right.

    A max_by over the row: every input task sends one row per key, and neither a rank nor an
    order-wide sort is needed. Select the needed columns first, the row travels as a whole.
    """
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest])


def _at_top(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The rows of each key with the greatest ``order`` (null where a key has no other); keys may be null."""
    tops = staged(df.groupBy(*keys).agg(F.max(order).alias("_top")), "tops")
    tops = tops.withColumnsRenamed({k: f"_top_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_top_{k}")) for k in keys] + [F.col(order).eqNullSafe(F.col("_top"))]
    return df.join(tops, same, "left_semi")


def dedup_latest_fixed(df: DataFrame, keys: list[str], order: Column, tie: str, columns: list[str]) -> DataFrame:
    """The row of each key with the greatest ``order``, then the greatest ``tie``, by hash aggregates alone.

    ``order`` is one number; ``tie`` and ``columns`` have fixed width, so no input or partial result is
    sorted. Of equal order and tie the row with the greatest hash of its columns counts; a null tie is
    least. The result does not depend on the order of the rows.

    The rows are first narrowed to those of the greatest order, then to those of the greatest tie, each time by
    a join with one number per key. So every aggregate holds one group per key, however many rows a key has,
    and only the rows at the top are written or exchanged.
    """
    hashed = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])
    by_order = [*keys, "_order"]
    rows = df.select(*keys, tie, *columns, order.alias("_order"), hashed.alias("_hash"))
    rows = _at_top(staged(_at_top(rows, keys, "_order"), "latest"), keys, tie)
    distinct = rows.groupBy(*by_order, tie).agg(*[F.max_by(c, "_hash").alias(c) for c in columns])
    # Where no row has a tie-breaker there is one row left, so any aggregate gives it.
    of_tie = lambda c: F.coalesce(F.max_by(c, tie), F.when(F.max(tie).isNull(), F.max(c))).alias(c)
    top = distinct.groupBy(*by_order).agg(F.max(tie).alias(tie), *[of_tie(c) for c in columns])
    return top.groupBy(*keys).agg(*[F.max_by(c, "_order").alias(c) for c in (tie, *columns)], F.max("_order").alias("_order"))


def newest(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The ``n`` newest rows of the whole table (a top-k, not a global sort)."""
    return df.orderBy(*order).limit(n)


def newest_then_ascending(df: DataFrame, order: str, n: int) -> DataFrame:
    """The ``n`` newest rows, presented in ascending order."""
    return newest(df, [F.desc(order)], n).orderBy(order)


def rank_recency(df: DataFrame, keys: list[str], order: str, out: str = "recency_rank") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order))))
