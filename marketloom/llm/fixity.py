"""Merkle fixity audit of record archives.

A volume (an archive file) is a row of records at offsets. Records are hashed, and ordered ranges of
``2 ** BITS`` offsets are hashed into nodes, level by level, up to one root per volume. Two replicas are
compared root by root; below a root that differs only the children of differing nodes are looked at, down
to the records. What is returned is the differing part of both trees.

Nodes gather at most ``2 ** BITS`` children. Records that share an offset are summed up before the
shuffle (the sums of eight parts of their digests, and their number), so repeated offsets gather nothing.

Defined results
    null fields: hashed as null, unlike an empty string. Null volumes: the volume with the empty name.
    Null and negative offsets: offset zero. Several records at one offset: one leaf, equal in both
    replicas if the same records are there as often, in any order. Equal replicas or empty tables:
    no rows. Other columns: not looked at unless named as fields.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import Stage

BITS = 6
PARTS = 8


def record_digest(fields: Sequence[str]) -> Column:
    """SHA-256 of the fields, each framed by its length."""
    framed = [F.coalesce(F.concat(F.octet_length(F.col(f).cast("string")).cast("string"), F.lit(":"), F.col(f).cast("string")), F.lit("-")) for f in fields]
    return F.sha2(F.concat_ws("|", *framed).cast("binary"), 256)


def leaves(records: DataFrame, volume: Column, offset: Column, fields: Sequence[str]) -> DataFrame:
    """``volume``, ``node`` (the offset), ``digest``, ``records``."""
    part = 64 // PARTS
    sums = [F.sum(F.conv(F.substring("d", k * part + 1, part), 16, 10).cast("long")).alias(f"s{k}") for k in range(PARTS)]
    hashed = records.select(
        F.coalesce(volume.cast("string"), F.lit("")).alias("volume"),
        F.greatest(F.coalesce(offset.cast("long"), F.lit(0)), F.lit(0)).alias("node"),
        record_digest(fields).alias("d"),
    )
    summed = hashed.groupBy("volume", "node").agg(F.count("*").alias("records"), *sums)
    return summed.select("volume", "node", F.sha2(F.concat_ws(",", "records", *[f"s{k}" for k in range(PARTS)]), 256).alias("digest"), "records")


def parents(level: DataFrame) -> DataFrame:
    """The nodes above: the ordered digests of the children, hashed."""
    child = F.struct(F.col("node").alias("node"), "digest")
    grouped = level.groupBy("volume", F.shiftright("node", BITS).alias("above")).agg(
        F.array_sort(F.collect_list(child)).alias("children"), F.sum("records").alias("records")
    )
    listed = F.array_join(F.transform("children", lambda c: F.concat_ws(":", c["node"], c["digest"])), ",")
    return grouped.select("volume", F.col("above").alias("node"), F.sha2(listed, 256).alias("digest"), "records")


def tree(stage: Stage, name: str, base: DataFrame, height: int) -> list[DataFrame]:
    """The levels from the records to the roots, each written once."""
    levels = [stage.keep(f"{name}0", base)]
    for k in range(1, height + 1):
        levels.append(stage.keep(f"{name}{k}", parents(levels[-1])))
    return levels


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    joined = a.alias("a").join(b.alias("b"), ["volume", "node"], "full")
    differs = ~F.col("a.digest").eqNullSafe(F.col("b.digest"))
    status = F.when(F.col("b.digest").isNull(), "missing").when(F.col("a.digest").isNull(), "extra").otherwise("changed")
    counts = [F.coalesce(f"{s}.records", F.lit(0)).cast("long").alias(f"records_{s}") for s in "ab"]
    return joined.filter(differs).select("volume", "node", status.alias("status"), *counts)


def audit(a: DataFrame, b: DataFrame, volume: str, offset: str, fields: Sequence[str], height: int | None = None) -> DataFrame:
    """The differing nodes of two replicas.

    ``level`` (0: records), ``volume``, ``first_offset``, ``last_offset``, ``status`` (missing, extra or
    changed in the second replica), ``records_a``, ``records_b``.
    """
    stage = Stage(a.sparkSession, "fixity")
    bases = [leaves(x, F.col(volume), F.col(offset), fields) for x in (a, b)]
    if height is None:
        most = max((x.agg(F.max(F.col(offset).cast("long"))).first()[0] or 0) for x in (a, b))
        height = -(-max(0, most).bit_length() // BITS)
    trees = [tree(stage, name, base, height) for name, base in zip("ab", bases)]
    found, differing = [], None
    for k in range(height, -1, -1):
        levels = [t[k] for t in trees]
        if differing is not None:
            above = differing.select("volume", F.col("node").alias("above"))
            levels = [x.withColumn("above", F.shiftright("node", BITS)).join(above, ["volume", "above"], "left_semi").drop("above") for x in levels]
        differing = stage.keep("differing", _differing(*levels))
        first = F.shiftleft("node", BITS * k)
        found.append(
            differing.select(
                F.lit(k).alias("level"), "volume", first.alias("first_offset"), (first + F.lit((1 << BITS * k) - 1)).alias("last_offset"),
                "status", "records_a", "records_b",
            )
        )
    stage.drop(*[f"{name}{k}" for name in "ab" for k in range(height + 1)])
    return reduce(DataFrame.unionByName, found)
