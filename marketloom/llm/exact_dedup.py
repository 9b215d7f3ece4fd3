"""Exact deduplication by deterministic block naming.

Each text is cut into blocks of a fixed number of bytes. The distinct blocks are sorted, and the place
of a block in that order is its integer name: equal blocks, and only those, share a name. Adjacent
names of a document are then paired, the distinct pairs are sorted and named in the same way, and so
on until one name is left for the document. Texts are equal exactly when the number of blocks and the
last name are equal, so no two different texts ever share an identity.

A block's text is shuffled once, to be sorted. Rows then look up names by a 128-bit digest of the
block; that the digest tells all blocks of this input apart is checked on the named blocks, and the
step repeats with other digests where it does not. Copies meet in the map-side part of ``distinct``,
and the look-ups are plain joins, which adaptive execution splits where a group of copies is large.

Defined results
    null text: as the empty text, which has one empty block. Null ids: the smallest id.
    Repeated rows: each counts; of rows with the same id and text, one stays.
    Empty table: no rows. Other columns: ignored by ``identities``, kept by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import Stage, free_name, text_or_empty

BLOCK_BYTES = 4096
MAX_SEEDS = 8


def block_digest(block: Column, seed: int) -> list[Column]:
    """Two 64-bit digests of a block; ``seed`` picks other functions."""
    return [F.xxhash64(F.lit(2 * seed + k), block) for k in range(2)]


def _named(distinct: DataFrame, keys: list[str]) -> DataFrame:
    """An integer name for each row: its place among the sorted rows of its partition, and the partition."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def _blocks(block_bytes: int) -> Column:
    """The blocks of the binary column ``bytes``, by offset: linear in the length of the text."""
    last = F.greatest(F.octet_length("bytes") - 1, F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), F.floor(last / block_bytes).cast("int")),
        lambda i: F.substring(F.col("bytes"), i * block_bytes + 1, F.lit(block_bytes)),
    )


def identities(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    digest: Callable[[Column, int], list[Column]] = block_digest,
) -> DataFrame:
    """One row per input row: ``row`` (its number), ``id``, ``text_sha256``, ``n_blocks``, ``name``.

    Two rows have equal ``(n_blocks, name)`` exactly when their texts are equal.
    """
    stage = Stage(docs.sparkSession, "names")
    source = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("bytes")
    )
    for seed in range(MAX_SEEDS):
        keys = [c.alias(f"h{i}") for i, c in enumerate(digest(F.col("block"), seed))]
        hs = [f"h{i}" for i in range(len(keys))]
        of_block = F.transform(_blocks(block_bytes), lambda b: F.struct(*[c.alias(f"h{i}") for i, c in enumerate(digest(b, seed))]))
        rows = stage.keep(
            "rows", source.select("row", "id", F.sha2(F.col("bytes"), 256).alias("text_sha256"), of_block.alias("blocks"))
        )
        distinct = source.select(F.explode(_blocks(block_bytes)).alias("block")).select(*keys, "block").distinct()
        names = stage.keep("level", _named(distinct, ["block"]).select(*hs, "name"))
        if names.groupBy(*hs).count().filter("count > 1").isEmpty():
            break
        stage.drop("rows", "level")
    else:
        raise ValueError("no digest tells the blocks apart")

    level = (
        rows.select("row", F.size("blocks").alias("n_blocks"), F.posexplode("blocks").alias("pos", "h"))
        .select("row", "n_blocks", "pos", "h.*")
        .join(names, hs)
        .select("row", "n_blocks", "pos", "name")
    )
    left = rows.agg(F.max(F.size("blocks"))).first()[0] or 1
    width, whole = 1, []
    while True:
        level = stage.keep("pairs", level)
        # A document is whole where its blocks fit into one name of this width.
        whole.append(level.filter((F.col("n_blocks") <= width) & (F.col("n_blocks") > width // 2)).select("row", "n_blocks", "name"))
        if left <= 1:
            break
        even = F.col("pos") % 2 == 0
        pairs = (
            level.filter(F.col("n_blocks") > width)
            .groupBy("row", "n_blocks", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
            .agg(
                F.max(F.when(even, F.col("name"))).alias("first"),
                F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("second"),
            )
        )
        named = _named(pairs.select("first", "second").distinct(), ["first", "second"])
        level = pairs.join(named, ["first", "second"]).select("row", "n_blocks", "pos", "name")
        left, width = -(-left // 2), width * 2
    names_of_rows = whole[0]
    for part in whole[1:]:
        names_of_rows = names_of_rows.unionByName(part)
    return rows.select("row", "id", "text_sha256").join(names_of_rows, "row")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: ``id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Of equal texts the row with the largest id stays; of rows that share that id, the last one read.
    """
    rows = identities(docs, id_col, text_col, **options)
    rows = Stage(docs.sparkSession, "names").keep("identities", rows)
    sizes = rows.groupBy("n_blocks", "name").agg(F.max(F.struct("id", "row")).alias("keep"), F.count("*").alias("group_size"))
    return rows.join(sizes, ["n_blocks", "name"]).select(
        "id",
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows that stay, with all their columns."""
    found = groups(docs, id_col, text_col, **options)
    sha, ident, one = (free_name(docs.columns, n) for n in ("sha", "ident", "one"))
    stays = (
        found.filter(F.col("id").eqNullSafe(F.col("keep_id")))
        .groupBy(F.coalesce(F.col("id").cast("string"), F.lit("")).alias(ident), F.col("text_sha256").alias(sha))
        .agg((F.count("*") == 1).alias(one))
    )
    keyed = docs.withColumns(
        {sha: F.sha2(text_or_empty(text_col).cast("binary"), 256), ident: F.coalesce(F.col(id_col).cast("string"), F.lit(""))}
    ).join(stays, [ident, sha])
    single, repeated = keyed.filter(one), keyed.filter(~F.col(one)).dropDuplicates([ident, sha])
    return single.unionByName(repeated).select(*docs.columns)
