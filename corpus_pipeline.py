"""From documents to packed training sequences, stage by stage.

Every stage reads what its predecessor kept and returns the columns of ``documents``; the last one returns
the pieces of the packed sequences. Between stages the rows are written to the shared folder and read
again, so a lost executor never repeats an earlier stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import exact_dedup, near_dedup, packing, pii, toxicity
from marketloom.llm.common import Stage, importable
from marketloom.llm.queries import byte_bpe, table

StageFn = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half stay."""
    importable(spark)
    scored = toxicity.fit(docs, table(spark, sf_dir, "labels")).score(docs)
    return scored.filter(toxicity.predicted() == 0).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    importable(spark)
    return near_dedup.deduplicate(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become their kind in brackets; ``n_chars`` follows the text."""
    importable(spark)
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of at most 1,024."""
    importable(spark)
    cut = packing.pieces(docs, byte_bpe())
    return packing.pack(cut.select(F.col("id").alias("doc_id"), "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES: list[tuple[str, StageFn]] = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

# Trees, minima, a random field and a vocabulary: SQL cannot express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Stage(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, apply) in enumerate(STAGES):
        docs = stage.keep(name, apply(spark, docs, sf_dir))
        if i:
            stage.drop(STAGES[i - 1][0])
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
