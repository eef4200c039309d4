"""From raw documents to packed training sequences: five stages, each over all that the stage before it kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet, and the next stage reads
that.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelspark.llm import decontaminate, exact, langid, packing, simhash
from panelspark.llm.queries import tokenizer_path
from panelspark.llm.store import settle
from panelspark.shipping import ship
from panelspark.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language stays unknown: without a letter, or as likely in any other language."""
    ship(spark)
    return langid.drop_unknown(docs, langid.train(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the longest stays, then the smallest doc_id."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, the smallest doc_id of each group stays."""
    ship(spark)
    return simhash.drop_near_copies(docs, shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a test item or a passage of at least ten tokens of one."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places the pieces of every document in sequences of 2048 tokens."""
    ship(spark)
    return packing.pack(docs, tokenizer_path(), capacity=2048, end_id=0)


STAGES: list[tuple[str, Stage]] = [
    ("language ID", language_id),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: SQL cannot express tokenizers, fingerprints or packing; tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
