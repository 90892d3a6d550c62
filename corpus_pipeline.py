"""Corpus pipeline over ``documents``: quality rules, near copies, benchmark
decontamination, personal data, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; all but the last return the columns of ``docs``, whatever
they are (columns beside ``doc_id``, ``text`` and ``n_chars`` pass through).
Rows are told apart by their place in the stored table, not by ``doc_id``, so
null and repeated ids are fine.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm.common import stored, table, without_rows
from tickwise.llm.decontaminate import contamination, is_contaminated
from tickwise.llm.near import near_classes
from tickwise.llm.packing import pack
from tickwise.llm.pii import mask_personal
from tickwise.llm.quality import ledger, passes
from tickwise.llm.queries import TOKENIZER


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the current policy rejects go."""
    rows = ledger(docs, nested=True)
    # a filter would be pushed below the ledger and measure every text again
    # for each rule; a generator stays above it
    return rows.select(F.explode(F.when(passes(), F.array("row"))).alias("row")).select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each class of linked documents the first one stays."""
    return without_rows(docs, near_classes(docs).where(~F.col("first")).select("row"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: contaminated documents go."""
    return without_rows(docs, contamination(docs, table(spark, sf_dir, "benchmark")).where(is_contaminated()).select("row"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: personal data is masked; ``n_chars`` follows the text."""
    return mask_personal(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: token windows of what is left."""
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each is stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# The near-copy classes and the tokenizer have no SQL form; tests compare the
# stages with brute force.
ORACLE_SQL = None
