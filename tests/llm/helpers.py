"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, kept string, `a.b` string"


def docs_of(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """``(doc_id, text)`` rows with extra columns whose names clash with the
    operators' own."""
    full = [(i, t, "en", "s", None if t is None else len(t), 7, "k", "x") for i, t in rows]
    return spark.createDataFrame(full, DOCS)


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


ODD_TEXTS = [None, "", " \n\t ", "one", "é ß 中文 😀", "A" * 5000, "- - - ... !!!", "x\x00y z"]
