"""A training-corpus pipeline over ``documents``: five stages, each written and read again.

Language ID drops documents it rejects; line dedup removes repeated lines; near-dedup keeps
one document of each group; decontamination drops documents with benchmark passages; mixing
decides how often each remaining document is taken. All stages but the last return the columns
of ``documents``; every stage works on all rows that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.llm.base import materialize
from vigil.llm.stages import drop_contaminated, drop_repeated_lines, keep_identified, keep_one_of_each, mix

STAGES = [
    ("language_id", keep_identified),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]

# Language ID is a learned model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
