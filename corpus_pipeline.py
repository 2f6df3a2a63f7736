"""A pipeline over documents.  Each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm import stages
from quern.llm.common import materialise, table

STAGES = [
    ("language_id", stages.language_id),
    ("near_duplicates", stages.near_duplicates),
    ("decontamination", stages.decontamination),
    ("secrets", stages.secrets),
    ("encoding", stages.encoding),
]

#: Models and tokenizers take part in the stages, so SQL cannot express the pipeline.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs, _ = materialise(docs, name)
    return docs
