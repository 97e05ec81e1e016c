"""A corpus from documents to token files: five stages, each written and read again before the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dockflow.llm import decontam, mixing, parity, quality, simple8b, store


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: a token file of all rows, read back. Null texts are empty and get their end id; a null doc_id stands first; repeated rows are
    documents each; other columns are left behind; an empty table gives no rows."""
    return simple8b.token_file(docs)


STAGES = [
    ("quality classifier", quality.reject_low_quality),
    ("n-gram Jaccard join", parity.drop_near_copies),
    ("benchmark decontamination", decontam.drop_leaks),
    ("mixing to target weights", mixing.mix_to_targets),
    ("token-ID output", tokenise),
]

#: The stages fit models and hash texts, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's result is a Parquet table in the shared folder."""
    docs = store.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
