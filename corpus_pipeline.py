"""Clean a document corpus for training: each stage works on all that its predecessor kept.

The first stages return the columns of ``documents``; the last adds token ids. Stages are written as Parquet in the
shared folder and read again, so a lost executor never repeats an earlier stage.
"""

from pyspark.sql import DataFrame, SparkSession

from credara.llm import stages
from credara.sources.workspace import Workspace

STAGES = [
    ("toxicity", stages.toxicity),
    ("exact_dedup", stages.exact_dedup),
    ("near_dedup", stages.near_dedup),
    ("decontaminate", stages.decontaminate),
    ("encode", stages.encode),
]

# SQL has no sequence tagger, truncated SVD or BPE: tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of a folder; returns the last one's rows."""
    ws = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = ws.save(name, stage(spark, docs, sf_dir))
    return docs
