"""Training-text pipeline over `documents`: each stage is written as Parquet and read again as the
next one's input."""

from pyspark.sql import DataFrame, SparkSession

from clientela.llm import stages
from clientela.llm.store import keep

STAGES = [
    ("quality_classifier", stages.quality),
    ("line_dedup", stages.lines),
    ("minhash_near_dedup", stages.near),
    ("benchmark_decontamination", stages.benchmark),
    ("bpe_encoding", stages.encode),
]

#: The classifier of the first stage is fitted numerically; SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the whole of `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
