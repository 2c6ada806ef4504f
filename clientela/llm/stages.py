"""The stages of the corpus pipeline: (spark, docs, sf_dir) to the documents that stay. Rows whose
doc_id is null pass the stages that compare documents, since nothing orders them."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela.llm import attention, bpe, decontaminate, minhash, winnow
from clientela.llm.sample import fold


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 500  # whole texts handed to a Python worker at once


def _small_batches(spark: SparkSession) -> None:
    """Spark hands 10,000 rows at once to Python workers, and holds them beside its heap. Rows are
    whole texts here, and the stages follow each other in the same executors. Holds for the session;
    a lower number stays."""
    if not 0 < int(spark.conf.get(BATCH)) <= BATCH_ROWS:
        spark.conf.set(BATCH, str(BATCH_ROWS))


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(ids.select("doc_id").distinct(), "doc_id", "left_anti").select([F.col(f"`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, d: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    _small_batches(spark)
    labels = spark.read.parquet(f"{d}/labels.parquet")
    model = attention.train(docs, labels, fold(F.col("doc_id"), 5) != 0)
    return attention.keep_good(docs, model, attention.DECISION)


def lines(spark: SparkSession, docs: DataFrame, d: str) -> DataFrame:
    """Later copies of runs of lines go, and documents that hold nothing else. n_chars follows."""
    _small_batches(spark)
    left = winnow.delete_runs(docs, winnow.repeated_runs(docs, long_words=winnow.LONG_WORDS))
    if "n_chars" not in left.columns:
        return left
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near(spark: SparkSession, docs: DataFrame, d: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    _small_batches(spark)
    return _without(docs, minhash.near_duplicates(docs).where("NOT kept"))


def benchmark(spark: SparkSession, docs: DataFrame, d: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return _without(docs, decontaminate.leaks(docs, spark.read.parquet(f"{d}/benchmark.parquet")))


def encode(spark: SparkSession, docs: DataFrame, d: str) -> DataFrame:
    """Every document that is left, with its token ids. Where documents have a column of that name,
    the new one is named with `_bpe` behind."""
    _small_batches(spark)
    taken = {c.lower() for c in docs.columns}
    names = tuple(c + "_bpe" * (c in taken) for c in ("n_tokens", "ids", "decoded_same"))
    return bpe.encode_rows(docs, public_tokenizers.path("byte_bpe_50k.json"), added=names)
