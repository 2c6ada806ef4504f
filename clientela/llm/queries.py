"""Registered queries of the operators, and their SQL where SQL can express them."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientela.llm.sample import fold
from clientela.sources.staging import stage_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    """Register a function of (spark, folder) under its name."""
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


@query
def op7_minhash_near_dedup(spark, d):
    from clientela.llm.minhash import near_duplicates
    return near_duplicates(table(spark, d, "documents"))


@query
def op1_line_dedup(spark, d):
    from clientela.llm.winnow import LONG_WORDS, repeated_runs
    return repeated_runs(table(spark, d, "documents"), long_words=LONG_WORDS)


@query
def op1_line_dedup_long(spark, d):
    """The name under which the runs of one or two lines that hold many words first came; as op1_line_dedup."""
    from clientela.llm.winnow import LONG_WORDS, repeated_runs
    return repeated_runs(table(spark, d, "documents"), long_words=LONG_WORDS)


@query
def op8_substring_dedup(spark, d):
    from clientela.llm.chunks import repeated_passages
    return repeated_passages(table(spark, d, "documents"))


@query
def op3_secret_scan(spark, d):
    from clientela.llm.secrets import scan
    return scan(table(spark, d, "documents"))


@query
def op10_benchmark_decontamination(spark, d):
    from clientela.llm.decontaminate import leaks
    return leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))


@query
def op6_quality_classifier(spark, d):
    from clientela.llm.attention import score, train
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    parts = fold(F.col("doc_id"), 5)
    model = train(docs, labels, parts != 0)
    return score(docs, model).select(
        "doc_id", F.coalesce(parts == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op9_quality_rules(spark, d):
    from clientela.llm.crf import judge, train
    docs = table(spark, d, "documents")
    return judge(docs, train(docs, table(spark, d, "labels")))


@query
def op5_bpe_encoding(spark, d):
    from clientela.llm.bpe import encode_digests
    return encode_digests(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op4_toxicity(spark, d):
    from clientela.llm.toxicity import DECISION, score, train
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    parts = fold(F.col("doc_id"), 3)
    model = train(docs, labels, parts != 1)
    return score(docs, model).select(
        "doc_id", F.coalesce(parts == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= DECISION).cast("int").alias("predicted"))


@query
def op2_language_id(spark, d):
    from clientela.llm.langid import identify, learn
    docs = table(spark, d, "documents")
    parts = fold(F.col("doc_id"), 3)
    return identify(docs, learn(docs, parts != 1)).select(
        "doc_id", F.coalesce(parts == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op11_tokenizer_alignment(spark, d):
    from clientela.llm.align import alignment
    path = public_tokenizers.path
    return alignment(table(spark, d, "documents"), path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))


@query
def op12_token_files(spark, d):
    from clientela.llm.tokenfiles import checksums, read_tokens, write_tokens
    folder = stage_path(spark, "op12-tokens")
    write_tokens(table(spark, d, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return checksums(read_tokens(spark, folder))


@query
def op13_hard_negatives(spark, d):
    from clientela.llm.negatives import hard_negatives
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, d, "embeddings").withColumn("label", label)
    return hard_negatives(vectors, vectors.where(F.col("vec_id") % 100 == 0))
