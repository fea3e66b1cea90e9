"""Corpus pipeline: language, near-duplicates, benchmark passages, mixing, token files.

Every stage takes ``(spark, docs, sf_dir)``, works on all documents that the stage
before kept, and returns the columns of ``documents``; the last one returns one row per
document written. Document keys are taken to name documents: rows that share one stay or
go together, except that of rows equal in key and text one stays. Rows with a NULL key are
removed as exact copies only. NULL and empty texts have no language and go first; an empty
table stays empty. Further columns of the given table are kept, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantelle.llm import decontaminate, language, mixing, near_dup, token_files
from quantelle.llm.common import checked, free_name, read_table, scratch, ship, stash, without

TOKENIZER = "byte_bpe_50k.json"
#: Rows and bytes that go to a Python worker at once; texts are long, so fewer than Spark's defaults.
BATCH_ROWS, BATCH_BYTES = "2000", "1m"


def _as_given(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents without a letter, and those whose text is far from all languages of
    the labelled documents: its shortest code is 1.5 times as long as usual there."""
    _small_batches(spark)
    ship(spark)
    narrow = docs.select("doc_id", "lang", "text")
    model = spark.sparkContext.broadcast(language.train(narrow))
    return docs.where(language.familiar(F.col("text"), model, language.bits_per_byte(narrow, model)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest document of each group of near-duplicates."""
    _small_batches(spark)
    kept = without(docs, near_dup.near_duplicates(docs.select("doc_id", "text")).where("not kept").select("doc_id"))
    name = free_name(docs, "again")
    again = stash(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1).select(F.col("doc_id").alias(name)), "again")
    if again.isEmpty():
        return kept
    shared = F.col("doc_id").eqNullSafe(F.col(name))
    single = kept.join(again, shared, "left_anti")
    return _as_given(single.unionByName(kept.join(again, shared, "left_semi").dropDuplicates(["doc_id", "text"])), docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove documents that hold a benchmark item."""
    _small_batches(spark)
    return without(docs, decontaminate.contaminated(docs.select("doc_id", "text"), read_table(spark, sf_dir, "benchmark")).select("doc_id"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out whole documents so that sources come to their target weights."""
    key, times = free_name(docs, "mixed_id"), free_name(docs, "copies")
    mixed = mixing.copies(mixing.mix(docs.select("doc_id", "source", "text"))).groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").alias(times))
    joined = docs.join(checked(stash(mixed, "copies")), F.col("doc_id").eqNullSafe(F.col(key))).where(F.col(times) > 0)
    copy = free_name(docs, "copy")
    return _as_given(joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))), docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back: ``(doc_id, start, n_tokens, ids_crc32)``."""
    _small_batches(spark)
    manifest = token_files.write_token_files(docs, scratch(spark, "tokens"), public_tokenizers.path(TOKENIZER))
    return token_files.read_token_files(spark, manifest)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
    ("token_files", write_tokens),
]

ORACLE_SQL = None  # model, similarity join and tokenizer cannot be said in SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each written as Parquet before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
