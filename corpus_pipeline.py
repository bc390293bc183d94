"""A corpus pipeline: five stages, each written as Parquet and read again as the next one's documents.

1. language ID: documents without a language (``und``) or with a low score leave;
2. line dedup: lines on too many pages of their source leave their documents;
3. n-gram Jaccard join: of each group of near copies one row stays, of those with the smallest id;
4. benchmark decontamination: documents that hold a benchmark item leave;
5. BPE encoding: ids and decoded text of what is left, with digests of both.

Defined cases: a document without text or letters has no language and leaves in the first stage; one without an
id passes like any other (near copies of it count, the benchmark stage drops it by its text); a null or unknown
``lang`` or ``source`` is kept as it is. Rows that repeat id and text are near copies of each other. Columns other
than those of ``documents`` are left out, whatever their names. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinetrail.llm import decontaminate, jaccard_join, language_id, line_dedup, word_bpe
from kinetrail.llm.common import Scratch, sent, table

#: A document's language needs this mean probability; with L languages, chance is 1 / L.
LEAST_SCORE = 0.3
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = language_id.fit(docs)
    return language_id.predict(docs.select(*COLUMNS), net).where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(docs).withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs.select(*COLUMNS))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go by their texts' hash, as ids may be null or repeat."""
    text = F.xxhash64("text")
    leaks = decontaminate.contaminations(docs.select(text.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark")).select(F.col("doc_id").alias("leak")).distinct()
    leaks = Scratch(spark, "leaks").keep(leaks, "leaks")
    return docs.select(*COLUMNS).join(sent(leaks), text == F.col("leak"), "left_anti")


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return word_bpe.encode(docs, digests=True)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard", near_copy_stage),
    ("decontaminate", benchmark_stage),
    ("bpe", encode_stage),
]
#: The trained network and the shingle join have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"{k}-{name}")
    return docs
