"""From raw documents to packed sequences: quality rules, language identification, near duplicates,
mixing, packing. Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read
again as the next stage's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import language, mixing, ngram_join, packing, quality
from ledgerlens.llm.common import shared_folder, table
from ledgerlens.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality rules", quality_rules), ("language ID", language_id), ("n-gram Jaccard join", near_duplicates),
          ("mixing sources", mix_sources), ("best-fit packing", best_fit_packing)]
ORACLE_SQL = None  # learned rules, language models and tokens have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
