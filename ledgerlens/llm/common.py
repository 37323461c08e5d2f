"""Helpers shared by the operators: tables, the shared scratch folder, word expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import ensure_checkpoint_dir

#: white space of all word definitions: blank and U+0009 to U+000D
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder that all executors share (``spark.checkpoint.dir``)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint: the rows are computed once."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def words(text: Column) -> Column:
    """Array of the words of ``text`` (empty for null or blank texts)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def row_key(doc_id: Column, text: Column) -> Column:
    """64-bit hash of a row's id and text, never null."""
    return F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("\x00")), F.coalesce(text, F.lit("\x00")))


def keep_keys(docs: DataFrame, keys: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows of ``docs`` whose ``row_key`` is in the one column of ``keys``: one exchange of the rows."""
    keys = keys.toDF("wanted").distinct()
    rows = docs.select(F.struct("*").alias("row"), row_key(F.col(doc_id), F.col(text)).alias("own"))
    return rows.join(keys, F.col("own") == F.col("wanted"), "left_semi").select("row.*")
