"""From raw documents to tokens: quality rules, line dedup, near-dedup, benchmark decontamination, byte-level BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackloom.llm import bpe, decontam, linededup, minhash, quality
from trackloom.llm.common import new_path, room
from trackloom.llm.queries import table, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without their failing lines."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them share."""
    kept = linededup.drop_shared_lines(docs)
    made = {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("long")}
    return kept.select(*[made.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the number and digest of their tokens, and the digest of what these decode to."""
    made = bpe.encode_decode(docs, tokenizer_path())
    return made.select("row.*", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("tokens", tokens),
]

#: Near-dedup and byte-level BPE have no SQL; the pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over `documents`; each result is written as Parquet in the shared folder and read again.

    What a stage stored for itself, and the documents that it read, go when its result is written.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with room(spark) as made:
            path = new_path(spark, name)
            stage(spark, docs, sf_dir).write.parquet(path)
            made += [before] * (before is not None)
        docs, before = spark.read.parquet(path), path
    return docs
