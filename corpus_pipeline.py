"""The corpus pipeline: quality, repeated lines, near duplicates, test passages, token ids.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a
DataFrame, and its rows, written and read again, are the next one's ``docs``. All stages but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortlist.llm import decontaminate, line_dedup, near_dup, quality, sentencepiece_codec
from shortlist.llm.queries import PIECE_MODEL, table
from shortlist.llm.rows import pack, unpack
from shortlist.session import configure, durable

#: the stages hold trained numbers and 64-bit hashes that SQL cannot state; the tests compare them with brute force
ORACLE_SQL = None

#: documents are linked at five words and a similarity of 0.8
NEAR = near_dup.Rule(shingle=5, percent=80)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    configure(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them; n_chars follows the text."""
    configure(spark)
    cut = line_dedup.drop_repeated_lines(pack(docs, "doc_id", "text"))
    cut = unpack(cut, docs.columns, ("doc_id", "text"))
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    configure(spark)
    return near_dup.keep_one_of_each(docs, NEAR)


def without_test_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a test item go."""
    configure(spark)
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids and whether the ids decode to the text."""
    configure(spark)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = sentencepiece_codec.decode(sentencepiece_codec.encode(texts, PIECE_MODEL), PIECE_MODEL)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", (F.col("decoded") == F.col("text")).alias("round_trip"))


STAGES = [
    ("quality", good_quality),
    ("line_dedup", without_repeated_lines),
    ("near_dedup", one_of_each),
    ("decontamination", without_test_passages),
    ("sentencepiece", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written before the next one reads it."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
