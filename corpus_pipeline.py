"""A corpus pipeline: quality, near copies, repeated passages, benchmark leaks, packing.

Each stage takes and returns documents (doc_id, text, lang, source, n_chars); the last returns packed pieces.
An empty table gives an empty result in every stage, and other columns than these are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm.decontaminate import contamination
from candela.llm.ngram_join import similar_documents
from candela.llm.packing import pack
from candela.llm.quality import quality
from candela.llm.queries import table, tokenizer_path
from candela.llm.substrings import remove_repeats
from candela.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good.

    A score equal to the threshold is good; null and empty texts get the mean label of the learned rows. Repeated rows are judged alike.
    """
    scored = quality(docs, table(spark, sf_dir, "labels"), carry=("text", "lang", "source", "n_chars"))
    return scored.where("predicted = 1").select(COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies.

    Of rows that share an id, the one with the smallest text hash stays; rows without an id all stay.
    """
    stays = similar_documents(docs.select("doc_id", "text")).where("component_id = doc_id").select("doc_id").distinct()
    rows = docs.select(COLUMNS).join(stays.withColumnRenamed("doc_id", "_stays"), F.col("doc_id") == F.col("_stays"), "left_semi")
    first = rows.selectExpr("*", "row_number() over (partition by doc_id order by xxhash64(text)) as _nth").where("_nth = 1")
    return first.select(COLUMNS).union(docs.where("doc_id is null").select(COLUMNS))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 20-word windows that stand earlier; a text all repeated is left empty.

    Of equal windows the one with the smallest id and then the smallest place stays; rows that share an id do not cut each other. Null texts stay null.
    """
    cut = remove_repeats(docs, carry=("text", "lang", "source", "n_chars"))
    text = F.coalesce("kept", "text")
    size = F.when(F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("n_chars"))
    return cut.select("doc_id", text.alias("text"), "lang", "source", size.alias("n_chars"))


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten-word window with the benchmark.

    Rows that share an id are judged by their own texts; null and empty texts, and rows without an id, stay unless their text is hit.
    """
    tagged = docs.select(COLUMNS).withColumn("_tag", F.xxhash64("text"))
    found = contamination(tagged, table(spark, sf_dir, "benchmark"), carry=("_tag",)).where("n_hit > 0")
    leaks = found.select(F.col("doc_id").alias("_id"), F.col("_tag").alias("_leak")).distinct()
    return tagged.join(leaks, (F.col("_tag") == F.col("_leak")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti").select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 4096 tokens.

    Null and empty texts are one token; rows that share an id, or have none, are documents of their own.
    """
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality", good_quality),
    ("near copies", one_of_each),
    ("repeated passages", without_repeats),
    ("benchmark leaks", without_leaks),
    ("packing", packed),
]

#: The classifier and the packing cannot be said in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
