"""Bounded samples of labelled documents to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id counts as the text 'null'."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("null")).cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, most: dict[int, int], folds: int = 5) -> DataFrame:
    """(doc_id, text, label) of at most ``most[c]`` rows of each class c outside fold 0.

    Ids are taken in order of their hash, of rows that share an id the one with the smallest text hash. Unlabelled
    rows, other labels and rows without an id are left out; an id with both labels is learned with both.
    """
    usable = labels.select("doc_id", F.col(label).alias("label")).where("doc_id is not null").where(remainder("doc_id", folds) != 0)
    chosen = None
    for value, n in most.items():
        some = usable.where(F.col("label") == value).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        chosen = some if chosen is None else chosen.union(some)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # sum(most) rows at most
    return rows.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("doc_id", "text", "label")
