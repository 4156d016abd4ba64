"""The corpus pipeline: five stages over ``documents``, each written and read again.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept.
All but the last return the columns of ``docs``, whatever else these hold; names that
clash with what an operator adds do not matter, as columns go by position inside.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelens.llm import exact_dedup, langid, minhash, packing, pii
from wavelens.llm.common import filled, table
from wavelens.llm.registry import ADDED, RANKS
from wavelens.session import scratch_path, stored

def _plain(docs: DataFrame) -> tuple[DataFrame, Callable[[str], Column], list[str]]:
    """``docs`` with columns named by position, and where a column of ``documents`` is."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), lambda name: F.col(names[docs.columns.index(name)]), names


def _chosen(plain: DataFrame, key: Column, kept: DataFrame, names: list[str]) -> DataFrame:
    """One row of ``plain`` per key of ``kept`` (``key``, ``n``: rows that have it).

    Rows that repeat a key are equal in it and its text; one of them is taken by an
    aggregate that each task begins on its own.
    """
    keyed = plain.withColumn("key", key)
    once = keyed.join(kept.filter("n = 1").select("key"), "key", "left_semi").select(names)
    if kept.filter("n > 1").isEmpty():
        return once
    again = keyed.join(kept.filter("n > 1").select("key"), "key", "left_semi")
    one = again.groupBy("key").agg(F.first(F.struct(*names)).alias("row")).select("row.*")
    return once.unionByName(one)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language. Code-switched ones stay, however their words divide.

    Null, empty and letterless texts go. Where no row says its language, there is nothing
    to learn from, and every text with a letter stays. Rows that repeat stay each; a table
    without rows gives none.
    """
    plain, of, names = _plain(docs)
    model = langid.trained(plain.select(of("doc_id").alias("doc_id"), of("text").alias("text"), of("lang").alias("lang")))
    text = names[docs.columns.index("text")]
    if not model.languages:
        return plain.filter(F.col(text).rlike(r"\p{L}")).toDF(*docs.columns)
    found = langid.predict(plain, model, names, text)
    kept = found.filter(F.col("lang_pred") != langid.UNKNOWN)
    return kept.select(names).toDF(*docs.columns)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest ``doc_id`` of each group of equal texts.

    Null counts as empty, a null ``doc_id`` as larger than any other. Rows that repeat a
    ``doc_id`` and text are one document, of which one row stays.
    """
    plain, of, names = _plain(docs)
    rows = exact_dedup.exact_dedup(plain.select(of("doc_id").alias("doc_id"), of("text").alias("text")))
    kept = rows.groupBy(F.struct("doc_id", "text_sha256").alias("key")).agg(
        F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("n")
    ).filter("kept")
    digest = F.sha2(exact_dedup.normalised(of("text")), 256)
    key = F.struct(of("doc_id").alias("doc_id"), digest.alias("text_sha256"))
    return _chosen(plain, key, stored(kept, "kept"), names).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares five-word shingles at 0.8 or more.

    The smallest ``doc_id`` of a group stays, null last. Texts without words, null among
    them, are near to none and stay. Rows that repeat are one document.
    """
    plain, of, names = _plain(docs)
    digest = F.sha2(filled(of("text")), 256)
    key = F.struct(of("doc_id").isNull().alias("unknown"), of("doc_id").alias("doc_id"), digest.alias("digest"))
    rows = minhash.near_dedup(plain.select(key.alias("doc_id"), of("text").alias("text")))
    kept = rows.groupBy(F.col("doc_id").alias("key")).agg(
        F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("n")
    ).filter("kept")
    return _chosen(plain, key, stored(kept, "kept"), names).toDF(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and what discloses it taken out.

    Every row stays, repeated ones too; null and empty texts and those without either are
    unchanged. ``n_chars`` is counted anew, but for null texts.
    """
    out = pii.sanitise(docs)
    if docs.columns.count("n_chars") != 1 or docs.columns.count("text") != 1:
        return out
    counted = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return out.withColumn("n_chars", counted)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token pieces with their places in sequences of 2048.

    A null or empty text is one piece of the closing token alone; rows that repeat are
    packed each; other columns are left behind. A table without rows gives no piece.
    """
    return packing.pack_documents(docs.select("doc_id", "text"), RANKS, public_tokenizers.PATTERN, added=ADDED)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("minhash_near_dedup", near_duplicates),
    ("pii", personal_data),
    ("best_fit_packing", sequences),
]

#: A trained model and near-duplicate candidates have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the stages, one after another, make of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
