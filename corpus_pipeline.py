"""From raw documents to packed training sequences: language, near copies, personal data, packing.

Every stage reads what its predecessor kept. ``run`` writes each stage's rows as Parquet to the shared folder and reads them
back, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metropulse.llm import language, packing, sanitise
from metropulse.llm.ngram_join import row_components
from metropulse.operators.staging import join_sized, settle, shared_folder

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts whose language is undetermined (null or without letters); the others keep their columns, and a missing
    lang is filled with the prediction. Learned from the labelled fold outside the held-out one."""
    model = language.learn(docs, "text", "lang", ~language.in_fold("doc_id", 5, 0))
    named = language.identify(docs.withColumn("body", F.col("text")), model, "body", keep=COLUMNS)
    kept = named.where(F.col("lang_pred") != language.UNKNOWN)
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked on word shingles the row with the smallest id stays, of one id the text with the smallest hash, and of
    rows equal in both the one with the least columns in order. Rows without id or without words stay, for they link with
    nothing. Rows are known by id and text, so two texts that share an id are judged apart."""
    groups = settle(row_components(docs).where(F.col("component").isNotNull()), "pipeline-groups").df
    row = F.struct("doc_id", "text_hash")
    stays = groups.groupBy("component").agg(F.min(row).alias("first"))
    rows = groups.groupBy("doc_id", "text_hash", "component").agg(F.count("*").alias("rows"))
    told = rows.join(stays, "component")
    fate = F.when(row != F.col("first"), "gone").when(F.col("rows") > 1, "again")
    fates = told.select("doc_id", "text_hash", fate.alias("fate")).where(F.col("fate").isNotNull())
    named = docs.select(*COLUMNS).withColumn("text_hash", F.xxhash64("text"))
    fated = join_sized(named, fates, ["doc_id", "text_hash"], label="pipeline-fates")
    once = fated.where(F.col("fate").isNull()).select(*COLUMNS)
    again = fated.where("fate = 'again'").groupBy("doc_id", "text_hash").agg(F.min(F.struct(*COLUMNS[1:])).alias("r"))
    return once.union(again.select("doc_id", *[F.col(f"r.{c}").alias(c) for c in COLUMNS[1:]]))


def take_out_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and terms that disclose it; n_chars follows the text."""
    clean = sanitise.sanitise(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents in training sequences of several lengths, in words and one end each."""
    return packing.best_fit_pack(docs, packing.word_tokens(F.col("text")))


STAGES = [
    ("language", keep_known_languages),
    ("near_copies", drop_near_copies),
    ("personal_data", take_out_personal_data),
    ("packing", pack_sequences),
]

#: EM, chosen prefixes and packing have no SQL; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
