"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept, as a table written to Parquet and
read back, and calls one operator of ``gildhall.llm``. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gildhall.llm import lang_id
from gildhall.llm._util import documents, held_out, scratch, stage
from gildhall.llm.exact_dedup import exact_duplicates, normalised
from gildhall.llm.packing import pack_documents
from gildhall.llm.simhash_dedup import near_duplicates
from gildhall.llm.substring_dedup import remove_earlier
from gildhall.operators.sequence import ordinal
from gildhall.session import checkpoint_dir

#: No stage can be told in SQL as a whole: the first is a fitted classifier. Tested against a brute-force version.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and long ones that resemble none of the languages; so do rows without an id.

    Learns from this stage's own input, where it has a language and the id is
    not held out; how little a text may resemble a language is read off the
    texts learned from. Where nothing can be learned, only texts without a letter
    go. An empty table stays empty, repeated rows are judged alike. A row
    without an id could be named by no later stage.
    """
    docs = docs.where("doc_id IS NOT NULL")
    model = lang_id.fit(docs, ~held_out(F.col("doc_id"), 4, 2))
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return lang_id.accepted(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space the row decided on stays; rows that repeat an id stay where their texts differ."""
    kept = exact_duplicates(docs).where("kept").select("doc_id", "text_sha256")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id"), F.sha2(normalised(F.col("text")).cast("binary"), 256).alias("text_sha256"))
    # rows that repeat an id and a text: the one with the most code points, as exact_duplicates chooses
    first = Window.partitionBy("doc_id", "text_sha256").orderBy(
        F.length(F.coalesce("row.text", F.lit(""))).desc(), "row.text", F.xxhash64("row"))
    return (rows.join(kept, ["doc_id", "text_sha256"], "left_semi").withColumn("place", F.row_number().over(first))
            .where("place = 1").select("row.*"))


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``key``, in the order of the ids: the id, or numbers of (id, text) where rows repeat an id."""
    if docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        return docs.withColumn("key", F.col("doc_id"))
    texts = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    keys = stage(ordinal(texts.select("doc_id", "text_sha256").distinct(), [], ["doc_id", "text_sha256"], name="key"))
    return stage(texts.join(keys, ["doc_id", "text_sha256"]).select(*docs.columns, "key"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group the document with the smallest id stays."""
    rows = keyed(docs)
    kept = near_duplicates(rows, "key").where("doc_id = component_id").select(F.col("doc_id").alias("key"))
    return rows.join(kept, "key", "left_semi").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that an earlier document's windows cover go, and documents that lose all of theirs."""
    rows = keyed(docs)
    cut = (remove_earlier(rows, "key").where("n_removed = 0 OR n_removed < n_words")
           .select(F.col("doc_id").alias("key"), "kept_text"))
    rest = rows.drop("text", "n_chars").join(cut, "key").withColumnRenamed("kept_text", "text")
    return rest.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, cut and packed into sequences of 1024 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage staged goes once its result is written."""
    docs = documents(spark, sf_dir)
    for _, step in STAGES[:-1]:
        path = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
        with scratch(spark):
            step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
