"""Shared inputs: awkward documents, and plain versions to compare with."""

import re

from pyspark.sql import functions as F

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, words string, spans string, row_id string, fp string, key string"


def make(spark, texts, start=1):
    """Documents with further columns whose names clash with the operators' own."""
    rows = [(i, t, "en", "s", len(t or ""), "x", "x", "x", "x", "x", "x") for i, t in enumerate(texts, start)]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
AWKWARD = [None, "", "   \t\n", "one", "one", " one ", "two words", "a b c", "a b c d", "A B C D", "é ñ 日本語 👍🏽", "x" * 5000, "1 2 3 !!", LONG, LONG + " end",
           "same same same same same same same same", "tab\tand\x0bvt\x0cff\r\n", "nbsp stays  here"]


def with_repeats(spark, texts):
    """The documents, one of them twice as a row, and two rows without an id."""
    docs = make(spark, texts)
    return docs.union(docs.where("doc_id = 7")).union(docs.where("doc_id IN (5, 8)").withColumn("doc_id", F.lit(None).cast("long")))


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
