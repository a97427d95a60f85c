"""Exact deduplication by content-defined chunk recipes.

The normalised text is cut into chunks at positions that depend only on the
characters before them. Chunks are deduplicated to identifiers, the
identifiers are verified against the chunk bytes, and documents are compared
by their ordered identifier lists. A long text crosses the network once, as
distinct chunks; everything after that moves sixteen bytes per chunk.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gildhall.llm._util import stage

#: Deleted before texts are compared.
WHITE_SPACE = " \t\n\x0b\f\r"

#: At least 256 characters, then up to the first place whose last three
#: characters fall in the classes below (about one place in a hundred), at
#: most 4096; what is left at the end of a text is a chunk as well.
CHUNK = r"(?s).{253,4093}?[aeioun][b-dmst][a-eh-i]|.{1,4096}"

MAX_SALTS = 8


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def chunk_id(chunk: Column, salt: int) -> Column:
    """128 bits per chunk, not trusted before :func:`collisions` is empty."""
    return F.struct(F.xxhash64(F.lit(2 * salt), chunk).alias("a"), F.xxhash64(F.lit(2 * salt + 1), chunk).alias("b"))


def chunks(norm: Column) -> Column:
    return F.regexp_extract_all(norm, F.lit(CHUNK), F.lit(0))


def collisions(docs: DataFrame, text_col: str, salt: int) -> DataFrame:
    """Identifiers that two different chunks share.

    Chunks are deduplicated map-side by their whole text, so a passage that a
    third of the documents share is shuffled once per task.
    """
    distinct = (docs.select(F.explode(chunks(normalised(F.col(text_col)))).alias("chunk"))
                .select(chunk_id(F.col("chunk"), salt).alias("id"), "chunk").distinct())
    return distinct.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def recipes(docs: DataFrame, id_col: str, text_col: str, salt: int) -> DataFrame:
    """One row per input row: ordered chunk identifiers, length, digest and a fixed row number."""
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.length(F.coalesce(F.col(text_col), F.lit(""))).alias("n_chars"),
                        normalised(F.col(text_col)).alias("norm"))
            .select("doc_id", "n_chars",
                    F.transform(chunks(F.col("norm")), lambda c: chunk_id(c, salt)).alias("recipe"),
                    F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
                    F.monotonically_increasing_id().alias("row_id")))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group the rows of ``docs`` whose texts are equal after white space is deleted.

    Returns one row per input row: ``doc_id``, ``keep_id`` (id of the row that
    stays), ``group_size``, ``kept`` and ``text_sha256`` of the normalised text.
    The row with the most code points in its original text stays, then the
    smallest id; a null id comes after every other id, and of rows that repeat
    both, exactly one stays. A null text counts as empty; all texts without
    any other character than white space form one group. An empty table gives
    an empty result. Other columns are ignored.

    Identifiers are verified, not assumed: should two different chunks share
    one, the whole step is repeated with another salt.
    """
    for salt in range(MAX_SALTS):
        if collisions(docs, text_col, salt).isEmpty():
            break
    else:
        raise RuntimeError("chunk identifiers collided under every salt")
    rows = stage(recipes(docs, id_col, text_col, salt))
    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id"))
    # staged, so that the join below is one whose large partitions Spark can split: a group may hold a third of the rows
    groups = stage(rows.groupBy("recipe").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
                   .select("recipe", F.col("best.doc_id").alias("keep_id"), F.col("best.row_id").alias("keep_row"),
                           "group_size"))
    return (rows.join(groups, "recipe")
            .select("doc_id", "keep_id", "group_size", (F.col("row_id") == F.col("keep_row")).alias("kept"),
                    "text_sha256"))
