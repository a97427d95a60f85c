"""Tables bucketed by a key, so that joins on it shuffle neither side (JON-3, JON-5).

A fact that resolves several surrogate keys by one natural key is written once
in hash buckets of that key, its lookups in the same buckets; each lookup is
then a merge of sorted buckets. A key that holds more rows than a bucket should,
and rows without a key, are kept beside the buckets: there are fewer of such
keys than buckets, so what the lookups hold for them may be broadcast.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gildhall.operators.joins import resolve_sk
from gildhall.sources.sinks import _exists, _fs, _join

#: A key with fewer rows than this never counts as hot.
HOT_ROWS = 1 << 16


@dataclass(frozen=True)
class Bucketed:
    """A table written by ``write_bucketed``: ``rows`` in buckets, ``hot`` those of hot keys and without a key."""

    key: str
    buckets: int
    rows: DataFrame
    hot: DataFrame
    hot_keys: tuple

    def all(self) -> DataFrame:
        return self.rows.unionByName(self.hot)


@dataclass(frozen=True)
class Lookup:
    """One key to resolve through ``table``: arguments as those of ``resolve_sk``."""

    table: Bucketed
    sk: str
    out: str | None = None
    missing: int | None = -1
    current_flag: str | None = "is_current_flag"
    carry: Mapping[str, str] | None = None


def _quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def _sorted_buckets(df: DataFrame, path: str, key: str, buckets: int) -> None:
    # one task a bucket, so one file a bucket, and each is sorted
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(f"gildhall_w_{uuid.uuid4().hex}"))


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, hot_rows: int = HOT_ROWS) -> Bucketed:
    """Write ``df`` to the new folder ``path`` in ``buckets`` buckets of ``key`` and open it.

    ``df`` is computed once. A key is hot if it has over ``hot_rows`` rows and
    more than a bucket's even share; fewer than ``buckets`` keys can. The
    description of the table is written last: a folder without one is an
    unfinished write and can't be opened. An empty ``df`` gives an empty table.
    """
    spark = df.sparkSession
    if _exists(spark, path):
        raise FileExistsError(path)
    seen, staged = Observation(), _join(path, "staged")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(staged)
    rows = spark.read.schema(df.schema).parquet(staged)
    most = max(hot_rows, seen.get["n"] // buckets)
    hot = [r[0] for r in rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") > most).select(key).collect()]
    beside = F.col(key).isNull() | _among(key, hot)
    rows.where(beside).write.parquet(_join(path, "hot"))
    _sorted_buckets(rows.where(~beside), _join(path, "rows"), key, buckets)
    fs, p = _fs(spark, staged)
    fs.delete(p, True)
    out = {"key": key, "buckets": buckets, "schema": df.schema.json()}
    fs, p = _fs(spark, _join(path, "table.json"))
    stream = fs.create(p, False)
    try:
        stream.write(bytearray(json.dumps(out).encode()))
    finally:
        stream.close()
    return open_bucketed(spark, path)


def _among(key: str, values: Sequence) -> Column:
    return F.col(key).isin(*values) if values else F.lit(False)


def open_bucketed(spark: SparkSession, path: str) -> Bucketed:
    """Open a table of ``write_bucketed``, also one that another session wrote."""
    if not _exists(spark, _join(path, "table.json")):
        raise FileNotFoundError(_join(path, "table.json"))
    spec = json.loads("\n".join(r[0] for r in spark.read.text(_join(path, "table.json")).collect()))
    schema = T.StructType.fromJson(json.loads(spec["schema"]))
    key, buckets = spec["key"], spec["buckets"]
    name = f"gildhall_r_{uuid.uuid4().hex}"
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({_quoted(key)}) SORTED BY ({_quoted(key)}) "
              f"INTO {buckets} BUCKETS LOCATION '{_join(path, 'rows')}'")
    hot = spark.read.schema(schema).parquet(_join(path, "hot"))
    keys = tuple(r[0] for r in hot.where(F.col(key).isNotNull()).select(key).distinct().collect())
    return Bucketed(key, buckets, spark.table(name), hot, keys)


def resolve_bucketed(fact: Bucketed, lookups: Sequence[Lookup]) -> DataFrame:
    """Resolve every lookup by the fact's bucket key; the rows of ``fact`` stay as many as they are.

    Rows in buckets are merged with the lookups' buckets without a shuffle;
    rows of hot keys meet a broadcast of the lookups' rows for those keys, of
    which there are fewer than buckets (a current key with two rows fails the
    job, as in ``resolve_sk``). A row without a key, or whose key is unknown,
    gets the lookup's ``missing``.
    """
    for u in lookups:
        if u.table.buckets != fact.buckets:
            raise ValueError(f"{u.sk}: {u.table.buckets} buckets, the fact has {fact.buckets}")

    def chain(rows: DataFrame, side) -> DataFrame:
        for u in lookups:
            rows = resolve_sk(rows, side(u.table), {fact.key: u.table.key}, u.sk, out=u.out, missing=u.missing,
                              current_flag=u.current_flag, carry=u.carry)
        return rows

    def in_buckets(t: Bucketed) -> DataFrame:
        if t.hot_keys:  # a lookup's hot keys are long histories; its current row for them is one row a key
            raise ValueError(f"{t.key}: write the current rows of a lookup, not its history")
        return t.rows

    cold = chain(fact.rows, in_buckets)
    return cold.unionByName(chain(fact.hot, lambda t: F.broadcast(t.rows.where(_among(t.key, fact.hot_keys)))))
