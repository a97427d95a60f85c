"""Shared pieces of the operators: input shaping, staging tables, bounds."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gildhall.session import checkpoint_dir


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads; a null text counts as empty.

    Every other column is pruned here, so clashing names cannot matter.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text falls on the held-out remainder (null id: not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


_used: ContextVar[list | None] = ContextVar("staged tables and broadcasts of this scope", default=None)


def stage(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs the running tasks, never the
    Python or text work above. Values that are not stable under recomputation
    (row numbers, batch numbers) are fixed by it. The folder is the one named
    by ``spark.checkpoint.dir``; a table stays there until its :func:`scratch`
    scope ends, or the folder is cleared.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    if _used.get() is not None:
        _used.get().append(path)
    return spark.read.schema(df.schema).parquet(path)


def share(spark: SparkSession, value) -> Broadcast:
    """A broadcast that the enclosing :func:`scratch` scope takes back from all executors at its end."""
    held = spark.sparkContext.broadcast(value)
    if _used.get() is not None:
        _used.get().append(held)
    return held


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged and values shared within go at the end, so what they feed must be written by then."""
    used: list = []
    token = _used.set(used)
    try:
        yield
    finally:
        _used.reset(token)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for x in used:
            if isinstance(x, str):
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(x)
                path.getFileSystem(conf).delete(path, True)
            else:
                x.destroy()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


_SPACE = re.compile(rb"[ \t-\r]")


def word_blocks(data: bytes, block: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of ``data`` in lists of about a megabyte, so a long text is never a list at once."""
    at, n = 0, len(data)
    while at < n:
        to = min(n, at + block)
        if to < n:
            m = _SPACE.search(data, to)
            to = m.start() if m else n
        yield data[at:to].split()
        at = to


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python once for each application, wherever the driver imported it from."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="gildhall-py-")
    path = os.path.join(folder, f"gildhall-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


_worker_caches: list[dict] = []
_served: list[str] = []


def worker_cache(cache: dict) -> dict:
    """Register a module's cache: a worker empties it when a task of another operator begins."""
    _worker_caches.append(cache)
    return cache


def _begin(operator: str) -> None:
    if _served != [operator]:
        _served[:] = [operator]
        for cache in _worker_caches:
            cache.clear()


def _end() -> None:
    """Hand freed memory back: workers are reused, and what one operator needed at its peak would stay with them."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not glibc


def map_arrow(df: DataFrame, fn, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers, which give memory back between tasks."""
    ship(df.sparkSession)
    operator = f"{fn.__module__}.{fn.__qualname__}"

    def task(batches):
        _begin(operator)
        try:
            yield from fn(batches)
        finally:
            _end()

    return df.mapInArrow(task, schema)
