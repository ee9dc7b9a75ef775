"""Helpers the corpus operators share: scratch tables, per-text UDFs, components.

Row identity.  A table may repeat a ``doc_id`` or hold nulls in it.  Operators
that work row by row keep each row as it is; those that group rows say what a
repeated or null id means.
"""

from __future__ import annotations

import ctypes
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixreg.session import remove_path, scratch_path

_WRITTEN: list[tuple[SparkSession, str]] = []


@contextmanager
def temporary() -> Iterator[None]:
    """Scratch tables written inside this block go at its end, failure or not;
    those written before it, which other results may still read, stay."""
    global _WRITTEN
    before, _WRITTEN = _WRITTEN, []
    try:
        yield
    finally:
        clean_scratch()
        _WRITTEN = before


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table below ``spark.checkpoint.dir``: cuts the
    lineage in shared storage, and later reads take only the columns they use.
    ``clean_scratch`` removes it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _WRITTEN.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs removed now.

    Spark removes them once the driver has collected the plans that refer to
    them, which may take long on a driver with little to do.  The first
    collection clears the caches that hold a plan, the second the plan."""
    for wait in (0.1, 0):
        spark.sparkContext._jvm.System.gc()
        time.sleep(wait)


class Scratch:
    """Tables of one operator in a folder of its own below ``spark.checkpoint.dir``.

    ``write`` cuts the lineage in shared storage.  ``drop`` removes tables as
    soon as nothing reads them any more; the rest stays for the result, which
    is computed later, until ``clean_scratch``.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.base = spark, scratch_path(spark, name)
        _WRITTEN.append((spark, self.base))

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.base}/{name}", compression="zstd")  # texts lie here while others are shuffled
        release_shuffles(self.spark)
        return self.spark.read.schema(df.schema).parquet(f"{self.base}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            remove_path(self.spark, f"{self.base}/{name}")


def clean_scratch() -> None:
    """Remove every scratch table written so far.  Call it once the results
    that were built on them are written."""
    while _WRITTEN:
        remove_path(*_WRITTEN.pop())


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def chunks(texts: list[str], most: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts holding about ``most`` characters (one text at least)."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def hand_back() -> None:
    """Gives freed memory back to the system.  A Python worker outlives its
    task and would keep it, while the next stage shares the executor with it."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def text_udf(make: Callable[[], Callable[[list[str]], dict]], fields: str, most: int = 1_000_000):
    """A Pandas UDF from a text column to a struct of ``fields``.

    ``make`` runs once per task and returns the function that maps a list of
    texts (null: empty) to lists by field.  It gets at most about ``most``
    characters at a time, unless one text is longer.
    """
    schema = T._parse_datatype_string(fields)
    names = schema.names

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of = make()
        for batch in batches:
            texts = ["" if t is None else t for t in batch]
            out: dict[str, list] = {n: [] for n in names}
            for a, b in chunks(texts, most):
                part = of(texts[a:b])
                for n in names:
                    out[n].extend(part[n])
            yield pd.DataFrame(out, columns=names)
            del texts, out, batch
            hand_back()

    return run


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Groups of rows with equal ``keys`` from batches sorted by them."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        same = np.ones(len(batch) - 1, bool)
        for k in keys:
            col = batch[k].to_numpy()
            same &= col[1:] == col[:-1]
        cuts = [0, *(np.flatnonzero(~same) + 1), len(batch)]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.iloc[a:b]
            if held and a == 0 and any(held[-1][k].iloc[-1] != part[k].iloc[0] for k in keys):
                yield pd.concat(held)
                held = []
            held.append(part)
            if b < len(batch):
                yield held[0] if len(held) == 1 else pd.concat(held)
                held = []
    if held:
        yield pd.concat(held)


def connected_components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b): the
    component is the smallest node reachable.

    Alternating stars: every round links each node's larger neighbours to its
    smallest one, then its smaller neighbours.  Minima are taken by a partial
    aggregate, so a node with many links costs a row per map task, and the
    joins leave a hot node to the skew split.  Each round is checkpointed; it
    ends when the edge set no longer changes (a logarithmic number of rounds).
    """
    kind = edges.schema["a"].dataType
    down = (edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
            .where("u <> v").distinct().checkpoint())
    seen = _state(down)
    for _ in range(rounds):
        if seen[0] == 0:
            break
        # Large star: larger neighbours of u go to the smallest of u's neighbourhood.
        both = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: smaller neighbours of u, and u, go to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        down = (large.join(low, "u")
                .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                .select("e.u", "e.v").where("u <> v").distinct().checkpoint())
        now = _state(down)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = down.select(F.col("v").alias("node")).distinct()
    out = down.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
    return out.select(F.col("node").cast(kind), F.col("component").cast(kind))


def _state(edges: DataFrame) -> tuple[int, int]:
    """Number and order-free digest of the edges."""
    got = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    return got["n"], got["h"] or 0


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
