"""Parquet tables (S8), and an explicit spread for scans that Spark cannot split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition only when ``df`` has fewer partitions than
    ``min_partitions`` (default: the context's default parallelism)."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    have = df.rdd.getNumPartitions()  # planning only, no job
    return df.repartition(want) if have < want else df


def read_table(spark: SparkSession, path: str, *, min_partitions: int | None = None) -> DataFrame:
    """Read Parquet; with ``min_partitions``, spread a scan that arrives in
    fewer partitions (a file with one large row group)."""
    df = spark.read.parquet(path)
    return spread(df, min_partitions) if min_partitions else df
