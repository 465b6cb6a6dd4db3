"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spread(df: DataFrame) -> DataFrame:
    """Spread the rows of a scan over all cores if its files give fewer splits than there are
    cores; a scan with enough splits stays as it is. A text of a few kilobytes costs far more to
    tokenise than to move, so one small file would otherwise keep one core busy.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_table(
    spark: SparkSession, folder: str, name: str, *columns: str, where: str | None = None
) -> DataFrame:
    """The columns of ``folder/name.parquet``, filtered at the scan."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    if where is not None:
        df = df.filter(F.expr(where))
    return df.select(*columns) if columns else df
