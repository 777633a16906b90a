"""The input tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``name`` of ``sf_dir`` as Parquet."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table that is read in fewer parts than half the cores, spread over all; any larger one as it is.

    Files of one or two row groups can't be read by more tasks, whatever is computed of their rows.
    ``df`` must be a plain scan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 < cores else df
