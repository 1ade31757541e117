"""Reading the input tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame) -> DataFrame:
    """Give a scan at least one partition per core.

    A large table arrives in thousands of file splits and is returned as
    is; only an input with fewer splits than cores (a small file with one
    row group) is round-robin repartitioned, so the row-level stage that
    follows is not run by a single task.  The extra exchange only ever
    applies to inputs of at most a few splits.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    n = df.rdd.getNumPartitions()
    return df.repartition(cores) if n < cores else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))
