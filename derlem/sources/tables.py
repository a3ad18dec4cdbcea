"""Typed readers of the corpus tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One parquet table of the folder (a file or a directory of files)."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as the session has cores, for work that is heavy per row: a table of one or two
    row groups would keep the other cores idle. Where there are enough partitions, as with any large table, nothing is moved."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def first_content(role: str, messages: str | Column = "messages") -> Column:
    """Content of the first message with that role; null if there is none."""
    col = F.col(messages) if isinstance(messages, str) else messages
    return F.get(F.filter(col, lambda m: m["role"] == role), F.lit(0))["content"]


def has_role(role: str, messages: str | Column = "messages") -> Column:
    col = F.col(messages) if isinstance(messages, str) else messages
    return F.coalesce(F.exists(col, lambda m: m["role"] == role), F.lit(False))
