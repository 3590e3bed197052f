"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinia.operators.materialize import checkpoint_folder


def written(df: DataFrame) -> DataFrame:
    """The rows as a parquet table in the session's checkpoint folder: compressed, complete and safe from lost executors."""
    path = f"{checkpoint_folder(df.sparkSession)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """One side of a join that both sides are shuffled for, never broadcast: compressed files, copied rows and Python steps let
    Spark size a table of millions of rows at a few megabytes."""
    return df.hint("merge")


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which a user sets to fit the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/pages.parquet")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct ``_row``, so that no name of theirs meets a name of an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
