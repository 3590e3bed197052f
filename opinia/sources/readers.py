"""Readers. Schemas are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinia.operators.materialize import materialize

LABELLED = T.StructType([T.StructField("text", T.StringType()), T.StructField("class", T.StringType())])
UNLABELLED = T.StructType([T.StructField("text", T.StringType())])


CSV_OPTIONS = {"sep": ",", "quote": '"', "escape": '"'}


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, raw): the records of comma-separated files, numbered from 0 in each file, header included.

    A quoted field may hold line breaks, so whether a line ends a record depends on all quotes before it in its file. Files
    are read by many tasks all the same: each block of a file counts the quotes of its lines, a prefix sum over the blocks,
    one row each, says whether a block begins inside quotes, and every block goes on from there on its own. Only records of
    several lines are put together by a shuffle. Blank lines between records do not count.
    """
    block = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    lines = spark.read.text(path).select("value", *block, F.monotonically_increasing_id().alias("at"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    # Running numbers depend on how Spark packs blocks into tasks, so they are written out.
    lines = materialize(lines.withColumn("quotes", quotes))
    # One row per block of a file.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("file", "block").orderBy("at")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    parity = lines.groupBy("file", "block").agg(F.sum("quotes").alias("n"))
    parity = parity.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("carried"))
    seen = F.col("carried") + F.coalesce(F.sum("quotes").over(earlier), F.lit(0))
    lines = lines.join(parity, ["file", "block"]).withColumn("open", seen % 2 == 1)
    lines = lines.withColumn("ends", F.col("open") == (F.col("quotes") % 2 == 1))
    lines = materialize(lines.where(F.col("open") | (F.trim(F.regexp_replace("value", "\r$", "")) != "")).select("file", "block", "at", "value", "open", "ends"))
    ended = lines.groupBy("file", "block").agg(F.count_if("ends").alias("n"))
    ended = ended.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("passed"))
    number = F.col("passed") + F.coalesce(F.sum(F.col("ends").cast("long")).over(earlier), F.lit(0))
    lines = lines.join(ended, ["file", "block"]).withColumn("record", number)
    alone = lines.where("not open and ends").select("file", "record", F.col("value").alias("raw"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "value"))), lambda x: x["value"])
    several = lines.where("open or not ends").groupBy("file", "record").agg(F.array_join(parts, "\n").alias("raw"))
    return alone.unionByName(several).withColumn("raw", F.regexp_replace("raw", "\r$", ""))


def read_reviews_csv(spark: SparkSession, path: str, schema: T.StructType = LABELLED) -> DataFrame:
    """Comma-separated UTF-8 files with a header row; columns are found by name. A missing ``doc_id`` is added: 0..n-1 by file
    name and place in the file. All files have the columns of the first one."""
    header = spark.read.options(header=True, encoding="UTF-8", multiLine=True, **CSV_OPTIONS).csv(path).columns
    wanted = [f.name for f in schema.fields]
    missing = [name for name in wanted if name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    # All columns as text, in file order: a schema is matched by position, not by name.
    full = ", ".join(f"`{name}` string" for name in header)
    records = materialize(csv_records(spark, path))
    rows = records.where("record > 0").select("file", "record", F.from_csv("raw", full, CSV_OPTIONS).alias("row"))
    fields = [F.col(f"row.`{name}`").alias(name) for name in wanted]
    if "doc_id" in header:
        return rows.select(*fields, F.col("row.doc_id").cast("long").alias("doc_id"))
    # One row per file: records less the header.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = records.groupBy("file").agg(F.max("record").alias("n"))
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.join(files, "file").select(*fields, (F.col("start") + F.col("record") - 1).alias("doc_id"))


def read_development_csv(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, text, class."""
    return read_reviews_csv(spark, path, LABELLED)


def read_evaluation_csv(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, text; a label column, if any, is not read."""
    return read_reviews_csv(spark, path, UNLABELLED)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """Scans with fewer splits than there are cores are dealt out once; large scans are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """All texts: doc_id, text."""
    return spread(table(spark, folder, "documents").select("doc_id", "text"))


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """The development set: doc_id, text, class."""
    quality = table(spark, folder, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "pos").otherwise("neg").alias("class")
    )
    return corpus(spark, folder).join(quality, "doc_id")


def unlabelled(spark: SparkSession, folder: str) -> DataFrame:
    """The evaluation set: texts that have no label."""
    return corpus(spark, folder).join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_anti")
