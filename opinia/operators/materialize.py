"""Cutting lineage in a place that outlives executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Has Spark delete the shuffle files of a query as it ends, not when the driver happens to collect its garbage.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# The tables written since the innermost ``passing_tables`` began.
_passing: ContextVar[list[DataFrame] | None] = ContextVar("passing", default=None)


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. One of our own is only made up on a single machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


# Row groups of this size, and a look at the size after every few rows, bound what a task holds of rows with long arrays.
TABLE_OPTIONS = {
    "compression": "zstd",
    "parquet.block.size": 32 << 20,
    "parquet.page.size.row.check.min": 1,
    "parquet.block.size.row.check.min": 1,
}


def materialize(df: DataFrame) -> DataFrame:
    """Write the rows to the checkpoint folder and go on from there, so that later passes do not redo the work.

    Parquet rather than ``checkpoint()``, which computes everything twice, once to count and once to write, and writes rows
    as they lie in memory. What was shuffled for them goes as soon as they are written.
    """
    spark = df.sparkSession
    path, cleaned = f"{checkpoint_folder(spark)}/table-{uuid.uuid4().hex}", spark.conf.get(CLEANED)
    spark.conf.set(CLEANED, "true")
    try:
        df.write.options(**TABLE_OPTIONS).parquet(path)
    finally:
        spark.conf.set(CLEANED, cleaned)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    if (passing := _passing.get()) is not None:
        passing.append(table)
    return table


def drop(*tables: DataFrame | None) -> None:
    """Deletes materialized tables that nothing reads any more; other frames are left alone."""
    for table in tables:
        place = getattr(table, "_written_to", None)
        if place is not None:
            path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def passing_tables() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """All tables materialized inside go at the end, but those given to the function that this yields: for work whose results
    do not read them, such as numbers on the driver."""
    written: list[DataFrame] = []
    kept: list[DataFrame] = []
    outer = _passing.get()
    before = _passing.set(written)

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table)
        return table

    try:
        yield keep
    finally:
        _passing.reset(before)
        drop(*[t for t in written if not any(t is k for k in kept)])
        if outer is not None:
            outer += kept


def shrink_partitions(df: DataFrame, rows_each: int) -> DataFrame:
    """For iterative jobs on small tables: no more partitions than rows make worthwhile. ``df`` is cheap to count."""
    wanted = -(-max(df.count(), 1) // rows_each)
    return df.coalesce(wanted) if wanted < df.rdd.getNumPartitions() else df
