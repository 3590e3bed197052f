"""Running totals and dense numbering over a whole table or over very large groups.

A plain window over one group runs in one task. Here rows are split into ordered buckets first, each bucket is
numbered on its own, and the totals of the buckets before it are added: no task ever sees more than a bucket.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 10_000
# Rows one bucket should hold at most; small tables get by with few buckets.
ROWS_PER_BUCKET = 100_000


def ordered_buckets(df: DataFrame, order: str, output: str = "_bucket", buckets: int | None = None) -> DataFrame:
    """Add a bucket number that grows with the numeric column ``order``; cut points come from its quantiles."""
    if buckets is None:
        buckets = min(BUCKETS, 1 + df.count() // ROWS_PER_BUCKET)
    if buckets <= 1:
        return df.withColumn(output, F.lit(0.0))
    cuts = df.approxQuantile(order, [i / buckets for i in range(1, buckets)], 0.25 / buckets)
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) < 3:
        return df.withColumn(output, F.lit(0.0))
    numbered = df.withColumn("_order", F.col(order).cast("double"))
    return Bucketizer(splits=splits, inputCol="_order", outputCol=output).transform(numbered).drop("_order")


def hash_buckets(df: DataFrame, key: str, output: str = "_bucket", buckets: int = BUCKETS) -> DataFrame:
    """Add a bucket number from a hash: for numbering where any fixed order will do."""
    return df.withColumn(output, F.pmod(F.xxhash64(key), F.lit(buckets)))


def running_total(
    df: DataFrame,
    order: list[str],
    output: str,
    value: Column | None = None,
    by: list[str] | None = None,
    bucket: str = "_bucket",
) -> DataFrame:
    """Exclusive running total of ``value`` (default 1, i.e. a number from 0) in each group, ordered by
    (bucket, *order). The bucket column must be there already and is dropped."""
    by = by or []
    value = F.lit(1) if value is None else value
    cells = df.groupBy(*by, bucket).agg(F.sum(value).alias("_cell"))
    # One row per group and bucket: the only part that is windowed per group.
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(*by, bucket, F.coalesce(F.sum("_cell").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*by, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return local.join(offsets, [*by, bucket]).withColumn(output, F.col("_local") + F.col("_offset")).drop(
        "_local", "_offset", bucket
    )
