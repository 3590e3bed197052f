"""URL filters by host and path prefix, as a sort-merge range join.

A rule (host, path, verdict) fits a URL whose host is the rule's or below it and whose path starts with the rule's path.
Hosts are reversed label by label, so that a host stands before the hosts below it. A canonical key is a reversed host,
a separator and a path; every URL gets one key per ending of its host. The keys that a rule fits are then exactly those
that start with the rule's key: an interval in sorted order, and intervals of rules nest or are disjoint.

Keys of rules and URLs are sorted together by range. A sweep carries the stack of rules that were open at the last rule
passed; at a URL's key the rules that do not start it are closed and the deepest open one is left. Per URL the longest
rule found over all its keys wins. Sorting is by (key, kind, page), so a host with a third of all pages is spread over
as many ranges as it needs; a range starts with the stack that the ranges before it left, which is one small row per
range. Rules are neither broadcast nor copied per URL; a stack holds at most one rule for each prefix of its path.

Null URLs and URLs without ``://`` have an empty host and path. An empty host fits no rule. If no rule fits, the verdict
is the default. Of rules with equal host and path, block wins. Rules with a null host or path are ignored. Pages that
repeat a page_id each get their row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinia.llm.storage import partitions, written

ALLOW, BLOCK = "allow", "block"
# Between reversed host and path: no host or path character sorts before it.
SEPARATOR = "\u0000"
RANGES_PER_PARTITION = 4
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, ASCII_UPPER, ASCII_LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels in reverse, each followed by a dot, so that a host's key starts the keys of the hosts below it."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def host_endings(host: Column) -> Column:
    """The keys of a host and of all hosts above it."""
    labels = F.reverse(F.split(host, r"\."))
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit(".")))


def prepared_rules(rules: DataFrame) -> DataFrame:
    """(key, stack): each rule with the rules that enclose it and itself, shortest key first."""
    known = rules.where("host is not null and path is not null and host != ''").groupBy("host", "path").agg(
        F.when(F.max((F.col("verdict") == BLOCK).cast("int")) == 1, BLOCK).otherwise(ALLOW).alias("verdict")
    )
    keyed = known.select(
        F.concat(host_key(F.col("host")), F.lit(SEPARATOR), "path").alias("key"),
        F.concat("host", "path").alias("rule"),
        "verdict",
        F.col("path"),
        host_key(F.col("host")).alias("head"),
    )
    own = keyed.select("key", F.struct(F.length("key").alias("depth"), F.col("key").alias("start"), "rule", "verdict").alias("open"))
    # A rule is enclosed by the rules whose key is its own, cut somewhere in the path.
    cuts = keyed.select(
        F.col("key").alias("inner"),
        F.explode(F.transform(F.sequence(F.lit(0), F.length("path")), lambda n: F.concat("head", F.lit(SEPARATOR), F.substring(F.col("path"), F.lit(1), n)))).alias("key"),
    )
    stacks = cuts.join(own, "key").groupBy("inner").agg(F.array_sort(F.collect_list("open")).alias("stack"))
    return stacks.withColumnRenamed("inner", "key")


def judge(pages: DataFrame, rules: DataFrame, default: str = ALLOW) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page. ``rules`` has host, path and verdict."""
    spark = pages.sparkSession
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    urls = urls.withColumn("row", F.monotonically_increasing_id())
    keys = urls.where("host != ''").select(
        F.explode(host_endings(F.col("host"))).alias("head"), "path", "row"
    ).select(F.concat("head", F.lit(SEPARATOR), "path").alias("key"), F.lit(1).alias("kind"), "row")
    stacks = prepared_rules(rules)
    empty = F.lit(None).cast(stacks.schema["stack"].dataType)
    events = keys.withColumn("stack", empty).unionByName(
        stacks.select("key", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("row"), "stack")
    )
    # Row numbers and ranges have to stay as they are, so both are written down.
    urls = written(urls)
    ranged = events.repartitionByRange(RANGES_PER_PARTITION * partitions(spark), "key", "kind", "row")
    sorted_ = written(ranged.withColumn("range", F.spark_partition_id()))
    # One row per range that has rules: what is open at its end.
    ends = sorted_.where("kind = 0").groupBy("range").agg(F.max_by("stack", "key").alias("left_open"))
    # One row per range: a number that the session sets, not the data.
    numbers = spark.range(RANGES_PER_PARTITION * partitions(spark)).select(F.col("id").cast("int").alias("range"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = numbers.join(ends, "range", "left").select("range", F.last("left_open", ignorenulls=True).over(before).alias("left_open"))
    sweep = Window.partitionBy("range").orderBy("key", "kind", "row").rowsBetween(Window.unboundedPreceding, 0)
    swept = sorted_.withColumn("here", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    swept = swept.join(F.broadcast(carried), "range", "left").withColumn("stack", F.coalesce("here", "left_open"))
    still_open = F.filter("stack", lambda rule: F.startswith(F.col("key"), rule["start"]))
    found = swept.select("row", F.try_element_at(still_open, F.lit(-1)).alias("rule")).where("rule is not null")
    order = F.struct(F.length("rule.rule"), F.col("rule.depth"), F.col("rule.start"))
    best = found.groupBy("row").agg(F.max_by("rule", order).alias("best"))
    return urls.join(best, "row", "left").select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
