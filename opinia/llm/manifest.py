"""Merkle manifest of a dataset: a tree per language with a fanout of eight, and a proof for every row.

A row's leaf is a SHA-256 over its fields. The leaves of a language stand in the order of doc_id; runs of eight nodes
become one until one is left, the language's subroot, and the subroots become the root in the same way.

Every language's leaves are numbered and dealt into aligned groups of ``8^CHUNK_LEVELS`` neighbours, which are rows of
one table from then on and build their own subtrees. The groups then find the rest by butterfly exchange: in round r
the eight groups whose numbers differ in nothing but octal digit r swap their subtree roots, and each of them hashes the
parent for itself. After as many rounds as the tree has levels above the groups, each group holds the root and all
siblings on its way, and no pass leads down again. Where the last subtree of a level is not full, its groups stand in
for the missing partners. The languages' subroots swap in the same way. Whatever the data, a task meets eight nodes or
one group of leaves at a time.

Rows that repeat a doc_id stand in the order of their leaves; rows without one come first and are never tampered with;
a missing language is a tree of its own, the first. Null fields are hashed as ``-``, so null and empty differ. Other
columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinia.llm.storage import partitions, written

# Bits of the fanout: runs of 8.
BITS = 3
FANOUT = 1 << BITS
# Levels that a group of leaves builds on its own: 512 leaves.
CHUNK_LEVELS = 3
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PATH = "array<struct<before: string, after: string>>"


def leaf_hash(columns: list[Column]) -> Column:
    """SHA-256 over fields written as ``-`` or byte count, colon, value."""

    def field(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(field, columns)), 256)


def depth(n: Column) -> Column:
    """Levels above n leaves: the smallest power of the fanout that reaches n."""
    found = F.lit(0)
    # 8^20 is the last power within a long.
    for level in range(21):
        found = F.when(n > 1 << (BITS * level), level + 1).otherwise(found)
    return found


def _parents(nodes: Column) -> Column:
    """The level above an array of nodes."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FANOUT).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * FANOUT + 1, FANOUT), ""), 256))


def numbered(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Add ``at``, a row's place from 0 in its group, and ``n``, the group's size, for groups and orders of any kind.

    Rows are sorted into ranges over all groups, so that a group spreads over as many tasks as its size asks for.
    """
    ranged = written(rows.repartitionByRange(partitions(rows.sparkSession), *by, *order).withColumn("_range", F.spark_partition_id()))
    cells = ranged.groupBy(*by, "_range").agg(F.count("*").alias("_cell"))
    whole = Window.partitionBy(*by)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per group and range.
    offsets = cells.select(*by, "_range", F.coalesce(F.sum("_cell").over(before), F.lit(0)).alias("_offset"), F.sum("_cell").over(whole).alias("n"))
    inside = F.row_number().over(Window.partitionBy(*by, "_range").orderBy(*order)) - 1
    placed = ranged.withColumn("_inside", inside).join(offsets, [*by, "_range"])
    return placed.withColumn("at", F.col("_offset") + F.col("_inside")).drop("_range", "_inside", "_offset")


def chunks(leaves: DataFrame) -> DataFrame:
    """(tree, chunk, n, levels, leaves, l0, l1, l2, node): groups of 512 neighbouring leaves with their inner levels.

    ``leaves`` holds tree, at, n, leaf and row, a struct that goes along.
    """
    grouped = leaves.groupBy("tree", F.shiftright("at", BITS * CHUNK_LEVELS).alias("chunk")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", "leaf", "row"))).alias("leaves")
    )
    grouped = grouped.select("*", depth(F.col("n")).alias("levels"), F.col("leaves.leaf").alias("l0"))
    for k in range(CHUNK_LEVELS):
        grouped = grouped.withColumn(f"l{k + 1}", F.when(F.col("levels") > k, _parents(F.col(f"l{k}"))).otherwise(F.col(f"l{k}")))
    return grouped.withColumn("node", F.element_at(f"l{CHUNK_LEVELS}", 1)).drop(f"l{CHUNK_LEVELS}")


def butterfly(nodes: DataFrame, rounds: int) -> DataFrame:
    """(tree, chunk, node, path): the root and the siblings on the way to it, for every one of ``nodes``.

    ``nodes`` holds tree, chunk (0 to count - 1 in each tree), count, rounds (levels of this tree) and node.
    """
    state = nodes.withColumn("path", F.array().cast(PATH))
    for r in range(rounds):
        low_count, shift = 1 << (BITS * r), BITS * r
        subtree, low = F.shiftright("chunk", shift), F.col("chunk") % low_count
        digit, last = subtree % FANOUT, F.shiftright(F.col("count") - 1, shift)
        there = F.col("count") - F.shiftleft(last, shift)
        # Partners that the last, unfinished subtree lacks are played by those it has, in turn.
        plays = F.when((subtree == last) & (digit > 0), F.sequence(low, F.lit(low_count - 1).cast("long"), there)).otherwise(F.array(low))
        group = F.shiftleft(F.shiftright("chunk", shift + BITS), shift + BITS)
        sent = state.where(F.col("rounds") > r).select(
            "tree", "count", "rounds", digit.alias("digit"), F.struct("chunk", "path").alias("who"), "node", low.alias("low"), group.alias("group"), F.explode(plays).alias("part")
        )
        member = F.struct("digit", "node", F.when(F.col("part") == F.col("low"), F.col("who")).alias("who"))
        met = sent.groupBy("tree", (F.col("group") + F.col("part")).alias("meeting")).agg(
            F.first("count").alias("count"), F.first("rounds").alias("rounds"), F.sort_array(F.collect_list(member)).alias("members")
        )
        # Eight nodes at most. Each member hashes the parent for itself.
        met = met.select("tree", "count", "rounds", "members", F.posexplode("members").alias("pos", "own")).where("own.who is not null")

        def side(members: Column) -> Column:
            return F.array_join(F.transform(members, lambda m: m["node"]), "")

        before = side(F.slice("members", F.lit(1), F.col("pos")))
        after = side(F.slice("members", F.col("pos") + 2, F.lit(FANOUT)))
        met = met.select("tree", "count", "rounds", "own", before.alias("before"), after.alias("after"))
        climbed = met.select(
            "tree", F.col("own.who.chunk").alias("chunk"), "count", "rounds",
            F.sha2(F.concat("before", F.col("own.node"), "after"), 256).alias("node"),
            F.concat("own.who.path", F.array(F.struct("before", "after"))).alias("path"),
        )
        state = written(climbed.unionByName(state.where(F.col("rounds") <= r).select(climbed.columns)))
    return state.select("tree", "chunk", "node", "path")


def proofs(leaves: DataFrame) -> DataFrame:
    """(leaf, row, subroot, root, path) of every row of ``leaves`` (tree, key, leaf, row).

    ``tree`` is a string that is never null; trees stand in its order. ``key`` orders the leaves of a tree, ties go by
    ``leaf``. ``row`` is a struct that goes along. ``path`` holds the siblings before and after, from leaf to root.
    """
    # Equal rows may stand in any order, and together they may be many: the salt keeps them from one range.
    salted = written(leaves.withColumn("salt", F.xxhash64(F.monotonically_increasing_id())))
    places = numbered(salted, ["tree"], ["key", "leaf", "salt"])
    groups = written(chunks(places.select("tree", "at", "n", "leaf", "row")))
    count = F.shiftright(F.col("n") - 1, BITS * CHUNK_LEVELS) + 1
    above = F.greatest(F.col("levels") - CHUNK_LEVELS, F.lit(0))
    nodes = groups.select("tree", "chunk", count.alias("count"), above.alias("rounds"), "node")
    inner = written(butterfly(nodes, nodes.agg(F.max("rounds").alias("r")).first()["r"] or 0))
    trees = numbered(inner.where("chunk = 0").select("tree", F.col("node").alias("node")), [], ["tree"])
    top = written(trees.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("at").alias("chunk"), F.col("n").alias("count"), depth(F.col("n")).alias("rounds"), "node"))
    joined = butterfly(top.drop("name"), top.agg(F.max("rounds").alias("r")).first()["r"] or 0)
    outer = joined.select("chunk", F.col("node").alias("root"), F.col("path").alias("outer")).join(top.select("chunk", F.col("name").alias("tree")), "chunk").drop("chunk")
    upper = inner.join(outer, "tree").select("tree", "chunk", F.col("node").alias("subroot"), "root", F.concat("path", "outer").alias("upper"))

    def siblings(k: int, i: Column) -> Column:
        own = F.shiftright(i, BITS * k)
        first = F.shiftleft(F.shiftright(own, BITS), BITS)
        nodes = F.col(f"l{k}")
        return F.struct(
            F.array_join(F.slice(nodes, first + 1, own - first), "").alias("before"),
            F.array_join(F.slice(nodes, own + 2, first + (FANOUT - 1) - own), "").alias("after"),
        )

    def proved(x: Column, i: Column) -> Column:
        inside = F.slice(F.array(*[siblings(k, i) for k in range(CHUNK_LEVELS)]), F.lit(1), F.least(F.col("levels"), F.lit(CHUNK_LEVELS)))
        return F.struct(x["leaf"].alias("leaf"), x["row"].alias("row"), "subroot", "root", F.concat(inside, "upper").alias("path"))

    whole = groups.join(upper, ["tree", "chunk"])
    return whole.select(F.inline(F.transform("leaves", proved)))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to by its proof."""
    return F.aggregate(path, leaf, lambda node, p: F.sha2(F.concat(p["before"], node, p["after"]), 256))


def path_hash(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["before"], p["after"])), ""), 256)


def dataset_leaves(docs: DataFrame, **others: Column) -> DataFrame:
    """(tree, key, leaf, row) of documents; ``row`` holds doc_id and the ``others``."""
    tree = F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-"))
    row = F.struct("doc_id", *[c.alias(name) for name, c in others.items()])
    return docs.select(tree.alias("tree"), F.col("doc_id").alias("key"), leaf_hash([F.col(c) for c in FIELDS]).alias("leaf"), row.alias("row"))


def verified_manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): every third document, by a checksum of its id,
    is tampered with by lower-casing its ASCII letters, and its proof is checked against the root."""
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    changed = leaf_hash([F.translate("text", UPPER, LOWER) if c == "text" else F.col(c) for c in FIELDS])
    known = proofs(dataset_leaves(docs, now=F.when(tampered, changed)))
    folded = known.withColumn("folded_root", fold(F.coalesce("row.now", "leaf"), F.col("path")))
    return folded.select(
        "row.doc_id", "leaf", "subroot", "root", path_hash(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
