"""Document fingerprints as Merkle trees over paragraphs and sections, in DataFrame functions only.

A section is a line with its line break; a paragraph is a part of a line up to the end of a sentence, so that texts of a
single line have branches too. Every character lies in exactly one paragraph. A paragraph's node is a hash of its text,
a section's node a hash of its paragraphs' nodes, the root a hash of the sections' nodes, all of full width: equal roots
mean equal texts. Walking down the branches that differ leads to what was edited: ``edited_branches`` gives their nodes,
``edited_range`` where they stand. A fingerprint is written as ``root;section=paragraphs;section=paragraphs;...`` with the
first 12 hex digits of each node and the whole root.

Likeness of two fingerprints: 1 for equal roots; else common over all distinct paragraph nodes, of branches that differ
and of those that do not.

Null text counts as empty, and has one section with one empty paragraph. Each row gets a row, repeated ones too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinia.llm.storage import partitions, written
from opinia.operators.prefix_sums import BUCKETS, ordered_buckets

NODE = 12
NO_ID = -(2**63)
# Behind a line break; behind the space that follows the end of a sentence.
SECTION_END = r"(?<=\n)"
PARAGRAPH_END = r"(?<=[.!?] )"


def fingerprint(text: Column) -> Column:
    """The whole tree of a text as a string."""
    sections = F.split(F.coalesce(text, F.lit("")), SECTION_END)
    # The nodes of a section's paragraphs at full width, one behind the other.
    paragraphs = F.transform(sections, lambda s: F.array_join(F.transform(F.split(s, PARAGRAPH_END), lambda p: F.sha2(p, 256)), ""))
    # The list is made once and used twice.
    tree = F.transform(F.array(F.transform(paragraphs, lambda nodes: F.struct(F.sha2(nodes, 256).alias("node"), nodes.alias("nodes")))), _written)
    return F.element_at(tree, 1)


def _written(sections: Column) -> Column:
    """The root over the full nodes, then all nodes cut to their first digits."""
    root_node = F.sha2(F.array_join(F.transform(sections, lambda s: s["node"]), ";"), 256)
    short = F.transform(
        sections,
        lambda s: F.concat(F.left(s["node"], F.lit(NODE)), F.lit("="), F.regexp_replace(s["nodes"], f"(.{{{NODE}}}).{{{64 - NODE}}}", "$1")),
    )
    return F.concat(root_node, F.lit(";"), F.array_join(short, ";"))


def root(tree: Column) -> Column:
    return F.substring_index(tree, ";", 1)


def branches(tree: Column) -> Column:
    """The sections of a fingerprint, each ``node=paragraph nodes``."""
    return F.slice(F.split(tree, ";"), 2, 1 << 30)


def paragraph_nodes(tree: Column) -> Column:
    """The distinct paragraph nodes of a fingerprint."""
    # Patterns that begin at a separator, so that long runs of nodes are passed over once.
    nodes = F.regexp_replace(F.substring(tree, F.lit(65), F.length(tree)), f";[0-9a-f]{{{NODE}}}=", "")
    return F.array_distinct(F.regexp_extract_all(nodes, F.lit(f"([0-9a-f]{{{NODE}}})"), 1))


def nodes_likeness(one: Column, two: Column, nodes_of_one: Column, nodes_of_two: Column) -> Column:
    """``likeness`` of two fingerprints whose paragraph nodes are at hand."""
    common = F.size(F.array_intersect(nodes_of_one, nodes_of_two))
    return F.when(root(one) == root(two), 1.0).otherwise(common / (F.size(nodes_of_one) + F.size(nodes_of_two) - common))


def likeness(one: Column, two: Column) -> Column:
    """0 to 1, 1 for equal roots."""
    return nodes_likeness(one, two, paragraph_nodes(one), paragraph_nodes(two))


def edited_branches(old: Column, new: Column) -> Column:
    """The sections of ``new`` that ``old`` does not have, as branches; none is looked at if the roots are equal."""
    changed = F.array_except(branches(new), branches(old))
    return F.when(root(old) == root(new), F.array().cast("array<string>")).otherwise(changed)


def edited_range(old: Column, new: Column) -> Column:
    """struct<first, end> of the sections of ``new``, numbered from 0, outside the sections that both begin and end with.

    Empty (first = end) where sections were only taken out; null if the roots are equal.
    """
    one, two = branches(old), branches(new)

    def common(a: Column, b: Column) -> Column:
        # Lists of different length are filled up with nulls, which differ.
        place = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
        return F.when(place > 0, place - 1).otherwise(F.size(b)).cast("int")

    first = common(one, two)
    last = F.least(common(F.reverse(one), F.reverse(two)), F.least(F.size(one), F.size(two)) - first)
    return F.when(root(old) != root(new), F.struct(first.alias("first"), (F.size(two) - last).cast("int").alias("end")))


def edited_paragraphs(old: Column, new: Column) -> Column:
    """The paragraph nodes of ``new`` that ``old`` does not have."""
    return F.array_except(paragraph_nodes(new), paragraph_nodes(old))


def keyed(docs: DataFrame) -> DataFrame:
    """(at, own, text): a null doc_id stands before all others; ``own`` is a hash of the text."""
    return docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("at"), F.xxhash64("text").alias("own"), F.coalesce("text", F.lit("")).alias("text"))


def with_next(docs: DataFrame) -> DataFrame:
    """(at, own, n_chars, next): links from each document to the next by doc_id, the last one's to the first.

    Works on ids and hashes of texts alone. The hashes order rows that share a doc_id; rows equal in both are one link.
    """
    ids = keyed(docs).select("at", "own", F.length("text").cast("long").alias("n_chars")).distinct()
    bucketed = written(ordered_buckets(written(ids), "at", buckets=min(BUCKETS, 4 * partitions(docs.sparkSession))))
    row = F.struct("at", "own")
    inside = Window.partitionBy("_bucket").orderBy("at", "own")
    # One row per bucket, at most some thousands: its first row is what follows the bucket before.
    firsts = bucketed.groupBy("_bucket").agg(F.min(row).alias("first"))
    order = Window.orderBy("_bucket")
    around = F.first("first").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    follows = firsts.select("_bucket", F.coalesce(F.lead("first").over(order), around).alias("follows"))
    linked = bucketed.withColumn("next", F.lead(row).over(inside)).join(F.broadcast(follows), "_bucket")
    return linked.select("at", "own", "n_chars", F.coalesce("next", "follows").alias("next"))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_edited_sections,
    first_edited_section, end_edited_section).

    The edited text has its last quarter replaced by as much of the start of the next document. Whole texts are shuffled
    once, by doc_id; after that only the starts wanted and fingerprints travel.
    """
    links = written(with_next(docs))
    # What the document before asks of each document.
    wanted = links.select(
        F.col("next.at").alias("at"),
        F.col("next.own").alias("own"),
        F.struct("at", "own").alias("before"),
        F.floor(F.col("n_chars") / 4).cast("int").alias("wanted"),
    )
    met = keyed(docs).join(wanted, ["at", "own"])
    # Rows that repeat doc_id and text have the same next document and are next to one only.
    met = met.withColumn("place", F.row_number().over(Window.partitionBy("at", "own").orderBy("before")))
    # Both ends of a link use the same columns of the same exchange, so texts travel once.
    starts = met.where("place = 1").select(
        F.col("before.at").alias("at"),
        F.col("before.own").alias("own"),
        F.substring(F.col("text"), F.lit(1), F.col("wanted")).alias("start"),
        fingerprint(F.col("text")).alias("next_fingerprint"),
    )
    ends = met.select("at", "own", "text", F.length("text").cast("long").alias("n_chars"), fingerprint(F.col("text")).alias("fingerprint"))
    pairs = ends.join(starts, ["at", "own"])
    quarter = F.floor(F.col("n_chars") / 4)
    kept = F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - quarter).cast("int"))
    edited = pairs.withColumn("edited", F.concat(kept, "start")).select(
        F.when(F.col("at") != NO_ID, F.col("at")).alias("doc_id"),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        fingerprint(F.col("edited")).alias("edited_fingerprint"),
        "next_fingerprint",
    )
    # Nodes are taken apart once per fingerprint.
    taken_apart = edited.withColumns({f"_{c}": paragraph_nodes(F.col(c)) for c in ("fingerprint", "edited_fingerprint", "next_fingerprint")})

    def near(other: str) -> Column:
        return nodes_likeness(F.col("fingerprint"), F.col(other), F.col("_fingerprint"), F.col(f"_{other}"))

    return taken_apart.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        near("edited_fingerprint").alias("near_edited"),
        near("next_fingerprint").alias("near_next"),
        F.size(edited_branches(F.col("fingerprint"), F.col("edited_fingerprint"))).cast("long").alias("n_edited_sections"),
        *[edited_range(F.col("fingerprint"), F.col("edited_fingerprint"))[end].alias(f"{end}_edited_section") for end in ("first", "end")],
    )
