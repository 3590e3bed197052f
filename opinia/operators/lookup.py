"""Joining term rows with per-term values when a few terms hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The most frequent terms of the rows are looked up from a broadcast table of at most this many rows. Any other term then
# holds at most 1/HOT_TERMS of the rows, which an ordinary shuffle join spreads well.
HOT_TERMS = 4096
OWN_KEY = "\u0000"


def spread_rows(
    rows: DataFrame, table: DataFrame, values: list[str], frequency: str, scatter: Column, key: str, frequent: DataFrame | None
) -> DataFrame:
    """``rows`` with ``_hot_`` values, where the broadcast part has them, and ``_probe``, the key to shuffle by."""
    hot_values = [F.col(v).alias(f"_hot_{v}") for v in values]
    if frequent is None:
        hot = table.orderBy(F.desc(frequency), key).limit(HOT_TERMS).select(key, F.lit(True).alias("_answered"), *hot_values)
    else:
        # Frequent keys that the table does not have, such as pruned terms, are answered as well: with nothing.
        few = F.broadcast(frequent.select(F.col(key).alias("_frequent")))
        hot = few.join(table.join(few, table[key] == F.col("_frequent"), "left_semi"), F.col("_frequent") == table[key], "left")
        hot = hot.select(F.col("_frequent").alias(key), F.lit(True).alias("_answered"), *hot_values)
    answered = F.col("_answered").isNotNull() | F.col(key).isNull()
    # No term contains a control character, so these keys meet nothing.
    own_key = F.concat(F.lit(OWN_KEY), scatter.cast("string"))
    return rows.join(F.broadcast(hot), key, "left").select(
        *[c for c in rows.columns if c != key],
        *[f"_hot_{v}" for v in values],
        F.when(answered, own_key).otherwise(F.col(key)).alias("_probe"),
        # The term itself travels once: as the key, or next to a key of its own.
        F.when(answered, F.col(key)).alias("_answered"),
    )


def lookup_terms(
    rows: DataFrame,
    table: DataFrame,
    values: list[str],
    frequency: str,
    scatter: Column,
    key: str = "term",
    how: str = "inner",
    frequent: DataFrame | None = None,
) -> DataFrame:
    """Add ``values`` from ``table`` (one row per ``key``) to ``rows``.

    ``frequency`` is the column of ``table`` that says how many rows a key has; ``values[0]`` is never null there.
    Where ``rows`` may have frequent keys that ``table`` lacks (pruned terms, new texts), ``frequent`` holds the most
    frequent keys of ``rows``, in a column ``key``. Rows already answered by the broadcast part go through the shuffle
    under a key of their own made from ``scatter``, so the hot terms end up spread over all partitions instead of in one.
    """
    rest = table.select(F.col(key).alias("_probe"), *[F.col(v).alias(f"_rest_{v}") for v in values])
    spread = spread_rows(rows, table, values, frequency, scatter, key, frequent)
    term = F.when(F.startswith("_probe", F.lit(OWN_KEY)), F.col("_answered")).otherwise(F.col("_probe"))
    joined = spread.join(rest, "_probe", "left").select(
        *[term.alias(key) if c == key else F.col(c) for c in rows.columns],
        *[F.coalesce(f"_hot_{v}", f"_rest_{v}").alias(v) for v in values],
    )
    return joined.where(F.col(values[0]).isNotNull()) if how == "inner" else joined
