"""Information-theoretic sanitisation of personal data.

Patterns find the protected entities themselves: e-mail addresses, IP addresses, card and phone numbers. Other words can
give an entity away just as well. How much is estimated from co-occurrence over the whole corpus: a term t reveals an
entity e by PMI(t; e) = log2(n(t, e) N / (n(t) n(e))) of the -log2(n(e) / N) bits that e carries. A share of
``REMOVE`` or more is removed from the texts with that entity, a share of ``GENERALISE`` or more is replaced by a general
word. Only terms that occur with the entity in ``LEAST_TEXTS`` different texts count, so that one text with its copies
proves nothing. Documents without an entity stay as they are.

How it runs: one pass finds the base spans; texts with an entity, and only they, go on, each different text once with
the number of its copies. Pairs of entity and term are counted from them with partial sums. Document frequencies of the
terms in question are counted over all documents in a second pass: a bitmap of fixed size lets only likely terms
through, each task adds up its own, and the exact join afterwards drops what the bitmap let through by chance. Where an
entity, a term or a text makes up a 1/1024 of its rows or more it is looked up by broadcast (at most 1,024 rows), the
rest by a shuffle, so no task gets a hot key.

Null text counts as empty. Rows that repeat a doc_id each get their row.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinia.llm.storage import whole_row, written

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ["email", "ip", "card", "phone"]
TERM_KIND = "term"
TERM = re.compile(r"[^\W\d_]{4,}")
LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
LEAST_TEXTS = 3
GENERALISE, REMOVE = 0.8, 0.95
PLACEHOLDER = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
GENERAL, GONE = "[TERM]", ""
BITMAP_BITS = 22
# Bits of one of Spark's bitmap blocks.
BLOCK_BITS = 32_768
# Different terms a task adds up before it passes them on.
HELD_TERMS = 200_000
HOT_SHARE = 1024
# Rows whose spans are held at a time.
FOUND_ROWS = 512
SPANS = "array<struct<kind: string, start: int, end: int>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the protected entities, by start and kind."""
    found = []
    if "@" in text:
        # A match has its @ in it and reaches back over the characters before, so nothing else needs a look.
        done, at = 0, text.find("@")
        while at >= 0:
            start = at
            while start > done and text[start - 1] in LOCAL_PART:
                start -= 1
            match = EMAIL.match(text, start) if start < at else None
            if match:
                found.append(("email", *match.span()))
            done = match.end() if match else at + 1
            at = text.find("@", done)
    if not any(d in text for d in "0123456789"):
        return found
    if "." in text:
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def entity_key(kind: str, value: str) -> str:
    """The same entity in other spellings: digits alone for numbers, lower case for addresses."""
    return kind + ":" + (re.sub(r"\D", "", value) if kind in ("card", "phone") else value.lower())


def free_terms(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of the words that no span touches."""
    taken = iter(sorted((s, e) for _, s, e in spans))
    start, end = next(taken, (len(text) + 1, 0))
    for m in TERM.finditer(text):
        while end <= m.start() and start <= len(text):
            start, end = next(taken, (len(text) + 1, 0))
        if m.end() <= start:
            yield m[0].lower(), m.start(), m.end()


def sanitised(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced; a span inside another goes with it. ``gone`` spans leave nothing."""
    parts, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            parts += [text[done:start], PLACEHOLDER.get(kind, GONE if kind == "gone" else GENERAL)]
        done = max(done, end)
    parts.append(text[done:])
    return "".join(parts)


def look_up(rows: DataFrame, table: DataFrame, key: str, frequency: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row per ``key`` and says how many rows have it."""
    hot = F.col(frequency) * HOT_SHARE >= total
    # Keys with that share of ``total`` rows: at most HOT_SHARE.
    few = F.broadcast(table.where(hot))
    by_few = rows.join(few, key)
    rest = rows.join(few.select(key), key, "left_anti").join(table.where(~hot), key)
    return by_few.unionByName(rest)


def detector() -> Callable[[str], F.Column]:
    """A function that makes struct<spans, hash, entities> of a text column; the last two are null where nothing is found."""
    spans_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    found_type = pa.struct([("spans", spans_type), ("hash", pa.string()), ("entities", pa.list_(pa.string()))])

    @F.arrow_udf(f"spans {SPANS}, hash string, entities array<string>")
    def detect(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            # Texts become Python strings one at a time: a batch may hold ten thousand of any length.
            for at in range(0, len(batch), FOUND_ROWS):
                rows = []
                for value in batch.slice(at, FOUND_ROWS):
                    text = value.as_py() or ""
                    spans = base_spans(text)
                    row = {"spans": [{"kind": k, "start": s, "end": e} for k, s, e in spans], "hash": None, "entities": None}
                    if spans:
                        row["hash"] = hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
                        row["entities"] = sorted({entity_key(k, text[s:e]) for k, s, e in spans})
                    rows.append(row)
                yield pa.array(rows, found_type)

    return lambda text: detect(F.col(text))


def likely_terms(terms: DataFrame) -> np.ndarray:
    """A bitmap of 2^BITMAP_BITS bits, half a megabyte, with the hashes of all ``term`` values."""
    place = F.crc32("term").bitwiseAND((1 << BITMAP_BITS) - 1) + 1
    blocks = terms.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")
    )
    bits = np.zeros(1 << BITMAP_BITS, bool)
    # 128 blocks of 4 KB at most, whatever the corpus; buckets count from 1.
    for row in blocks.collect():
        block = np.unpackbits(np.frombuffer(bytes(row["bits"]), np.uint8), bitorder="little").astype(bool)
        bits[np.flatnonzero(block) + (row["b"] - 1) * BLOCK_BITS] = True
    return bits


def document_frequencies(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n_t): number of documents of the whole corpus with each of ``terms``."""
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(likely_terms(terms)))

    def counts(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["term", "n_t"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, mask = np.unpackbits(shared.value), (1 << BITMAP_BITS) - 1
        likely = bits.tobytes()
        held: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                text = value.as_py()
                if text:
                    held.update([t for t in set(TERM.findall(text.lower())) if likely[zlib.crc32(t.encode()) & mask]])
            if len(held) > HELD_TERMS:
                yield counts(held)
                held.clear()
        if held:
            yield counts(held)

    counted = docs.select("text").mapInArrow(count, "term string, n_t long").groupBy("term").agg(F.sum("n_t").alias("n_t"))
    return counted.join(terms, "term", "left_semi")


def disclosing_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(hash, copies, added): texts with terms that reveal one of their entities, and where those terms stand.

    ``found`` has text, hash, spans and entities of the rows with an entity.
    """
    texts = written(
        found.groupBy("hash").agg(F.count("*").alias("copies"), F.first("text").alias("text"), F.first("spans").alias("spans"), F.first("entities").alias("entities"))
    )
    held = texts.select("hash", "copies", F.explode("entities").alias("entity"))
    counted = written(held.groupBy("entity").agg(F.sum("copies").alias("n_e"), F.count("*").alias("n_texts")))
    repeated = counted.where(F.col("n_texts") >= LEAST_TEXTS)
    n_held = held.count()
    watched = look_up(held, repeated.select("entity", "n_texts"), "entity", "n_texts", n_held)
    watched = watched.groupBy("hash").agg(F.collect_list("entity").alias("watched"))

    @F.pandas_udf("array<string>")
    def terms_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for text, spans in batches:
            yield pd.Series([
                sorted({t for t, _, _ in free_terms(x, [(s["kind"], s["start"], s["end"]) for s in sp])}) for x, sp in zip(text, spans)
            ])

    risky = written(texts.join(watched, "hash"))
    pairs = risky.select("copies", "watched", F.explode(terms_of("text", "spans")).alias("term"))
    pairs = pairs.select("copies", "term", F.explode("watched").alias("entity"))
    pairs = written(
        pairs.groupBy("entity", "term").agg(F.sum("copies").alias("n_te"), F.count("*").alias("n_texts")).where(F.col("n_texts") >= LEAST_TEXTS)
    )
    per_term = pairs.groupBy("term").agg(F.count("*").alias("n_pairs"))
    frequencies = written(document_frequencies(docs, pairs.select("term").distinct()).join(per_term, "term"))
    n_pairs, n_docs = pairs.count(), docs.count()
    weighed = look_up(pairs.drop("n_texts"), frequencies, "term", "n_pairs", n_pairs).drop("n_pairs")
    pairs_of = weighed.groupBy("entity").agg(F.count("*").alias("n_pairs"))
    weighed = look_up(weighed, counted.join(pairs_of, "entity").select("entity", "n_e", "n_pairs"), "entity", "n_pairs", n_pairs)
    # Counting documents for a term may see letters that the joined spelling splits, hence the bound.
    n_t = F.greatest("n_t", "n_te")
    pmi = F.log2(F.col("n_te") * n_docs / (n_t * F.col("n_e")))
    carried = F.log2(n_docs / F.col("n_e"))
    share = F.when(carried > 0, pmi / carried).otherwise(0.0)
    telling = weighed.withColumn("share", share).where(F.col("share") >= GENERALISE).select("entity", F.struct("term", "share").alias("told"))
    telling = written(telling.groupBy("entity").agg(F.collect_list("told").alias("told"), F.count("*").alias("n")))

    by_entity = risky.select("hash", F.explode("watched").alias("entity"))
    n_by = by_entity.groupBy("entity").agg(F.count("*").alias("n_rows"))
    told = look_up(by_entity, telling.join(n_by, "entity").select("entity", "told", "n_rows"), "entity", "n_rows", max(1, by_entity.count()))
    told = told.groupBy("hash").agg(F.flatten(F.collect_list("told")).alias("told"))

    @F.pandas_udf(SPANS)
    def places(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for text, spans, told in batches:
            out = []
            for x, sp, tt in zip(text, spans, told):
                shares: dict[str, float] = {}
                for t in tt:
                    shares[t["term"]] = max(t["share"], shares.get(t["term"], 0.0))
                base = [(s["kind"], s["start"], s["end"]) for s in sp]
                out.append([
                    {"kind": "gone" if shares[t] >= REMOVE else TERM_KIND, "start": s, "end": e} for t, s, e in free_terms(x, base) if t in shares
                ])
            yield pd.Series(out)

    return risky.join(told, "hash").select("hash", "copies", places("text", "spans", "told").alias("added"))


def _with_added(docs: DataFrame, row: F.Column) -> DataFrame:
    """``row``, ``spans`` and ``added`` of all rows; rows without an entity are not shuffled."""
    seen = docs.select(row.alias("row"), "text", detector()("text").alias("found"))
    has_entity = F.col("found.hash").isNotNull()
    seen = written(seen.select("row", "found.*", F.when(has_entity, F.col("text")).alias("text")))
    rows = seen.where("hash is not null")
    added = written(disclosing_spans(docs, rows.select("text", "hash", "spans", "entities")))
    nothing = F.array().cast(SPANS)
    plain = seen.where("hash is null").select("row", "spans", nothing.alias("added"))
    # Texts that make up 1/1024 of these rows: at most that many.
    hot = F.broadcast(added.where(F.col("copies") * HOT_SHARE >= rows.count()))
    by_hot = rows.join(hot, "hash").select("row", "spans", "added")
    rest = rows.join(hot.select("hash"), "hash", "left_anti").join(added.select("hash", "added"), "hash", "left")
    return plain.unionByName(by_hot).unionByName(rest.select("row", "spans", F.coalesce("added", nothing).alias("added")))


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term) of every document."""
    found = _with_added(docs, F.col("doc_id"))

    def named(spans: F.Column) -> F.Column:
        kind = lambda s: F.when(s["kind"] == "gone", TERM_KIND).otherwise(s["kind"])
        place = lambda s: F.coalesce(F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]), F.lit(9))
        rows = F.transform(spans, lambda s: F.struct(s["start"].alias("s"), place(s).alias("p"), F.concat_ws(":", kind(s), s["start"].cast("string"), s["end"].cast("string")).alias("n")))
        return F.array_join(F.transform(F.array_sort(rows), lambda r: r["n"]), ",")

    counts = [_count_of(kind) for kind in KINDS]
    return found.select(
        F.col("row").alias("doc_id"), *counts, F.sha2(named(F.col("spans")), 256).alias("base_sha256"),
        named(F.concat("spans", "added")).alias("spans"), F.size("added").cast("long").alias("n_term"),
    )


def _count_of(kind: str) -> F.Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def without_personal_data(docs: DataFrame) -> DataFrame:
    """The rows with entities and disclosing terms replaced in ``text``, and ``n_chars`` set to the new length."""
    found = _with_added(docs, whole_row(docs))

    @F.pandas_udf("string")
    def cleaned(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for text, spans, added in batches:
            yield pd.Series([
                x if not len(a) and not len(b) else sanitised(x, [(s["kind"], s["start"], s["end"]) for s in (*a, *b)])
                for x, a, b in zip(text, spans, added)
            ], dtype=object)

    changed = found.select("row", "spans", "added", cleaned(F.col("row.text"), F.col("spans"), F.col("added")).alias("text"))
    touched = F.size("spans") + F.size("added") > 0
    values = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in values:
        values["n_chars"] = F.when(touched, F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(values["n_chars"])
    return changed.select(*[values[c].alias(c) for c in docs.columns])
