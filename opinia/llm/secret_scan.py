"""Secret scans by a battery of randomness tests, in DataFrame functions only.

Base patterns find assignments, access keys and long hex runs. Beyond them every run of 20 or more code characters that
mixes digits with letters is a candidate, or what base finds leave of it, if that is as long. Its encoding is inferred
from the characters it uses (hex, base 32, base 36, base 64); under that alphabet four tests ask how far it is from random:
- chi-squared uniformity of the symbol counts, with the variance that short strings have under a uniform alphabet,
- chi-squared uniformity over groups of symbols (vowels, other letters by case, digits), which has more power on short ones,
- number of runs below and above the middle of the alphabet,
- serial correlation of neighbouring symbols.
Fisher's method joins them to one p-value, which is small for words, paths and numbered names and about uniform for random
strings. The tests are weak on short strings, so false discoveries are controlled by length: candidates are put into
strata by encoding and length, and in each the Benjamini-Hochberg procedure picks those that are certainly not random. So
that single names in a corpus of few do not pass for secrets, p-values below a floor do not either, whatever the others
are: ``FLOOR`` in the shortest class, half as much in each longer one, where the tests have more power. The rest are
secrets. A corpus of readable names lifts its own bar that way, and random strings are lost at the rate of the floor.

The procedure needs only how many p-values lie below a step, so per stratum a histogram of fixed size is counted, with
partial sums before the shuffle; at most a few hundred rows go to the driver's broadcast whatever the corpus.

Null text counts as empty. A doc_id that repeats gets a row each time. Texts are scanned whole.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinia.llm.storage import written

# Base patterns: name, regular expression, group whose length counts, least length.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ACCESS = r"(AKIA[A-Z0-9]+)"
# A maximal run, so asking for the length in the pattern finds the same ones.
HEX = r"([0-9a-f]{16,})"
KINDS = ["assign", "access", "hex", "random"]
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

# Not shorter than LEAST_CANDIDATE.
CANDIDATE = r"([A-Za-z0-9+/_=-]{20,})"
# (name, what the characters have to match, alphabet in order)
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ENCODINGS = [
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef"),
    ("base32", r"^([A-Z2-7]+=*|[a-z2-7]+=*)$", LOWER + "234567"),
    ("base36", r"^([A-Z0-9]+|[a-z0-9]+)$", DIGITS + LOWER),
    ("base64", r"^[A-Za-z0-9+/_-]+=*$", UPPER + LOWER + DIGITS + "+/"),
]
# Lengths where a stratum ends.
LENGTH_STEPS = [24, 32, 40, 64, 128]
STEPS = 200
LEVEL = 0.05
FLOOR = 0.05
LEAST_CANDIDATE = 20
VOWELS = "aeiou"


def spans(text: Column, pattern: str, group: int = 1, least: int = 1) -> Column:
    """array<struct<start, end, value>> of the leftmost non-overlapping matches whose ``group`` has ``least`` characters.

    A match begins where the texts between matches and the matches before it end, so lengths give all positions.
    """
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    whole = F.regexp_extract_all(text, F.lit(pattern), 1)
    counted = F.regexp_extract_all(text, F.lit(pattern), group)
    rows = F.arrays_zip(gaps.alias("gap"), whole.alias("value"), counted.alias("counted"))
    kind = "struct<at: int, found: array<struct<start: int, end: int, value: string>>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int, value: string>>").alias("found")).cast(kind)

    def step(acc: Column, row: Column) -> Column:
        begin = acc["at"] + row["gap"]
        end = begin + F.length(row["value"])
        hit = F.struct(begin.alias("start"), end.alias("end"), row["value"].alias("value"))
        grown = F.when(F.length(row["counted"]) >= least, F.concat(acc["found"], F.array(hit))).otherwise(acc["found"])
        return F.struct(F.coalesce(end, begin).alias("at"), grown.alias("found")).cast(kind)

    return F.aggregate(rows, start, step, lambda acc: acc["found"])


def _only_if(text: Column, probe: str, found: Column) -> Column:
    """Positions are worked out only where a probe matches at all."""
    return F.when(text.rlike(probe), found).otherwise(F.array().cast("array<struct<start: int, end: int, value: string>>"))


def encoding_of(value: Column) -> Column:
    """The narrowest encoding whose characters a string uses, or null: hex asks for digits and letters, base 64 for
    both cases and digits, base 32 and base 36 for letters of one case and digits."""
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    verdict = F
    for name, pattern, _ in ENCODINGS:
        both = mixed & value.rlike("[a-z]") & value.rlike("[A-Z]") if name == "base64" else mixed
        verdict = verdict.when(both & value.rlike(pattern), F.lit(name))
    return verdict.otherwise(F.lit(None).cast("string"))


def _symbols(value: Column, encoding: Column) -> Column:
    """Places of the characters in the alphabet of the encoding, without padding."""
    bare = F.rtrim(value, F.lit("="))
    # The URL-safe variant's characters take the places of the others.
    plain = F.translate(bare, "-_", "+/")
    chars = F.split(F.when(encoding == "base64", plain).otherwise(F.lower(plain)), "")
    alphabet = reduce(lambda other, e: F.when(encoding == e[0], F.lit(e[2])).otherwise(other), ENCODINGS, F.lit(""))
    return F.transform(chars, lambda c: F.position(c, alphabet))


def _size(encoding: Column) -> Column:
    return reduce(lambda other, e: F.when(encoding == e[0], F.lit(len(e[2]))).otherwise(other), ENCODINGS, F.lit(1))


def _group_chi(value: Column, encoding: Column) -> tuple[Column, Column]:
    """Chi-squared of the counts of vowels, other letters (by case, if the encoding has both) and the rest, and the degrees
    of freedom."""
    bare = F.rtrim(value, F.lit("="))
    n = F.length(bare)
    count = lambda group: n - F.length(F.regexp_replace(bare, f"[{group}]", ""))
    others = "".join(c for c in LOWER if c not in VOWELS)
    vowels, lower, upper = count(VOWELS + VOWELS.upper()), count(others), count(others.upper())

    def chi(alphabet: str) -> Column:
        share = lambda group: sum(c in group for c in alphabet) / len(alphabet)
        seen = [(vowels, share(VOWELS + VOWELS.upper()))]
        if any(c in UPPER for c in alphabet):
            seen += [(lower, share(others)), (upper, share(others.upper()))]
        else:
            seen += [(lower + upper, share(others))]
        seen += [(n - sum(c for c, _ in seen), 1 - sum(p for _, p in seen))]
        return sum(F.pow(c - n * p, 2) / (n * p) for c, p in seen)

    x = reduce(lambda other, e: F.when(encoding == e[0], chi(e[2])).otherwise(other), ENCODINGS, F.lit(0.0))
    return x, F.when(encoding == "base64", 3.0).otherwise(2.0)


def _beyond(z: Column) -> Column:
    """Chance of a normal value above z, by a logistic approximation that is within 0.0002."""
    inside = F.greatest(F.least(z, F.lit(8.0)), F.lit(-8.0))
    return 1 / (1 + F.exp(1.5976 * inside + 0.070566 * inside * inside * inside))


def _sum(values: Column, of=lambda x: x) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + of(x).cast("double"))


def with_p_value(candidates: DataFrame) -> DataFrame:
    """Add ``p``: how often a random string of that length and alphabet looks at least as regular. ``value`` and
    ``encoding`` are there."""
    x, free = _group_chi(F.col("value"), F.col("encoding"))
    # Wilson and Hilferty: the cube root of a chi-squared value over its degrees of freedom is close to normal.
    part = 2 / (9 * free)
    candidates_columns = candidates.columns
    candidates = candidates.withColumn("_z_groups", (F.pow(x / free, 1 / 3) - (1 - part)) / F.sqrt(part))
    staged = candidates.withColumn("_s", _symbols(F.col("value"), F.col("encoding"))).withColumn("_k", _size(F.col("encoding")).cast("double"))
    staged = staged.withColumn("_n", F.size("_s").cast("double")).withColumn("_distinct", F.array_distinct("_s"))
    s, n, k = F.col("_s"), F.col("_n"), F.col("_k")
    squares = _sum(F.col("_distinct"), lambda x: F.pow(F.size(F.filter(s, lambda y: y == x)), 2))
    mean = _sum(s) / n
    high = F.transform(s, lambda x: (x > k / 2).cast("int"))
    staged = staged.withColumns({"_squares": squares, "_mean": mean, "_high": high})
    staged = staged.withColumns({
        "_var": _sum(s, lambda x: F.pow(x - F.col("_mean"), 2)),
        "_cov": F.aggregate(F.sequence(F.lit(1), F.size(s) - 1), F.lit(0.0), lambda acc, i: acc + (F.element_at(s, i) - F.col("_mean")) * (F.element_at(s, i + 1) - F.col("_mean"))),
        "_runs": 1 + F.aggregate(F.sequence(F.lit(1), F.size(s) - 1), F.lit(0.0), lambda acc, i: acc + (F.element_at("_high", i) != F.element_at("_high", i + 1)).cast("double")),
        "_ones": _sum(F.col("_high")),
    })
    chi = k / n * F.col("_squares") - n
    z_chi = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    both = 2 * F.col("_ones") * (n - F.col("_ones"))
    spread = both * (both - n) / (n * n * (n - 1))
    z_runs = F.when(spread > 0, (F.col("_runs") - both / n - 1) / F.sqrt(spread)).otherwise(8.0)
    z_serial = F.when(F.col("_var") > 0, (F.col("_cov") / F.col("_var") + 1 / n) * F.sqrt(n)).otherwise(8.0)
    two_sided = lambda z: 2 * _beyond(F.abs(z))
    fisher = -2 * (F.ln(_beyond(z_chi)) + F.ln(_beyond(F.col("_z_groups"))) + F.ln(two_sided(z_runs)) + F.ln(two_sided(z_serial)))
    staged = staged.withColumn("_x", fisher / 2)
    # Chi-squared with eight degrees of freedom, in closed form.
    tail = F.exp(-F.col("_x")) * (1 + F.col("_x") + F.pow("_x", 2) / 2 + F.pow("_x", 3) / 6)
    return staged.withColumn("p", tail).select(*candidates_columns, "p")


def length_class(length: Column) -> Column:
    return sum(((length >= at).cast("int") for at in LENGTH_STEPS), F.lit(0))


def stratum(encoding: Column, length: Column) -> Column:
    """Encoding and length class."""
    return F.concat(encoding, F.lit("-"), length_class(length).cast("string"))


def free_parts(candidate: Column, base: Column) -> Column:
    """array<struct<start, end, value>>: what the spans of ``base`` leave of a candidate, if it is long enough."""
    kind = "struct<at: int, parts: array<struct<start: int, end: int, value: string>>>"
    none = F.array().cast("array<struct<start: int, end: int, value: string>>")
    touching = F.array_sort(F.filter(base, lambda b: (b["start"] < candidate["end"]) & (candidate["start"] < b["end"])))

    def grown(acc: Column, end: Column) -> Column:
        part = F.struct(acc["at"].alias("start"), end.alias("end"), F.substring(candidate["value"], acc["at"] - candidate["start"] + 1, end - acc["at"]).alias("value"))
        return F.when(end - acc["at"] >= LEAST_CANDIDATE, F.concat(acc["parts"], F.array(part))).otherwise(acc["parts"])

    return F.aggregate(
        touching,
        F.struct(candidate["start"].alias("at"), none.alias("parts")).cast(kind),
        lambda acc, b: F.struct(F.greatest(acc["at"], b["end"]).alias("at"), grown(acc, b["start"]).alias("parts")).cast(kind),
        lambda acc: grown(acc, candidate["end"]),
    )


def cut_offs(candidates: DataFrame, level: float = LEVEL) -> DataFrame:
    """(stratum, least_step): p-values below that step are rejected as random by Benjamini-Hochberg at ``level``.

    ``step`` is the number of the p-value's class on a scale that is even in log p, so the table has ``STEPS`` rows per
    stratum at most. A class is rejected if its upper end times the number of all is within ``level`` times the number
    at or below it.
    """
    counts = candidates.groupBy("stratum", "step").agg(F.count("*").alias("n"))
    up = Window.partitionBy("stratum").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    all_ = Window.partitionBy("stratum")
    ranked = counts.select("stratum", "step", F.sum("n").over(up).alias("below"), F.sum("n").over(all_).alias("total"))
    upper = F.exp((F.col("step") + 1 - STEPS) / 10.0)
    rejected = ranked.where(upper * F.col("total") <= level * F.col("below"))
    return rejected.groupBy("stratum").agg((F.max("step") + 1).alias("least_step"))


def step_of(p: Column) -> Column:
    """0 for the smallest p-values to STEPS - 1 for 1: ten classes per power of e."""
    return F.greatest(F.lit(0), F.least(F.lit(STEPS - 1), F.floor(STEPS + 10 * F.ln(F.greatest(p, F.lit(1e-300)))))).cast("int")


def scan(docs: DataFrame, level: float = LEVEL) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random)."""
    text = F.col("text")
    filled = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = filled.select(
        "doc_id",
        _only_if(text, r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", spans(text, ASSIGN, 2, LEAST_ASSIGN)).alias("assign"),
        _only_if(text, "AKIA", spans(text, ACCESS, 1, LEAST_ACCESS)).alias("access"),
        _only_if(text, HEX, spans(text, HEX)).alias("hex"),
        _only_if(text, CANDIDATE, spans(text, CANDIDATE)).alias("candidates"),
    )
    # Rows without a find stay short; the number ties a document's candidates to it.
    bare = lambda kind: F.transform(kind, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(kind)
    found = found.select("doc_id", *map(bare, KINDS[:3]), "candidates")
    found = written(found.withColumn("row", F.monotonically_increasing_id()))
    base = F.concat("assign", "access", "hex")
    free = F.flatten(F.transform("candidates", lambda c: free_parts(c, base)))
    tried = found.where(F.size("candidates") > 0).select("row", F.inline(free)).withColumn("encoding", encoding_of(F.col("value")))
    tried = with_p_value(tried.where("encoding is not null"))
    length = F.length("value")
    likely = F.col("p") >= FLOOR / F.pow(2, length_class(length))
    tried = tried.select("row", "start", "end", stratum(F.col("encoding"), length).alias("stratum"), step_of(F.col("p")).alias("step"), likely.alias("likely"))
    tried = written(tried)
    # A few strata: encodings times length classes.
    bars = F.broadcast(cut_offs(tried, level))
    secret = tried.join(bars, "stratum", "left").where("likely").where(F.col("step") >= F.coalesce("least_step", F.lit(0)))
    random = secret.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("random"))
    joined = found.drop("candidates").join(random, "row", "left")

    def one_kind(place: int, kind: str) -> Column:
        name = lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string"))
        return F.transform(F.coalesce(F.col(kind), F.array().cast("array<struct<start: int, end: int>>")), lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("place"), name(s).alias("name")))

    def named(kinds: list[str]) -> Column:
        ordered = F.array_sort(F.concat(*[one_kind(place, kind) for place, kind in enumerate(kinds)]))
        return F.array_join(F.transform(ordered, lambda s: s["name"]), ",")

    return joined.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(named(KINDS[:3]), 256).alias("base_sha256"),
        named(KINDS).alias("spans"),
        F.coalesce(F.size("random"), F.lit(0)).cast("long").alias("n_random"),
    )
