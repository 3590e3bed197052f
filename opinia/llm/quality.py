"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every rule says when a text fails. On a bounded sample each rule is timed and its rejections are counted; rules then run
in falling order of rejections per second, as branches of a CASE: a text that one rule rejects is not looked at by the
rules after it, so an expensive rule sees only what the cheap ones let through. The order changes the cost alone. A text
is kept if no rule rejects it, in whatever order, so results are the same on every run.

Words are runs of characters other than space and U+0009 to U+000D. Null text has no words. Texts are read whole; what
a rule needs from the rows of a text are arrays within the row, so nothing is shuffled and no text meets another.
Reports carry doc_id only; kept rows carry all their columns.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinia.llm.storage import whole_row, written

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 8
LEAST_WORDS = 20
# Rows that costs and selectivities are estimated on. They decide the order of the rules, never a verdict.
SAMPLE_ROWS = 1000
LEAST_SECONDS = 1e-3

Lookup = Callable[[str], Column]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _removed(text: Column, pattern: str) -> Column:
    """How many characters a pattern takes away."""
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _windows(words: Column, width: int = WINDOW) -> Column:
    """A hash of each run of ``width`` words, in order."""
    starts = F.sequence(F.lit(1), F.size(words) - (width - 1))
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    runs = _let(hashes, lambda all_: F.transform(starts, lambda i: F.xxhash64(F.slice(all_, i, width))))
    return F.when(F.size(words) >= width, runs).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column, width: int = WINDOW) -> Column:
    """Words in windows that occur twice or more."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(all_: Column) -> Column:
        beside = lambda k: F.get(all_, k)["h"]  # noqa: E731  null beyond the ends
        return F.filter(all_, lambda x, k: F.coalesce(x["h"] == beside(k - 1), F.lit(False)) | F.coalesce(x["h"] == beside(k + 1), F.lit(False)))

    def covered(starts: Column) -> Column:
        return F.aggregate(
            starts,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-width).alias("last")),
            lambda acc, i: F.struct((acc["n"] + F.least(F.lit(width), i - acc["last"])).alias("n"), i.alias("last")),
            lambda acc: acc["n"],
        )

    starts = _let(placed, lambda all_: F.array_sort(F.transform(repeated(all_), lambda x: x["i"])))
    total = _let(starts, covered)
    return F.when(F.size(windows) == F.size(F.array_distinct(windows)), F.lit(0).cast("long")).otherwise(total)


def _dup_lines(text: Column) -> Column:
    lines = F.split(text, "\n")
    filled = F.filter(lines, lambda line: line.rlike(WORD))
    counted = (F.size(filled) - F.size(F.array_distinct(filled))).cast("long")
    return F.when(F.size(lines) == F.size(F.array_distinct(lines)), F.lit(0).cast("long")).otherwise(counted)


def _stutters(words: Column) -> Column:
    """Words equal to the one before."""
    return F.size(F.filter(words, lambda w, i: F.coalesce(w == F.get(words, i - 1), F.lit(False)))).cast("long")


# What rules look at, each a function of text, words and window hashes.
FEATURES: dict[str, Callable[[Column, Column, Column], Column]] = {
    "n_words": lambda text, words, windows: F.size(words).cast("long"),
    "word_chars": lambda text, words, windows: F.length(F.array_join(words, "")).cast("long"),
    "n_symbols": lambda text, words, windows: _removed(text, SYMBOLS),
    "n_lines": lambda text, words, windows: F.size(F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))).cast("long"),
    "n_dup_lines": lambda text, words, windows: _dup_lines(text),
    "n_repeat_words": lambda text, words, windows: _covered(windows),
    "n_upper": lambda text, words, windows: _removed(text, r"\p{Lu}+"),
    "n_letters": lambda text, words, windows: _removed(text, r"\p{L}+"),
    "n_stutters": lambda text, words, windows: _stutters(words),
}


@dataclass(frozen=True)
class Rule:
    """``fails`` gets a function that gives a feature's Column by name. ``windows``: it needs the window hashes."""

    name: str
    fails: Callable[[Lookup], Column]
    windows: bool = False


BASE_RULES = [
    Rule("too_short", lambda f: f("n_words") < LEAST_WORDS),
    Rule("repeated_windows", lambda f: 100 * f("n_repeat_words") > 30 * f("n_words"), windows=True),
]
MORE_RULES = [
    Rule("symbols", lambda f: 10 * f("n_symbols") > 3 * f("n_words")),
    Rule("repeated_lines", lambda f: (f("n_dup_lines") >= 3) & (2 * f("n_dup_lines") > f("n_lines"))),
    Rule("shouting", lambda f: 2 * f("n_upper") > f("n_letters")),
    Rule("stutter", lambda f: 5 * f("n_stutters") > f("n_words")),
    Rule("word_length", lambda f: (f("word_chars") < 2 * f("n_words")) | (f("word_chars") > 15 * f("n_words"))),
]
RULES = BASE_RULES + MORE_RULES


def prepared(docs: DataFrame, text: str = "text") -> DataFrame:
    """With the words of a text, which nearly every rule needs, as ``_words``, and its filled text as ``_text``."""
    filled = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    return filled.withColumn("_words", words_of(F.col("_text")))


def lazily(name: str) -> Column:
    """A feature computed on the spot, inside the branch of the rule that asks for it."""
    return FEATURES[name](F.col("_text"), F.col("_words"), F.col("_windows"))


def ordered(docs: DataFrame, rules: list[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules in falling order of rejections per second, both taken from a sample of at most ``rows`` rows."""
    sample = written(docs.select("text").limit(rows))

    def seconds(fails: Column, windows: bool = False) -> tuple[float, int]:
        staged = prepared(sample)
        if windows:
            staged = staged.withColumn("_windows", _windows(F.col("_words")))
        start = time.perf_counter()
        rejected = staged.agg(F.count_if(fails)).first()[0]
        return time.perf_counter() - start, rejected

    idle = min(seconds(F.size("_words") < 0)[0] for _ in range(2))
    rates = {}
    for rule in rules:
        spent, rejected = seconds(rule.fails(lazily), rule.windows)
        rates[rule.name] = rejected / max(spent - idle, LEAST_SECONDS)
    return sorted(rules, key=lambda r: (-rates[r.name], r.name))


def cascade(staged: DataFrame, order: list[Rule], feature: Lookup = lazily) -> DataFrame:
    """Add ``_rejected``, the first rule of ``order`` that rejects a text, or null.

    Rules are branches of a CASE, which ends at the first that holds. Window hashes are made right before the first rule
    that needs them, for the texts that are still in, unless they are there already.
    """
    staged = staged.withColumn("_rejected", F.lit(None).cast("string"))
    waiting: list[Rule] = []

    def judged(df: DataFrame) -> DataFrame:
        verdict = F.when(F.col("_rejected").isNotNull(), F.col("_rejected"))
        for rule in waiting:
            verdict = verdict.when(rule.fails(feature), F.lit(rule.name))
        return df.withColumn("_rejected", verdict)

    for rule in order:
        if rule.windows and "_windows" not in staged.columns:
            staged, waiting = judged(staged), []
            staged = staged.withColumn("_windows", F.when(F.col("_rejected").isNull(), _windows(F.col("_words"))))
        waiting.append(rule)
    return judged(staged)


def accepted(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """The rows that no rule rejects, as they are."""
    judged = cascade(prepared(docs.select(whole_row(docs), "text")), ordered(docs, rules))
    # A filter moves below projections and takes the expressions it needs along, which would compute the words again for
    # every use inside a rule. It does not move below a row number.
    numbered = judged.withColumn("_number", F.monotonically_increasing_id())
    return numbered.where("_rejected is null and _number >= 0").select("_row.*")


def quality_report(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept).

    The base features are wanted for every row, so they are computed once and the cascade reads them; the features of
    the other rules are computed inside its branches.
    """
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    order = ordered(docs, rules)
    staged = prepared(docs.select("doc_id", "text")).withColumn("_windows", _windows(F.col("_words")))
    staged = staged.withColumns({n: FEATURES[n](F.col("_text"), F.col("_words"), F.col("_windows")) for n in base})
    feature = lambda name: F.col(name) if name in base else lazily(name)
    failed = F.lit(False)
    for rule in BASE_RULES:
        failed = failed | rule.fails(feature)
    return cascade(staged, order, feature).select(
        "doc_id", *base, failed.alias("base_failed"), F.col("_rejected").isNull().alias("kept")
    )
