"""Tokenising as Column expressions: no Python runs per row, so the work stays inside the JVM.

The three steps are separate columns on purpose: each is read several times by the next one, and as columns of
their own they are computed once per text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinia.functions import fixed_values as fixed
from opinia.functions.stop_words import stop_word_list


@dataclass(frozen=True)
class TokenizerConfig:
    """Tokenizer options. ``lowercase`` is what a vectoriser does to the whole text before tokenising it."""

    no_numbers: bool = True
    min_length: int = 1
    clean_emoji: bool = True
    drop_stop_words: bool = True
    keep_listed_words: bool = True
    stemmer: bool = False
    lowercase: bool = True
    legacy: bool = False
    language: str = "italian"


# The older variant: digits vanish instead of becoming a space, no link, emoji or stop-word step, no length limit.
LEGACY = TokenizerConfig(clean_emoji=False, drop_stop_words=False, lowercase=False, legacy=True)

# Strippable characters other than the separator itself.
OTHER_SPACE = f"(?! ){fixed.STRIPPED_SPACE}"


def plain_text(text: Column, config: TokenizerConfig = TokenizerConfig()) -> Column:
    """Lower case, then links, numbers and symbols to spaces. A null text counts as an empty one."""
    text = F.coalesce(text, F.lit(""))
    if config.legacy:
        if config.no_numbers:
            text = F.regexp_replace(text, fixed.NUMBER_PATTERN, "")
        symbols = fixed.PUNCTUATION + fixed.LEGACY_EXTRA_SYMBOLS
    else:
        if config.lowercase:
            text = F.lower(text)
        text = F.regexp_replace(text, fixed.LINK_PATTERN, " ")
        if config.no_numbers:
            text = F.regexp_replace(text, fixed.NUMBER_PATTERN, " ")
        symbols = fixed.PUNCTUATION + fixed.EXTRA_SYMBOLS
    return F.translate(text, symbols, " " * len(symbols))


def replace_emoji(plain: Column, config: TokenizerConfig = TokenizerConfig()) -> Column:
    """Emoji with a polarity become a token of their own; whatever else lies beyond the BMP becomes a space."""
    if not config.clean_emoji:
        return plain
    marked = plain
    # Each is looked for as it stands: a pattern of alternatives would try every one of them at every character.
    for listed, token in ((fixed.POSITIVE_EMOJI, fixed.POSITIVE_TOKEN), (fixed.NEGATIVE_EMOJI, fixed.NEGATIVE_TOKEN)):
        for emoji in listed:
            marked = F.replace(marked, F.lit(emoji), F.lit(f" {token} "))
    marked = F.regexp_replace(marked, fixed.BEYOND_BMP_PATTERN, " ")
    # All of these lie beyond the BMP, so one cheap test spares most texts the three passes.
    return F.when(plain.rlike(fixed.BEYOND_BMP_PATTERN), marked).otherwise(plain)


def split_tokens(cleaned: Column, config: TokenizerConfig = TokenizerConfig()) -> Column:
    """Cleaned text -> array of tokens: split on the space, strip, then drop by length and stop word."""
    words = F.split(cleaned, " ")
    if not config.lowercase:
        words = F.transform(words, F.lower)
    ends = f"^{fixed.STRIPPED_SPACE}+|{fixed.STRIPPED_SPACE}+$"
    stripped = F.transform(words, lambda word: F.regexp_replace(word, ends, ""))
    # Stripping runs a pattern per token; texts without such characters (nearly all) skip it.
    words = F.when(cleaned.rlike(OTHER_SPACE), stripped).otherwise(words)
    stop_words = stop_word_list(config.keep_listed_words, config.language) if config.drop_stop_words else []

    def survives(word: Column) -> Column:
        keep = F.length(word) > config.min_length
        if not config.legacy:
            keep = keep & (F.length(word) < fixed.TOKEN_LENGTH_LIMIT)
        return keep & ~word.isin(stop_words) if stop_words else keep

    return F.filter(words, survives)


def ngrams(tokens: Column, lowest: int, highest: int) -> Column:
    """All contiguous n-grams for n in lowest..highest, words joined by a space."""
    grams, wanted = tokens, [tokens] if lowest == 1 else []
    for n in range(2, highest + 1):
        following = F.slice(tokens, n, F.greatest(F.size(tokens) - (n - 1), F.lit(0)))
        starts = F.slice(grams, F.lit(1), F.greatest(F.size(grams) - 1, F.lit(0)))
        grams = F.zip_with(starts, following, lambda head, word: F.concat(head, F.lit(" "), word))
        if n >= lowest:
            wanted.append(grams)
    return wanted[0] if len(wanted) == 1 else F.concat(*wanted)


def run_starts(ordered: Column) -> Column:
    """Positions (from 0) in a sorted array where a new value begins."""
    positions = F.sequence(F.lit(0), F.size(ordered) - 1)
    starts = F.filter(positions, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
    return F.when(F.size(ordered) > 0, starts).otherwise(F.array().cast("array<int>"))


def run_lengths(ordered: Column, starts: Column) -> Column:
    """Sorted array and its run starts -> array of (term, tf), without leaving the row."""
    return F.transform(
        starts,
        lambda start, i: F.struct(
            F.get(ordered, start).alias("term"),
            (F.coalesce(F.get(starts, i + 1), F.size(ordered)) - start).cast("long").alias("tf"),
        ),
    )
