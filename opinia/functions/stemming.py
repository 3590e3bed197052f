"""Italian stemming by the published Snowball rules, as staged Column expressions over a table of words.

Meant for a vocabulary (one row per distinct word), never for running text: the rules are a few dozen patterns, so
they are paid once per word and not once per occurrence.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VOWEL = "[aeiouàèìòù]"
OTHER = "[^aeiouàèìòù]"

PRONOUNS = (
    "ci gli la le li lo mi ne si ti vi sene gliela gliele glieli glielo gliene mela mele meli melo mene "
    "tela tele teli telo tene cela cele celi celo cene vela vele veli velo vene"
).split()

# Standard endings by what removing them needs and leaves behind.
PLAIN = (
    "anza anze ico ici ica ice iche ichi ismo ismi abile abili ibile ibili ista iste isti istà istè istì "
    "oso osi osa ose mente atrice atrici ante anti"
).split()
ACTION = "azione azioni atore atori".split()
STUDY = "logia logie".split()
USAGE = "uzione uzioni usione usioni".split()
QUALITY = "enza enze".split()
OUTCOME = "amento amenti imento imenti".split()
MANNER = ["amente"]
STATE = ["ità"]
TENDENCY = "ivo ivi iva ive".split()

VERBAL = (
    "ammo ando ano are arono asse assero assi assimo ata ate ati ato ava avamo avano avate avi avo emmo enda ende "
    "endi endo erà erai eranno ere erebbe erebbero erei eremmo eremo ereste eresti erete erò erono essero ete eva "
    "evamo evano evate evi evo Yamo iamo immo irà irai iranno ire irebbe irebbero irei iremmo iremo ireste iresti "
    "irete irò irono isca iscano isce isci isco iscono issero ita ite iti ito iva ivamo ivano ivate ivi ivo ono uta "
    "ute uti uto ar ir"
).split()


def _ending(word: Column, endings: list[str]) -> Column:
    """The longest of the endings that the word has, or ''. (Leftmost match before the end = longest.)"""
    return F.regexp_extract(word, f"(?:{'|'.join(endings)})$", 0)


def _starts_after(word: Column, pattern: str) -> Column:
    """Length of the part matched by the pattern; the whole word where it does not match."""
    return F.when(word.rlike(pattern), F.length(F.regexp_extract(word, pattern, 0))).otherwise(F.length(word))


def _drop_after(word: Column, region: Column, chain: list[tuple[str, int]]) -> Column:
    """Cut further endings that lie in the region: tuples of (pattern, letters to cut), the first that fits."""
    cut = F.lit(None).cast("string")
    for pattern, letters in reversed(chain):
        fits = word.rlike(f"(?:{pattern})$") & (F.length(word) - letters >= region)
        cut = F.when(fits, F.left(word, F.length(word) - letters)).otherwise(cut)
    return F.coalesce(cut, word)


def stem_words(words: DataFrame, column: str = "word", output: str = "stem") -> DataFrame:
    """Add the stem of every word. All regions (RV, R1, R2) are start positions counted from 0."""
    w = F.col("_w")
    kept = [F.col(c) for c in words.columns]

    marked = F.translate(F.lower(F.col(column)), "áéíóú", "àèìòù")
    marked = F.regexp_replace(marked, "qu", "qU")
    # u and i between vowels count as consonants. A match eats the vowel before it, so scanning goes left to right.
    marked = F.regexp_replace(marked, f"({VOWEL})([ui])(?={VOWEL})", "$1$2\u0001")
    marked = F.replace(F.replace(marked, F.lit("u\u0001"), F.lit("U")), F.lit("i\u0001"), F.lit("I"))
    df = words.select(*kept, marked.alias("_w"))
    df = df.select(
        *kept,
        w,
        _starts_after(
            w, f"^(?:.{OTHER}{OTHER}*{VOWEL}|{VOWEL}{VOWEL}{VOWEL}*{OTHER}|{OTHER}{VOWEL}.)"
        ).alias("_rv"),
        _starts_after(w, f"^.*?{VOWEL}{OTHER}").alias("_r1"),
        _starts_after(w, f"^.*?{VOWEL}{OTHER}.*?{VOWEL}{OTHER}").alias("_r2"),
    )
    rv, r1, r2 = F.col("_rv"), F.col("_r1"), F.col("_r2")
    regions = [rv, r1, r2]

    # Attached pronouns, after a gerund or an infinitive in RV.
    pronouns = "|".join(PRONOUNS)
    tail = F.substring(w, rv + 1, F.length(w))
    tail = F.regexp_replace(tail, f"(ando|endo)(?:{pronouns})$", "$1")
    tail = F.regexp_replace(tail, f"(ar|er|ir)(?:{pronouns})$", "$1e")
    # "replace with e" means the whole of ar/er/ir stays and the pronoun turns into e.
    df = df.select(*kept, F.concat(F.left(w, rv), tail).alias("_w"), *regions)

    # Standard endings: the longest one decides, and it must lie in its region.
    groups = [PLAIN, ACTION, STUDY, USAGE, QUALITY, OUTCOME, MANNER, STATE, TENDENCY]
    df = df.select(*kept, w, *regions, _ending(w, [e for g in groups for e in g]).alias("_e"))
    e = F.col("_e")
    df = df.select(*kept, w, *regions, e, F.left(w, F.length(w) - F.length(e)).alias("_b"))
    b = F.col("_b")
    inside_rv, inside_r1, inside_r2 = (F.length(b) >= region for region in regions)

    results = [
        (e.isin(MANNER) & inside_r1, _drop_after(b, r2, [("ativ", 4), ("iv|os|ic", 2), ("abil", 4)])),
        (e.isin(OUTCOME) & inside_rv, b),
        (e.isin(PLAIN) & inside_r2, b),
        (e.isin(ACTION) & inside_r2, _drop_after(b, r2, [("ic", 2)])),
        (e.isin(STUDY) & inside_r2, F.concat(b, F.lit("log"))),
        (e.isin(USAGE) & inside_r2, F.concat(b, F.lit("u"))),
        (e.isin(QUALITY) & inside_r2, F.concat(b, F.lit("ente"))),
        (e.isin(STATE) & inside_r2, _drop_after(b, r2, [("abil", 4), ("ic|iv", 2)])),
        (e.isin(TENDENCY) & inside_r2, _drop_after(b, r2, [("icat", 4), ("at", 2)])),
    ]
    standard = reduce(lambda otherwise, c: F.when(c[0], c[1]).otherwise(otherwise), results, F.lit(None).cast("string"))
    df = df.select(*kept, w, rv, standard.alias("_s"))
    s = F.col("_s")

    # Verb endings in RV, only where no standard ending went.
    in_rv = _ending(F.substring(w, rv + 1, F.length(w)), VERBAL)
    df = df.select(*kept, F.coalesce(s, F.left(w, F.length(w) - F.length(in_rv))).alias("_w"), rv)

    # A final vowel in RV, and an i before it.
    tail = F.substring(w, rv + 1, F.length(w))
    df = df.select(*kept, F.concat(F.left(w, rv), F.regexp_replace(tail, "i?[aeioàèìò]$", "")).alias("_w"), rv)
    # A final ch or gh in RV.
    tail = F.substring(w, rv + 1, F.length(w))
    stem = F.concat(F.left(w, rv), F.regexp_replace(tail, "([cg])h$", "$1"))
    return df.select(*kept, F.translate(stem, "IU", "iu").alias(output))
