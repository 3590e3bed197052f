"""The catalogue's queries as SQL for DuckDB, written independently of the DataFrame code."""

from __future__ import annotations

from opinia.functions import fixed_values as fixed
from opinia.plans.parameters import GIVEN_WORDS, GRID

K = 10


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _in(words) -> str:
    return "(" + ", ".join(_literal(w) for w in sorted(words)) + ")"


STOP_WORDS = set(fixed.BASE_STOP_WORDS) | set(fixed.CUSTOM_STOP_WORDS)
KEPT_STOP_WORDS = STOP_WORDS - set(fixed.KEPT_WORDS)

STRIP = _literal(f"^{fixed.STRIPPED_SPACE}+|{fixed.STRIPPED_SPACE}+$")


def _clean(text: str = "text") -> str:
    symbols = fixed.PUNCTUATION + fixed.EXTRA_SYMBOLS
    sql = f"lower(coalesce({text}, ''))"
    sql = f"regexp_replace({sql}, {_literal(fixed.LINK_PATTERN)}, ' ', 'g')"
    sql = f"regexp_replace({sql}, {_literal(fixed.NUMBER_PATTERN)}, ' ', 'g')"
    sql = f"translate({sql}, {_literal(symbols)}, {_literal(' ' * len(symbols))})"
    for emoji, token in ((fixed.POSITIVE_EMOJI, fixed.POSITIVE_TOKEN), (fixed.NEGATIVE_EMOJI, fixed.NEGATIVE_TOKEN)):
        for e in emoji:
            sql = f"replace({sql}, {_literal(e)}, ' {token} ')"
    return f"regexp_replace({sql}, {_literal(fixed.BEYOND_BMP_PATTERN)}, ' ', 'g')"


def _tokens(text: str = "text", stop_words=KEPT_STOP_WORDS) -> str:
    words = f"list_filter(string_split({_clean(text)}, ' '), lambda x: x <> '')"
    words = f"list_transform({words}, lambda x: regexp_replace(x, {STRIP}, '', 'g'))"
    stops = f" AND x NOT IN {_in(stop_words)}" if stop_words else ""
    return f"list_filter({words}, lambda x: length(x) > 1 AND length(x) < {fixed.TOKEN_LENGTH_LIMIT}{stops})"


def _legacy_tokens(text: str = "text") -> str:
    symbols = fixed.PUNCTUATION + fixed.LEGACY_EXTRA_SYMBOLS
    sql = f"regexp_replace(coalesce({text}, ''), {_literal(fixed.NUMBER_PATTERN)}, '', 'g')"
    sql = f"translate({sql}, {_literal(symbols)}, {_literal(' ' * len(symbols))})"
    words = f"list_filter(string_split({sql}, ' '), lambda x: x <> '')"
    words = f"list_transform({words}, lambda x: regexp_replace(lower(x), {STRIP}, '', 'g'))"
    return f"list_filter({words}, lambda x: length(x) > 1)"


DEV = """dev AS (
  SELECT d.doc_id, d.text, CASE WHEN l.quality = 1 THEN 'pos' ELSE 'neg' END AS class
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""
EVA = "eva AS (SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))"


def _term_rows(source: str, name: str, carry: str = "", ngrams: int = 2) -> str:
    """CTEs <name>_tok(doc_id, ..., tokens) and <name>(doc_id, ..., term, tf)."""
    extra = f", {carry}" if carry else ""
    grams = "tokens"
    if ngrams == 2:
        grams = "list_concat(tokens, list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1]))"
    return f"""{name}_tok AS MATERIALIZED (SELECT doc_id{extra}, {_tokens()} AS tokens FROM {source}),
{name} AS MATERIALIZED (
  SELECT doc_id{extra}, term, count(*) AS tf
  FROM (SELECT doc_id{extra}, unnest({grams}) AS term FROM {name}_tok) GROUP BY ALL)"""


def _tfidf(max_df: float = 0.5, min_df: int = 1) -> str:
    """CTEs n(n), vocab(term, df, idf) and w(doc_id, class, term, w) over the development set."""
    return f"""{DEV},
{_term_rows('dev', 'tt', 'class')},
n AS (SELECT count(*) AS n FROM dev),
vocab AS MATERIALIZED (
  SELECT term, count(*) AS df, ln((1.0 + (SELECT n FROM n)) / (1 + count(*))) + 1 AS idf
  FROM tt GROUP BY term
  HAVING count(*) <= {max_df} * (SELECT n FROM n) AND count(*) >= {min_df}),
raw AS (SELECT tt.doc_id, tt.class, tt.term, tt.tf * vocab.idf AS x FROM tt JOIN vocab ON tt.term = vocab.term),
nrm AS (SELECT doc_id, sqrt(sum(x * x)) AS nrm FROM raw GROUP BY doc_id),
w AS MATERIALIZED (SELECT raw.doc_id, raw.class, raw.term, raw.x / nrm.nrm AS w FROM raw JOIN nrm ON raw.doc_id = nrm.doc_id)"""


EVA_WEIGHTS = f"""{EVA},
{_term_rows('eva', 'et')},
eraw AS (SELECT et.doc_id, et.term, et.tf * vocab.idf AS x FROM et JOIN vocab ON et.term = vocab.term),
enrm AS (SELECT doc_id, sqrt(sum(x * x)) AS nrm FROM eraw GROUP BY doc_id),
ew AS MATERIALIZED (SELECT eraw.doc_id, eraw.term, eraw.x / enrm.nrm AS w FROM eraw JOIN enrm ON eraw.doc_id = enrm.doc_id)"""

MODEL_SUMS = """s AS MATERIALIZED (
  SELECT term, sum(CASE WHEN class = 'neg' THEN w ELSE 0.0 END) AS sn, sum(CASE WHEN class = 'pos' THEN w ELSE 0.0 END) AS sp,
         sum(CASE WHEN class = 'neg' THEN w * w ELSE 0.0 END) AS qn, sum(CASE WHEN class = 'pos' THEN w * w ELSE 0.0 END) AS qp
  FROM w GROUP BY term),
cls AS (SELECT count_if(class = 'neg')::DOUBLE AS nn, count_if(class = 'pos')::DOUBLE AS np FROM dev),
tot AS (SELECT sum(sn) AS tn, sum(sp) AS tp, count(*) AS v FROM s)"""

PICK = "CASE WHEN pos > neg THEN 'pos' ELSE 'neg' END AS predicted"

FOLDS = f"""lab AS (SELECT doc_id, class FROM dev),
fcls AS (SELECT class, min(doc_id) AS f, count(*) AS n FROM lab GROUP BY class),
off AS (SELECT class, n, coalesce(sum(n) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM fcls),
fold AS (SELECT unnest(range({K})) AS i),
al AS (SELECT class, i, floor((s + n - i + {K - 1}) / {K}.0) - floor((s - i + {K - 1}) / {K}.0) AS a FROM off CROSS JOIN fold),
rng AS (SELECT class, i, sum(a) OVER (PARTITION BY class ORDER BY i) - a AS lo, sum(a) OVER (PARTITION BY class ORDER BY i) AS hi FROM al),
rk AS (SELECT doc_id, class, row_number() OVER (PARTITION BY class ORDER BY doc_id) - 1 AS r FROM lab),
folds AS MATERIALIZED (
  SELECT rk.doc_id, rk.class, rng.i::INTEGER AS fold FROM rk JOIN rng ON rk.class = rng.class AND rk.r >= rng.lo AND rk.r < rng.hi)"""


def _fold_vocab(max_df: float = 0.5, min_df: int = 1) -> str:
    """CTEs for all folds at once: fv(held, term, idf)."""
    return f"""{DEV},
{FOLDS},
{_term_rows('dev', 'tt', 'class')},
tf_ AS MATERIALIZED (SELECT tt.*, folds.fold FROM tt JOIN folds ON tt.doc_id = folds.doc_id),
fn AS (SELECT h.i AS held, count(*) AS n FROM fold h JOIN folds ON folds.fold <> h.i GROUP BY h.i),
fdf AS (SELECT h.i AS held, term, count(*) AS df FROM fold h JOIN tf_ ON tf_.fold <> h.i GROUP BY h.i, term),
fv AS MATERIALIZED (
  SELECT fdf.held, fdf.term, ln((1.0 + fn.n) / (1 + fdf.df)) + 1 AS idf
  FROM fdf JOIN fn ON fdf.held = fn.held WHERE fdf.df <= {max_df} * fn.n AND fdf.df >= {min_df})"""


def _out_of_fold(kind: str, max_df: float = 0.5, min_df: int = 1) -> str:
    """CTEs down to oof(doc_id, class, fold, predicted)."""
    if kind == "complement":
        neg = "ln(c.tp + {v}) - ln(m.sp + 1)"
        pos = "ln(c.tn + {v}) - ln(m.sn + 1)"
        base_neg = base_pos = "0.0"
    else:
        neg = "ln(m.sn + 1) - ln(c.tn + {v})"
        pos = "ln(m.sp + 1) - ln(c.tp + {v})"
        base_neg = "ln(p.nn / (p.nn + p.np))"
        base_pos = "ln(p.np / (p.nn + p.np))"
    neg, pos = neg.format(v="c.v"), pos.format(v="c.v")
    return f"""{_fold_vocab(max_df, min_df)},
fraw AS (SELECT fv.held, tf_.doc_id, tf_.class, tf_.fold, tf_.term, tf_.tf * fv.idf AS x FROM tf_ JOIN fv ON tf_.term = fv.term),
fnrm AS (SELECT held, doc_id, sqrt(sum(x * x)) AS nrm FROM fraw GROUP BY held, doc_id),
fw AS MATERIALIZED (
  SELECT fraw.held, fraw.doc_id, fraw.class, fraw.fold, fraw.term, fraw.x / fnrm.nrm AS w
  FROM fraw JOIN fnrm ON fraw.held = fnrm.held AND fraw.doc_id = fnrm.doc_id),
m AS MATERIALIZED (
  SELECT held, term, sum(CASE WHEN class = 'neg' THEN w ELSE 0.0 END) AS sn, sum(CASE WHEN class = 'pos' THEN w ELSE 0.0 END) AS sp
  FROM fw WHERE fold <> held GROUP BY held, term),
c AS (SELECT held, sum(sn) AS tn, sum(sp) AS tp, count(*) AS v FROM m GROUP BY held),
p AS (SELECT h.i AS held, count_if(class = 'neg')::DOUBLE AS nn, count_if(class = 'pos')::DOUBLE AS np
      FROM fold h JOIN folds ON folds.fold <> h.i GROUP BY h.i),
sc AS (
  SELECT fw.doc_id, sum(fw.w * ({neg})) AS neg, sum(fw.w * ({pos})) AS pos
  FROM fw JOIN m ON fw.held = m.held AND fw.term = m.term JOIN c ON c.held = fw.held
  WHERE fw.fold = fw.held GROUP BY fw.doc_id),
oof AS MATERIALIZED (
  SELECT folds.doc_id, folds.class, folds.fold,
         CASE WHEN {base_pos} + coalesce(sc.pos, 0.0) > {base_neg} + coalesce(sc.neg, 0.0) THEN 'pos' ELSE 'neg' END AS predicted
  FROM folds JOIN p ON p.held = folds.fold LEFT JOIN sc ON sc.doc_id = folds.doc_id)"""


F1 = """lbl AS (SELECT fold, class AS label FROM oof UNION SELECT fold, predicted FROM oof),
pc AS (
  SELECT l.fold, l.label, count_if(o.class = l.label AND o.predicted = l.label) AS hits,
         count_if(o.class = l.label) AS support, count_if(o.predicted = l.label) AS guessed
  FROM lbl l JOIN oof o ON o.fold = l.fold GROUP BY l.fold, l.label),
ff AS (
  SELECT fold, sum(support * CASE WHEN support + guessed = 0 THEN 0.0 ELSE 2.0 * hits / (support + guessed) END) / sum(support) AS f1
  FROM pc GROUP BY fold)"""


def _predict(neg: str, pos: str, base_neg: str = "0.0", base_pos: str = "0.0") -> str:
    return f"""WITH {_tfidf()},
{MODEL_SUMS},
{EVA_WEIGHTS},
sc AS (SELECT ew.doc_id, sum(ew.w * ({neg})) AS neg, sum(ew.w * ({pos})) AS pos
       FROM ew JOIN s ON ew.term = s.term CROSS JOIN tot GROUP BY ew.doc_id),
f AS (SELECT eva.doc_id, coalesce(sc.neg, 0.0) + {base_neg} AS neg, coalesce(sc.pos, 0.0) + {base_pos} AS pos
      FROM eva CROSS JOIN cls LEFT JOIN sc ON eva.doc_id = sc.doc_id)
SELECT doc_id, {PICK}, round(greatest(neg, pos), 6) AS score FROM f"""


COMPLEMENT = _predict("ln(tot.tp + tot.v) - ln(s.sp + 1)", "ln(tot.tn + tot.v) - ln(s.sn + 1)")
MULTINOMIAL = _predict(
    "ln(s.sn + 1) - ln(tot.tn + tot.v)", "ln(s.sp + 1) - ln(tot.tp + tot.v)",
    "ln(cls.nn / (cls.nn + cls.np))", "ln(cls.np / (cls.nn + cls.np))",
)
GAUSSIAN = f"""WITH {_tfidf()},
{MODEL_SUMS},
fl AS (SELECT 1e-9 * max(greatest((qn + qp) / (nn + np) - pow((sn + sp) / (nn + np), 2), 0.0)) AS eps FROM s CROSS JOIN cls),
g AS MATERIALIZED (
  SELECT term, sn / nn AS mn, sp / np AS mp, greatest(qn / nn - pow(sn / nn, 2), 0.0) + eps AS vn,
         greatest(qp / np - pow(sp / np, 2), 0.0) + eps AS vp
  FROM s CROSS JOIN cls CROSS JOIN fl),
b AS (SELECT -0.5 * sum(ln(2 * pi() * vn) + mn * mn / vn) AS bn, -0.5 * sum(ln(2 * pi() * vp) + mp * mp / vp) AS bp FROM g),
{EVA_WEIGHTS},
sc AS (SELECT ew.doc_id, sum(-0.5 * (pow(ew.w - mn, 2) - mn * mn) / vn) AS neg, sum(-0.5 * (pow(ew.w - mp, 2) - mp * mp) / vp) AS pos
       FROM ew JOIN g ON ew.term = g.term GROUP BY ew.doc_id),
f AS (SELECT eva.doc_id, ln(nn / (nn + np)) + bn + coalesce(sc.neg, 0.0) AS neg, ln(np / (nn + np)) + bp + coalesce(sc.pos, 0.0) AS pos
      FROM eva CROSS JOIN cls CROSS JOIN b LEFT JOIN sc ON eva.doc_id = sc.doc_id)
SELECT doc_id, {PICK} FROM f"""


def _knn(k: int = 5) -> str:
    return f"""WITH {_tfidf()},
{EVA_WEIGHTS},
an AS (SELECT eva.doc_id, coalesce(sum(ew.w * ew.w), 0.0) AS nn FROM eva LEFT JOIN ew ON eva.doc_id = ew.doc_id GROUP BY eva.doc_id),
bn AS (SELECT dev.doc_id, dev.class, coalesce(sum(w.w * w.w), 0.0) AS nn FROM dev LEFT JOIN w ON dev.doc_id = w.doc_id GROUP BY ALL),
dots AS (SELECT ew.doc_id AS a, w.doc_id AS b, sum(ew.w * w.w) AS dot FROM ew JOIN w ON ew.term = w.term GROUP BY ALL),
d AS (SELECT an.doc_id, bn.doc_id AS neighbour, bn.class, round(greatest(an.nn + bn.nn - 2 * coalesce(dot, 0.0), 0.0), 9) AS d2
      FROM an CROSS JOIN bn LEFT JOIN dots ON dots.a = an.doc_id AND dots.b = bn.doc_id),
top AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY d2, neighbour) <= {k}),
v AS (SELECT doc_id, count_if(class = 'neg') AS neg, count_if(class = 'pos') AS pos FROM top GROUP BY doc_id)
SELECT doc_id, {PICK} FROM v"""


def _scaled(columns: str, formula: str) -> str:
    return f"""WITH {_tfidf()},
c AS (SELECT term, {columns} FROM w GROUP BY term)
SELECT w.doc_id, w.term, round({formula}, 6) AS w FROM w JOIN c ON w.term = c.term"""


N = "(SELECT n FROM n)"
ROBUST = f"""WITH {_tfidf()},
full_ AS (
  SELECT term, list_concat(list_transform(range(0, {N} - count(*)), lambda i: 0.0), list_sort(list(w))) AS xs FROM w GROUP BY term),
c AS (SELECT term, list_aggregate(xs, 'quantile_cont', 0.75) - list_aggregate(xs, 'quantile_cont', 0.25) AS iqr FROM full_)
SELECT w.doc_id, w.term, round(w.w / CASE WHEN c.iqr > 0 THEN c.iqr ELSE 1.0 END, 6) AS w FROM w JOIN c ON w.term = c.term"""

CHI2 = f"""WITH {_tfidf()},
sums AS (SELECT term, sum(CASE WHEN class = 'neg' THEN w ELSE 0.0 END) AS o_n, sum(CASE WHEN class = 'pos' THEN w ELSE 0.0 END) AS o_p FROM w GROUP BY term),
cls AS (SELECT count_if(class = 'neg') / count(*) AS pn, count_if(class = 'pos') / count(*) AS pp FROM dev),
x AS (SELECT term, pow(o_n - pn * (o_n + o_p), 2) / (pn * (o_n + o_p)) + pow(o_p - pp * (o_n + o_p), 2) / (pp * (o_n + o_p)) AS chi2
      FROM sums CROSS JOIN cls)
SELECT term, round(chi2, 6) AS chi2 FROM x ORDER BY round(chi2, 9) DESC, term LIMIT 10000"""

# Frequent itemsets level by level: a set grows by items that sort after its last one.
ITEMSETS = f"""WITH RECURSIVE basket AS MATERIALIZED (
  SELECT doc_id, unnest(list_distinct(list_filter({_legacy_tokens()}, lambda x: length(x) > 2))) AS item FROM documents),
least_ AS (SELECT 0.2 * count(*) AS least_n, count(*) AS n FROM documents),
one AS MATERIALIZED (
  SELECT doc_id, item FROM basket WHERE item IN (
    SELECT item FROM basket GROUP BY item HAVING count(*) >= (SELECT least_n FROM least_))),
grow AS (
  SELECT doc_id, item AS items, item AS tail FROM one
  UNION ALL
  SELECT doc_id, items, tail FROM (
    SELECT g.doc_id, g.items || ',' || o.item AS items, o.item AS tail, count(*) OVER (PARTITION BY g.items || ',' || o.item) AS n
    FROM grow g JOIN one o ON g.doc_id = o.doc_id AND o.item > g.tail)
  WHERE n >= (SELECT least_n FROM least_))
SELECT items, count(*) AS freq, round(count(*) / (SELECT n FROM least_), 6) AS support FROM grow GROUP BY items"""

def with_emoji_sql(text: str = "text") -> str:
    for word, emoji in fixed.EMOJI_STAND_INS:
        text = f"replace({text}, {_literal(word)}, {_literal(emoji)})"
    return text


def _emoji_by_class() -> str:
    lists = (("positive", fixed.POSITIVE_EMOJI), ("negative", fixed.NEGATIVE_EMOJI), ("neutral", fixed.NEUTRAL_EMOJI))
    rows = ", ".join(f"('{kind}', {i}, {_literal(e)})" for kind, emoji in lists for i, e in enumerate(emoji))
    return f"""WITH {DEV},
e AS (SELECT * FROM (VALUES {rows}) AS t(kind, position, emoji)),
t AS (SELECT class, {with_emoji_sql()} AS text FROM dev)
SELECT e.kind, e.position::INTEGER AS position, e.emoji,
       count_if(class = 'neg' AND contains(t.text, e.emoji))::BIGINT AS neg_count,
       count_if(class = 'pos' AND contains(t.text, e.emoji))::BIGINT AS pos_count,
       round(count_if(class = 'neg' AND contains(t.text, e.emoji)) / count_if(class = 'neg'), 6) AS neg_rate,
       round(count_if(class = 'pos' AND contains(t.text, e.emoji)) / count_if(class = 'pos'), 6) AS pos_rate
FROM e CROSS JOIN t GROUP BY e.kind, e.position, e.emoji"""


WORDS = f"wd AS (SELECT doc_id, class, unnest(list_distinct({_tokens()})) AS word FROM dev)"


def _grid(rows: list[tuple[str, float, int]]) -> str:
    """One row per configuration with its cross-validated score."""
    parts = []
    for i, (kind, max_df, min_df) in enumerate(rows):
        parts.append(
            f"SELECT {i}::INTEGER AS config_id, '{kind}nb' AS classifier, {max_df}::DOUBLE AS max_df, {min_df}::DOUBLE AS min_df, "
            f"(WITH {_out_of_fold(kind, max_df, min_df)}, {F1} SELECT round(avg(f1), 6) FROM ff) AS f1_weighted"
        )
    return "\nUNION ALL\n".join(parts)


def oracle_sql() -> dict[str, str]:
    return {
        "class_counts": f"""WITH {DEV}
SELECT class, count(*) AS n FROM dev GROUP BY class UNION ALL SELECT 'overall', count(*) FROM dev""",
        "evaluation_counts": f"WITH {EVA} SELECT count(*) AS n, sum(length(text))::BIGINT AS characters FROM eva",
        "doc_length_hist": f"""WITH {DEV},
l AS (SELECT length(text) AS x FROM dev),
s AS (SELECT min(x)::DOUBLE AS lo, max(x)::DOUBLE AS hi, count(*) AS total FROM l),
e AS (SELECT i AS bin, lo + i * ((hi - lo) / 50) AS lower, CASE WHEN i = 49 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 50) END AS upper, total, (hi - lo) / 50 AS width
      FROM s, (SELECT unnest(range(50)) AS i))
SELECT bin::INTEGER AS bin, round(lower, 6) AS lower, round(upper, 6) AS upper, count(x) AS n, round(count(x) / (total * width), 9) AS density
FROM e LEFT JOIN l ON x >= lower AND (x < upper OR (bin = 49 AND x = upper)) GROUP BY bin, lower, upper, total, width""",
        "doc_length_stats": f"""WITH {DEV}
SELECT count(*) AS n, round(avg(length(text)), 6) AS mean, round(stddev_pop(length(text)), 6) AS std,
       quantile_cont(length(text), 0.5)::DOUBLE AS median FROM dev""",
        "doc_length_box": f"""WITH {DEV},
l AS (SELECT 'overall' AS grp, length(text) AS x FROM dev UNION ALL SELECT class, length(text) FROM dev),
q AS (SELECT grp, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3 FROM l GROUP BY grp)
SELECT q.grp AS "group", q1::DOUBLE AS q1, median::DOUBLE AS median, q3::DOUBLE AS q3,
       least(min(x) FILTER (x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), q1)::DOUBLE AS whisker_low,
       greatest(max(x) FILTER (x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), q3)::DOUBLE AS whisker_high
FROM q JOIN l ON q.grp = l.grp GROUP BY q.grp, q1, median, q3""",
        "tokens_clean": f"SELECT doc_id, array_to_string({_tokens()}, ' ') AS tokens, len({_tokens()})::INTEGER AS n FROM documents",
        "tokens_all_stop_words": f"SELECT doc_id, array_to_string({_tokens(stop_words=STOP_WORDS)}, ' ') AS tokens FROM documents",
        "tokens_second_removal": f"SELECT doc_id, array_to_string({_tokens(stop_words=STOP_WORDS)}, ' ') AS tokens FROM documents",
        "development_csv": f"WITH {DEV} SELECT doc_id, text, class FROM dev",
        "evaluation_csv": f"WITH {EVA} SELECT doc_id, text FROM eva",
        "itemset_sink": f"SELECT items AS itemsets, support FROM ({ITEMSETS})",
        "experiment_log_sink": f"""SELECT config_id AS "CONFIG_ID", classifier AS "CLASSIFIER", max_df AS "MAX_DF", min_df AS "MIN_DF",
  f1_weighted AS "F1_WEIGHTED" FROM ({_grid(GRID)})""",
        "tokens_legacy": f"SELECT doc_id, array_to_string({_legacy_tokens()}, ' ') AS tokens FROM documents",
        "emoji_tokens": f"SELECT doc_id, array_to_string({_tokens(with_emoji_sql())}, ' ') AS tokens FROM documents",
        "stop_word_occurrences": f"""WITH t AS (SELECT unnest({_tokens(stop_words=None)}) AS word FROM documents)
SELECT s.word, count(t.word) AS n FROM (SELECT unnest([{', '.join(_literal(w) for w in sorted(KEPT_STOP_WORDS))}]) AS word) s
LEFT JOIN t ON s.word = t.word GROUP BY s.word""",
        "legacy_word_set": f"SELECT DISTINCT unnest({_legacy_tokens()}) AS word FROM documents",
        "top_words": f"""WITH {DEV}, {WORDS}
SELECT word, count(*) AS n FROM wd GROUP BY word ORDER BY n DESC, word LIMIT 30""",
        "top_words_by_class": f"""WITH {DEV}, {WORDS}
SELECT word, count(*) AS count, count_if(class = 'neg')::BIGINT AS neg_count, count_if(class = 'pos')::BIGINT AS pos_count,
       round(count_if(class = 'neg') / (SELECT count_if(class = 'neg') FROM dev), 6) AS neg_rate,
       round(count_if(class = 'pos') / (SELECT count_if(class = 'pos') FROM dev), 6) AS pos_rate
FROM wd GROUP BY word ORDER BY count DESC, word LIMIT 30""",
        "given_word_df": f"""WITH {DEV}, {WORDS},
g AS (SELECT unnest(range({len(GIVEN_WORDS)}))::INTEGER AS position, unnest([{', '.join(_literal(w) for w in GIVEN_WORDS)}]) AS word)
SELECT g.position, g.word, count(*) FILTER (class = 'neg') AS neg, count(*) FILTER (class = 'pos') AS pos
FROM g LEFT JOIN wd ON g.word = wd.word GROUP BY g.position, g.word""",
        "emoji_by_class": _emoji_by_class(),
        "frequent_itemsets": ITEMSETS,
        "random_reviews": f"SELECT md5('7-' || doc_id) AS shuffle_key, doc_id, array_to_string({_legacy_tokens()}, ' ') AS tokens FROM documents",
        "ngram_counts": f"WITH {_term_rows('documents', 'tt')} SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM tt GROUP BY term",
        "df_pruned_vocab": f"""WITH {_tfidf(0.5, 2)} SELECT term, df FROM vocab""",
        "max_features_vocab": f"""WITH {_tfidf(0.5, 2)}
SELECT tt.term, count(*) AS df, sum(tf)::BIGINT AS cf FROM tt JOIN vocab ON tt.term = vocab.term GROUP BY tt.term ORDER BY cf DESC, tt.term LIMIT 500""",
        "vocabulary_size": f"WITH {_tfidf()} SELECT count(*) AS n FROM vocab",
        "tfidf_weights": f"WITH {_tfidf()} SELECT doc_id, class, term, round(w, 6) AS w FROM w",
        "maxabs_scaled": _scaled("max(abs(w)) AS m", "w.w / m"),
        "minmax_scaled": _scaled(
            f"CASE WHEN count(*) < {N} THEN least(min(w), 0.0) ELSE min(w) END AS lo, CASE WHEN count(*) < {N} THEN greatest(max(w), 0.0) ELSE max(w) END AS hi",
            "(w.w - lo) / CASE WHEN hi > lo THEN hi - lo ELSE 1.0 END",
        ),
        "standard_scaled": _scaled(
            f"sqrt(greatest(sum(w * w) / {N} - pow(sum(w) / {N}, 2), 0.0)) AS s", "w.w / CASE WHEN s > 0 THEN s ELSE 1.0 END"
        ),
        "robust_scaled": ROBUST,
        "chi2_top_terms": CHI2,
        "mnb_predict": MULTINOMIAL,
        "cnb_predict": COMPLEMENT,
        "gnb_predict": GAUSSIAN,
        "knn_predict": _knn(),
        "scored_export": f"""WITH p AS ({COMPLEMENT})
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS "Id", predicted AS "Predicted" FROM p""",
        "stratified_folds": f"WITH {DEV}, {FOLDS} SELECT doc_id, class, fold FROM folds",
        "fold_idf": f"WITH {_fold_vocab()} SELECT held::INTEGER AS fold, term, round(idf, 6) AS idf FROM fv",
        "oof_predictions": f"WITH {_out_of_fold('complement')} SELECT doc_id, class, fold, predicted FROM oof",
        "confusion_matrix": f"""WITH {_out_of_fold('complement')},
l AS (SELECT DISTINCT class FROM oof)
SELECT a.class, b.class AS predicted, count(oof.doc_id) AS n
FROM l a CROSS JOIN l b LEFT JOIN oof ON oof.class = a.class AND oof.predicted = b.class GROUP BY a.class, b.class""",
        "fold_f1_weighted": f"WITH {_out_of_fold('complement')}, {F1} SELECT fold, round(f1, 6) AS f1_weighted FROM ff",
        "cv_f1_weighted": f"WITH {_out_of_fold('complement')}, {F1} SELECT count(*) AS folds, round(avg(f1), 6) AS f1_weighted FROM ff",
        "param_grid": f"""WITH {DEV}
SELECT (row_number() OVER (ORDER BY c.C, l.i DESC, d.max_df, m.min_df) - 1)::INTEGER AS config_id, c.C::DOUBLE AS "C", 1 AS ngram_1, 2 AS ngram_2,
  l.loss, d.max_df::DOUBLE AS max_df, m.min_df::DOUBLE AS min_df, 0.000001::DOUBLE AS tol, (SELECT count(*) FROM dev) AS texts
FROM (VALUES (2.0), (2.5), (3.0)) c(C), (VALUES (1, 'hinge'), (2, 'squared_hinge')) l(i, loss), (VALUES (0.5), (0.8)) d(max_df), (VALUES (1), (2)) m(min_df)""",
        "grid_search": _grid(GRID),
        "best_config": f"""WITH g AS ({_grid(GRID)})
SELECT * FROM g ORDER BY f1_weighted DESC, config_id LIMIT 1""",
    }
