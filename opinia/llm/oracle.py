"""Queries of this package as SQL for DuckDB, where SQL can express them."""

from __future__ import annotations

# The rules that op9 applies: (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]

QUALITY = r"""WITH words AS (
  SELECT doc_id, text, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(generate_series(1, len(w) - 7)) AS i, array_to_string(w[i:i + 7], ' ') AS run FROM words WHERE len(w) >= 8),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, run) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(8) AS r(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM documents),
base AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines,
    length(regexp_replace(coalesce(text, ''), '[^\p{Lu}]', '', 'g')) AS n_upper,
    length(regexp_replace(coalesce(text, ''), '[^\p{L}]', '', 'g')) AS n_letters,
    len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutters
  FROM words d JOIN lines USING (doc_id) LEFT JOIN covered c USING (doc_id)),
judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 3 * n_words OR (n_dup_lines >= 3 AND 2 * n_dup_lines > n_lines) OR 2 * n_upper > n_letters
    OR 5 * n_stutters > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words) AS kept
FROM judged"""


def _url_filter() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
    return rf"""WITH rules AS (SELECT * FROM (VALUES {rules}) AS t(rule_host, rule_path, verdict)),
cut AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
fits AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM cut JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM cut LEFT JOIN fits USING (page_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality": QUALITY, "op9_urls": _url_filter()}
