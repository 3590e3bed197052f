"""Cases that a review of the training-text operators brought up."""

import random
import re

from xxhash import xxh64_intdigest

import corpus_pipeline
from opinia.llm import html

FOLDER = "/root/testdata/sf0.001"


def fingerprint(text):
    """64 majority bits over the hashes of all runs of three words, repeats included."""
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(run.encode(), 42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicate_stage_keeps_one_of_each_group(spark):
    rng = random.Random(3)
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in documents.collect() if len(r.text.split()) <= 2000][:60]
    edited = []
    for k, (doc_id, text, lang, source, _) in enumerate(rows):
        words = text.split()
        for at in rng.sample(range(len(words)), min(len(words), k % 3)):
            words[at] = f"w{rng.randrange(10**9)}"
        near = " ".join(words)
        edited.append((100_000 + doc_id, near, lang, source, len(near)))
    given = rows + edited
    prints = {r[0]: fingerprint(r[1]) for r in given}
    group = {i: i for i in prints}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in prints:
        for j in prints:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= 3:
                one, two = sorted((root(i), root(j)))
                group[two] = one
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(given, documents.schema), FOLDER).collect()
    assert sorted(r.doc_id for r in kept) == sorted(i for i in prints if root(i) == i)
    # Unedited copies, a third of all, are gone.
    assert len(kept) <= len(given) - len(rows) // 3
    assert {tuple(r) for r in kept} <= set(given)


def test_short_lists_and_table_cells_of_an_article_stay():
    long = "".join(f"<p>{c * 290}, and on.</p>" for c in "abcde")
    items = [f"item {i} is short" for i in range(4)]
    listed = "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
    table = "<table>" + "".join(f"<tr><td>cell {i} here</td></tr>" for i in range(4)) + "</table>"
    for before, after in (("<article>", "</article>"), ("<main><article>", "</article></main>"), ("<div id=x>", "</div>"), ("", "")):
        page = f"<html><body><nav><a href=x>Home</a></nav>{before}{long}{listed}{table}{after}<footer>c 2020</footer></body></html>"
        lines = html.main_text(page).split("\n")
        assert len(lines) == 13 and lines[5:9] == items and lines[9:] == [f"cell {i} here" for i in range(4)], before


def test_names_of_enclosing_elements_and_unclosed_tags_lose_no_text():
    text = ["First paragraph of text, long enough to count. It goes on.", "Second paragraph, with more to say. It ends."]
    body = "".join(f"<p>{t}</p>" for t in text)
    beside = '<div class="sidebar"><p>Related, short.</p></div>'
    for page in (
        f'<html><body class="no-sidebar"><article>{body}</article>{beside}</body></html>',
        f'<html class="has-header"><body><div class="content with-sidebar">{body}</div>{beside}</body></html>',
        f'<body><div id="page" class="has-header"><main>{body}</main>{beside}</div></body>',
        f'<body><article><svg viewBox="0 0 1 1"/>{body}</article></body>',
        f"<body><article><iframe src=x>{body}</article></body>",
        f"<body><article><button>{body}</article></body>",
        f"<body><article><svg><text>no</text></svg>{body}<select><option>no</select></article></body>",
    ):
        assert html.main_text(page).split("\n") == text, page
    assert html.main_text("<p>a<script>b") == "a"


def test_tags_around_the_main_text_do_not_exclude_it():
    long = "A sentence of the article, with a comma in it, goes on for a while. " * 5
    for page in (
        f'<body><form id="aspnetForm"><main><p>{long}</p></main></form></body>',
        f"<body><form><div><p>{long}</p></div></form><footer>c 2020</footer></body>",
        f'<body><article><p>{long}</p><aside>Aside, short.</aside><form>Sign up, now.</form></article></body>',
        f'<body><div class="main"><p>{long}</p></div><div class="commentlist"><p>I do not agree, at all.</p></div></body>',
        f'<body><article><p>{long}</p></article><dialog><p>Cookies, please.</p></dialog></body>',
    ):
        assert html.main_text(page) == long.strip(), page


def test_quoted_values_and_further_sections_of_an_article():
    long = "A sentence of the article, with a comma in it, goes on for a while. " * 5
    assert html.main_text(f"<article><p>{long}<a title=\"x > y\" data-x='>' href=\"#\">link</a></p></article>").endswith("while. link")
    page = f'<body><div class="one"><p>{long}</p></div><div class="two"><p>{long}</p><ul><li>First</li><li>Second</li></ul></div></body>'
    assert html.main_text(page).split("\n") == [long.strip(), long.strip(), "First", "Second"]


def test_deep_and_broken_pages_take_linear_time():
    for page in ("<div>" * 20_000 + "text" + "</div>" * 20_000, "<div class=ad>" * 20_000 + "text" + "</x></div>" * 20_000):
        assert html.main_text(page) == "text"
    # Nothing here is a tag, so it is text.
    assert html.main_text('<a href="x' * 30_000) == '<a href="x' * 30_000
