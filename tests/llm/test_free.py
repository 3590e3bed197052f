"""The operators that run Python in tasks, against brute force, exact round trips and held-out accuracy."""

import collections
import hashlib
import html as entities
import math
import random
import re
import string
import time
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from opinia.llm import bpe, catalog, html, language, packing, pii, simhash

FOLDER = "/root/testdata/sf0.001"
NAMES = ("_row", "found", "fp", "row", "hash", "spans", "added", "place", "group", "ids")
STRANGE = [
    "a", "B", "É", "é", "Σ", "ς", "İ", "ß", " ", "\n", "\x1c", "\x85", "\xa0", "'s", "'T", "1", "２", "½", "Ⅷ", "_", "-", "😀", "한",
    "<|endoftext|>", "<|startoftext|>", "<|", "ﬁ", "ا", "​", "\x00", "क़",
]


def with_odd_columns(frame):
    for name in NAMES:
        frame = frame.withColumn(name, F.lit(1))
    return frame


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(catalog.vocabulary())


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def strange_texts(n):
    rng = random.Random(1)
    return ["".join(rng.choice(STRANGE) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_codes_equal_the_library(tokenizer):
    codec, packer = bpe.Codec(catalog.vocabulary()), packing.WordEncoder(catalog.vocabulary())
    for text in [*strange_texts(3000), "word " * 500, "x" * 3000]:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert list(codec.encode(text)) == ids
        assert list(packer.packed(pa.array([text]))) == [np.array(ids, "<u4").tobytes()]
        assert codec.decode(ids) == tokenizer.decode(ids, skip_special_tokens=False)


def test_long_words_take_the_same_merges(tokenizer):
    rng = random.Random(2)
    codec = bpe.Codec(catalog.vocabulary())
    for alphabet in ("ab", "etaoinshr", "กขคงจฉช", "的一是不了人我", string.ascii_lowercase):
        word = "".join(rng.choices(alphabet, k=2000))
        assert list(codec.encode(word)) == tokenizer.encode(word, add_special_tokens=False).ids
    start = time.monotonic()
    codec.encode("".join(rng.choices(string.ascii_lowercase, k=200_000)))
    assert time.monotonic() - start < 20


def test_code_digests(spark, documents, tokenizer):
    extra = spark.createDataFrame([(-1, None), (-2, ""), (-3, "twice"), (-3, "twice")], "doc_id long, text string")
    rows = bpe.code_digests(with_odd_columns(documents.select("doc_id", "text").union(extra)), catalog.vocabulary()).collect()
    texts = {r.doc_id: r.text or "" for r in documents.collect()} | {-1: "", -2: "", -3: "twice"}
    assert len(rows) == documents.count() + 4
    for r in rows:
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_encode_and_decode_round_trip(spark, tokenizer):
    frame = spark.createDataFrame([("it's the end",), (None,), ("",)], "text string")
    coded = bpe.decode(bpe.encode(frame, catalog.vocabulary()), catalog.vocabulary())
    rows = coded.collect()
    assert rows[0].ids == tokenizer.encode("it's the end", add_special_tokens=False).ids
    assert rows[0].decoded == tokenizer.decode(rows[0].ids) and rows[1].ids == [] and rows[2].decoded == ""


def test_first_fit_takes_the_first_sequence_with_room():
    rng = random.Random(4)
    for _ in range(50):
        lengths = [rng.randint(1, 64) for _ in range(rng.randint(1, 60))]
        free, expected = [], {}
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            at = next((k for k, room in enumerate(free) if room >= lengths[i]), len(free))
            if at == len(free):
                free.append(64)
            expected[i] = (at, 64 - free[at])
            free[at] -= lengths[i]
        assert packing.first_fit_decreasing(lengths, 64) == [expected[i] for i in range(len(lengths))]


def test_words_of_letters_are_told_apart_as_arrays(monkeypatch, tokenizer):
    packer, asked = packing.WordEncoder(catalog.vocabulary()), []
    one_by_one = packer.new_codes
    monkeypatch.setattr(packer, "new_codes", lambda words: asked.extend(words) or one_by_one(words))
    texts = ["Straße, ÀÉÎÕÜÝÞß ÿ? Niño; a×b ÷ x1 naïve! ŁÓDŹ d'Été", "È, É. è; é"]
    for text, found in zip(texts, packer.packed(pa.array(texts))):
        assert np.frombuffer(found, np.uint32).tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert sorted(asked) == sorted(["a×b", "÷", "x1", "ŁÓDŹ", "d'Été"])


def test_words_that_a_worker_keeps_take_few_bytes(monkeypatch, tokenizer):
    packer = packing.WordEncoder(catalog.vocabulary())
    monkeypatch.setattr(packing, "RECENT_WORDS", 1000, raising=False)
    rng = random.Random(5)
    words = ["".join(rng.choices(string.ascii_lowercase, k=9)) for _ in range(20_000)]
    texts = [" ".join(words[at : at + 500]) for at in range(0, len(words), 500)] * 2
    list(packer.packed(pa.array(["warm up"])))
    tracemalloc.start()
    for text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids if text is texts[0] else None
        found = np.frombuffer(next(packer.packed(pa.array([text]))), np.uint32).tolist()
        assert ids is None or found == ids
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 70 * len(words)
    # Those that are known are not asked for again, and have the same ids.
    monkeypatch.setattr(packer, "fresh_codes", None)
    assert np.frombuffer(next(packer.packed(pa.array([texts[7]]))), np.uint32).tolist() == tokenizer.encode(texts[7], add_special_tokens=False).ids


def test_packing_places_every_id_once(spark, documents, tokenizer):
    extra = spark.createDataFrame([(-1, None), (-2, ""), (-4, "w " * 9000)], "doc_id long, text string")
    rows = packing.pack(with_odd_columns(documents.select("doc_id", "text").union(extra)), catalog.vocabulary()).toPandas()
    texts = {r.doc_id: r.text for r in documents.collect()} | {-1: "", -2: "", -4: "w " * 9000}
    assert set(rows.doc_id) == set(texts)
    for doc_id, pieces in rows.sort_values("start").groupby("doc_id"):
        ids = np.array([*tokenizer.encode(texts[doc_id], add_special_tokens=False).ids, 2], "<u4")
        assert (pieces.doc_tokens == len(ids)).all() and pieces.length.sum() == len(ids)
        assert list(pieces.start) == [0, *np.cumsum(pieces.length)[:-1]]
        for p in pieces.itertuples():
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    for _, pieces in rows.sort_values("offset").groupby("sequence_id"):
        assert list(pieces.offset) == [0, *np.cumsum(pieces.length)[:-1]] and pieces.length.sum() <= packing.SEQUENCE
    assert rows.sequence_id.nunique() <= 1.02 * -(-rows.length.sum() // packing.SEQUENCE) + 1


def test_code_lengths_equal_the_trees(spark):
    known = {"a": ["hello there world", "the cat sat on the mat", "hello there the the"], "b": ["bonjour le monde", "le chat est là là là", "le le monde"]}
    frame = spark.createDataFrame([(k, t) for k, ts in known.items() for t in ts], "lang string, text string")
    table = language.code_table(language.context_counts(frame).toPandas())
    counts = {k: [collections.defaultdict(collections.Counter) for _ in range(4)] for k in known}
    everywhere = [collections.Counter() for _ in range(4)]
    for k, ts in known.items():
        for data in (t.encode() for t in ts):
            for size in range(4):
                for i in range(size, len(data)):
                    counts[k][size][data[i - size : i]][data[i]] += 1
                    everywhere[size][data[i - size : i]] += 1

    def chance(k, data, i, size):
        if size < 0:
            return 1 / 256
        context = data[i - size : i]
        followers = counts[k][size].get(context)
        if size > i or not followers or size and everywhere[size][context] < language.LEAST_SEEN:
            return chance(k, data, i, size - 1)
        n, q = sum(followers.values()), len(followers)
        return followers[data[i]] / (n + q) if data[i] in followers else q / (n + q) * chance(k, data, i, size - 1)

    for text in ("the monde là", "zzz hello", "bonjour", "ÿ"):
        data = text.encode()
        expected = [-sum(math.log2(chance(k, data, i, 3)) for i in range(len(data))) for k in sorted(known)]
        assert table.code_lengths(text) == pytest.approx(expected, rel=1e-5)


def test_language_of_held_out_documents(spark, empty):
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet").unionByName(
        spark.createDataFrame([(-1, None, "de", "s", 0), (-2, "12 !", "de", "s", 4), (None, "der die das", None, "s", 11)], empty.schema)
    )
    rows = language.language_predictions(with_odd_columns(documents)).toPandas()
    assert len(rows) == documents.count()
    truth = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    held = rows[rows.held_out & (rows.doc_id >= 0)]
    assert all(zlib.crc32(str(int(i)).encode()) % 3 == 1 for i in held.doc_id)
    assert np.mean([truth[i] == p for i, p in zip(held.doc_id, held.lang_pred)]) > 0.98
    assert rows.score.between(0, 1).all()
    odd = rows[rows.doc_id.isin([-1, -2])]
    assert (odd.lang_pred == "und").all() and (odd.score == 0).all()
    kept = language.with_known_language(with_odd_columns(documents))
    assert set(kept.columns) >= {*documents.columns, *NAMES} and kept.where("doc_id in (-1, -2)").isEmpty()
    assert kept.count() >= 0.99 * documents.count()


def simhash_of(text):
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("crowded", [simhash.CROWDED, 0])
def test_near_duplicates_equal_all_pairs(spark, documents, crowded):
    extra = [(5000, None), (5001, ""), (5002, "a"), (5003, "A  a"), (5004, "a\ta"), (5005, "a a b"), (None, "a a b"), (5005, "a a b"), (5006, "É é")]
    frame = documents.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    rows = frame.collect()
    prints = np.array([simhash_of(r.text) for r in rows], np.uint64)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 3):
            root[find(i)] = find(int(j))
    least = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[find(i)] = min(least.get(find(i), r.doc_id), r.doc_id)
    expected = collections.Counter((r.doc_id, format(int(p), "016x"), least[find(i)]) for i, (r, p) in enumerate(zip(rows, prints)))
    found = simhash.near_duplicates(with_odd_columns(frame), crowded=crowded).collect()
    assert collections.Counter(map(tuple, found)) == expected
    kept = simhash.one_of_each(with_odd_columns(frame)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(set(least.values()))


def test_anchors_cover_all_pairs_within_three_bits():
    rng = np.random.default_rng(2)
    one = rng.integers(0, 1 << 31, 500)
    for flip in (0, *(1 << np.arange(31))):
        near = {int(r): set() for r in range(500)}
        home = {}
        for rows, anchors, at_home in simhash.anchors_near(one):
            for r, a in zip(rows, anchors):
                near[int(r)].add(int(a))
                if at_home:
                    home[int(r)] = int(a)
        (_, homes, _), *_ = simhash.anchors_near(one ^ flip)
        assert all(int(homes[r]) in near[r] for r in range(500))
        assert all(bin(int(one[r]) ^ home[r]).count("1") <= 1 and len(near[r]) <= 16 for r in range(500))


def base_spans(text):
    text = text or ""
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m[0])
        doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(digits[::-1])]
        if 12 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0:
            found.append(("card", *m.span()))
    found += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub(r"\D", "", m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_spans():
    rng = random.Random(2)
    parts = [*"ab1234.@+- ()%_é😀\n", "4539578763621486", "4539 5787-6362 1486", "1.2.3.4", "999.1.1.1", "a@b.c", "+49 (30) 123.456-7", "@", ".."]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == base_spans(text)


def test_personal_data_and_disclosing_terms(spark, documents):
    tale = [f"Nachbar {a} wohnt neben zorblax am {b} Platz, Post an bob@mail.example.org bitte." for a, b in zip(["rot", "blau", "gelb"], ["alten", "neuen", "hohen"])]
    extra = [None, "", "12", *tale, *tale, "Platz ohne Nachbar"] + ["der Platz dort"] * 40
    frame = documents.unionByName(spark.createDataFrame([(-i - 1, t, "de", "s", len(t or "")) for i, t in enumerate(extra)], documents.schema))
    texts = {r.doc_id: r.text for r in frame.collect()}
    rows = {r.doc_id: r for r in pii.personal_data(with_odd_columns(frame)).collect()}
    assert len(rows) == len(texts)
    copies = collections.Counter(t or "" for t in texts.values())
    entities_of = {t: {pii.entity_key(k, t[s:e]) for k, s, e in base_spans(t)} for t in copies}
    n_t, n_e, n_te, k_e, k_te = (collections.Counter() for _ in range(5))
    for t, m in copies.items():
        n_t.update({w: m for w in set(pii.TERM.findall(t.lower()))})
        for e in entities_of[t]:
            n_e[e] += m
            k_e[e] += 1
            for w in {w for w, _, _ in pii.free_terms(t, base_spans(t))}:
                n_te[e, w] += m
                k_te[e, w] += 1
    told = collections.defaultdict(set)
    for (e, w), n in n_te.items():
        if k_te[e, w] >= 3 and math.log2(n * len(texts) / (n_t[w] * n_e[e])) / math.log2(len(texts) / n_e[e]) >= pii.GENERALISE:
            told[e].add(w)
    assert told == {"email:bob@mail.example.org": {"wohnt", "neben", "zorblax", "post", "bitte"} | told["email:bob@mail.example.org"] & {"nachbar"}}
    for i, t in texts.items():
        base = base_spans(t)
        added = [(s, "term:%d:%d" % (s, e)) for w, s, e in pii.free_terms(t or "", base) if any(w in told[x] for x in entities_of[t or ""])]
        named = [(s, "%s:%d:%d" % (k, s, e)) for k, s, e in base]
        r = rows[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in base) for k in pii.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(n for _, n in named).encode()).hexdigest()
        assert sorted(r.spans.split(",")) == sorted(n for _, n in named + added) or r.spans == "" and not named + added
    cleaned = {r.doc_id: r for r in pii.without_personal_data(with_odd_columns(frame)).collect()}
    for i, t in texts.items():
        if entities_of[t or ""]:
            assert not any(t[s:e] in cleaned[i].text for _, s, e in base_spans(t)) and cleaned[i].n_chars == len(cleaned[i].text)
        else:
            assert cleaned[i].text == t
    assert "zorblax" not in cleaned[-4].text and "[EMAIL]" in cleaned[-4].text


def test_main_text_is_the_article(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    sources = {r.page_id: r.html for r in pages.collect()}
    for r in html.extract(with_odd_columns(pages)).collect():
        article = re.search(r"<article>(.*)</article>", sources[r.page_id], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article.replace("<br>", " ")))
        assert r.text == "\n".join(filter(None, (re.sub(r"\s+", " ", entities.unescape(p)).strip() for p in parts)))
        assert r.n_chars == len(r.text)


def test_main_text_without_an_article_element():
    page = """<html><head><title>t</title></head><body><header><h1>Site</h1></header><nav><a href=x>Home</a></nav>
    <div class="cookie-notice"><p>We use cookies, to serve you. Accept them all, please, now.</p></div>
    <div id=content><h1>Title here</h1><p>First paragraph of text, long enough to count. It goes on.</p>
    <ul><li>One thing, maybe two.</li><li>Another thing, or so.</li></ul><p>Second paragraph &amp; more text&nbsp;here, with&#8212;dash.</p>
    <form><p>Sign up now.</p><input></form><div class=comments><p>I like this, it is so good. Thanks a lot.</p></div></div>
    <script>var x = "<p>no</p>"</script><aside>Related stuff</aside><footer>c 2020, all rights reserved.</footer></body>"""
    assert html.main_text(page).split("\n") == [
        "Title here", "First paragraph of text, long enough to count. It goes on.", "One thing, maybe two.", "Another thing, or so.",
        "Second paragraph & more text here, with—dash.",
    ]
    assert [html.main_text(x) for x in (None, "", "plain text", "<p", "<!-- x", "<b>x", "a<b")] == ["", "", "plain text", "<p", "", "x", "a<b"]


def test_empty_tables(spark, empty):
    assert packing.pack(empty, catalog.vocabulary()).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert language.language_predictions(empty).count() == 0
    assert pii.personal_data(empty).count() == 0
    from opinia.llm import merkle, quality, secret_scan, urls

    assert quality.quality_report(empty).count() == 0
    assert merkle.edited_fingerprints(empty).count() == 0
    assert secret_scan.scan(empty).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html.extract(pages).count() == 0
    assert urls.judge(pages, spark.createDataFrame([], "host string, path string, verdict string")).count() == 0


def test_pipeline_stages_take_effect(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, FOLDER).cache()
        assert docs.columns == documents.columns and docs.count() <= before.count(), name
        assert docs.select("doc_id").distinct().count() == docs.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}
    assert corpus_pipeline.run(spark, FOLDER).count() == pieces.count()
    good = spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 0")
    assert docs.join(good, "doc_id", "left_semi").isEmpty()


def test_pii_detector_holds_few_rows_at_a_time(spark, monkeypatch):
    """Spans of a batch are passed on in small parts, complete and in order (op2 failed by executor memory)."""
    monkeypatch.setattr(pii, "FOUND_ROWS", 3)
    texts = [None if i % 7 == 0 else f"nr {i} mail u{i}@ex{i % 3}.org " if i % 2 else f"nothing {i}" for i in range(50)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = frame.select("doc_id", "text", pii.detector()("text").alias("found")).collect()
    assert len(rows) == 50
    for r in rows:
        base = pii.base_spans(r.text or "")
        assert [tuple(s) for s in r.found.spans] == base
        assert (r.found.hash is None) == (not base)
        assert r.found.entities == (sorted({pii.entity_key(k, r.text[s:e]) for k, s, e in base}) if base else None)
