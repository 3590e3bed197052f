"""Conversation repair, Merkle manifest and the language model against brute force."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opinia.llm import catalog, conversations, kneser_ney, manifest, words

FOLDER = "/root/testdata/sf0.001"
NEXT = {"E": "U", "S": "U", "U": "A", "A": "U"}
KEPT = {("E", "s"): "S", ("E", "u"): "U", ("S", "u"): "U", ("U", "a"): "A", ("A", "u"): "U"}
NAME = {"U": "user", "A": "assistant"}


def odd_columns(frame):
    for name in ("row", "gone", "key", "first", "at", "n", "tree", "chunk", "leaf", "path", "word", "total", "shard"):
        frame = frame.withColumn(name, F.lit(1))
    return frame


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


# Conversations


def cheapest(rows):
    """(cost, audit, lines) by a search over (row, state), cheapest and then first by ASCII."""
    heap, done = [(0, "", 0, "E", ())], set()
    while True:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in "EA":
            return cost, audit, lines
        heapq.heappush(heap, (cost + 2, audit + "I", i, NEXT[state], (*lines, NAME[NEXT[state]] + ":")))
        if i < len(rows):
            role, text, must, short = rows[i]
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, state, lines))
            if not must:
                heapq.heappush(heap, (cost + 2 + short, audit + "R", i + 1, NEXT[state], (*lines, f"{NAME[NEXT[state]]}:{text}")))
                if (state, role[:1]) in KEPT:
                    heapq.heappush(heap, (cost + short, audit + "K", i + 1, KEPT[state, role[:1]], (*lines, f"{role}:{text}")))


def repaired_by_hand(rows):
    found = {}
    for conv, turn, role, text in rows:
        held = found.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        chance = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if chance == 0:
            continue
        text = "" if chance == 1 else re.sub("[.!?]", "", text) if chance == 2 else text
        held += [(turn, "user" if chance == 4 else role, text)] * (2 if chance == 3 else 1)
    out = []
    for conv, held in found.items():
        held.sort(key=lambda h: (h[0] is not None, h[0] or 0, h[1].encode(), h[2].encode()))
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults, seen, marked = Counter(), set(), []
        for _, role, text in held:
            visible = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        cost, audit, lines = cheapest(marked)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest))
    return out


def test_block_tables_find_the_first_of_the_cheapest_audits():
    rng, tables = random.Random(1), conversations.tables()
    assert len(tables.blocks[0]) == conversations.SYMBOLS**conversations.BLOCK
    for _ in range(2000):
        rows = [(rng.choice("suauaox"), "", rng.random() < 0.2, rng.random() < 0.3) for _ in range(rng.randint(0, 14))]
        symbols = bytes(conversations.MUST_GO if must else conversations.symbol(role, short) for role, _, must, short in rows)
        assert tables.audit(symbols) == cheapest(rows)[:2]


def conversation_frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.fixture(scope="module")
def strange_conversations():
    rng = random.Random(2)
    roles = ["user", "assistant", "system", "tool", "", None, "usr", "User"]
    texts = ["a.", "b", " ", "", None, "c!\n", "Was? ", ".\t\x0b", "long " * 5000, "é."]
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for _ in range(500)]
    # One long conversation of copies, and one of a single text.
    rows += [(100, i, "user" if i % 2 == 0 else "assistant", f"x{i % 300}.") for i in range(1500)]
    return rows + [(101, i, "user", "same.") for i in range(300)] + [(102, -(2**63), "user", "a."), (102, 2**63 - 1, "assistant", "b.")]


def test_conversation_reports(spark, strange_conversations):
    got = [tuple(r) for r in conversations.damage_and_repair(odd_columns(conversation_frame(spark, strange_conversations))).collect()]
    expected = repaired_by_hand(strange_conversations)
    expected = [(*r[:1], min(r[1], 2**63 - 1), *r[2:]) for r in expected]
    assert in_order(got) == in_order(expected)
    assert conversations.damage_and_repair(conversation_frame(spark, [])).collect() == []


def test_conversation_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = [tuple(r) for r in catalog.queries()["op11_conversations"](spark, FOLDER).collect()]
    assert in_order(got) == in_order(repaired_by_hand(rows))


def test_repaired_turns_are_sound(spark, strange_conversations):
    rows = conversations.repair(conversation_frame(spark, strange_conversations)).orderBy("conv_id", "place").collect()
    found = defaultdict(list)
    for r in rows:
        assert r["place"] == len(found[r["conv_id"]])
        assert (r["turn"] is None and r["text"] == "") if r["edit"] == "I" else r["edit"] in "KR"
        found[r["conv_id"]].append(r["role"])
    for roles in found.values():
        assert re.fullmatch("s?(ua)+", "".join(role[0] for role in roles))


# Manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def manifest_by_hand(rows):
    def leaf(r, text):
        values = [r[0], r[3], r[2], r[4], text]
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    def tree(nodes):
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, p in enumerate(at):
                first = p // 8 * 8
                paths[i].append(("".join(nodes[first:p]), "".join(nodes[p + 1 : first + 8])))
                at[i] = p // 8
            nodes = [sha(*nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
        return nodes[0], paths

    trees = defaultdict(list)
    for r in rows:
        trees[r[2]].append((r, leaf(r, r[1])))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    inner = []
    for name in names:
        leaves = sorted(trees[name], key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        inner.append((leaves, *tree([h for _, h in leaves])))
    root, outer = tree([subroot for _, subroot, _ in inner]) if inner else (None, [])
    out = []
    for k, (leaves, subroot, paths) in enumerate(inner):
        for (r, h), path in zip(leaves, paths):
            path = path + outer[k]
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            lower = None if r[1] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
            folded = leaf(r, lower) if tampered else h
            for before, after in path:
                folded = sha(before, folded, after)
            out.append((r[0], h, subroot, root, sha(*[b + a for b, a in path]), folded, folded == root))
    return out


@pytest.mark.parametrize("n, languages", [(0, ["en"]), (1, ["en"]), (700, [None, "", "é", "en", "z", "Z"]), (9000, ["x", "y"]), (200, [f"l{i}" for i in range(70)])])
def test_manifest(spark, n, languages):
    rng = random.Random(n)
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "abc", f"Déjà Vu {i}", "x" * rng.randint(0, 50)])
        doc_id = i if rng.random() < 0.7 else rng.choice([None, rng.randint(0, n)])
        rows.append((doc_id, text, rng.choice(languages), rng.choice(["s", None, "Web"]), rng.choice([None, 3])))
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = [tuple(r) for r in manifest.verified_manifest(odd_columns(frame)).collect()]
    assert in_order(got) == in_order(manifest_by_hand(rows))


def test_manifest_finds_what_was_tampered_with(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = manifest.verified_manifest(documents).collect()
    # A text without capital letters is the same afterwards.
    touched = {r["doc_id"] for r in documents.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and re.search("[A-Z]", r["text"])}
    assert len({r["root"] for r in rows}) == 1 and {r["doc_id"] for r in rows if not r["verified"]} == touched


# Language model


def tokens_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def scores_by_hand(rows):
    def held(i):
        return i is not None and zlib.crc32(str(i).encode()) % 10 == 0

    pairs = Counter()
    for i, text in rows:
        if i is not None and not held(i):
            line = ["<s>", *tokens_of(text), "</s>"]
            pairs.update(zip(line, line[1:]))
    followers, preceded = defaultdict(Counter), Counter()
    for (a, b), c in pairs.items():
        followers[a][b] = c
        preceded[b] += 1
    count = {a: sum(f.values()) for a, f in followers.items()}
    count["</s>"] = count.get("<s>", 0)
    n, v = sum(c for w, c in count.items() if w != "<s>"), len(preceded)

    def discounts(values):
        return kneser_ney.discounts([sum(x == k for x in values) for k in range(1, 5)])

    d, e, whole = discounts(pairs.values()), discounts(preceded.values()), sum(preceded.values())
    unseen = (sum(e[min(c, 3)] for c in preceded.values()) / whole if whole else 1) / (v + 1)
    back = {a: sum(d[min(c, 3)] for c in f.values()) / count[a] for a, f in followers.items()}

    def lower(w):
        return (preceded[w] - e[min(preceded[w], 3)]) / whole + unseen if preceded[w] else unseen

    def p(a, b):
        if a not in followers:
            return lower(b)
        c = followers[a][b]
        return (c - d[min(c, 3)]) / count[a] + back[a] * lower(b)

    out = []
    for i, text in rows:
        line = ["<s>", *tokens_of(text), "</s>"]
        base = sum(math.log10((count.get(b, 0) + 0.1) / (n + 0.1 * (v + 1))) for b in line[1:])
        known = sum(count.get(b, 0) > 0 for b in line[1:])
        out.append((i, held(i), len(line) - 1, known, n, base, sum(math.log10(p(a, b)) for a, b in zip(line, line[1:]))))
    # What a seen word leaves to all words sums up to one.
    for a in list(followers)[:3]:
        assert sum(p(a, b) for b in preceded) + back[a] * unseen == pytest.approx(1.0)
    return out


@pytest.mark.parametrize("case", ["empty", "nothing to learn", "strange", "documents"])
def test_language_model(spark, case):
    rng = random.Random(4)
    rows = {
        "empty": [],
        "nothing to learn": [(None, "a b"), (None, None)],
        "strange": [(i, rng.choice([None, "", "a b", "A  b\tc\x0bÉ É", "the the the x", "\x1c\x85 z", "y " * 400])) for i in range(60)] + [(None, "a b z"), (3, "a"), (3, "a")],
        "documents": [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()],
    }[case]
    frame = odd_columns(spark.createDataFrame(rows, "doc_id long, text string"))
    got = in_order([tuple(r)[:7] for r in kneser_ney.language_model_scores(frame).collect()])
    expected = in_order(scores_by_hand(rows))
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    for g, e in zip(got, expected):
        assert g[5:] == pytest.approx(e[5:], rel=1e-9, abs=1e-9)


def test_words_are_cut_in_blocks_of_any_size(monkeypatch):
    texts = ["one two  three", "", None, "x" * 300, "a " * 200 + "b" * 90, " lead and trail ", "É é\tA"]
    column = pa.array(texts)
    whole = [g for g in kneser_ney.grams_of(column)]
    monkeypatch.setattr(words, "BLOCK_BYTES", 64)
    parts = [g for g in kneser_ney.grams_of(column)]
    assert len(parts) > len(whole)

    def rows(found):
        return [(t, a, b) for g in found for t, a, b in zip(g.text.tolist(), g.first.tolist(), g.second.tolist())]

    assert rows(parts) == rows(whole) and len(rows(whole)) == sum(len(tokens_of(t)) + 1 for t in texts)


def test_pairs_survive_packing():
    import numpy as np

    rng = np.random.default_rng(1)
    first = np.sort(rng.integers(0, 40, 5000).astype(np.uint64))
    second, n = rng.integers(0, 1 << 63, 5000, dtype=np.uint64), rng.integers(1, 1000, 5000)
    for got, sent in zip(kneser_ney.unpacked(kneser_ney.packed(first, second, n)), (first, second, n)):
        assert np.array_equal(got, sent)
