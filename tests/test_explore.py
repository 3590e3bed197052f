import itertools
import math
import random

from collections import Counter
from itertools import combinations

import numpy as np
import pytest

from opinia.operators import explore

LENGTHS = [1, 2, 2, 3, 5, 8, 13, 21, 34, 100]


@pytest.fixture(scope="module")
def sized(spark):
    rows = [(i, "x" * n, "pos" if i % 3 else "neg") for i, n in enumerate(LENGTHS)]
    return spark.createDataFrame(rows, "doc_id long, text string, class string")


def test_class_counts(sized):
    assert {r["class"]: r["n"] for r in explore.class_counts(sized).collect()} == {"pos": 6, "neg": 4, "overall": 10}


def test_histogram(sized):
    counts, edges = np.histogram(LENGTHS, bins=50)
    density, _ = np.histogram(LENGTHS, bins=50, density=True)
    got = explore.length_histogram(sized).orderBy("bin").collect()
    assert [r["n"] for r in got] == counts.tolist()
    np.testing.assert_allclose([r["density"] for r in got], density)
    np.testing.assert_allclose([r["lower"] for r in got], edges[:-1])


def test_histogram_of_one_length(spark):
    docs = spark.createDataFrame([("ab",), ("cd",)], "text string")
    assert [r["n"] for r in explore.length_histogram(docs).orderBy("bin").collect()] == np.histogram([2, 2], bins=50)[0].tolist()


def test_length_statistics(sized):
    row = explore.length_statistics(sized).first()
    assert row["mean"] == pytest.approx(np.mean(LENGTHS))
    assert row["std"] == pytest.approx(np.std(LENGTHS))
    assert row["median"] == np.median(LENGTHS)


def test_boxes(sized):
    row = explore.length_boxes(sized).where("`group` = 'overall'").first()
    q1, median, q3 = np.percentile(LENGTHS, [25, 50, 75])
    inside = [x for x in LENGTHS if q1 - 1.5 * (q3 - q1) <= x <= q3 + 1.5 * (q3 - q1)]
    assert (row["q1"], row["median"], row["q3"]) == (q1, median, q3)
    assert (row["whisker_low"], row["whisker_high"]) == (min(inside), max(inside))


def test_top_and_given_words(reviews):
    top = explore.top_words(reviews, 2).collect()
    assert [(r["word"], r["n"]) for r in top] == [("camera", 15), ("ottima", 15)]
    both = {r["word"]: (r["count"], r["neg_rate"], r["pos_rate"]) for r in explore.top_words_by_class(reviews, 3).collect()}
    assert both["camera"] == (15, 6 / 12, 9 / 18) and both["ottima"] == (15, 0.0, 15 / 18)
    given = explore.given_word_counts(reviews, ["sporca", "niente", "ottima"]).orderBy("position").collect()
    assert [(r["word"], r["neg"], r["pos"]) for r in given] == [("sporca", 12, 0), ("niente", 0, 0), ("ottima", 0, 15)]


def test_emoji_by_class(spark):
    rows = [(1, "👍👍 bene 👏🏻", "pos"), (2, "👎 male", "neg"), (3, "👏 👍 😂", "neg"), (4, "niente", "neg")]
    got = explore.emoji_by_class(spark.createDataFrame(rows, "doc_id long, text string, class string")).collect()
    assert len(got) == 39
    counts = {r["emoji"]: (r["kind"], r["neg_count"], r["pos_count"]) for r in got if r["neg_count"] + r["pos_count"]}
    assert counts == {
        "👍": ("positive", 1, 1), "👏🏻": ("positive", 0, 1), "👎": ("negative", 1, 0), "😂": ("neutral", 1, 0)
    }


def test_frequent_itemsets_against_brute_force(spark):
    baskets = ["pane latte uova", "pane latte", "latte uova uova", "pane burro di", "latte pane uova burro"]
    docs = spark.createDataFrame(list(enumerate(baskets)), "doc_id long, text string")
    got = {tuple(r["items"]): r["support"] for r in explore.frequent_itemsets(docs, 0.4).collect()}
    sets = [{w for w in b.split() if len(w) > 2} for b in baskets]
    counts = Counter(c for s in sets for size in range(1, 5) for c in combinations(sorted(s), size))
    assert got == {c: n / 5 for c, n in counts.items() if n / 5 >= 0.4}


def test_shuffled_listing_is_a_fixed_permutation(reviews):
    one, two = [explore.shuffled_listing(reviews, seed).select("doc_id").collect() for seed in (1, 1)]
    other = explore.shuffled_listing(reviews, 2).select("doc_id").collect()
    assert one == two and one != other and sorted(r["doc_id"] for r in other) == list(range(30))


def test_legacy_word_set(reviews):
    assert explore.legacy_word_set(reviews).count() == len({w for r in reviews.collect() for w in r["text"].split() if len(w) > 1})


def test_itemsets_match_brute_force_and_send_counts_only(spark):
    """Every set of words with enough documents; no transaction is shuffled."""
    rng = random.Random(5)
    words = ["uno", "due", "tre", "quattro", "cinque", "sei", "sette"]
    held = [[w for i, w in enumerate(words) if rng.random() < 0.8 - 0.09 * i] for _ in range(300)]
    docs = spark.createDataFrame([(i, " ".join(h)) for i, h in enumerate(held)] + [(300, None), (301, "")], "doc_id long, text string").repartition(5)
    got = {tuple(r["items"]): (r["freq"], r["support"]) for r in explore.frequent_itemsets(docs, 0.1).collect()}
    want = {}
    for size in range(1, len(words) + 1):
        for items in itertools.combinations(sorted(words), size):
            n = sum(set(items) <= set(h) for h in held)
            if n >= math.ceil(0.1 * 302):
                want[items] = (n, n / 302)
    assert got == want and max(map(len, got)) >= 3
    blocks = spark.createDataFrame([(bytes([0b10100000, 0b11000000]), 2)], "bits binary, items int")
    assert [(r["place"], r["n"]) for r in explore._holders(blocks, [(0, 1)]).collect()] == [(0, 1)]


def test_itemsets_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert explore.frequent_itemsets(docs, 0.2).count() == 0
