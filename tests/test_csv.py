"""The splittable CSV reader against Python's, whatever the cuts."""

import csv
import random

import pytest

from opinia.sources import readers

PIECES = ["a", "é", "👍", '"', "\n", ",", " ", "\n\n", '""', "x\ny", "long " * 5, "'", "\t"]


def fixture(path, seed, n=60):
    rng = random.Random(seed)
    rows = [("".join(rng.choice(PIECES) for _ in range(rng.randint(1, 6))), rng.choice(["pos", "neg"])) for _ in range(n)]
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write("text,class\n")
        for text, label in rows:
            plain = not any(c in text for c in '",\n') and text.strip() == text
            quoted = text if plain and rng.random() < 0.5 else '"' + text.replace('"', '""') + '"'
            f.write(f"{quoted},{label}\n" + ("\n" if rng.random() < 0.1 else ""))
    with open(path, encoding="utf-8", newline="") as f:
        assert [(r["text"], r["class"]) for r in csv.DictReader(f)] == rows
    return rows


@pytest.mark.parametrize("cut", [7, 64, 100_000])
def test_reader_equals_a_serial_one(spark, tmp_path, cut):
    files = {name: fixture(tmp_path / f"{name}.csv", seed) for seed, name in enumerate("ab")}
    old = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", cut)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        rows = readers.read_development_csv(spark, str(tmp_path)).orderBy("doc_id").collect()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    assert [r["doc_id"] for r in rows] == list(range(120))
    assert [(r["text"], r["class"]) for r in rows] == files["a"] + files["b"]


def test_carriage_returns_and_an_open_quote(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes(b'text,class\r\n"one\ntwo",pos\r\n\r\nthree,neg\r\n')
    rows = readers.read_development_csv(spark, str(path)).orderBy("doc_id").collect()
    assert [(r["text"], r["class"]) for r in rows] == [("one\ntwo", "pos"), ("three", "neg")]
    # What an open quote swallows is one record.
    path.write_text('text,class\na,pos\n"b,neg\nc,pos\n', encoding="utf-8")
    assert readers.read_development_csv(spark, str(path)).count() == 2
