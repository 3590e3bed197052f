"""Which joins are broadcast, whatever Spark takes the tables' sizes for."""

import random
import re

from pyspark.sql import functions as F

from opinia.llm import simhash, storage


def test_fingerprints_are_never_broadcast(spark, monkeypatch):
    """Compressed tables look small, and their copies at anchors are many: all joins but the two of hot fingerprints shuffle."""
    plans = []

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return storage.written(df)

    monkeypatch.setattr(simhash, "written", seen)
    deal = random.Random(4)
    texts = [" ".join(deal.choice("abcdefgh") * 3 for _ in range(30)) for _ in range(12)]
    texts += [t + " more" for t in texts] + texts[:3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = simhash.near_duplicates(docs)
    last = found._jdf.queryExecution().executedPlan().toString()
    assert not [p for p in plans if "BroadcastHashJoin" in p or "BroadcastNestedLoopJoin" in p]
    assert last.count("BroadcastHashJoin") == 2 and last.count("SortMergeJoin") == 1
    rows = {r["doc_id"]: r for r in found.collect()}
    assert len(rows) == len(texts)
    assert all(rows[24 + i]["component_id"] == rows[i]["component_id"] for i in range(3))
    keepers = simhash.one_of_each(docs)._jdf.queryExecution().executedPlan().toString()
    assert re.search("SortMergeJoin.*LeftSemi", keepers) and not re.search("Broadcast.*LeftSemi", keepers)
    assert simhash.one_of_each(docs).agg(F.count("*")).first()[0] == len({r["component_id"] for r in rows.values()})
