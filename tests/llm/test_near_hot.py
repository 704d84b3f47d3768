"""Joins of the near-dedup whose keys are hot."""

import random
from collections import Counter

from pyspark.sql import functions as F

from wattlake.llm import neardup


def test_hot_keys_are_few_and_cut(spark):
    rows = [(7, n) for n in range(3000)] + [(k, 10_000 + k) for k in range(100, 5100)]
    frame = spark.createDataFrame(rows, "key bigint, node bigint")
    sizes = frame.groupBy("key").agg(F.count("*").alias("size"))
    hot = neardup.hot_keys(sizes, "key")
    assert [tuple(r) for r in hot.collect()] == [(7, 384)]
    facts = sizes.where("key < 3000").withColumn("hub", F.col("key") * 2)
    got = neardup.joined(frame, facts, "key", "node", hot)
    assert got.columns == ["key", "node", "size", "hub"]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, frame.join(facts, "key").collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_piece" in plan and "BroadcastNestedLoopJoin" not in plan


def test_no_rows_no_hot_keys(spark):
    none = spark.createDataFrame([], "key bigint, node bigint")
    sizes = none.groupBy("key").agg(F.count("*").alias("size"))
    hot = neardup.hot_keys(sizes, "key")
    assert hot.count() == 0 and neardup.joined(none, sizes, "key", "node", hot).count() == 0


def test_hot_keys_do_not_change_groups(spark, monkeypatch):
    monkeypatch.setattr(neardup, "PAIRED", 3)
    rng = random.Random(8)
    word = lambda: "w%d" % rng.randrange(500)
    heads = [[word() for _ in range(60)] for _ in range(6)]
    texts = []
    for i in range(90):
        own = list(heads[0] if i % 3 else heads[i % 6])
        own[rng.randrange(60)] = word()
        texts.append((i, " ".join(own)))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")

    def groups():
        return {r.doc_id: r.component_id for r in neardup.near_groups(docs).collect()}

    hot = groups()
    monkeypatch.setattr(neardup, "PARTS", 1)
    assert groups() == hot

    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(56)} for i, t in texts}
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    assert hot == root
