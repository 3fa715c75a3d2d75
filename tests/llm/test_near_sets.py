"""Sets of near-duplicate nodes, and near-duplicates of rows with repeated or null ids."""

import numpy as np
from pyspark.sql import functions as F

from foliomend.llm import near_dedup

LONG = " ".join(f"w{i}" for i in range(40))


def rows(spark, ids, texts):
    return spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").repartition(3)


def test_one_set_for_a_node(spark):
    docs = rows(spark, [7] * 6 + [None] * 6 + [8], [LONG] * 6 + [LONG + " x"] * 6 + ["other words"])
    signs = near_dedup.signed(docs, 2, "doc_id", "text")
    ends = signs.groupBy("set_a", "set_b").agg(F.min(F.struct("row", "doc_id")).alias("first")).select(F.col("first.row").alias("id"), "first.doc_id", "set_a", "set_b").cache()
    got = near_dedup.sets_of(ends, docs, 2, "doc_id", "text").collect()
    assert sorted(r.id for r in got) == sorted(r.id for r in ends.collect())
    assert sorted(len(r.shingles) // 8 for r in got) == [1, 39, 40]


def test_false_hits_of_the_filter(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "hits", lambda ids, wanted: ids == ids)  # everything is a hit
    docs = rows(spark, range(20), [LONG] * 10 + [LONG + " x"] * 10)
    ends = spark.createDataFrame([(r.row, r.doc_id, r.set_a, r.set_b) for r in near_dedup.signed(docs, 2, "doc_id", "text").dropDuplicates(["set_a", "set_b"]).collect()], "id long, doc_id long, set_a long, set_b long")
    assert near_dedup.sets_of(ends, docs, 2, "doc_id", "text").count() == 2
    assert {r.component_id for r in near_dedup.near_duplicates(docs, words=2).collect()} == {0}


def test_large_keys_as_small_ones(spark, monkeypatch):
    """Pairs from blocks are those from a join, over sizes of several bands."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << near_dedup.BITS, near_dedup.SYMBOLS)
    rows = []
    for i in range(300):
        own = base.copy()
        wrong = rng.choice(near_dedup.SYMBOLS, int(rng.integers(10, 40)), replace=False)
        own[wrong] = rng.integers(0, 1 << near_dedup.BITS, len(wrong))
        packed = near_dedup.packed(own.astype(np.uint16)[None])[0].tolist()
        rows += [(key, 300, i, i % 37, i % 41, int(40 * 1.25 ** rng.integers(0, 4) + rng.integers(0, 3)), packed) for key in range(1 + i % 3)]
    live = spark.createDataFrame(rows, "key long, m long, id long, root long, hub long, n long, sig array<long>").cache()
    found = []
    for joined, block in ((0, 4096), (0, 70), (10**6, 4096)):
        monkeypatch.setattr(near_dedup, "JOINED", joined)
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        found.append(sorted(map(tuple, near_dedup.near_pairs(live, 80).collect())))
    assert found[0] == found[1] == found[2] and len(found[0]) > 100
