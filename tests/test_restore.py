"""Placeholders restored in one pass, against one replacement after the other; counts from the pass itself."""

import random
import re
import time

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from foliomend.operators import placeholders as PH
from foliomend.plans import fix
from foliomend.plans.corpus import corpus

STORE = "doc_id long, text string, store array<struct<placeholder:string,raw:string>>"


def by_turns(text, store):
    for placeholder, raw in sorted(store, key=lambda e: -len(e[0])):
        text = text.replace(placeholder, raw)
    return text


def resolved(text, store, before=10**9):
    raws, number = dict(store), lambda p: int(p[-8:-2])
    put = lambda m: resolved(raws[m[0]], store, number(m[0])) if m[0] in raws and number(m[0]) < before else m[0]
    return re.sub(r"__PH_[A-Z0-9]+_\d{6,}__", put, text)


@pytest.mark.parametrize("nested", [False, True])
def test_restore(spark, nested):
    rng, rows = random.Random(3), []
    for i in range(300):
        store = []
        for k in range(1, rng.randrange(1, 12)):
            raw = "".join(rng.choice(["x", "y ", *[p for p, _ in store], "__PH_CODE_000009__", "_", "__PH_"]) for _ in range(rng.randrange(4)))
            store.append((f"__PH_{rng.choice(['CODE', 'URL', 'LINKURL', 'MATH'])}_{k:06d}__", raw))
        text = "".join(rng.choice(["a", "_", " ", "__PH_CODE_000031__", *[p for p, _ in store]]) for _ in range(rng.randrange(20)))
        rows.append((i, text, store[rng.randrange(2) if len(store) > 5 else 0 :]))  # some have no first entry, so that numbers are no places
    got = {r.doc_id: r.x for r in spark.createDataFrame(rows, STORE).select("doc_id", PH.restore(F.col("text"), F.col("store"), nested).alias("x")).collect()}
    assert got == {i: (resolved if nested else by_turns)(text, store) for i, text, store in rows}
    odd = spark.createDataFrame([(1, None, []), (2, "", []), (3, "__PH_CODE_000001__", [])], STORE)
    assert [r[0] for r in odd.orderBy("doc_id").select(PH.restore(F.col("text"), F.col("store"), nested)).collect()] == [None, "", "__PH_CODE_000001__"]


def test_time_in_proportion(spark):
    def took(n):
        store = [(f"__PH_CODE_{k:06d}__", f"code {k}") for k in range(1, n + 1)]
        rows = spark.createDataFrame([(1, " and ".join(p for p, _ in store), store)], STORE)
        start = time.time()
        assert rows.select(PH.restore(F.col("text"), F.col("store")).contains(f"code {n}")).collect()[0][0]
        return time.time() - start

    took(100)
    some, many = took(25_000), took(100_000)
    assert many < 20 and many < 10 * max(some, 0.5)


def test_repairs_are_counted_by_the_pass_itself(spark):
    docs = corpus(spark, "/root/testdata/sf0.001")
    counts = Observation()
    fix.fix_new(docs, counts).write.format("noop").mode("overwrite").save()
    want = fix.repairs(docs).agg(F.sum("repaired")).head()[0]
    assert counts.get["repaired"] == want > 0 and counts.get["blocks"] > want
