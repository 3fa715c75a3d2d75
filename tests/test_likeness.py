"""The check of translations gives the verdicts of the plain comparison, and compares few texts at length."""

import difflib
import random

from pyspark.sql import functions as F

from foliomend.functions import text as T
from foliomend.operators import nodes as N
from foliomend.plans import registry


def test_bounds_change_no_verdict():
    rng = random.Random(6)
    for _ in range(3000):
        a = "".join(rng.choice("abcde ") for _ in range(rng.randrange(30)))
        b = list(a)
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(b) + 1)
            b[at : at + rng.randrange(3)] = rng.choice(["", "x", "ab"])
        b = "".join(rng.sample(b, len(b)) if rng.random() < 0.1 else b)
        assert (N.likeness(a, b) < N.ALIKE) == (difflib.SequenceMatcher(None, a, b).ratio() < N.ALIKE)


def test_verdicts_over_all_nodes(spark):
    nodes = registry._nodes(spark, "/root/testdata/sf0.001").withColumn("k", F.pmod(F.xxhash64("doc_id", "nid"), F.lit(5)))
    changed = F.when(F.col("k") == 0, F.col("origin")).when(F.col("k") == 1, F.concat(F.reverse("origin"), F.lit("."))).when(F.col("k") == 2, F.concat(F.lit("so "), "origin")).when(F.col("k") == 3, F.substring("origin", 1, 20)).otherwise(F.regexp_replace("origin", "[aeiou]", "e"))
    rows = nodes.withColumn("translated", changed)
    got = rows.select(N.succeeded(F.col("origin"), F.col("translated"), "zh").alias("ok"), (T.placeholders(F.col("origin")) == T.placeholders(F.col("translated"))).alias("same"), T.is_placeholder_only(F.col("origin")).alias("only"), T.has_target_script(F.col("translated"), "zh").alias("script"), (F.trim(F.regexp_replace("translated", r"\s", "")) != "").alias("filled"), T.for_comparison(F.col("origin")).alias("a"), T.for_comparison(F.col("translated")).alias("b")).collect()
    compared = 0
    for r in got:
        ratio = difflib.SequenceMatcher(None, r.a, r.b).ratio()
        assert r.ok == (r.same and r.filled and (r.only or r.script or ratio < N.ALIKE))
        m = difflib.SequenceMatcher(None, r.a, r.b)
        compared += r.a != r.b and not r.script and min(m.real_quick_ratio(), m.quick_ratio()) >= N.ALIKE
    assert {r.ok for r in got} == {True, False} and compared < 0.6 * len(got)
