"""Marks of lines are found from heads and tails: the same as the plain patterns give."""

import random

from pyspark.sql import functions as F

from foliomend.functions import lines as L
from foliomend.operators import embedded as E
from foliomend.operators import pages as P
from foliomend.plans.corpus import corpus

PARTS = "and the Fig. Figure Table Tab. 3 12 e.g. U.S. Dr. etc. is being have Input: Output Algorithm algorithm ALGORİTHM 算法 for ** * *** ``` | || |---| ![i](j) ![i] <table> </TD> <img 。 ？ . : ; - ( \" ' 」 1. 2) a) • + # ## X. １ ٣. é Ж 😀".split()
SPACES = [" ", "", "  ", "\t", "\xa0", "\u2028", "\x85", "\x1c", "\u0301", "\u0301" * 20]


def odd_lines(n):
    rng = random.Random(8)
    return ["".join(rng.choice(PARTS) + rng.choice(SPACES) for _ in range(rng.randrange(7))) for _ in range(n)]


def packed(bits, answers):
    return [sum(bit for bit, name in bits.items() if r[name]) for r in answers]


def test_marks_are_those_of_the_patterns(spark):
    lines = odd_lines(6000)
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "n int, x string")
    t = L.stripped(F.col("x"))
    plain = {E.BLANK: t == "", E.IMAGE: L.is_image(t), E.CAPTION: t.rlike(L.CAPTION), E.HTML: L.is_html_table(t), E.PIPES: L.is_markdown_table(t), E.PICTURE: t.contains("<img"), E.STOP: t.rlike(L.STOP), E.SHORT: t.rlike(L.SHORT_ABBREVIATION), E.OPEN: L.any_of(t, L.OPEN_TAIL, "(?i)"), E.OPEN_INSIDE: L.any_of(F.concat(F.lit(" "), t), L.OPEN_TAIL, "(?i)"), E.ENDS: t.rlike(L.STOP_QUOTED) & ~t.rlike(L.ABBREVIATION), E.LOWER: L.starts_lower(t), E.HEADING: L.like_heading(t), E.LISTED: L.any_of(t, L.LIST_STARTS), E.QUOTED: t.contains('"'), E.QUOTE_LAST: t.endswith('"')}
    names = {bit: f"b{bit}" for bit in plain}
    got = rows.select("n", *(c.alias(names[bit]) for bit, c in plain.items()), E.marks(F.col("x"))[0].alias("marks"), (L.element(F.col("x")) != "text").alias("element"), L.embedded(t).alias("embedded"), L.trimmed(F.col("x")).alias("trimmed"), t.alias("t")).collect()
    assert [r.marks for r in got] == packed(names, got)
    assert all(r.element == r.embedded and r.trimmed == r.t for r in got)
    assert all(any(r[name] for r in got) for name in names.values())


def test_documents_of_one_file_are_dealt(spark):
    assert "Exchange hashpartitioning(doc_id" in corpus(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_pages_meet_by_one_sort(spark):
    pages = P.split_pages_old(spark.createDataFrame([(1, "a\n---\nb")], "doc_id long, md string"), "md")
    assert P.merge_pages(pages)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count(" Sort ") == 1
