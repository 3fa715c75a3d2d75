"""Interrupted paragraphs and algorithms: random texts against SQL, and time by the number of lines."""

import random
import time

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from foliomend.operators import embedded as E
from foliomend.plans import oracle_blocks as SB

LINES = [
    "This sentence is about the", "thing that ends here.", "![a](b)", "Fig. 1. c", "Table 2 x", "| a | b |", "|---|---|", "<table>", "</table>", "<tr><td>x</td></tr>", "<table><tr></tr></table>",
    "", "", "a", "are", 'He said "yes"', '"no" he said', "- item one", "1. item two", "Big Heading", "# H", "and so on we go further with a longer line of more than fifty characters here", "Dr.", "see Fig.",
    "Upper line " + "word " * 30 + "end.", "  indented lower are", "<td>cell", "exam-", "ple of hyphen", "(x", "that, is", "<IMG src=x>", "<img src=x>", "x | y", " - | - ",
]
ALGORITHMS = ["Algorithm 1 Sort", "**Algorithm 2** X", "```", "1: do", "2. x", "Input: a", "**Input:** b", "free text", "", "***", "# H", "**Bold**", "for x in y", "end", "<sub>*a*</sub> *b*"]


def texts(bank, n, seed):
    rng = random.Random(seed)
    return ["\n".join(rng.choice(bank) for _ in range(rng.randrange(1, 30))) for _ in range(n)]


def by_sql(sql, rows):
    con = duckdb.connect()
    con.register("given", pd.DataFrame(list(enumerate(rows)), columns=["doc_id", "md"]))
    return dict(con.execute(sql).fetchall())


@pytest.mark.parametrize("case", ["embedded", "old", "new"])
def test_random_texts(spark, case):
    given = "c AS (SELECT doc_id, md FROM given)"
    rows = texts(LINES if case == "embedded" else ALGORITHMS, 500, case)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, md string")
    apply = {"embedded": E.repair_column, "old": E.wrap_pseudocode_column, "new": lambda c: E.wrap_pseudocode_column(c, old=False)}[case]
    want = by_sql(SB.embedded(given) if case == "embedded" else SB.pseudocode(given, old=case == "old"), rows)
    got = {r.doc_id: r.md for r in docs.select("doc_id", apply(F.col("md")).alias("md")).collect()}
    assert got == want and sum(got[i] != t for i, t in enumerate(rows)) > 100


def took(spark, text, apply):
    docs = spark.createDataFrame([(text,)], "md string")
    start = time.time()
    n = docs.select(F.octet_length(apply(F.col("md")).cast("binary"))).collect()[0][0]
    assert n >= len(text)
    return time.time() - start


@pytest.mark.parametrize("case", ["one run", "runs", "tables", "open tables", "algorithms"])
def test_time_in_proportion(spark, case):
    on = "goes on without a stop and on it goes for more than fifty characters"
    parts = {"one run": [on], "runs": [on, on, "![a](b)"], "tables": [on, "<table>", "<tr>", "</table>"], "open tables": [on, "<table>", "<td>x"], "algorithms": ["Algorithm 1 x", "1: y", "free"]}[case]
    apply = E.wrap_pseudocode_column if case == "algorithms" else E.repair_column
    text = lambda n: "\n".join(parts * (n // len(parts)) + ["![a](b)"])
    took(spark, text(1000), apply)
    some, many = took(spark, text(25000), apply), took(spark, text(100000), apply)
    assert many < 20 and many < 10 * some
