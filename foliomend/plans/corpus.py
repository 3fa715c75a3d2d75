"""A Markdown corpus made from the documents table, in Spark and in SQL.

The tables hold almost no Markdown, so each line x, at position i of its document, is rewritten by
the slot k % 47 with k = doc_id * 7 + i; the slots after the last of SLOTS leave it alone. Every slot
keeps all of x, in the line itself or before or after what a line of x has no place in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _lines(*parts: str) -> str:
    """Lines, given as expressions, under each other."""
    return " || chr(10) || ".join(parts)


_K = "cast({k} as string)"
_DIGIT = "cast({k} % 9 + 1 as string)"
_RULE, _FENCE, _MATH, _TABLE = "'---'", "'```'", "'$$'", _lines("'| a | b |'", "'|---|---|'", f"'| ' || {_K} || ' | c |'")

# What the slots produce. {k} is the line's number; both dialects read these strings.
SLOTS = [
    "'## ' || substr('IVX', cast({k} % 3 + 1 as int), 1) || '. ' || x",
    f"'### ' || {_DIGIT} || '.' || cast({{k}} % 4 + 1 as string) || '. ' || x",
    f"'Fig. ' || {_K} || '. ' || x",
    _lines(f"'![a' || {_K} || '](i/' || {_K} || '.png)'", "x"),
    _lines(_TABLE, "x"),
    _lines(_FENCE, "x", _FENCE),
    _lines(_MATH, f"'x_' || {_K}", _MATH, "x"),
    "x || ' [' || cast({k} % 30 + 1 as string) || '] and [' || cast({k} % 5 + 1 as string) || '-' || cast({k} % 5 + 3 as string) || '].'",
    _lines(_RULE, "x"),
    "'- ' || x",
    _lines("'**Algorithm ' || cast({k} % 7 + 1 as string) || '** ' || x", f"'1: x_' || {_K}"),
    f"x || ' &lt;b&gt; &amp; https://ex.org/' || {_K} || ' u' || {_K} || '@ex.org'",
    # Pages that go on: a sentence, a word, a word around a figure, a list of references, a paragraph.
    _lines("x || ' because of the'", _RULE, f"'other side of ' || {_K} || '.'"),
    _lines("x || ' exam-'", _RULE, f"'ple of it ' || {_K} || '.'"),
    _lines("x || ' exam-'", f"'![h' || {_K} || '](h/' || {_K} || '.png)'", _RULE, f"'ple with a figure ' || {_K} || '.'"),
    _lines(f"'[' || {_DIGIT} || '] ' || x", _RULE, f"'[' || cast({{k}} % 9 + 2 as string) || '] Next one ' || {_K}"),
    _lines("x", f"'Department of Physics ' || {_K}", _RULE, f"'(' || {_K} || ') starts.'"),
    _lines("x || ' ends here without a mark'", _RULE, f"'(see ' || {_K} || ') it goes on.'"),
    # HTML, lists of citations, letters, other scripts, emphasis, notes, indented code.
    _lines("'<div>'", "x", "'</div>'"),
    _lines("'<pre>'", "x", "'</pre>'"),
    "'<table><tr><td>' || x || '</td></tr></table>'",
    f"x || ' [1, 2] and [3,' || {_K} || '].'",
    "'# ' || substr('Ab', cast({k} % 2 + 1 as int), 1) || '. ' || x",
    "x || ' 中文。'",
    "x || ' H<sub>2</sub>O **bold** and *soft*Capital'",
    _lines(f"x || '[^' || {_K} || '].'", f"'[^' || {_K} || ']: note'", "'    more of it'"),
    "'    ' || x",
    # Paragraphs that a table or code interrupts, a journal's note, a generated note, marks inside a line.
    _lines("x || ' and so it'", _TABLE, "'goes on after the table and so it ends.'"),
    _lines("x || ' and so it'", _FENCE, f"'code ' || {_K}", _FENCE, "'goes on after the code and so it ends.'"),
    _lines("x", f"'ACM 1234-567X/2020/1-ART' || {_K}", "''"),
    _lines(f"'*' || {_K} || ' pages*'", "x"),
    "x || ' <a href=\"u\">t</a> $y_1$ `c` [l](m) [r][s] ![i](j)'",
]


def _case(k: str) -> str:
    return f"CASE cast({k} % 47 as int) " + " ".join(f"WHEN {n} THEN {s.format(k=k)}" for n, s in enumerate(SLOTS)) + " ELSE x END"


#: In SQL, the common table expression c(doc_id, md).
SQL = f"c AS (SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: {_case('(doc_id * 7 + i - 1)')}), chr(10)) AS md FROM documents)"
#: And l(doc_id, n, x): its lines, from 0.
SQL_LINES = SQL + ", l AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS n, string_split(md, chr(10))[i] AS x FROM c, unnest(range(1, len(string_split(md, chr(10))) + 1)) r(i))"


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, md). Documents are dealt by their id before anything is made of them: a file may be one task's alone."""
    md = f"array_join(transform(split(text, '\\n', -1), (x, i) -> {_case('(doc_id * 7 + i)')}), chr(10))"
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").repartition("doc_id").select("doc_id", F.expr(md).alias("md"))
