"""The corpus holds its documents whole, and reaches what the operators decide on."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from foliomend.plans import registry
from foliomend.plans.corpus import SLOTS, corpus

TABLES = "/root/testdata/sf0.001"


def test_lines_are_whole(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").where("text IS NOT NULL").join(corpus(spark, TABLES), "doc_id")
    assert docs.count() > 0
    assert docs.where(~F.forall(F.split("text", "\n", -1), lambda x: F.col("md").contains(x))).count() == 0
    assert all(s.count("x") and "substr(x" not in s for s in SLOTS)


def values(spark, name, column):
    return {r[0]: r[1] for r in registry.QUERIES[name](spark, TABLES).groupBy(column).count().collect()}


def test_every_verdict_occurs(spark):
    found = values(spark, "page_continuity", "reason")
    assert set(found) >= {"hyphenated word", "split sentence", "references", "metadata boundary", "section boundary", "open paragraph", "undecided", "empty page"}
    assert {"merged", "kept"} <= set(values(spark, "page_merge_plan", "action"))
    assert {"table_split", "code_split"} <= set(values(spark, "split_types", "type"))
    assert values(spark, "table_interrupt_repair", "merged")[True] > 20
    assert set(values(spark, "lex_blocks", "kind")) == {"text", "table", "heading", "code_fence", "math_block", "algorithm", "metadata"}
    assert set(values(spark, "lex_protected_blocks", "kind")) == {"plain", "CODEFENCE", "HTMLBLOCK", "MATHBLOCK", "TABLE", "FOOTDEF", "INDENTCODE"}
    assert set(values(spark, "heading_levels_old", "kind")) == {"roman", "number", "upper", "lower"}
    assert set(values(spark, "translation_check_english", "ok")) == {True, False}


@pytest.mark.parametrize(("name", "before"), [("metadata_separation", "md"), ("cite_lists_new", "md"), ("references_new", "md"), ("journal_notes_plain", "md"), ("embedded_repair", "md"), ("pseudocode_wrap", "md"), ("bracket_links", "md"), ("fix_old", "md"), ("fix_new", "md")])
def test_texts_change(spark, name, before):
    changed = registry.QUERIES[name](spark, TABLES).withColumnRenamed("md", "after").join(corpus(spark, TABLES), "doc_id").where("md <> after")
    assert changed.count() > 5


def test_line_kinds_occur(spark):
    lines = registry.QUERIES["classify_lines"](spark, TABLES)
    hit = lines.agg(*(F.count_if(c).alias(c) for c in ("math", "delimiter", "list_item", "heading", "caption", "algorithm", "generated", "incomplete", "sentence_end")), F.count_if(F.col("html_code") != "").alias("code"), F.count_if(F.col("html_block") != "").alias("block")).head()
    assert all(hit), hit


def test_entry_merges_pages(spark):
    assert entry.entry(spark).agg(F.sum("merged")).head()[0] > 0
