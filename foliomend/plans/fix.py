"""The two ways of repairing a document, as compositions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from foliomend.functions import text as T
from foliomend.operators import blocks as B
from foliomend.operators import embedded as E
from foliomend.operators import headings as H
from foliomend.operators import lines as O
from foliomend.operators import pages as P
from foliomend.sources.shared import written


def _steps(docs: DataFrame, steps: list[Callable[[Column], Column]]) -> DataFrame:
    """doc_id, md: one step after the other, each over the column of the one before."""
    for step in steps:
        docs = docs.select("doc_id", step(F.col("md")).alias("md"))
    return docs


def fix_old(docs: DataFrame, level: str = "conservative") -> tuple[DataFrame, DataFrame]:
    """(texts, plan) of docs (doc_id, md): headings, pages, citations, pseudocode, entities, spacing.

    texts: doc_id, md. plan: the page pairs, as merge_plan gives them; a document of one page has none.
    Interrupted paragraphs are repaired in each page before and after merging, and in the whole text.
    A null text counts as empty. Pages meet by one shuffle; all else stays within its row.
    """
    pages = P.split_pages_old(_steps(docs, [lambda c: H.retitled_old(F.coalesce(c, F.lit("")))]))
    pages = written(pages.select("doc_id", "page", E.repair_column(F.col("text")).alias("text")), "pages")
    # A document of one page keeps its outer white space, and is repaired once.
    last = pages.groupBy("doc_id").agg(F.max("page").alias("last"), F.min_by("text", "page").alias("only"))
    merged = P.merge_pages(pages, level).select("doc_id", "page", E.repair_column(F.col("text")).alias("text"))
    whole = P.join_pages(merged).join(last, "doc_id")
    again = E.repair_column(F.when(F.col("last") > 0, F.col("md")))
    whole = whole.select("doc_id", F.when(F.col("last") == 0, F.col("only")).otherwise(again).alias("md"))
    coded = E.wrapped_texts(_steps(whole, T.REFERENCES_OLD))
    spaced = B.rewritten(_steps(coded, [T.decode_entities, lambda c: F.coalesce(c, F.lit(""))]), B.respaced)
    return _steps(spaced, [T.bracket_links, T.collapse_newlines]), P.merge_plan(pages, level)


def fix_new(docs: DataFrame, counts: Observation | None = None) -> DataFrame:
    """doc_id, md of docs (doc_id, md): blocks, interrupted paragraphs, headings, citations, algorithms, journal notes.

    Blocks meet by one shuffle; all else stays within its row. counts: gets `blocks` and `repaired` (how
    many paragraphs were made whole) from the pass itself, once the result has been written.
    """
    blocks = B.repair_tables(B.lex_blocks(P.split_pages_new(docs)).repartition("doc_id"))
    if counts is not None:
        blocks = blocks.observe(counts, F.count("*").alias("blocks"), F.count_if("merged").alias("repaired"))
    md = docs.select("doc_id").join(B.to_markdown(blocks), "doc_id", "left").select("doc_id", F.coalesce("md", F.lit("")).alias("md"))
    return _steps(md, [H.retitled_new, *T.REFERENCES_NEW, O.fenced_algorithms, T.clean_whitespace])


def repairs(docs: DataFrame) -> DataFrame:
    """doc_id, repaired: how many interrupted paragraphs the new repair makes whole."""
    blocks = B.repair_tables(B.lex_blocks(P.split_pages_new(docs)))
    return blocks.groupBy("doc_id").agg(F.count_if("merged").alias("repaired"))
