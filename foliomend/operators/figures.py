"""Figures to the head of their sections, as window expressions and one sort key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliomend.functions import lines as L
from foliomend.operators.blocks import PROTECT, lex_blocks

# A line of images, and what begins a caption of a figure or a table.
IMAGES = r"^(!\[[^\]]*\]\([^)]*\)\s*)+\z"
CAPTION = r"(?i)^(?:fig\.|figure|figs\.|table|tab\.|图|表)\s*\d+"


def figure_blocks(lines: DataFrame) -> DataFrame:
    """doc_id, pos, kind, text: header, figure, caption or other. Table lines in a row are one figure, other
    lines that aren't blank one block each. lines: doc_id, n, x."""
    order = Window.partitionBy("doc_id").orderBy("n")
    t = L.stripped(F.col("x"))
    table = L.is_html_table(t) | L.is_markdown_table(t)
    kind = F.when(L.is_heading(F.col("x")), "header").when(table, "table").when(t.rlike(IMAGES), "figure").when(t.rlike(CAPTION), "caption").otherwise("other")
    rows = lines.where(~L.is_blank(F.col("x"))).select("doc_id", "n", "x", kind.alias("kind"))
    fresh = F.when((F.col("kind") == "table") & (F.lag("kind").over(order) == "table") & (F.lag("n").over(order) == F.col("n") - 1), 0).otherwise(1)
    blocks = rows.withColumn("pos", F.sum(fresh).over(order)).groupBy("doc_id", "pos", "kind").agg(F.array_sort(F.collect_list(F.struct("n", "x"))).alias("rows"))
    return blocks.select("doc_id", (F.col("pos") - 1).cast("int").alias("pos"), F.when(F.col("kind") == "table", "figure").otherwise(F.col("kind")).alias("kind"), F.array_join(F.transform("rows", lambda r: r["x"]), "\n").alias("text"))


def sections(blocks: DataFrame) -> DataFrame:
    """blocks with section: 0 before the first header, then the number of headers so far."""
    order = Window.partitionBy("doc_id").orderBy("pos")
    return blocks.withColumn("section", F.sum(F.when(F.col("kind") == "header", 1).otherwise(0)).over(order).cast("int"))


def clusters(blocks: DataFrame) -> DataFrame:
    """blocks with section and member: whether a block is part of a cluster, a run of figures with a caption before or after.

    A caption belongs to figures that follow it; failing that, to figures before it, unless these have
    a caption in front. A figure whose own text looks like a caption counts as a figure.
    """
    order = Window.partitionBy("doc_id", "section").orderBy("pos")
    own = lambda k: F.coalesce(k.isin("figure", "caption"), F.lit(False))
    kind, before, after = F.col("kind"), F.lag("kind").over(order), F.lead("kind").over(order)
    breaks = ~own(kind) | ~own(before) | ((kind == "caption") & (before == "caption"))
    chained = sections(blocks).select("*", before.alias("before"), after.alias("after"), F.sum(F.when(breaks, 1).otherwise(0)).over(order).alias("chain"))
    begins = F.first("kind").over(Window.partitionBy("doc_id", "section", "chain").orderBy("pos"))
    joins = (F.col("after") == "figure") | ((F.col("before") == "figure") & (begins == "figure"))
    member = F.when(kind == "figure", True).when(kind == "caption", F.coalesce(joins, F.lit(False))).otherwise(False)
    return chained.withColumn("member", member).drop("before", "after", "chain")


def figures_first(blocks: DataFrame) -> DataFrame:
    """doc_id, place (from 0), pos, section, kind, text: clusters right behind their section's header, all else in order."""
    key = [F.col("section"), F.when(F.col("kind") == "header", 0).otherwise(1), F.when((F.col("section") > 0) & ~F.col("member"), 1).otherwise(0), F.col("pos")]
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(*key)) - 1
    return clusters(blocks).select("doc_id", place.alias("place"), "pos", "section", "kind", "text")


def document_blocks(docs: DataFrame) -> DataFrame:
    """doc_id, pos, kind, text as in figure_blocks, of whole documents (doc_id, md): what is fenced, indented or
    mathematics is one block, and so are the lines of a paragraph or list. Tables in HTML count as figures."""
    lexed = lex_blocks(docs.select("doc_id", F.lit(0).alias("page"), F.col("md").alias("text")), PROTECT, "plain", keep_blank=True)
    plain, t = F.col("kind") == "plain", L.stripped(F.col("text"))
    figure = (F.col("kind") == "TABLE") | ((F.col("kind") == "HTMLBLOCK") & L.is_html_table(t)) | (plain & (t.rlike(IMAGES) | L.is_markdown_table(t)))
    kind = F.when(plain & L.is_blank(F.col("text")), "blank").when(plain & L.is_heading(F.col("text")), "header").when(figure, "figure").when(plain & t.rlike(CAPTION), "caption").otherwise("other")
    order = Window.partitionBy("doc_id").orderBy("block")
    rows = lexed.select("doc_id", "block", plain.alias("plain"), kind.alias("kind"), "text")
    goes_on = F.col("plain") & (F.col("kind") == "other") & F.lag("plain").over(order) & (F.lag("kind").over(order) == "other")
    rows = rows.withColumn("pos", F.sum(F.when(goes_on, 0).otherwise(1)).over(order)).where("kind <> 'blank'")
    blocks = rows.groupBy("doc_id", "pos", "kind").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("rows"))
    return blocks.select("doc_id", F.col("pos").cast("int").alias("pos"), "kind", F.array_join(F.transform("rows", lambda r: r["text"]), "\n").alias("text"))


def moved(docs: DataFrame) -> DataFrame:
    """doc_id, md of docs (doc_id, md): clusters of figures and captions right behind their section's header,
    all else in order, a blank line between blocks. A null or empty text stays as an empty one."""
    rows = figures_first(document_blocks(docs)).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("place", "text"))).alias("rows"))
    texts = rows.select("doc_id", F.array_join(F.transform("rows", lambda r: r["text"]), "\n\n").alias("md"))
    return docs.select("doc_id").join(texts, "doc_id", "left").select("doc_id", F.coalesce("md", F.lit("")).alias("md"))


def reorganise(blocks: DataFrame) -> DataFrame:
    """doc_id, heading (pos of the nearest header before, null if none), figures: how many figures belong under each heading."""
    order = Window.partitionBy("doc_id").orderBy("pos")
    heading = F.last(F.when(F.col("kind") == "header", F.col("pos")), ignorenulls=True).over(order)
    return blocks.withColumn("heading", heading).where("kind = 'figure'").groupBy("doc_id", "heading").agg(F.count("*").alias("figures"))


def reorganised(blocks: DataFrame) -> DataFrame:
    """doc_id, md: every figure, with a caption right behind it, under the nearest header before it, in order;
    then what else stands under that header. Before the first header all stays. A blank line between blocks.

    The header is the last one seen so far, and all else one sort key: no block meets another.
    """
    order = Window.partitionBy("doc_id").orderBy("pos")
    heading = F.last(F.when(F.col("kind") == "header", F.col("pos")), ignorenulls=True).over(order)
    element = (F.col("kind") == "figure") | ((F.col("kind") == "caption") & F.coalesce(F.lag("kind").over(order) == "figure", F.lit(False)))
    turn = F.when(F.col("kind") == "header", 0).when(element & heading.isNotNull(), 1).otherwise(2)
    rows = blocks.select("doc_id", F.struct(F.coalesce(heading, F.lit(-1)).alias("heading"), turn.alias("turn"), "pos", "text").alias("row"))
    return rows.groupBy("doc_id").agg(F.array_sort(F.collect_list("row")).alias("rows")).select("doc_id", F.array_join(F.transform("rows", lambda r: r["text"]), "\n\n").alias("md"))
