"""Documents to lines, classified once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomend.functions import lines as L
from foliomend.functions.text import bound

#: Line ends of a text: those that split a page or a document when lines are kept whole.
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def split_lines(docs: DataFrame, text_col: str = "md", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keys, n (from 0), x: the lines of each text between newlines. Null texts have none."""
    return docs.select(*keys, F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("n", "x"))


def universal_lines(text: Column) -> Column:
    """Array of lines at any line end, without a last empty one."""
    parts = F.split(text, LINE_END, -1)
    return F.when(F.try_element_at(parts, F.lit(-1)) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def classify(lines: DataFrame) -> DataFrame:
    """Adds what each line is by itself, for whatever scans follow."""
    x = F.col("x")
    return lines.select(
        "*",
        L.is_blank(x).alias("blank"),
        L.fence(x).alias("fence"),
        L.is_math_fence(x).alias("math"),
        L.html_code_tag(x).alias("html_code"),
        L.block_html_tag(x).alias("html_block"),
        L.has_pipe(x).alias("pipe"),
        L.is_table_delimiter(x).alias("delimiter"),
        L.is_list_item(x).alias("list_item"),
        L.is_heading(x).alias("heading"),
        L.like_heading(x).alias("like_heading"),
        L.element(x).alias("element"),
        L.is_caption(x).alias("caption"),
        L.ends_sentence(x).alias("sentence_end"),
        L.is_incomplete(x).alias("incomplete"),
        L.is_algorithm_header(x).alias("algorithm"),
        L.continues_algorithm_old(x).alias("algorithm_old"),
        L.continues_algorithm_new(x).alias("algorithm_new"),
        L.is_generated_note(x).alias("generated"),
    )


def captions_in_context(lines: DataFrame) -> DataFrame:
    """Captions with an image or an image tag, or a table line, at most two lines away: keys, n, x, near."""
    near = Window.partitionBy("doc_id").orderBy("n").rowsBetween(-2, 2)
    t = L.stripped(F.col("x"))
    hit = F.when(L.is_image(t) | F.col("x").contains("<img") | L.is_html_table(t) | L.is_markdown_table(t), 1).otherwise(0)
    counted = lines.select("doc_id", "n", "x", L.is_caption(F.col("x")).alias("caption"), (F.sum(hit).over(near) - hit).alias("near"))
    return counted.where("caption").select("doc_id", "n", "x", (F.col("near") > 0).alias("near"))


def paragraph_pairs(lines: DataFrame) -> DataFrame:
    """doc_id, n of the second line, continues: whether it goes on the paragraph of the line before."""
    order = Window.partitionBy("doc_id").orderBy("n")
    pairs = lines.select("doc_id", "n", F.lag("x").over(order).alias("a"), F.col("x").alias("b")).where("a IS NOT NULL")
    return pairs.select("doc_id", "n", L.continues_paragraph(F.col("a"), F.col("b")).alias("continues"))


def wrap_algorithms(lines: DataFrame) -> DataFrame:
    """doc_id, algorithm (from 1), first, last: blocks of two or more lines that a bold algorithm title begins
    and a blank line, a heading, a caption or the next title ends."""
    x = F.col("x")
    title = x.rlike(r"^\*\*Algorithm\s+\d+\*\*")
    stop = L.is_blank(x) | x.startswith("#") | x.startswith("Fig.") | x.startswith("Table")
    order = Window.partitionBy("doc_id").orderBy("n")
    marked = lines.select("doc_id", "n", title.alias("title"), F.sum(F.when(title | stop, 1).otherwise(0)).over(order).alias("run"))
    runs = marked.groupBy("doc_id", "run").agg(F.min("n").alias("first"), F.max("n").alias("last"), F.min_by("title", "n").alias("title")).where("title AND last > first")
    return runs.select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("first")).alias("algorithm"), "first", "last")


def fenced_algorithms(md: Column) -> Column:
    """A text with the blocks that wrap_algorithms finds between fences: cut at titles and stops, within the row."""
    lines = F.split(md, "\n", -1)
    title = lambda x: x.rlike(r"^\*\*Algorithm\s+\d+\*\*")
    stop = lambda x: L.is_blank(x) | x.startswith("#") | x.startswith("Fig.") | x.startswith("Table")
    cuts = F.filter(F.transform(lines, lambda x, i: F.when(title(x) | stop(x), F.struct(i.alias("at"), title(x).alias("title")))), lambda c: c.isNotNull())

    def part(d: Column, c: Column, k: Column) -> Column:
        length = F.coalesce(F.get(d["cuts"], k + 1)["at"], F.size(d["lines"])) - c["at"]
        text = F.array_join(F.slice(d["lines"], c["at"] + 1, length), "\n")
        return F.when(c["title"] & (length > 1), F.concat(F.lit("```\n"), text, F.lit("\n```"))).otherwise(text)

    def whole(d: Column) -> Column:
        before = F.slice(d["lines"], 1, F.coalesce(F.get(d["cuts"], F.lit(0))["at"], F.size(d["lines"])))
        return F.array_join(F.concat(before, F.transform(d["cuts"], lambda c, k: part(d, c, k))), "\n")

    return bound(F.struct(lines.alias("lines"), cuts.alias("cuts")), whole)
