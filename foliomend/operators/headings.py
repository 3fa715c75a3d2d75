"""Heading levels from the numbering of headings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomend.functions.text import bound

# Shapes of numbered headings. The old rules need a hash, the new ones a dot.
OLD = {
    "roman": r"^(?:#{1,6})+\s*(?:Sec(?:tion)?\.?\s+)?([IVX]+)\.?\s+(.+)$",
    "number": r"^(?:#{1,6})+\s*(\d+(?:\.\d+)*?)\.?\s+(.+)$",
    "upper": r"^(?:#{1,6})+\s*([A-Z])\.?\s+([A-Z].+)$",
    "lower": r"^(?:#{1,6})+\s*([a-z])\.?\s+(.+)$",
}
NEW = {
    "roman": r"^(?:#{1,6})?\s*(Sec(?:tion)?\.\s+)?([IVX]+)\.\s+(.+)$",
    "number": r"^(?:#{1,6})?\s*(\d+(?:\.\d+)*?)\.\s+(.+)$",
    "upper": r"^(?:#{1,6})?\s*([A-Z])\.\s+(.+)$",
    "lower": r"^(?:#{1,6})?\s*([a-z])\.\s+(.+)$",
}
ROMAN_ANYWHERE = r"^#{1,6}?\s*(?:Sec(?:tion)?\.\s+)?[IVX]+\.\s+"


def _hashes(level: Column) -> Column:
    return F.repeat(F.lit("#"), F.least(level, F.lit(6)).cast("int"))


def _old(x: Column, kind: str, has_roman: Column) -> Column:
    """number, title, level and new line of a heading of one of the OLD kinds."""
    number, title = F.regexp_extract(x, OLD[kind], 1), F.regexp_extract(x, OLD[kind], 2)
    dots = F.length(number) - F.length(F.replace(number, F.lit("."), F.lit("")))
    level = {"roman": F.lit(2), "number": F.when(has_roman, 3).otherwise(2) + dots, "upper": F.lit(3), "lower": F.lit(4)}[kind]
    section = F.when(x.contains("Sec"), "Sec ").otherwise("") if kind == "roman" else F.lit("")
    return F.struct(F.lit(kind).alias("kind"), number.alias("number"), title.alias("title"), F.least(level, F.lit(6)).alias("level"), F.concat(_hashes(level), F.lit(" "), section, number, F.lit(". "), title).alias("line"))


def old_heading(x: Column, has_roman: Column) -> Column:
    """kind, number, title, level and line of a heading with a hash, null for other lines."""
    return F.when(x.startswith("#"), F.coalesce(*(F.when(x.rlike(p), _old(x, k, has_roman)) for k, p in OLD.items())))


def relevel_old(lines: DataFrame) -> DataFrame:
    """doc_id, n, kind, number, title, level, line: headings with a hash and what they become.

    Roman numbers are level 2, numbers 2 (3 in a document with roman ones) and one more for each dot,
    capitals 3, small letters 4; never more than 6. lines: doc_id, n, x.
    """
    flagged = lines.select("doc_id", "n", "x", F.bool_or(F.col("x").rlike(OLD["roman"])).over(Window.partitionBy("doc_id")).alias("has_roman"))
    return flagged.select("doc_id", "n", old_heading(F.col("x"), F.col("has_roman")).alias("h")).where("h IS NOT NULL").select("doc_id", "n", "h.*")


def new_heading(x: Column, has_roman: Column, dot: bool = True) -> Column:
    """level and line of a numbered line, null for other lines."""
    shapes = NEW if dot else {k: p.replace(r"\.\s+(.+)", r"\.?\s+(.+)") for k, p in NEW.items()}
    part = lambda k, g: F.regexp_extract(x, shapes[k], g)
    line = lambda level, prefix, k, g: F.struct(F.least(level, F.lit(6)).alias("level"), F.concat(_hashes(level), F.lit(" "), prefix, part(k, g), F.lit(". "), part(k, g + 1)).alias("line"))
    parts = F.size(F.split(part("number", 1), r"\.")) + F.when(has_roman, 1).otherwise(0)
    letter = lambda k, level: F.when(x.rlike(shapes[k]) & ~part(k, 2).rlike("^[A-Z][a-z]"), line(F.lit(level), F.lit(""), k, 1))
    return F.coalesce(
        F.when(has_roman & x.rlike(shapes["roman"]), line(F.lit(1), part("roman", 1), "roman", 2)),
        F.when(x.rlike(shapes["number"]), line(parts, F.lit(""), "number", 1)),
        letter("upper", 3),
        letter("lower", 4),
    )


def relevel_new(lines: DataFrame, dot: bool = True) -> DataFrame:
    """doc_id, n, level, line: numbered lines, with or without hashes, and what they become.

    Roman numbers are level 1, and only count in a document where one stands behind a hash; numbers
    have a level for each part (one more where roman ones count); letters 3 and 4, unless the title
    begins with a capitalised word. dot=False: the variant in which the dot after a number may be missing.
    """
    flagged = lines.select("doc_id", "n", "x", F.bool_or(F.col("x").rlike(ROMAN_ANYWHERE)).over(Window.partitionBy("doc_id")).alias("has_roman"))
    return flagged.select("doc_id", "n", new_heading(F.col("x"), F.col("has_roman"), dot).alias("h")).where("h IS NOT NULL").select("doc_id", "n", "h.*")


def _retitled(md: Column, roman: str, heading: Callable[[Column, Column], Column]) -> Column:
    lines = F.split(md, "\n", -1)
    document = F.struct(lines.alias("lines"), F.exists(lines, lambda x: x.rlike(roman)).alias("has_roman"))
    return bound(document, lambda d: F.array_join(F.transform(d["lines"], lambda x: F.coalesce(heading(x, d["has_roman"])["line"], x)), "\n"))


def retitled_old(md: Column) -> Column:
    """A text with its headings as relevel_old makes them: within the row, nothing is shuffled."""
    return _retitled(md, OLD["roman"], old_heading)


def retitled_new(md: Column) -> Column:
    """A text with its headings as relevel_new makes them."""
    return _retitled(md, ROMAN_ANYWHERE, new_heading)


def table_of_contents(lines: DataFrame, deepest: int = 6) -> DataFrame:
    """doc_id, entry (from 1), n, level, title: the hash headings of each document, in order."""
    x = F.col("x")
    shape = r"^\s{0,3}(#{1,6})\s+(.*?)\s*#*\s*$"
    found = lines.where(x.rlike(shape)).select("doc_id", "n", F.length(F.regexp_extract(x, shape, 1)).alias("level"), F.regexp_extract(x, shape, 2).alias("title"))
    return found.where(F.col("level") <= deepest).select("doc_id", F.row_number().over(Window.partitionBy("doc_id").orderBy("n")).alias("entry"), "n", "level", "title")
