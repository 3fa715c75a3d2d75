"""Rules that stand alone: headings by looks, elements inside paragraphs, and which blocks could be one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliomend.functions import lines as L

# Headings by their numbering, with levels and the group that holds the text.
NUMBERED = [(r"^([IVX]+)\.\s+(.+)", 1), (r"^(\d+)\.\s+([A-Z].+)", 2), (r"^(\d+\.\d+)\s+(.+)", 3), (r"^([A-Z])\.\s+(.+)", 3), (r"^([a-z])\.\s+(.+)", 4)]
VERB = r"\b(is|are|was|were|has|have|will|would)\b"
HASHES = r"^(#{1,6})\s+(.+)"
TITLE_WORDS = ["framework", "algorithm", "system", "method", "approach", "efficient", "real-time", "registration"]
PLACE_WORDS = ["university", "institute", "college", "school", ", china"]
BOLD_ALGORITHM = r"\*\*Algorithm\s+\d+\*\*"


def heading_by_looks(line: Column) -> Column:
    """(level, text) of a line that looks like a heading, else null: hashes, numbering, capitals only, or a short
    line that begins with a capital and holds no common verb."""
    t = L.stripped(line)
    found = lambda level, text: F.struct(level.alias("level"), text.alias("text"))
    case = F.when(t.rlike(HASHES), found(F.length(F.regexp_extract(t, HASHES, 1)), F.regexp_extract(t, HASHES, 2)))
    for pattern, level in NUMBERED:
        case = case.when(t.rlike(pattern), found(F.lit(level), F.regexp_extract(t, pattern, 2)))
    capitals = (F.length(t) < 80) & (F.upper(t) == t) & t.rlike(r"\p{Lu}") & ~t.endswith(".")
    short = (F.length(t) < 60) & t.rlike(r"^\p{Lu}") & ~t.endswith(".") & ~t.rlike(VERB)
    return case.when(capitals, found(F.lit(2), t)).when(short, found(F.lit(3), t))


def starts_element(line: Column) -> Column:
    t = L.stripped(line)
    return t.rlike(L.IMAGE) | t.rlike(L.CAPTION) | t.startswith("|") | t.contains("<table")


def element_type(line: Column) -> Column:
    """image, caption, table_markdown, table_html or unknown, by the first that fits."""
    t = L.stripped(line)
    return F.when(t.rlike(L.IMAGE), "image").when(t.rlike(L.CAPTION), "caption").when(t.contains("|"), "table_markdown").when(F.lower(t).contains("<table"), "table_html").otherwise("unknown")


def inside_paragraph(before: Column, after: Column) -> Column:
    """Whether what stands between two lines interrupts a paragraph; null for no line."""
    a, b = L.stripped(before), L.stripped(after)
    text = lambda t: (t != "") & heading_by_looks(t).isNull()
    no_stop = ~before.rlike(L.STOP)
    return F.coalesce(text(a) & ~a.rlike(L.STOP), F.lit(False)) | F.coalesce(text(b) & (L.starts_lower(b) | F.coalesce(no_stop, F.lit(False))), F.lit(False))


def is_open_text(kind: Column, text: Column) -> Column:
    t = L.stripped(text)
    return (kind == "text") & (F.length(t) > 50) & ~t.rlike(L.STOP)


def could_be_one(kind: Column, text: Column, next_kind: Column, next_text: Column) -> Column:
    """Why two blocks in a row could be one, or why not."""
    either = lambda k: (kind == k) | (next_kind == k)
    hyphen = L.stripped(text).endswith("-") & L.starts_lower(L.stripped(next_text))
    return (
        F.when(either("page_boundary"), "page boundary")
        .when(either("metadata"), "metadata")
        .when(kind != next_kind, "other kind")
        .when((kind == "text") & hyphen, "hyphenated word")
        .when(is_open_text(kind, text), "open sentence")
        .otherwise("no reason")
    )


def _has_any(text: Column, words: list[str]) -> Column:
    return reduce(lambda p, q: p | q, (F.lower(text).contains(w) for w in words))


def is_author_line(text: Column) -> Column:
    return _has_any(text, PLACE_WORDS) | ((F.upper(text) == text) & text.rlike(r"\p{Lu}") & text.contains(","))


def is_title_line(text: Column) -> Column:
    return (F.length(text) > 80) & _has_any(text, TITLE_WORDS)


def joins_next(text: Column, after: Column) -> Column:
    """Whether a text block takes the text block after it: author lines among themselves, long texts short ones."""
    long = (F.length(text) > 50) & (F.length(after) < 100) & ~is_author_line(after) & ~after.startswith("**") & ~after.startswith("#")
    return F.when(is_title_line(text), False).when(is_author_line(text), is_author_line(after)).otherwise(long)


def split_algorithm(text: Column) -> Column:
    """A text and the algorithm that begins inside it, fenced; the text alone if there is none."""
    at = F.regexp_instr(text, F.lit(BOLD_ALGORITHM))
    before = L.stripped(F.substr(text, F.lit(1), at - 1))
    fenced = F.concat(F.lit("```\n"), L.stripped(F.substr(text, at)), F.lit("\n```"))
    return F.when(at == 0, F.array(text)).otherwise(F.filter(F.array(before, fenced), lambda x: x != ""))
