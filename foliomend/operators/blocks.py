"""Lexing of Markdown into blocks. A block's end depends on how it was opened, so a scan in Python,
one document or page at a time in Arrow batches, finds the blocks; all else is left to expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliomend.functions import lines as L
from foliomend.functions.batches import slices

_LINE = re.compile(r"[^\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]*(?:\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]|$)")
_FENCE, _HTML_CODE, _DELIMITER, _HEADING = (re.compile(p) for p in (L.FENCE, L.HTML_CODE, L.TABLE_DELIMITER, L.HEADING))
_BLOCK_HTML, _ALGORITHM, _GENERATED = (re.compile(p) for p in (L.BLOCK_HTML, L.ALGORITHM, L.GENERATED))
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "meta", "param", "source", "track", "wbr"}
_MARKED_HTML = [("<!--", "-->"), ("<![CDATA[", "]]>"), ("<?", "?>")]


@dataclass
class Block:
    kind: str
    first: int
    last: int
    text: str


def with_ends(text: str) -> list[str]:
    """The lines of a text with their ends."""
    return [m for m in _LINE.findall(text) if m]


def _until(lines: list[str], start: int, closes: Callable[[str], object]) -> int:
    """The first line from start on that closes, or the last line there is."""
    return next((j for j in range(start, len(lines)) if closes(lines[j])), len(lines) - 1)


def _fenced(lines: list[str], i: int) -> int | None:
    if m := _FENCE.match(lines[i]):
        return _until(lines, i + 1, lambda x: x.lstrip().startswith(m[1]))
    return None


def _math(lines: list[str], i: int) -> int | None:
    return _until(lines, i + 1, lambda x: x.strip() == "$$") if lines[i].strip() == "$$" else None


def _table(lines: list[str], i: int) -> int | None:
    if "|" in lines[i] and i + 1 < len(lines) and _DELIMITER.match(lines[i + 1]):
        end = _until(lines, i + 2, lambda x: "|" not in x or not x.strip())
        return end if end == len(lines) - 1 and "|" in lines[end] and lines[end].strip() else end - 1
    return None


def _html_code(lines: list[str], i: int) -> int | None:
    if m := _HTML_CODE.search(lines[i]):
        close = re.compile(rf"(?i)</{m[1]}\s*>")
        return _until(lines, i, close.search)
    return None


def _html(lines: list[str], i: int) -> int | None:
    s = lines[i].lstrip()
    for begin, end in _MARKED_HTML:
        if s.startswith(begin):
            return _until(lines, i, lambda x: end in x)
    if not (m := _BLOCK_HTML.match(s)):
        return None
    if (tag := m[1].lower()) in _VOID:
        return i
    opening, closing = re.compile(rf"(?i)<{tag}\b(?![^>]*?/>)"), re.compile(rf"(?i)</{tag}\s*>")
    depth = 0
    for j in range(i, len(lines)):
        depth += len(opening.findall(lines[j])) - len(closing.findall(lines[j]))
        if depth <= 0:
            return j
    return len(lines) - 1


def _footnote(lines: list[str], i: int) -> int | None:
    if re.match(r"\[\^[^\]]+\]:", lines[i]):
        j = i + 1
        while j < len(lines) and (re.match(r"\s{4,}", lines[j]) or not lines[j].strip()):
            j += 1
        return j - 1
    return None


def _indented(lines: list[str], i: int) -> int | None:
    if lines[i].startswith(("    ", "\t")):
        return _until([*lines, ""], i + 1, lambda x: not x.startswith(("    ", "\t"))) - 1
    return None


def _algorithm(lines: list[str], i: int) -> int | None:
    """To the line before the next heading or algorithm, blank lines and all else included."""
    if _ALGORITHM.match(lines[i].strip()):
        return _until([*lines, "# -"], i + 1, lambda x: _HEADING.match(x.strip()) or _ALGORITHM.match(x.strip())) - 1
    return None


def _one(test: Callable[[str], object]) -> Callable[[list[str], int], int | None]:
    return lambda lines, i: i if test(lines[i]) else None


#: Kinds in order of precedence, each with the rule that gives a block's last line.
REPAIR = [
    ("code_fence", _fenced),
    ("math_block", _math),
    ("table", _table),
    ("heading", _one(_HEADING.match)),
    ("algorithm", _algorithm),
    ("metadata", _one(lambda x: _GENERATED.match(x.strip()))),
    ("blank", _one(lambda x: not x.strip())),
]
PROTECT = [("CODEFENCE", _fenced), ("HTMLBLOCK", _html_code), ("HTMLBLOCK", _html), ("MATHBLOCK", _math), ("TABLE", _table), ("FOOTDEF", _footnote), ("INDENTCODE", _indented)]


def lex(text: str, rules: list, other: str) -> Iterator[Block]:
    lines, i = with_ends(text), 0
    while i < len(lines):
        kind, last = next(((k, end) for k, rule in rules if (end := rule(lines, i)) is not None), (other, i))
        yield Block(kind, i, last, "".join(lines[i : last + 1]))
        i = last + 1


def lex_blocks(pages: DataFrame, rules: list = REPAIR, other: str = "text", keep_blank: bool = False) -> DataFrame:
    """doc_id, page, block (from 0), kind, first, last, text: the blocks of each page, a plain line each for itself.

    Null texts have no blocks. pages: doc_id, page, text.
    """
    schema = "doc_id long, page int, block int, kind string, first int, last int, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 2):
            rows = []
            for doc, page, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = [b for b in lex(text or "", rules, other) if keep_blank or b.kind != "blank"]
                rows += [(doc, page, k, b.kind, b.first, b.last, b.text.rstrip("\n")) for k, b in enumerate(found)]
            columns = list(zip(*rows)) or [()] * 7
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in schema.split(", ")])

    return pages.select(F.col("doc_id").cast("long"), F.col("page").cast("int"), "text").mapInArrow(run, schema)


def repair_tables(blocks: DataFrame) -> DataFrame:
    """Blocks in which a paragraph that a table interrupts is whole again, in front of the table.

    A text, a table and a text are taken together where the first has an open sentence and the second
    begins in lower case; the joined text isn't looked at again, so in a chain of such places at a
    distance of two every second one is joined. Page by page; other kinds of block never reach the
    confidence that a repair needs. Adds merged: whether the text was joined.
    """
    order = Window.partitionBy("doc_id", "page").orderBy("block")
    kept = blocks.where("kind <> 'metadata'").withColumn("block", (F.row_number().over(order) - 1).cast("int"))
    before, after = L.stripped(F.col("text")), L.stripped(F.lead("text", 2).over(order))
    can = (F.col("kind") == "text") & (F.lead("kind").over(order) == "table") & (F.lead("kind", 2).over(order) == "text")
    can = F.coalesce(can & ~before.rlike(L.STOP) & L.starts_lower(after) & (L.split_confidence(before, after) >= 0.7), F.lit(False))
    marked = kept.withColumn("can", can).withColumn("lane", F.col("block") % 2)
    lane = Window.partitionBy("doc_id", "page", "lane").orderBy("block")
    runs = marked.withColumn("run", F.sum(F.when(F.col("can"), 0).otherwise(1)).over(lane))
    nth = F.sum(F.when(F.col("can"), 1).otherwise(0)).over(Window.partitionBy("doc_id", "page", "lane", "run").orderBy("block"))
    joined = runs.withColumn("merged", F.col("can") & (nth % 2 == 1))
    text = F.when(F.col("merged"), F.concat(F.regexp_replace("text", r"(?U)\s+\z", ""), F.lit(" "), F.regexp_replace(F.lead("text", 2).over(order), r"(?U)^\s+", ""))).otherwise(F.col("text"))
    done = joined.select("doc_id", "page", "block", "kind", "first", "last", text.alias("text"), "merged", F.coalesce(F.lag("merged", 2).over(order), F.lit(False)).alias("gone"))
    return done.where("NOT gone").drop("gone")


def split_types(blocks: DataFrame) -> DataFrame:
    """doc_id, page, block, type, confidence, strategy: every text, non-text, text window and what it looks like,
    acted upon or not; confidence under 0.7 is never acted upon."""
    order = Window.partitionBy("doc_id", "page").orderBy("block")
    middle = F.lead("kind").over(order)
    windows = blocks.select("doc_id", "page", "block", "kind", middle.alias("middle"), L.stripped(F.col("text")).alias("a"), F.lead("kind", 2).over(order).alias("third"), L.stripped(F.lead("text", 2).over(order)).alias("b"))
    windows = windows.where("kind = 'text' AND middle <> 'text' AND third = 'text'")
    a, b, m = F.col("a"), F.col("b"), F.col("middle")
    open_ = L.is_paragraph_split(a, b)
    case = lambda kind, sure, how: F.struct(F.lit(kind).alias("type"), sure.alias("confidence"), F.lit(how).alias("strategy"))
    found = (
        F.when(m.isin("image", "figure_caption") & open_, case("image_split", L.split_confidence(a, b), "merge_around_image"))
        .when((m == "table") & open_, case("table_split", L.split_confidence(a, b), "merge_around_table"))
        .when((m == "page_boundary") & a.endswith("-") & L.starts_lower(b), case("hyphen_split", F.lit(0.95), "merge_hyphenated"))
        .when((m == "page_boundary") & ~a.rlike(L.STOP) & L.starts_lower(b), case("sentence_split", F.lit(0.8), "merge_sentence"))
        .when(m.isin("code_fence", "algorithm") & open_, case("code_split", F.lit(0.6), "merge_around_code"))
        .when(~m.isin("image", "figure_caption", "table", "page_boundary", "code_fence", "algorithm") & open_ & (L.common_words(a, b) > 2), case("other_split", F.lit(0.5), "merge_conservative"))
    )
    return windows.select("doc_id", "page", "block", found.alias("found")).where("found IS NOT NULL").select("doc_id", "page", "block", "found.*")


def to_markdown(blocks: DataFrame) -> DataFrame:
    """doc_id, md: the blocks with a blank line between, page after page."""
    rows = blocks.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "block", "text"))).alias("rows"))
    return rows.select("doc_id", F.regexp_replace(F.array_join(F.transform("rows", lambda r: r["text"]), "\n\n"), "\n{3,}", "\n\n").alias("md"))


def rewritten(docs: DataFrame, rewrite: Callable[[str], str]) -> DataFrame:
    """doc_id, md: each text as a Python function gives it, batch by batch; null stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            texts = [None if t is None else rewrite(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "md"])

    return docs.select(F.col("doc_id").cast("long"), "md").mapInArrow(run, "doc_id long, md string")


def respaced(text: str) -> str:
    """A text with its blocks kept word for word, a blank line between any two blocks or lines."""
    return re.sub("\n{3,}", "\n\n", "\n\n".join(b.text.rstrip("\n") for b in lex(text, PROTECT, "plain")))
