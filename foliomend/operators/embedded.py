"""Paragraphs that images, captions or tables interrupt, and algorithms: runs of lines, found from marks.

What a line is, is decided by column expressions, once for each line: `marks` holds the answers as bits.
From these a text's runs follow as a whole: lines that go on one from the other, table rows, HTML
tables by the sum of opened and closed ones. A run's end is a lookup, so a text takes time in
proportion to its lines. Python, in Arrow batches, only goes from one interruption to the next
and puts the text together.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomend.functions import lines as L
from foliomend.functions.batches import cuts, slices

(BLANK, IMAGE, CAPTION, HTML, PIPES, PICTURE, STOP, SHORT, OPEN, OPEN_INSIDE, ENDS, LOWER, HEADING, LISTED, QUOTED, QUOTE_LAST) = (1 << k for k in range(16))


def marks(text: Column) -> Column:
    """For each line of a text the bits above."""
    def line(t: Column) -> Column:
        return F.struct(t.alias("t"), L.head(t).alias("head"), L.tail(t).alias("end"))

    def hanging(x: Column) -> Column:
        return F.struct(x["t"].alias("t"), x["head"].alias("head"), x["end"].alias("end"), L.hangs(x["end"]).alias("open"))

    def bits(x: Column) -> Column:
        t, head, end, hangs = x["t"], x["head"], x["end"], x["open"]
        answers = {
            BLANK: t == "",
            IMAGE: L.image(t),
            CAPTION: L.caption(t),
            HTML: L.html_table(t),
            PIPES: L.pipes(t),
            PICTURE: t.contains("<img"),
            STOP: L.stops(end),
            SHORT: L.short_abbreviation(end),
            OPEN: hangs,
            # A space before it tells only in a line that is no more than a word.
            OPEN_INSIDE: hangs | ((F.length(end) < L.TAIL) & L.hangs(F.concat(F.lit(" "), t))),
            ENDS: L.ends_quoted(end),
            LOWER: L.starts_lower(head),
            HEADING: L.heads(t, head),
            LISTED: L.listed(t, head),
            QUOTED: t.contains('"'),
            QUOTE_LAST: t.endswith('"'),
        }
        return _packed(answers)

    return F.transform(F.transform(F.transform(F.transform(F.split(text, "\n"), L.trimmed), line), hanging), bits)


def _where(condition: Column, bits: Column) -> Column:
    """The marks of a text that may need them, no marks of another one."""
    return F.when(condition, bits).otherwise(F.array().cast("array<int>"))


def _packed(answers: dict[int, Column]) -> Column:
    out = F.lit(0)
    for bit, answer in answers.items():
        out = out.bitwiseOR(F.when(answer, bit).otherwise(0))
    return out


def _positions(where: np.ndarray) -> list[int]:
    return np.flatnonzero(where).tolist()


def _first(positions: list[int], least: int, otherwise: int) -> int:
    """The first of the ascending positions from least on."""
    k = bisect_left(positions, least)
    return positions[k] if k < len(positions) else otherwise


class Lines:
    """The lines of a text with their marks: which go on, which belong to an element and how far that reaches."""

    def __init__(self, lines: list[str], bits: np.ndarray):
        self.lines, self.n = lines, len(lines)
        has = lambda bit: (bits & bit) != 0
        near = has(IMAGE | HTML | PIPES | PICTURE)
        beside = np.zeros(self.n, bool)
        for k in (1, 2):
            beside[k:] |= near[:-k] if self.n > k else False
            beside[:-k] |= near[k:] if self.n > k else False
        #: A caption counts with a picture or a table at most two lines away.
        self.caption = has(CAPTION) & beside
        self.image = has(IMAGE)
        self.html = has(HTML) & ~self.image & ~self.caption
        self.piped = has(PIPES) & ~self.image & ~self.caption & ~self.html
        self.table = self.html | self.piped
        self.other = self.image | self.caption | self.table
        self.blank, self.tag, self.pipes = has(BLANK), has(HTML), has(PIPES)
        self._tables = None

        length = np.fromiter((len(x.strip()) for x in lines), np.int64, self.n)
        self.raw = np.concatenate([[0], np.cumsum(np.fromiter(map(len, lines), np.int64, self.n))])
        self.stop, self.short, self.open_inside = has(STOP), has(SHORT), has(OPEN_INSIDE)
        #: A line of ten or more characters whose sentence seems to go on.
        self.open = (length >= 10) & np.where(self.stop, self.short, has(OPEN) | (length > 50))
        self.listed, self.quoted, self.quote_last = has(LISTED), has(QUOTED), has(QUOTE_LAST)
        #: May follow at all; follows whatever was before; closes a long sentence.
        self.able = ~has(BLANK | IMAGE | CAPTION | HTML | PIPES | HEADING)
        self.lower, self.closing = has(LOWER), has(ENDS) & (length > 100)
        before = slice(0, max(0, self.n - 1))
        on = np.zeros(self.n, bool)
        on[1:] = self._follows(np.arange(1, self.n), self.open[before], self.listed[before], self.quote_last[before], ~self.blank[before])
        #: Where no line goes on from the one before it.
        self.breaks = _positions(~(on & ~self.other))
        self.opening, self.others = _positions(self.open), _positions(self.other)

    def _follows(self, at: np.ndarray, is_open: np.ndarray, listed: np.ndarray, quote_last: np.ndarray, filled: np.ndarray) -> np.ndarray:
        """Whether the lines at these places go on after text of which this is known."""
        quotes = ~(listed & self.listed[at]) & quote_last & self.quoted[at]
        return filled & self.able[at] & (self.lower[at] | np.where(is_open, ~self.closing[at], quotes))

    def run_end(self, i: int) -> int:
        """Behind the last line of the run that line i is in."""
        return _first(self.breaks, i + 1, self.n)

    def resumes(self, first: int, end: int, j: int) -> bool:
        """Whether line j goes on after lines first .. end - 1 as one text."""
        if end - first == 1:
            is_open = self.open[first]
        else:
            head, tail = self.lines[first], self.lines[end - 1]
            length = int(self.raw[end] - self.raw[first]) + end - first - 1 - (len(head) - len(head.lstrip())) - (len(tail) - len(tail.rstrip()))
            is_open = length >= 10 and (self.short[end - 1] if self.stop[end - 1] else length > 50 or self.open_inside[end - 1])
        return bool(self._follows(np.array([j]), np.array([is_open]), self.listed[[first]], self.quote_last[[end - 1]], np.array([True]))[0])

    def _table_end(self, i: int) -> int:
        """Behind a table that begins at i: its rows, or HTML until as many tables are closed as opened."""
        if self.piped[i]:
            return max(i + 1, _first(self._table_index()[0], i, self.n))
        _, level, opens, same, same_outside = self._table_index()
        return _first(same.get(level[i], []), i + 1, self.n) if opens[i] else _first(same_outside.get(level[i], []), i + 2, self.n)

    def _table_index(self) -> tuple:
        """Lines without pipes; open tables before each line; lines that open one; for each level the
        places that have it, and those of them that are the end or before no HTML."""
        if self._tables is None:
            change, opens = [0] * self.n, [False] * self.n
            for i in _positions(self.tag):
                low = self.lines[i].lower()
                opens[i] = "<table" in low
                change[i] = low.count("<table") - low.count("</table>")
            level = [0, *np.cumsum(change).tolist()] if self.n else [0]
            same: dict[int, list[int]] = {}
            outside: dict[int, list[int]] = {}
            for at, x in enumerate(level):
                same.setdefault(x, []).append(at)
                if at == self.n or not self.tag[at]:
                    outside.setdefault(x, []).append(at)
            self._tables = _positions(~self.pipes), level, opens, same, outside
        return self._tables

    def element(self, i: int) -> tuple[list[str], int]:
        """The lines of the element that begins at i, its caption before or after it among them, and where it ends."""
        if self.caption[i]:
            gap = i + 1 < self.n and bool(self.blank[i + 1])
            at = i + 1 + gap
            body = at < self.n and bool(self.image[at] or self.table[at])
            end = at if not body else at + 1 if self.image[at] else self._table_end(at)
            return [self.lines[i], *[""] * gap, *self.lines[at:end]], end
        end = i + 1 if self.image[i] else self._table_end(i)
        gap = bool(self.image[i]) and end + 1 < self.n and bool(self.blank[end])
        if end + gap < self.n and self.caption[end + gap]:
            return [*self.lines[i:end], *[""] * gap, self.lines[end + gap]], end + gap + 1
        return self.lines[i:end], end

    def interruptions(self) -> list[tuple[int, int, list[tuple[int, int]], list[list[str]]]]:
        """(first, end, runs, elements): lines first .. end - 1 are one paragraph in those runs, with those elements."""
        out, at = [], 0
        for other in self.others:
            if other <= at:
                continue
            run = self.breaks[bisect_right(self.breaks, other - 1) - 1]
            first = _first(self.opening, max(at, run), self.n)
            if first >= other:
                continue
            runs, elements, at = [(first, other)], [], other
            while at < self.n and self.other[at]:
                lines, at = self.element(at)
                elements.append(lines)
                if at < self.n and not self.other[at] and self.resumes(*runs[-1], at):
                    runs.append((at, self.run_end(at)))
                    at = runs[-1][1]
            out.append((first, at, runs, elements))
        return out


def joined(parts: list[str]) -> str:
    """Parts of a paragraph as one: a hyphen goes before a small letter, a space comes between all else but before marks."""
    out: list[str] = []
    for raw in parts:
        part = raw.strip()
        if not part:
            continue
        if out and out[-1].endswith("-") and raw[0].islower():
            out[-1] = out[-1][:-1]
        elif out and (out[-1].endswith("-") or out[-1][-1] in ".!?,;:" or part[0] not in ".,;:!?)"):
            out.append(" ")
        out.append(part)
    return "".join(out)


def repaired(text: str, bits: np.ndarray) -> str:
    """The text, whose lines have these marks, with interrupted paragraphs whole and the elements behind them."""
    if not (bits & (IMAGE | CAPTION | HTML | PIPES)).any():
        return text
    lines, out, at = text.split("\n"), [], 0
    for first, end, runs, elements in Lines(lines, bits).interruptions():
        out += lines[at:first]
        out.append(joined([" ".join(lines[a:b]) for a, b in runs]))
        for element in elements:
            out += ["", *element]
        out.append("")
        at = end
    return "\n".join(out + lines[at:])


def _with_marks(text: Column, bits: Column, rewrite: Callable[[str, np.ndarray], str]) -> Column:
    """rewrite(text, marks) in Arrow batches, a slice of each at a time; null stays null."""

    @F.arrow_udf("string")
    def run(texts: pa.Array, marked: pa.Array) -> pa.Array:
        done = [pa.array([], pa.string())]
        for at, n in cuts(texts):
            done.append(pa.array([None if t is None else rewrite(t, b.values.to_numpy(zero_copy_only=False)) for t, b in zip(texts.slice(at, n).to_pylist(), marked.slice(at, n))], pa.string()))
        return pa.concat_arrays(done)

    return run(text, bits)


def repair_column(text: Column) -> Column:
    """A text with the paragraphs whole that images, captions or tables interrupt; null stays null."""
    # What no element can do without.
    elements = text.contains("|") | text.contains("<") | text.contains("![") | text.contains("Fig") | text.contains("Tab")
    return _with_marks(text, _where(elements, marks(text)), repaired)


# ------------------------------------------------------------- pseudocode

# What begins an algorithm, bold lines, headings and numbered steps; line ends.
TITLE = r"(?i)^\s*(?:\*\*)?\s*(?:Algorithm|算法)\s+([A-Za-z0-9.-]+)?\s*(?:\*\*)?\s*(.*)$"
BOLD = r"^\s*\*\*.+\*\*\s*$"
BOLD_LABEL = r"(?i)^\s*\*\*\s*(Input|Output|Procedure|Requires?|Ensure)\s*[:：]?\s*\*\*"
HASHES, NUMBERED_STEP = r"^\s*#{1,6}\s", r"^\d+\s*[:.)]\s"
#: In every text that has a title, whatever letter stands for an i.
MAY_HOLD_TITLE = "(?i)algor.thm|算法"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"
_TITLE, _LINE_END = re.compile(TITLE), re.compile(LINE_END)
(CODE, TITLED, ENDING, FREE, NUMBERED) = (1 << k for k in range(5))


def algorithm_marks(text: Column, old: bool) -> Column:
    """For each line: whether it is a code fence, a title, ends an algorithm at once, may stand in one at any place, is a numbered step."""
    steps = L.ALGORITHM_STEP_OLD if old else L.ALGORITHM_STEP_NEW

    def bits(x: Column) -> Column:
        s, t, head = x["s"], x["t"], x["head"]
        code, first = t.startswith("```"), F.substring(head, 1, 1)
        answers = {
            CODE: code,
            TITLED: first.isin("A", "a", "*", "算") & s.rlike("(?U)" + TITLE),
            ENDING: code | (t.startswith("#") & s.rlike("(?U)" + HASHES)) | (t.startswith("**") & s.rlike("(?U)" + BOLD) & ~s.rlike("(?U)" + BOLD_LABEL)),
            FREE: (t == "") | (t == "***") | L.algorithm_step(t, head, steps),
            NUMBERED: first.rlike(r"(?U)\d") & t.rlike("(?U)" + NUMBERED_STEP),
        }
        return _packed(answers)

    lines = F.transform(F.split(text, LINE_END), lambda s: F.struct(s.alias("s"), L.trimmed(s).alias("t")))
    lines = F.transform(lines, lambda x: F.struct(x["s"].alias("s"), x["t"].alias("t"), L.head(x["t"]).alias("head")))
    return _where(text.rlike(MAY_HOLD_TITLE), F.transform(lines, bits))


def _plain(s: str) -> str:
    """Subscripts to an underscore, emphasis marks off."""
    s = re.sub(r"(?i)<\s*sub\s*>\s*(.*?)\s*<\s*/\s*sub\s*>", lambda m: "_" + m[1].replace("*", ""), s)
    return re.sub(r"\*([^*]+)\*", r"\1", re.sub(r"\*\*([^*]+)\*\*", r"\1", s))


def _header(line: str) -> str:
    number, rest = ((x or "").strip() for x in _TITLE.match(line).groups())
    return "// " + _plain(f"Algorithm {number}: {rest}".strip() if number or rest else "Algorithm")


def wrapped(text: str, bits: np.ndarray, lang: str, old: bool) -> str:
    """Algorithms as fenced code with their title as a comment. By the old rules other lines pass until there was a numbered step."""
    lines = _LINE_END.split(text)
    if lines[-1] == "":
        lines.pop()
    bits = bits[: len(lines)]
    has = lambda bit: (bits & bit) != 0
    titles = _positions(has(TITLED) & (np.cumsum(has(CODE)) % 2 == 0))
    ending, foreign, steps = _positions(has(ENDING)), _positions(~has(FREE)), _positions(has(NUMBERED))
    out, at, n = [], 0, len(lines)
    for title in titles:
        if title < at:
            continue
        strict = _first(steps, title + 1, n) + 1 if old else title + 1
        end = min(_first(ending, title + 1, n), _first(foreign, strict, n))
        body = ["// " + "-" * 40 if x.strip() == "***" else _plain(x) for x in lines[title + 1 : end]]
        out += [*lines[at:title], f"```{lang}", _header(lines[title]), *body, "```"]
        at = end
    return "\n".join(out + lines[at:])


def wrapped_texts(docs: DataFrame, lang: str = "pseudo", old: bool = True) -> DataFrame:
    """doc_id, md of docs: each text as `wrapped` gives it; null stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            texts = [None if t is None else wrapped(t, b.values.to_numpy(zero_copy_only=False), lang, old) for t, b in zip(batch.column(1).to_pylist(), batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "md"])

    return docs.select(F.col("doc_id").cast("long"), "md", algorithm_marks(F.col("md"), old).alias("marks")).mapInArrow(run, "doc_id long, md string")


def wrap_pseudocode_column(text: Column, lang: str = "pseudo", old: bool = True) -> Column:
    """`wrapped` of a text column; null stays null."""
    return _with_marks(text, algorithm_marks(text, old), lambda t, bits: wrapped(t, bits, lang, old))
