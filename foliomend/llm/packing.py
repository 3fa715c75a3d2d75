"""Packing of token sequences by non-negative least squares over a length histogram.

Documents are tokenised once. Each is cut at multiples of the window, so only what is left over
needs packing. Lengths are counted in units; all combinations of at most `depth` lengths that fill
a window exactly are enumerated, their repeat counts are solved by non-negative least squares
against the histogram, rounded down, and what remains is packed greedily (best fit, longest first)
on the histogram. The driver sees the histogram only, whose size is fixed; a piece finds its place
from its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliomend.llm.common import written

#: Distinct words whose ids a Python worker keeps.
CACHE_WORDS = 500_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, unit int, task int, nth long"


# The normaliser and the splitting of a tokenizer whose words can be taken one by one.
NORMALISER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTING = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}


def by_words(path: str) -> bool:
    """Whether a tokenizer file has that normaliser, that splitting and a BPE model."""
    found = json.loads(Path(path).read_text(encoding="utf-8"))
    return (found.get("normalizer"), found.get("pre_tokenizer"), found["model"].get("type")) == (NORMALISER, SPLITTING, "BPE")


class WordIds(dict):
    """Ids of white-space separated words, as little-endian 32-bit integers, kept while there is room.

    Where by_words holds, the tokenizer drops white space before it splits, so a text's ids are those
    of its words; words of plain Latin letters go straight to the tokenizer's own model, all others,
    special tokens among them, through the whole tokenizer. With any other tokenizer file whole texts do.
    """

    PLAIN = re.compile("([a-zß-öø-ÿ]+)([.,;:!?()]*)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.marks: dict[str, bytes] = {"": b""}
        self.by_words = by_words(path)

    def ids(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if m := self.PLAIN.fullmatch(text):
            letters, marks = m.groups()
            if not letters.isascii():
                letters = self.as_bytes(letters)[0][0]
            ids = np.array([t.id for t in self.model.tokenize(letters)], "<u4").tobytes()
            if marks not in self.marks:
                self.marks[marks] = self.ids(marks)
            ids += self.marks[marks]
        else:
            ids = self.ids(text)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) < 64:
            self[word] = ids
        return ids

    def of(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_words:
            return self.ids(text)
        if "<|" in text:  # may hold a special token, which lower case would make or break
            words = text.encode().split()
        else:
            try:
                text.encode("latin-1")
                words = text.lower().encode().split()
            except UnicodeEncodeError:
                words = text.encode().lower().split()
        return b"".join(map(self.__getitem__, words))


_WORDS: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One cache for each Python worker: tasks that follow one another share it."""
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path]


def pieces(docs: DataFrame, tokenizer: str, window: int, units: int, end_id: int | None, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, unit, task, nth): the pieces of each document.

    unit: length in window / units tokens, rounded up. nth: rank among the task's pieces of that unit.
    """
    step = -(-window // units)
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, task, count = word_ids(tokenizer), TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = words.of(text.as_py()) + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start : 4 * (start + window)]
                    length = len(part) // 4
                    unit = -(-length // step)
                    rows.append((doc, start, length, zlib.crc32(part), total, unit, task, count[unit]))
                    count[unit] += 1
            columns = list(zip(*rows)) or [[]] * 8
            kinds = (pa.int64(),) * 5 + (pa.int32(),) * 2 + (pa.int64(),)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in PIECES.split(", ")])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(cut, PIECES)


def fillings(units: int, depth: int) -> list[tuple[int, ...]]:
    """All ways to fill a window of so many units with 2 to depth lengths, longest first."""
    found = []

    def extend(parts: tuple[int, ...], left: int) -> None:
        if not left:
            found.append(parts)
        elif len(parts) < depth:
            for n in range(min(left, parts[-1] if parts else units - 1), 0, -1):
                if n * (depth - len(parts)) >= left:
                    extend((*parts, n), left - n)

    extend((), units)
    return found


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The x >= 0 that minimises |a x - b|, by active sets (Lawson and Hanson 1974)."""
    gram, target = a.T @ a, a.T @ b
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(3 * a.shape[1]):
        gain = np.where(active, -np.inf, target - gram @ x)
        best = int(gain.argmax())
        if gain[best] <= tolerance:
            break
        active[best] = True
        while True:
            on = np.flatnonzero(active)
            s = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            if s.min() > 1e-12:
                break
            low = s <= 1e-12
            with np.errstate(divide="ignore", invalid="ignore"):
                ratio = np.where(low, x[on] / (x[on] - s), np.inf)
            ratio = np.nan_to_num(ratio, nan=0.0, posinf=np.inf)
            x[on] += min(1.0, ratio.min()) * (s - x[on])
            active[on[(x[on] <= 1e-12) & low]] = False
            x[~active] = 0
            if not active.any():
                break
        x[:] = 0
        if active.any():
            x[on] = s
    return x


def plan(histogram: dict[int, int], units: int, depth: int = 3) -> list[tuple[tuple[int, ...], int]]:
    """Combinations of lengths and how often each is used; together they hold every piece once."""
    left = {n: c for n, c in histogram.items() if c}
    chosen: list[tuple[tuple[int, ...], int]] = []
    b = np.array([left.get(n, 0) for n in range(1, units)], float)
    if b.sum():
        ways = [w for w in fillings(units, depth) if all(n in left for n in w)]
        if ways:
            a = np.zeros((units - 1, len(ways)))
            for j, w in enumerate(ways):
                for n in w:
                    a[n - 1, j] += 1
            for w, times in zip(ways, nnls(a, b / b.sum()) * b.sum()):
                times = min([int(times), *(left[n] // w.count(n) for n in set(w))])
                if times > 0:
                    chosen.append((w, times))
                    for n in w:
                        left[n] -= times
    return chosen + greedy(left, units)


def greedy(left: dict[int, int], units: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, on counts: windows with equal contents are handled together."""
    room: dict[int, list[list]] = defaultdict(list)
    free: list[int] = []

    def put(parts: tuple[int, ...], times: int) -> None:
        r = units - sum(parts)
        if not room[r]:
            bisect.insort(free, r)
        room[r].append([parts, times])

    for n in sorted(left, reverse=True):
        count = left[n]
        while count:
            at = bisect.bisect_left(free, n)
            if at < len(free):
                r = free[at]
                parts, times = room[r].pop()
                if not room[r]:
                    free.pop(at)
                fits = r // n
                if count >= times * fits:
                    put(parts + (n,) * fits, times)
                    count -= times * fits
                else:
                    whole, rest = divmod(count, fits)
                    if whole:
                        put(parts + (n,) * fits, whole)
                    if rest:
                        put(parts + (n,) * rest, 1)
                    if times - whole - (rest > 0):
                        put(parts, times - whole - (rest > 0))
                    count = 0
            else:
                fits = units // n
                whole, rest = divmod(count, fits)
                if whole:
                    put((n,) * fits, whole)
                if rest:
                    put((n,) * rest, 1)
                count = 0
    return [(tuple(p), t) for groups in room.values() for p, t in groups]


def places(chosen: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank of each combination, its repeats of that length, first sequence and first slot."""
    base, out = 0, defaultdict(list)
    for parts, times in chosen:
        for n in dict.fromkeys(parts):
            out[n].append((parts.count(n) * times, parts.count(n), base, parts.index(n)))
        base += times
    found = {}
    for n, rows in out.items():
        size, repeats, first, slot = (np.array(x, np.int64) for x in zip(*rows))
        found[n] = (np.concatenate([[0], np.cumsum(size)[:-1]]), repeats, first, slot)
    return found


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, units: int = 128, depth: int = 3, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most `window` tokens.

    Returns one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Null
    and empty texts count as empty: with an end_id they are one piece of that id, without one they have
    no piece. Repeated rows are packed each for itself; a very long text is one row while it is tokenised. Other columns of docs are not read. An empty
    table gives an empty result. Only lengths pass through the driver: `units` counts.
    """
    table = written(pieces(docs, tokenizer, window, units, end_id, id_col, text_col), "pieces")
    counts = table.groupBy("task", "unit").agg(F.count("*").alias("n"))
    histogram = {r.unit: r.n for r in counts.groupBy("unit").agg(F.sum("n").alias("n")).collect()}
    where = places(plan(histogram, units, depth))
    before = counts.select("task", "unit", (F.sum("n").over(Window.partitionBy("unit").orderBy("task")) - F.col("n")).alias("before"))
    ranked = table.join(before, ["task", "unit"]).withColumn("nth", F.col("nth") + F.col("before"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, slot long"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, nth = (batch.column(k).to_numpy() for k in ("unit", "nth"))
            sequence, slot = np.zeros(len(unit), np.int64), np.zeros(len(unit), np.int64)
            for n in np.unique(unit):
                rows = np.flatnonzero(unit == n)
                first_rank, repeats, first, first_slot = where[int(n)]
                k = np.searchsorted(first_rank, nth[rows], "right") - 1
                inside = nth[rows] - first_rank[k]
                sequence[rows] = first[k] + inside // repeats[k]
                slot[rows] = first_slot[k] + inside % repeats[k]
            kept = [batch.column(k) for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(slot)], [x.split()[0] for x in schema.split(", ")])

    so_far = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranked.select(*(x.split()[0] for x in PIECES.split(", "))).mapInArrow(place, schema)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(so_far), F.lit(0)).cast("long").alias("offset"))


