"""Shared helpers: joins with hot keys, and word hashes computed a batch at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliomend.sources.shared import written as written


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: A key is hot if it has more than one in HOT of all rows, so fewer than HOT keys are.
HOT = 1000


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], small: Column | None = None) -> DataFrame:
    """rows joined with table, which has one row per key and in `times` the number of rows that have it.

    The values of hot keys are broadcast, fewer than HOT rows, so that their rows stay where they
    are; only the others are shuffled. small: which rows of table are of bounded size. Both sides are
    read more than once. Rows whose key is not in table go.
    """
    total = table.agg(F.sum("times")).head()[0] or 0
    hot = F.col("times") * HOT > total
    if small is not None:
        hot = hot & small
    few = F.broadcast(table.where(hot).drop("times"))
    rest = rows.join(F.broadcast(table.where(hot).select(*keys)), keys, "left_anti").join(table.where(~hot).drop("times"), keys)
    return rows.join(few, keys).unionByName(rest)


#: Parts of a group that are thinned each for itself before a sample is taken.
PARTS = 64


def sampled(rows: DataFrame, group: str, most: int) -> DataFrame:
    """At most `most` of each group's distinct rows (id, group), with `turn`: their rank by a hash of the id.

    Parts of a group by that hash are thinned first, to 4 * most / PARTS rows each, so that the task
    which ranks a group gets no more than 4 * most rows of it, whatever the group's size.
    """
    by_hash = [F.xxhash64("id"), F.col("id")]
    thin = F.row_number().over(Window.partitionBy(group, "_part").orderBy(*by_hash))
    few = rows.withColumn("_part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(PARTS))).withColumn("_thin", thin).where(F.col("_thin") <= -(-4 * most // PARTS))
    turn = F.row_number().over(Window.partitionBy(group).orderBy(*by_hash))
    return few.select("id", group).distinct().withColumn("turn", turn).where(F.col("turn") <= most)


# ---------------------------------------------------------------- word hashes

#: The six characters that separate words.
ASCII_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes hashed at once; a longer text is cut between two words.
SEGMENT = 1 << 19

_rng = np.random.Generator(np.random.PCG64(20240611))
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[list(ASCII_SPACE)] = False
#: ASCII letters and every byte of a longer UTF-8 character.
LETTER = np.zeros(256, bool)
LETTER[97:123] = LETTER[65:91] = LETTER[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which each input bit moves all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n - 1).bit_length())
    if size not in _POWERS:
        inverse = pow(_BASE, -1, 2**64)
        _POWERS.clear()
        _POWERS[size] = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, b, np.uint64))]) for b in (_BASE, inverse))
    return _POWERS[size]


def _hash_words(data: np.ndarray, starts: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words in data, in order, and where each begins.

    starts: offsets at which a new text begins. A word is a run of bytes b with word_byte[b].
    """
    low = LOWER[data]
    inside = word_byte[low]
    if not inside.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    begin, end = np.flatnonzero(first), np.flatnonzero(last)
    power, inverse = _powers(len(data))
    total = np.cumsum(_BYTE[low] * power[: len(data)])
    before = np.where(begin > 0, total[begin - 1], np.uint64(0))
    return mix((total[end] - before) * inverse[begin] + (end - begin + 1).astype(np.uint64)), begin


def word_hashes(texts: pa.Array, word_byte: np.ndarray = NOT_SPACE) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Word hashes of a batch of texts, a few texts at a time: (index of the first text, hashes
    of all words in order, words per text). Null counts as empty. A-Z are lower-cased.

    Memory follows SEGMENT, plus eight bytes for each word of the longest text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, off, buf = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(off, off[i] + SEGMENT, "right")) - 1)
        if j == i + 1:
            out, at, end = [], off[i], off[i + 1]
            while at < end:
                cut = min(at + SEGMENT, end)
                while cut < end and word_byte[data[cut]]:
                    cut += 1
                out.append(_hash_words(data[at:cut], np.zeros(1, np.int64), word_byte)[0])
                at = cut
            h = np.concatenate(out) if out else np.zeros(0, np.uint64)
            yield i, h, np.array([len(h)])
        else:
            local = off[i : j + 1] - off[i]
            h, begin = _hash_words(data[off[i] : off[j]], local[:-1][local[:-1] < local[-1]], word_byte)
            yield i, h, np.diff(np.searchsorted(begin, local, "left"))
        i = j


def slices(batch: pa.RecordBatch, column: int, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose texts have about `most` bytes together, or one text that is longer."""
    size = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, before + most, "right")))
        yield batch.slice(at, end - at)
        at = end
