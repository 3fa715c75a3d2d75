"""Phrase collocations by position bitmaps: shift, AND and popcount, depth first, summed over shards.

A shard is a run of pieces of one language that a task meets, some megabytes of text. Its words get
positions, with one left free between two pieces. Each word keeps a bitmap of its positions,
compressed: only bytes that aren't zero are stored, with their numbers. A phrase's bitmap, shifted by
one position and ANDed with those of all words that have a byte in the same places, gives the bitmaps
of its extensions; their popcounts are the occurrences. Free positions stop phrases at the ends of
pieces. Phrases are extended depth first, some beginnings at a time, so memory follows a part of a
shard. Counts are summed over shards by one shuffle; each shard sends a phrase once.

Phrases of one and two words are counted in one pass. Each further length takes another, in which only
phrases are extended that occur often enough in the whole corpus, and only by words that make the last
words such a phrase too. Which ones these are is held in a bit filter of a fixed size: its false hits
cost rows of the shuffle and no right result, since the counts decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliomend.llm.common import LOWER, looked_up, mix, slices, word_hashes, written

#: Bytes of text in a shard, about, and bitmap bytes whose extensions are made at once.
SHARD, STEP = 1 << 21, 1 << 15
#: Bits of the filter: 16 MB, for any corpus. It is made in parts of PART bits.
FILTER, PART = 1 << 27, 1 << 16
NO_LANGUAGE = "und"
#: What a byte is: 0 part of a word, 1 between words, 2 between pieces.
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
COUNTS = "lang string, words int, phrase string, f long"


class Shard:
    """The words of some texts of one language, their positions and bitmaps."""

    def __init__(self, texts: list[pa.Array]):
        whole = pa.concat_arrays([t.cast(pa.large_string()) for t in texts])
        _, offsets, data = whole.buffers()
        offsets = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1]
        data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
        kind = KIND[data]
        inside = kind == 0
        begins = np.zeros(len(data) + 1, bool)  # where a text begins, and behind the last one
        begins[offsets - offsets[0]] = True
        before = np.concatenate([[False], inside[:-1]])[: len(data)]
        first = np.flatnonzero(inside & (~before | begins[:-1])).astype(np.int32)
        after = np.concatenate([inside[1:], [False]])[: len(data)]
        last = np.flatnonzero(inside & (~after | begins[1:])).astype(np.int32)
        cuts = np.flatnonzero((kind == 2) | begins[:-1]).astype(np.int32)
        self.n = len(first)
        ends = np.zeros(self.n + 1, np.int64)
        np.cumsum(last - first + 1, out=ends[1:])
        words = pa.LargeStringArray.from_buffers(self.n, pa.py_buffer(ends), pa.py_buffer(LOWER[data[inside]]))
        found = words.dictionary_encode()
        self.words, word = found.dictionary, found.indices.to_numpy(zero_copy_only=False)
        piece = np.searchsorted(cuts, first, "right")
        position = (np.arange(self.n) + np.cumsum(np.diff(piece, prepend=piece[:1]) > 0)).astype(np.int32)
        del data, kind, inside, begins, before, after, first, last, cuts, ends, words, found, piece
        # The words' bitmaps, in order of words: entries of one word are next to each other.
        order = np.argsort(word, kind="stable")
        word, position = word[order], position[order]
        self.word, self.block, self.bits = _merged(word, position >> 3, np.uint8(1) << (position & 7).astype(np.uint8))
        # The same entries in order of blocks, to find what lies in one.
        by_block = np.argsort(self.block, kind="stable")
        self.word_b, self.bits_b = self.word[by_block], self.bits[by_block]
        n_blocks = int(self.block[by_block[-1]]) + 2 if self.n else 1
        self.at = np.searchsorted(self.block[by_block], np.arange(n_blocks + 1)).astype(np.int32)

    def extended(self, group: np.ndarray, block: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bitmaps (group, word, block, bits) of every group's phrase followed by one more word."""
        group, block = np.concatenate([group, group]), np.concatenate([block, block + 1])
        bits = np.concatenate([bits << np.uint8(1), bits >> np.uint8(7)])
        some = np.flatnonzero((bits != 0) & (block < len(self.at) - 1))
        group, block, bits = group[some], block[some], bits[some]
        many = self.at[block + 1] - self.at[block]
        source = np.repeat(np.arange(len(many)), many)
        target = np.arange(len(source)) - np.repeat(np.cumsum(many) - many, many) + self.at[block][source]
        both = bits[source] & self.bits_b[target]
        hit = np.flatnonzero(both)
        source, target = source[hit], target[hit]
        return group[source], self.word_b[target], block[source], both[hit]


def _merged(word: np.ndarray, block: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of one word and block as one."""
    if not len(word):
        return word, block, bits
    new = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (block[1:] != block[:-1])]))
    return word[new], block[new], np.bitwise_or.reduceat(bits, new)


def _grouped(group: np.ndarray, word: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that brings entries of one (group, word) together, and where each begins in it."""
    key = group.astype(np.int64) * n_words + word
    order = np.argsort(key, kind="stable")
    key = key[order]
    return order, np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)


def _phrase_hash(hashes: list[np.ndarray], seed: np.uint64) -> np.ndarray:
    """Where a phrase is in the filter, from the hashes of its words and of its language."""
    h = np.full(len(hashes[0]), seed, np.uint64)
    for x in hashes:
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + x)
    return (h & np.uint64(FILTER - 1)).astype(np.int64)


def _hashes(words: pa.Array) -> np.ndarray:
    """A hash of each word; a word holds no white space, so it stays one word."""
    parts = [h for _, h, _ in word_hashes(words)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _seed(lang: str) -> np.uint64:
    h = 0
    for b in lang.encode():
        h = (h * 257 + b + 1) % 2**64
    return np.uint64(h)


def counted(shard: Shard, lang: str, least: int, most: int, often: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Occurrences of the shard's phrases of least to most words. often: the filter of frequent phrases
    of most - 1 words (or more than one); what isn't in it is neither extended nor counted as an end."""
    n_words, seed = len(shard.words), _seed(lang)
    hashes = _hashes(shard.words) if often is not None else None
    frequent = lambda *ws: (often[(at := _phrase_hash([hashes[w] for w in ws], seed)) >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    def row(size: int, phrases: list[np.ndarray], bits: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        text = shard.words.take(pa.array(phrases[0]))
        for more in phrases[1:]:
            text = pc.binary_join_element_wise(text, shard.words.take(pa.array(more)), pa.scalar(" ", pa.large_string()))
        f = np.add.reduceat(np.bitwise_count(bits).astype(np.int64), starts)
        n = len(f)
        return pa.RecordBatch.from_arrays([pa.array([lang] * n), pa.array(np.full(n, size, np.int32)), text.cast(pa.string()), pa.array(f)], ["lang", "words", "phrase", "f"])

    def deeper(phrases: list[np.ndarray], group: np.ndarray, block: np.ndarray, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
        """phrases: words of each group's phrase, place by place; its bitmaps are grouped in order."""
        for at in range(0, len(group), STEP):
            part = slice(at, at + STEP)
            if at:  # no group may be cut in two
                part = slice(max(at, int(np.searchsorted(group, group[at - 1], "right"))), at + STEP)
            end = int(np.searchsorted(group, group[min(part.stop, len(group)) - 1], "right"))
            if part.start >= end:
                continue
            part = slice(part.start, end)
            g, w, b, x = shard.extended(group[part], block[part], bits[part])
            size = len(phrases) + 1
            if often is not None and size == most and len(g):
                keep = frequent(*[p[g] for p in phrases[1:]], w)
                g, w, b, x = g[keep], w[keep], b[keep], x[keep]
            order, starts = _grouped(g, w, n_words)
            if not len(starts):
                continue
            g, w, b, x = g[order], w[order], b[order], x[order]
            found = [*(p[g[starts]] for p in phrases), w[starts]]
            if size >= least:
                yield row(size, found, x, starts)
            if size < most:
                inner = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(g)))
                if often is not None and size == most - 1:
                    keep = frequent(*found)
                    some = keep[inner]
                    inner, b, x = (np.cumsum(keep) - 1)[inner[some]], b[some], x[some]
                    found = [p[keep] for p in found]
                yield from deeper(found, inner, b, x)

    if not shard.n:
        return
    starts = np.flatnonzero(np.concatenate([[True], shard.word[1:] != shard.word[:-1]]))
    single = [np.arange(n_words)]
    if least == 1:
        yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([0], pa.int32()), pa.array([""]), pa.array([shard.n])], ["lang", "words", "phrase", "f"])
        yield row(1, [shard.word[starts]], shard.bits, starts)
    if most > 1:
        yield from deeper(single, shard.word, shard.block, shard.bits)


def counts(docs: DataFrame, least: int, most: int, often: Broadcast | None = None) -> DataFrame:
    """Shards' counts (lang, words, phrase, f) of phrases of least to most words in docs (lang, text); with
    least = 1 also the number of all words, as words = 0 and an empty phrase. Not summed yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if often is None else np.frombuffer(often.value, np.uint8)
        held: dict[str, list[pa.Array]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, texts in held.items():
                for found in counted(Shard(texts), lang, least, most, bits):
                    yield from (found.slice(i, 1 << 16) for i in range(0, found.num_rows, 1 << 16))
            held.clear()
            pa.default_memory_pool().release_unused()

        for batch in batches:
            for part in slices(batch, 1, SHARD // 2):
                for lang in part.column(0).unique().to_pylist():
                    texts = part.column(1).filter(pc.equal(part.column(0), lang))
                    held.setdefault(lang, []).append(texts)
                    size += texts.nbytes
                if size >= SHARD:
                    yield from flush()
                    size = 0
        yield from flush()

    return docs.mapInArrow(run, COUNTS)


def summed(shards: DataFrame) -> DataFrame:
    """Shards' counts added up. A shard has a phrase once and most phrases are in few shards, so they are
    shuffled as they are: adding up in each task first would hold all its phrases."""
    return shards.repartition("lang", "phrase").groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))


def bit_filter(frequent: DataFrame) -> bytes:
    """A filter of FILTER bits with the phrases of frequent (lang, phrase): parts of it are put together
    in tasks, and only those, of FILTER / 8 bytes in all, come to the driver."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in batch.column(0).unique().to_pylist():
                phrases = batch.column(1).filter(pc.equal(batch.column(0), lang))
                hashes = _hashes(phrases)
                n = len(hashes) // max(1, len(phrases))
                at = _phrase_hash([hashes[k::n] for k in range(n)], _seed(lang))
                yield pa.RecordBatch.from_arrays([pa.array(at // PART), pa.array((at % PART).astype(np.int32))], ["part", "bit"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for bits in batch.column(1):
                mask = np.zeros(PART, np.uint8)
                mask[bits.values.to_numpy(zero_copy_only=False)] = 1
                out.append(np.packbits(mask, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["part", "bits"])

    parts = frequent.select("lang", "phrase").mapInArrow(places, "part long, bit int").groupBy("part").agg(F.collect_set("bit").alias("bits"))
    whole = bytearray(FILTER // 8)
    for row in parts.mapInArrow(packed, "part long, bits binary").toLocalIterator():
        whole[row["part"] * PART // 8 : (row["part"] + 1) * PART // 8] = row["bits"]
    return bytes(whole)


def frequencies(docs: DataFrame, longest: int, fewest: int) -> DataFrame:
    """f of all phrases of up to `longest` words that occur `fewest` times or more, and of all words together."""
    spark = docs.sparkSession
    enough = F.col("f") >= fewest
    found = written(summed(counts(docs, 1, min(2, longest))).where(enough | (F.col("words") == 0)), "phrases")
    for size in range(3, longest + 1):
        often = spark.sparkContext.broadcast(bit_filter(found.where(F.col("words") == size - 1)))
        more = written(summed(counts(docs, size, size, often)).where(enough), "phrases")
        often.unpersist()
        found = found.unionByName(more)
    return found


def scored(candidates: DataFrame, f: DataFrame, longest: int) -> DataFrame:
    """candidates (lang, phrase, words, a) with l, r and score of the cut that scores lowest."""
    words = F.split("phrase", " ")
    cut = lambda k: F.struct(F.lit(k).alias("k"), F.array_join(F.slice(words, 1, k), " ").alias("left"), F.array_join(F.slice(words, k + 1, longest), " ").alias("right"))
    cuts = candidates.select("lang", "phrase", "a", F.explode(F.filter(F.array(*(cut(k) for k in range(1, longest))), lambda c: c["k"] < F.col("words"))).alias("cut")).select("lang", "phrase", "a", "cut.*")
    for side, name in (("left", "l"), ("right", "r")):
        cuts = written(cuts, "cuts")
        times = cuts.groupBy("lang", side).agg(F.count("*").alias("times"))
        table = written(f.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)).join(times, ["lang", side]), "parts")
        cuts = looked_up(cuts, table, ["lang", side])
    score = F.expr("cast(1000000 * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) as decimal(38,0)) div cast(cast(l as decimal(18,0)) * cast(r as decimal(18,0)) as decimal(38,0))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return cuts.groupBy("lang", "phrase", "a").agg(lowest.alias("low")).select("lang", "phrase", "a", "low.*").drop("k")


def collocations(docs: DataFrame, longest: int = 3, fewest: int = 10, inside: int = 50, top: int = 2000, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """One row per language and rank: lang, rank (from 1), phrase, a, l, r, n, score.

    A phrase of two to `longest` words that occurs a >= fewest times is cut after each of its words;
    the cut into parts with l and r occurrences scores floor(1000000 * a * a / (l * r)), the lowest
    score counts, of equal ones that of the earliest cut. Phrases inside a longer one that occurs in
    `inside` hundredths of the cases or more are left out. The first `top` of each language come back,
    by score, a and phrase (bytes). n: all words of the language. Words are runs other than space and
    tab within pieces; A-Z are lower-cased. A null language is `und`, a null text has no words; repeated
    rows count each for itself; other columns are not read; an empty table gives no rows. A piece is
    never cut, so memory follows SHARD or the longest text. docs is read once for each length from 2.
    Counts to 10^15 are exact.
    """
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    f = frequencies(rows, longest, fewest)
    candidates = f.where(F.col("words") >= 2).withColumnRenamed("f", "a")
    words = F.split("phrase", " ")
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("words") - 1), lambda m: F.transform(F.sequence(F.lit(1), F.col("words") - m + 1), lambda i: F.array_join(F.slice(words, i, m), " "))))
    longer = candidates.where("words > 2").select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), F.col("a").alias("b")).groupBy("lang", "phrase").agg(F.max("b").alias("b"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").where(F.col("b").isNull() | (100 * F.col("b") < inside * F.col("a"))).drop("b")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = scored(kept, f.where("words > 0"), longest).withColumn("rank", rank).where(F.col("rank") <= top)
    n = f.where("words = 0").select("lang", F.col("f").alias("n"))
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, unnest(w) AS a, unnest(w[2:]) AS b, unnest(w[3:]) AS c FROM w WHERE len(w) > 0),
f AS (
  SELECT lang, a AS phrase, 1 AS words, count(*) AS f FROM t GROUP BY ALL
  UNION ALL SELECT lang, a || ' ' || b, 2, count(*) FROM t WHERE b IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, a || ' ' || b || ' ' || c, 3, count(*) FROM t WHERE c IS NOT NULL GROUP BY ALL
),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, phrase, words, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words >= 2 AND f >= 10),
i AS (SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM c WHERE words = 3 UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM c WHERE words = 3),
k AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.lang = c.lang AND i.phrase = c.phrase AND 100 * i.a >= 50 * c.a)),
s AS (
  SELECT k.*, cut, array_to_string(w[1:cut], ' ') AS left_part, array_to_string(w[cut + 1:], ' ') AS right_part
  FROM k, range(1, 3) r(cut) WHERE cut < words
),
v AS (
  SELECT s.lang, s.phrase, s.a, l.f AS l, r.f AS r, cut, CAST(CAST(1000000 AS HUGEINT) * s.a * s.a // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM s JOIN f l ON l.lang = s.lang AND l.phrase = left_part JOIN f r ON r.lang = s.lang AND r.phrase = right_part
),
b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, CAST(row_number() OVER o AS INTEGER) AS rank, phrase, a, l, r, n, score FROM b JOIN n USING (lang)
WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER o <= 2000
"""
