"""SentencePiece encoding and decoding with a unigram vocabulary, in numpy batches.

The distinct parts of a batch of texts are grouped by length, and all parts of one length advance
together: at each end position, the hashes of their substrings of every length probe the sorted keys
of the pieces, and a vectorised maximum keeps the best score and a back pointer. Ties go as in
`unigram`. Parts are kept with their ids while there is room.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliomend.llm.common import slices
from foliomend.llm.unigram import vocabulary

#: Parts whose ids a Python worker keeps, characters of the longest kept, and parts that advance together.
CACHE_PARTS, CACHE_CHARS, TOGETHER = 200_000, 48, 2048
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Encoder:
    def __init__(self, path: str):
        self.vocabulary = v = vocabulary(path)
        self.power = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(v.longest, _BASE))])
        rows = sorted((int(self._prefixes(self._codes([p]))[0, -1]), len(p), i, s) for p, (i, s) in v.pieces.items())
        self.keys = np.array([r[0] for r in rows], np.uint64)
        if len(np.unique(self.keys)) != len(rows):
            raise ValueError("two pieces share a hash")
        self.lengths = np.array([r[1] for r in rows])
        pieces = {i: p for p, (i, _) in v.pieces.items()}
        self.codes = np.frombuffer("".join(pieces[r[2]] for r in rows).encode("utf-32-le"), np.uint32)
        self.at = np.concatenate([[0], np.cumsum(self.lengths)])
        self.ids = np.array([r[2] for r in rows], np.uint32)
        self.scores = np.array([r[3] for r in rows])
        # Most substrings are no piece: a bit for each slot of the keys tells so before the search.
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self._slot(self.keys)] = True
        self.single = np.zeros(0x110000, bool)
        self.single[[ord(p) for p in v.pieces if len(p) == 1]] = True
        self.kept: dict[str, bytes] = {}

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(44)

    @staticmethod
    def _codes(parts: list[str]) -> np.ndarray:
        return np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32).reshape(len(parts), -1)

    @staticmethod
    def _prefixes(codes: np.ndarray) -> np.ndarray:
        """Hashes of the first 0, 1, ... characters."""
        h = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
        for k in range(codes.shape[1]):
            h[:, k + 1] = h[:, k] * _BASE + codes[:, k] + np.uint64(1)
        return h

    def _is_piece(self, at: np.ndarray, codes: np.ndarray, rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Whether each piece has the very characters of its row from its start on."""
        length = self.lengths[at]
        first = np.cumsum(length) - length
        offset = np.arange(length.sum()) - np.repeat(first, length)
        differs = self.codes[np.repeat(self.at[at], length) + offset] != codes[np.repeat(rows, length), np.repeat(starts, length) + offset]
        return np.add.reduceat(np.concatenate([differs, [0]]), first) == 0 if len(at) else np.zeros(0, bool)

    def viterbi(self, parts: list[str], careful: bool = False) -> list[bytes]:
        """Ids, as little-endian 32-bit integers, of parts of one length.

        Hashes find the pieces; the characters of those on the best path are compared. A best path of
        true pieces only is also the best without false ones; should it hold a false one, all pieces
        found are compared before they count (careful).
        """
        codes = self._codes(parts)
        n, size = codes.shape
        # Position by position, so that what is done to all parts at one position lies together.
        h = np.ascontiguousarray(self._prefixes(codes).T)
        known = self.single[codes.T]
        rows = np.arange(n)
        score = np.full((size + 1, n), -np.inf)
        score[0] = 0
        back, piece = np.zeros((size + 1, n), np.int32), np.zeros((size + 1, n), np.int32)
        longest = self.vocabulary.longest
        all_sums, all_pieces = np.empty((longest, n)), np.zeros((longest, n), np.int32)
        for end in range(1, size + 1):
            low = max(0, end - longest)  # the longest substring first: it wins ties
            key = h[end] - h[low:end] * self.power[end - low : 0 : -1, None]
            k, r = np.nonzero(self.maybe[self._slot(key)])
            key = key[k, r]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = np.flatnonzero((self.keys[at] == key) & (self.lengths[at] == end - low - k))
            r, k, at = r[found], k[found], at[found]
            if careful:
                true = self._is_piece(at, codes, r, low + k)
                r, k, at = r[true], k[true], at[true]
            sums, pieces = all_sums[: end - low], all_pieces[: end - low]
            sums.fill(-np.inf)
            sums[k, r] = score[low + k, r] + self.scores[at]
            pieces[k, r] = at
            best = sums.argmax(axis=0)
            most = sums[best, rows]
            alone = np.where(known[end - 1], -np.inf, score[end - 1] + self.vocabulary.unknown)
            own = alone > most
            score[end] = np.where(own, alone, most)
            back[end] = np.where(own, end - 1, low + best)
            piece[end] = np.where(own, -1, pieces[best, rows])
        # All parts follow their back pointers together, from the end.
        position, found, starts = np.full(n, size), [], []
        while (position > 0).any():
            found.append(np.where(position > 0, piece[position, rows], -2))
            position = np.where(position > 0, back[position, rows], 0)
            starts.append(position)
        steps, starts = np.array(found[::-1]).T, np.array(starts[::-1]).T
        taken = steps != -2
        r, k = np.nonzero(steps >= 0)
        if not careful and not self._is_piece(steps[r, k], codes, r, starts[r, k]).all():
            return self.viterbi(parts, careful=True)
        end = np.cumsum(taken.sum(axis=1)) * 4
        data = self.ids[np.maximum(steps[taken], 0)].tobytes()
        out = [data[i:j] for i, j in zip([0, *end[:-1].tolist()], end.tolist())]
        for i in np.flatnonzero((steps == -1).any(axis=1)):
            out[i] = b"".join(self._with_bytes(parts[i], steps[i][taken[i]]))
        return out

    def _with_bytes(self, part: str, row: np.ndarray) -> Iterator[bytes]:
        at = 0
        for p in row:
            if p >= 0:
                yield self.ids[p].tobytes()
                at += int(self.lengths[p])
            else:
                yield np.array([self.vocabulary.byte_ids[b] for b in part[at].encode()], "<u4").tobytes()
                at += 1

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and where each text's ids begin and the last one's end. Null counts as empty."""
        parts, of = self.vocabulary.parts(texts)
        found = parts.dictionary_encode()
        ids = self._ids(found.dictionary.to_pylist())
        number = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        each = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(number)])), pa.array(np.frombuffer(b"".join(ids), np.int32)))
        index = found.indices.to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(number[index])])
        return each.take(found.indices).flatten().to_numpy(zero_copy_only=False), ends[of]

    def _ids(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts."""
        out = list(map(self.kept.get, parts))
        new: dict[int, list[int]] = defaultdict(list)
        for i, ids in enumerate(out):
            if ids is None:
                new[len(parts[i])].append(i)
        if len(self.kept) > CACHE_PARTS:
            self.kept.clear()
        for size, places in new.items():
            step = max(1, min(TOGETHER, (1 << 21) // size))
            for at in range(0, len(places), step):
                some = [parts[i] for i in places[at : at + step]]
                found = self.viterbi(some)
                for i, ids in zip(places[at : at + step], found):
                    out[i] = ids
                if size <= CACHE_CHARS:
                    self.kept.update(zip(some, found))
        return out


@lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, text, ids (array of int), ids_crc32 (of the ids as little-endian unsigned 32-bit integers).

    model: path of a SentencePiece model file, whose pieces are taken as a unigram vocabulary. Null
    and empty texts have no ids. Whole texts are read, other columns are not; repeated rows get equal
    rows; an empty table gives an empty result. Of a part without a space some forty bytes a character
    are held, and it is gone through character by character.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for batch in batches:
            for part in slices(batch, 1, 1 << 21):
                found, at = own.encode(part.column(1))
                ids = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(found))
                check = [zlib.crc32(found[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), ids, pa.array(check, pa.int64())], ["doc_id", "text", "ids", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, text string, ids array<int>, ids_crc32 long")


#: Rows that are decoded at once.
ROWS = 512


def decode(encoded: DataFrame, model: str, ids_col: str = "ids") -> DataFrame:
    """All columns of encoded, and decoded: the text of the ids.

    Null ids give null, no ids an empty text. Ids out of range and control pieces show as nothing,
    bytes that are no UTF-8 as U+FFFD. A column `decoded` that is there already is replaced.
    """
    encoded = encoded.drop("decoded")
    names = encoded.columns
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown = pa.array([*vocabulary(model).shown, b""], pa.large_binary())
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            ids = batch.column(names.index(ids_col))
            flat = ids.flatten().to_numpy(zero_copy_only=False)
            lengths = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(lengths)])
            taken = shown.take(pa.array(np.where((flat >= 0) & (flat < len(shown) - 1), flat, len(shown) - 1)))
            _, offsets, data = taken.buffers()
            at = np.frombuffer(offsets, np.int64)[ends].tolist()
            data = data.to_pybytes() if data is not None else b""
            texts = [data[i:j].removeprefix(b" ").decode("utf-8", "replace") if v else None for v, i, j in zip(ids.is_valid().to_pylist(), at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, "decoded"])

    return encoded.mapInArrow(run, schema)


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_pieces, ids_crc32, round_trip: whether the decoded text is the text, with U+2581 as a space."""
    same = F.translate(F.coalesce("text", F.lit("")), "▁", " ") == F.coalesce("decoded", F.lit(""))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids_crc32", same.alias("round_trip"))
