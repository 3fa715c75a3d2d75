"""Token counts without tokens: count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton gives all pieces that end at a position; dynamic programming carries the
best score and the number of pieces of the best path, no back pointers. Ties go as in `unigram`.
Distinct parts of a text are counted once and kept while there is room.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliomend.llm.unigram import vocabulary

#: Parts whose counts a Python worker keeps, and characters of the longest kept.
CACHE_PARTS, CACHE_CHARS = 400_000, 64


class Counter(dict):
    """Number of pieces of a text's parts."""

    def __init__(self, path: str):
        import ahocorasick

        self.vocabulary = vocabulary(path)
        self.automaton = ahocorasick.Automaton()
        for piece, (_, score) in self.vocabulary.pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()

    def best(self, part: str) -> int:
        """From left to right: the best score up to each position, and how many pieces it takes."""
        known, unknown = self.vocabulary.pieces, self.vocabulary.unknown
        score, count = array("d", [0.0]), array("q", [0])
        matches = self.automaton.iter(part)
        match = next(matches, None)
        for end, c in enumerate(part, 1):
            top, pieces, longest = float("-inf"), 0, 0
            while match and match[0] == end - 1:
                length, value = match[1]
                s = score[end - length] + value
                if s > top or s == top and length > longest:
                    top, pieces, longest = s, count[end - length] + 1, length
                match = next(matches, None)
            # A character that is no piece may stand alone, in bytes; being the shortest, it loses ties.
            if c not in known and score[end - 1] + unknown > top:
                top, pieces = score[end - 1] + unknown, count[end - 1] + len(c.encode())
            score.append(top)
            count.append(pieces)
        return count[-1]

    def __missing__(self, part: str) -> int:
        n = self.best(part)
        if len(part) <= CACHE_CHARS:
            if len(self) >= CACHE_PARTS:
                self.clear()
            self[part] = n
        return n

    def of(self, text: str | None) -> int:
        return sum(map(self.__getitem__, self.vocabulary.split(text))) if text else 0


@lru_cache(2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_tokens.

    model: path of a SentencePiece model file, whose pieces are taken as a unigram vocabulary. Null
    and empty texts have no tokens. Whole texts are read, other columns are not; repeated rows get
    equal rows; an empty table gives an empty result. A part without a space takes sixteen bytes a
    character while it is counted.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = counter(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([tokens.of(t.as_py()) for t in batch.column(1)], pa.int64())], ["doc_id", "n_tokens"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(count, "doc_id long, n_tokens long")
