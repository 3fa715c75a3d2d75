"""A unigram vocabulary: the pieces of a SentencePiece model file with their scores.

The best segmentation of a text has the largest sum of scores. A character that is no piece by
itself may stand alone as unknown, at the lowest score less UNKNOWN_PENALTY, and then becomes its
UTF-8 bytes. Of segmentations with equal sums up to some position, the one whose last piece there is
longest is taken. Sums are doubles, as in the Unigram model of `tokenizers`. White space follows
SentencePiece's usual form: a space before the text, and every space written as U+2581.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

SPACE = "▁"
UNKNOWN_PENALTY = 10.0


class Vocabulary:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.pieces: dict[str, tuple[int, float]] = {}
        self.byte_ids = [0] * 256
        self.shown: list[bytes] = [b""] * self.size
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte = int(piece[3:5], 16)
                self.byte_ids[byte], self.shown[i] = i, bytes([byte])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[piece] = (i, model.get_score(i))
                self.shown[i] = piece.replace(SPACE, " ").encode()
        self.unknown = min(s for _, s in self.pieces.values()) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.pieces))
        joined = [p for p in self.pieces if len(p) > 1]
        if any(not re.fullmatch(f"{SPACE}*[^{SPACE}]*", p) for p in joined):
            raise ValueError("a piece goes on after a word's end, so words can't be handled apart")
        # No piece joins these characters to others: a text can be cut at them.
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in joined))
        self.alone = np.zeros(256, bool)
        self.alone[list(alone.encode())] = True
        self.units = re.compile(f"[{alone}]|{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+" if alone else f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    def split(self, text: str) -> list[str]:
        """The parts of a text that are segmented each for itself; together they are the text."""
        return self.units.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def parts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The parts of all texts, as `split` gives them, one behind the other, and where each text's begin
        and the last one's end. Null counts as empty."""
        mark = SPACE.encode()
        with_mark = [b"" if not t else mark + t.replace(b" ", mark) for t in texts.cast(pa.large_binary()).to_pylist()]
        begin = np.concatenate([[0], np.cumsum([len(t) for t in with_mark])]).astype(np.int64)
        data = np.frombuffer(b"".join(with_mark), np.uint8)
        space = np.zeros(len(data) + 3, bool)  # where a U+2581 begins
        if len(data) > 2:
            space[: len(data) - 2] = (data[:-2] == mark[0]) & (data[1:-1] == mark[1]) & (data[2:] == mark[2])
        behind = np.concatenate([[False] * 3, space[: len(data)]])[: len(data)]  # where one has just ended
        alone = self.alone[data]
        first = alone | np.concatenate([[False], alone])[: len(data)] | (space[: len(data)] & ~behind)
        first[begin[:-1][begin[:-1] < len(data)]] = True
        at = np.flatnonzero(first)
        offsets = np.concatenate([at, [len(data)]]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data)), np.searchsorted(at, begin)


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    """One for each Python worker."""
    return Vocabulary(path)
