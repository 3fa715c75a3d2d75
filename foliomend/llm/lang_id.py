"""Language identification by string kernels.

The kernel of two texts is the blended spectrum in its presence form: the number of n-grams of
length 2 to 4 that both hold, over the geometric mean of their numbers of n-grams. A Nystroem map
on landmark texts makes it finite, and one-versus-rest kernel ridge regression is solved on it.
Texts are scored in batches: presence matrix times landmark matrix, then times coefficients.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomend.llm.common import LETTER, LOWER, sampled

#: Slots that n-grams are hashed to; lengths of the n-grams in bytes.
SLOTS, LENGTHS = 1 << 15, (2, 3, 4)
#: Training texts and landmarks among them, at most; languages take turns.
SAMPLE, LANDMARKS = 2048, 128
#: Texts scored at once, and bytes of a text taken at once.
BATCH, SEGMENT = 128, 1 << 18
NO_LANGUAGE = "und"
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def has_letter(text: str, data: bytes) -> bool:
    return bool(_ASCII_LETTER.search(data)) or not text.isascii() and any(map(str.isalpha, text))


def presence(data: bytes, out: np.ndarray) -> None:
    """Set out[slot] for each n-gram of the text: lower-cased bytes, all but letters as spaces."""
    low = LOWER[np.frombuffer(b" " + data + b" ", np.uint8)]
    low = np.where(LETTER[low], low, np.uint8(32))
    for at in range(0, len(low) - 1, SEGMENT):
        part = low[at : at + SEGMENT + max(LENGTHS) - 1]
        letter = part != 32
        code = part.astype(np.uint32)
        for n in range(2, max(LENGTHS) + 1):
            code = (code[:-1] << np.uint32(8)) | part[n - 1 :]
            if not len(code):
                break
            if n in LENGTHS:
                some = letter[: len(code)] | letter[n - 1 :]
                hashed = (code[some] ^ np.uint32(n * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(0x9E3779B1)
                out[((hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x85EBCA77)) >> np.uint32(17)] = True


@dataclass
class KernelModel:
    languages: list[str]
    landmarks: np.ndarray
    """A column per landmark: presence over the root of its count."""
    coefficients: np.ndarray
    bias: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """One value per text and language, about 1 for the right one and -1 for others."""
        norm = np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))
        return (rows.astype(np.float32) @ self.landmarks) / norm @ self.coefficients + self.bias


def fit(rows: np.ndarray, languages: list[str], landmarks: int = LANDMARKS, ridge: float = 1e-3) -> KernelModel:
    """rows: presence of the training texts, of which the first are the landmarks."""
    names = sorted(set(languages))
    norm = np.sqrt(np.maximum(rows.sum(axis=1, keepdims=True), 1))
    marks = (rows[:landmarks] / norm[:landmarks]).astype(np.float32).T.copy()
    k = np.vstack([rows[i : i + 256].astype(np.float32) @ marks for i in range(0, len(rows), 256)]).astype(float) / norm
    value, vector = np.linalg.eigh(k[: marks.shape[1]])
    good = value > 1e-6 * value.max()
    to_map = vector[:, good] / np.sqrt(value[good])
    phi = k @ to_map
    y = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    weight = sum((np.array(languages) == n) / max(1, languages.count(n)) for n in names)[:, None] / len(names)
    mean, target = (weight * phi).sum(axis=0), (weight * y).sum(axis=0)
    centred = phi - mean
    w = np.linalg.solve(centred.T @ (weight * centred) + ridge * np.eye(phi.shape[1]) / len(phi), centred.T @ (weight * (y - target)))
    return KernelModel(names, marks, (to_map @ w).astype(np.float32), (target - mean @ w).astype(np.float32))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> KernelModel | None:
    """Fit on at most `sample` rows that are not held out and have a language and a text.

    Languages take turns, each in the order of a hash of the id, so that all are learned as far as
    the sample reaches. Rows with one id and language are one row of the sample, with the least of
    their texts in order. The sample's ids are broadcast, its n-grams found on the executors.
    """
    known = docs.where(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    chosen = sampled(known.select("id", "lang"), "lang", sample).orderBy("turn", "lang").limit(sample)
    found = known.join(F.broadcast(chosen), ["id", "lang"]).groupBy("turn", "lang").agg(F.min("text").alias("text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = []
            for text in batch.column(2):
                row = np.zeros(SLOTS, bool)
                presence((text.as_py() or "").encode(), row)
                bits.append(np.packbits(row).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bits, pa.binary())], ["turn", "lang", "bits"])

    rows = found.mapInArrow(extract, "turn int, lang string, bits binary").toPandas().sort_values(["turn", "lang", "bits"])
    if not len(rows):
        return None
    return fit(np.unpackbits(np.frombuffer(b"".join(rows["bits"]), np.uint8).reshape(len(rows), -1), axis=1).view(bool), list(rows["lang"]))


def identifier(model: KernelModel | None) -> Callable[[Column], Column]:
    """A column function: text to (lang_pred, score), as `identify` describes them."""

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        names, scores = [NO_LANGUAGE] * len(texts), np.zeros(len(texts))
        for at in range(0, len(texts) if model else 0, BATCH):
            rows, which = np.zeros((BATCH, SLOTS), bool), []
            for k, text in enumerate(texts[at : at + BATCH]):
                text = text.as_py() or ""
                data = text.encode()
                if has_letter(text, data):
                    presence(data, rows[len(which)])
                    which.append(at + k)
            if which:
                values = model.scores(rows[: len(which)])
                best = values.argmax(axis=1)
                scores[which] = np.clip((values[np.arange(len(which)), best] + 1) / 2, 0, 1)
                for k, b in zip(which, best):
                    names[k] = model.languages[b]
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang_pred", "score"])

    return predict


def identify(docs: DataFrame, model: KernelModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score.

    Null texts and texts without a letter are `und` with score 0, as is everything when there was
    nothing to learn from. score: where the best language's value lies between -1 and 1, as 0 to 1.
    Only id and whole text are read; repeated rows get equal rows; an empty table gives an empty result.
    """
    verdict = identifier(model)(F.col(text_col).cast("string")).alias("verdict")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), verdict).select("doc_id", "held_out", "verdict.*")
