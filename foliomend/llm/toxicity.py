"""Severity of toxic text by cumulative-link ordinal regression on sparse text features.

P(grade >= k | x) = sigmoid(w . x - t_k): one weight vector is shared by all thresholds t_1 <= t_2
<= ..., which are kept in order by construction (t_k = t_1 + sum of squares). A text's features are
its hashed windows of five bytes that lie in a word but for the first and the last byte, so that
the beginnings, ends and insides of words all show, in any language. The value of a feature is its
count over the square root of the number of windows. Weights go to the features that are present
more often in higher grades, by the likelihood ratio. The expected severity is the sum over k of P(grade >= k).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomend.llm.common import LETTER, LOWER, mix, sampled

#: Hashed features, and how many of them get a weight.
DIMENSIONS, SELECTED = 1 << 22, 400
#: Labelled rows that a model is fitted on, at most, for each grade.
SAMPLE_PER_GRADE = 2500
#: Bytes of a window, and bytes of a text that are taken at once.
WINDOW, SEGMENT = 5, 1 << 18


def windows(text: bytes, dimensions: int = DIMENSIONS) -> Iterator[np.ndarray]:
    """The hashed windows of a text, a segment at a time; segments overlap so that no window is lost."""
    low = LOWER[np.frombuffer(b" " + text + b" ", np.uint8)]
    low = np.where(LETTER[low], low, np.uint8(32))
    for at in range(0, len(low) - WINDOW + 1, SEGMENT):
        part = low[at : at + SEGMENT + WINDOW - 1]
        n = len(part) - WINDOW + 1
        inside = part != 32
        valid = inside[1 : n + 1] & inside[2 : n + 2] & inside[3 : n + 3]
        code = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            code = (code << np.uint64(8)) | part[k : k + n]
        yield (mix(code[valid]) & np.uint64(dimensions - 1)).astype(np.int32)


@dataclass
class OrdinalModel:
    """Weights of the selected features, and one threshold for each grade above the lowest."""

    slots: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def table(self, dimensions: int = DIMENSIONS) -> np.ndarray:
        out = np.zeros(dimensions, np.float32)
        out[self.slots] = self.weights
        return out

    def at_least(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ...; a row per score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


#: Twice this is the likelihood ratio that a feature must pass.
EVIDENCE = 5.0


def select(index: list[np.ndarray], grade: np.ndarray, dimensions: int, most: int) -> np.ndarray:
    """The features whose share of texts is higher above the lowest grade, the surest first, sorted at last."""

    high = grade > 0
    n, m = high.sum(), (~high).sum()
    counts = np.zeros((2, dimensions), np.int32)
    for i, above in zip(index, high):
        counts[int(above), i] += 1  # the features of a text are distinct
    slots = np.flatnonzero(counts[1])
    a, b = counts[1, slots].astype(float), counts[0, slots].astype(float)
    p, q, both = (a + 0.5) / (n + 1), (b + 0.5) / (m + 1), (a + b + 1) / (n + m + 2)
    ratio = a * np.log(p / both) + (n - a) * np.log((1 - p) / (1 - both)) + b * np.log(q / both) + (m - b) * np.log((1 - q) / (1 - both))
    best = np.argsort(-ratio, kind="stable")[:most]
    return np.sort(slots[best[(ratio[best] > EVIDENCE) & (p[best] > q[best])]])


@dataclass
class Likelihood:
    """The weighted log-likelihood of grades, less an L2 penalty on the weights, and its gradient.

    Texts are rows of a sparse matrix (row, column, value). Parameters: the weights, the first
    threshold, and the roots of the gaps between thresholds.
    """

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    grade: np.ndarray
    weight: np.ndarray
    grades: int
    used: int
    ridge: float

    def thresholds(self, p: np.ndarray) -> np.ndarray:
        return p[self.used] + np.concatenate([[0.0], np.cumsum(p[self.used + 1 :] ** 2)])

    def __call__(self, p: np.ndarray) -> tuple[float, np.ndarray]:
        w, gaps, t, n = p[: self.used], p[self.used + 1 :], self.thresholds(p), len(self.grade)
        score = np.bincount(self.row, self.value * w[self.column], n)
        # log P(grade = g) = log(s(score - t_g) - s(score - t_{g+1})), with the outer terms 1 and 0
        s = np.column_stack([np.ones(n), 1 / (1 + np.exp(np.clip(t[None, :] - score[:, None], -60, 60))), np.zeros(n)])
        slope, r, g = s * (1 - s), np.arange(n), self.grade
        chance = np.maximum(s[r, g] - s[r, g + 1], 1e-12)
        d_score = self.weight * (slope[r, g] - slope[r, g + 1]) / chance
        d_t = np.zeros((n, self.grades + 1))
        d_t[r, g] -= self.weight * slope[r, g] / chance
        d_t[r, g + 1] += self.weight * slope[r, g + 1] / chance
        d_t = d_t[:, 1 : self.grades].sum(axis=0)
        d_w = np.bincount(self.column, self.value * d_score[self.row], self.used) - self.ridge * w
        gradient = np.concatenate([d_w, [d_t.sum()], 2 * gaps * np.cumsum(d_t[::-1])[::-1][1:]])
        return float(self.weight @ np.log(chance) - self.ridge / 2 * w @ w), gradient


def fit(index: list[np.ndarray], value: list[np.ndarray], grade: np.ndarray, grades: int, dimensions: int = DIMENSIONS, most: int = SELECTED, ridge: float = 1e-4, rounds: int = 300, enough: float = 1e-6) -> OrdinalModel:
    """Maximum likelihood with an L2 penalty, by Adam on all rows at once: `rounds` steps, fewer once
    no part of the gradient exceeds `enough`.

    index, value: the distinct features of each text. The lowest grade and all others together weigh the same.
    """
    chosen = select(index, grade, dimensions, most)
    wanted = np.zeros(dimensions, bool)
    wanted[chosen] = True
    keep = [wanted[i] for i in index]
    index, value = [i[k] for i, k in zip(index, keep)], [v[k] for v, k in zip(value, keep)]
    sizes = np.array([len(i) for i in index], np.int64)
    used, column = np.unique(np.concatenate([*index, np.zeros(0, np.int64)]), return_inverse=True)
    low = grade == 0
    weight = np.where(low, 0.5 / max(1, low.sum()), 0.5 / max(1, (~low).sum()))
    of = Likelihood(np.repeat(np.arange(len(sizes)), sizes), column, np.concatenate([*value, np.zeros(0)]), grade, weight, grades, len(used), ridge)
    p = np.concatenate([np.zeros(len(used) + 1), np.ones(max(0, grades - 2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for k in range(1, rounds + 1):
        g = of(p)[1]
        if np.abs(g).max() < enough:
            break
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g**2
        p = p + 0.2 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-9)
    return OrdinalModel(used, p[: len(used)], of.thresholds(p))


def train(labels: DataFrame, docs: DataFrame, grades: int, id_col: str = "doc_id", grade_col: str = "grade", text_col: str = "text", per_grade: int = SAMPLE_PER_GRADE) -> OrdinalModel:
    """Fit on at most per_grade labels of each grade 0 .. grades - 1, the first by a hash of the id.

    Labels with a null grade or id, or a grade out of range, are left out; with none left every score
    is 0. Of several labels of one id the highest counts, of several texts of one id the least in
    order: an id is one row of the sample, so per_grade * grades bounds it however rows repeat. The
    sample's ids are broadcast; texts become features on the executors, and the driver gets the
    sample's features only.
    """
    known = labels.where(F.col(grade_col).between(0, grades - 1)).select(F.col(id_col).cast("long").alias("id"), F.col(grade_col).cast("int").alias("grade")).dropna()
    chosen = sampled(known.groupBy("id").agg(F.max("grade").alias("grade")), "grade", per_grade).select("id", "grade")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sample = texts.join(F.broadcast(chosen), "id").groupBy("id", "grade").agg(F.min("text").alias("text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, value = [], []
            for text in batch.column(1):
                i, n = np.unique(np.concatenate([np.zeros(0, np.int32), *windows((text.as_py() or "").encode())]), return_counts=True)
                index.append(i.astype(np.int32).tobytes())
                value.append((n / np.sqrt(max(1, n.sum()))).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(index, pa.binary()), pa.array(value, pa.binary())], ["grade", "index", "value"])

    found = sample.select("grade", "text").mapInArrow(extract, "grade int, index binary, value binary").toPandas()
    index = [np.frombuffer(b, np.int32) for b in found["index"]]
    value = [np.frombuffer(b, np.float32) for b in found["value"]]
    return fit(index, value, found["grade"].to_numpy(np.int64), grades)


def scorer(model: OrdinalModel) -> Callable[[Column], Column]:
    """A column function: text to (severity, grade, toxic_probability), as `score` describes them."""

    @F.arrow_udf("struct<severity:double,grade:int,toxic_probability:double>")
    def grade(texts: pa.Array) -> pa.Array:
        weights = model.table()
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for k, text in enumerate(texts):
            for slots in windows((text.as_py() or "").encode()):
                total[k] += float(weights[slots].sum(dtype=np.float64))
                count[k] += len(slots)
        p = model.at_least(total / np.sqrt(np.maximum(count, 1)))
        p[count == 0] = 0
        each = np.column_stack([np.ones(len(p)), p]) - np.column_stack([p, np.zeros(len(p))])
        return pa.StructArray.from_arrays([pa.array(p.sum(axis=1)), pa.array(each.argmax(axis=1).astype(np.int32)), pa.array(p[:, 0].copy())], ["severity", "grade", "toxic_probability"])

    return grade


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, severity (expected grade), grade (most probable), toxic_probability.

    Null and empty texts, and texts without three letters in a row, have severity 0 and grade 0. Whole
    texts are read; other columns are not, and an empty table gives an empty result.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), scorer(model)(F.col(text_col).cast("string")).alias("verdict")).select("doc_id", "verdict.*")
