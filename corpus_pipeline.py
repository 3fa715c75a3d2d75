"""From raw documents to packed sequences, one stage after the other.

Each stage reads what its predecessor kept: toxic texts go, then texts without a language, then all
but one of equal texts, then all but one of near-duplicates, and what is left is packed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliomend.llm import exact_dedup, lang_id, near_dedup, packing, toxicity
from foliomend.llm.common import documents, written
from foliomend.llm.queries import TOXIC_FROM, tokenizer_path, toxicity_model


def _kept(docs: DataFrame, verdicts: DataFrame, mark: str, of: Column, stays: str) -> DataFrame:
    """The rows of docs that verdicts (doc_id, mark, stays) keep. Of rows with one id and mark one stays,
    the first by a hash of the whole row: rows that share this too are the same."""
    keys = lambda m: [F.col("doc_id").isNull().alias("_no_id"), F.coalesce(F.col("doc_id"), F.lit(0)).alias("_id"), m.alias("_mark")]
    names = ["_no_id", "_id", "_mark"]
    kept = verdicts.where(stays).select(*keys(F.col(mark))).distinct()
    row = F.struct(*docs.columns)
    rows = docs.select(row.alias("_row"), F.xxhash64(F.to_json(row)).alias("_order"), *keys(of)).join(kept, names, "left_semi")
    first = F.row_number().over(Window.partitionBy(*names).orderBy("_order"))
    return rows.withColumn("_nth", first).where("_nth = 1").select("_row.*")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that are toxic with a probability of TOXIC_FROM or more go."""
    verdict = toxicity.scorer(toxicity_model(spark, docs, sf_dir))
    return docs.where(verdict(F.col("text"))["toxic_probability"] < TOXIC_FROM)


def reject_no_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a language (`und`) go. With nothing to learn from, these are those without a letter."""
    model = lang_id.train(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    verdict = lang_id.identifier(model)
    return docs.where(verdict(F.col("text"))["lang_pred"] != lang_id.NO_LANGUAGE)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays; of repeated rows with that id, one."""
    return _kept(docs, exact_dedup.exact_duplicates(docs), "text_sha256", F.sha2(exact_dedup.normalised(F.col("text")), 256), "kept")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) one row stays, with the smallest doc_id; a null one only if all are."""
    return _kept(docs, near_dedup.near_duplicates(docs, words=5, percent=80), "text_hash", near_dedup.text_hash(F.col("text")), "stays")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 2048 tokens: (doc_id, start, length, ..., sequence_id, offset)."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), window=2048, end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("language", reject_no_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: Trained models and token ids have no form in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; between two of them a table in the shared folder."""
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
