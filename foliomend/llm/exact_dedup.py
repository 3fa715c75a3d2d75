"""Exact de-duplication by recipes of content-defined chunks, in DataFrame functions only.

A text is normalised and cut where its own content says so: at the first sentence end after
`least` characters; if there is none, at the first space, mark, symbol or number; only where there is
none of these either, at `most` characters. Each chunk gets an identifier, a hash
that is verified: all chunks of the corpus are de-duplicated with their contents, and no identifier
may stand for two contents. A text is then the ordered list of its identifiers, and only these
short lists are grouped and compared; a long text moves once, as its distinct chunks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomend.llm.common import looked_up, written

#: Chunks of a recipe that may be broadcast when it is hot.
SHORT = 64
#: Runs of white space that aren't one plain space already.
RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """White-space runs as one space; null as an empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), RUNS, " ")


def chunked(text: Column, least: int = 1024, most: int = 8192) -> Column:
    """The content-defined chunks of a text, in order; together they are the text."""
    some = rf".{{{least - 2},{most - 2}}}?"
    return F.regexp_extract_all(text, F.lit(rf"(?s){some}(?:[.!?] |[。！？])|{some}(?:[ \p{{P}}\p{{S}}]|(?<=\p{{L}})(?=\p{{Nd}}))|.{{1,{most}}}"), F.lit(0))


def hashed(chunk: Column) -> Column:
    """128 bits of hash, and the length."""
    return F.struct(F.xxhash64(chunk).alias("a"), F.xxhash64(chunk, F.lit("b")).alias("b"), F.length(chunk).alias("n"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", identify: Callable[[Column], Column] = hashed) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Equal texts form a group; of each group the row with the smallest id stays, a null id last. Null
    counts as an empty text, and all empty texts are equal. Of repeated rows (same id, same text) one
    stays. Other columns of docs are not read; an empty table gives an empty result.
    identify: a chunk's identifier before verification. Should two contents share one, the chunks
    themselves are the identifiers, so that the result is the same.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), normalised(F.col(text_col).cast("string")).alias("text"))
    chunks = texts.select(F.explode(chunked(F.col("text"))).alias("chunk")).select(identify(F.col("chunk")).alias("id"), "chunk").distinct()
    clash = chunks.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id").head(1)
    recipe = F.transform(chunked(F.col("text")), (lambda c: c) if clash else identify)
    rows = written(texts.select("doc_id", F.monotonically_increasing_id().alias("row"), F.sha2(F.col("text"), 256).alias("text_sha256"), recipe.alias("recipe")), "recipes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    groups = written(rows.groupBy("recipe").agg(first.alias("first"), F.count("*").alias("times")).withColumn("group_size", F.col("times")), "groups")
    found = looked_up(rows, groups, ["recipe"], small=F.size("recipe") <= SHORT)
    return found.select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256")


ORACLE = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(x) AS text_sha256
FROM t WINDOW w AS (PARTITION BY x)
"""
