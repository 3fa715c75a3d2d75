"""Placeholders: parts of a document that must not change are frozen, and restored later."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomend.functions.batches import slices
from foliomend.functions.text import each_match
from foliomend.operators.blocks import PROTECT, lex
from foliomend.plans.config import TranslateConfig

# What is frozen inside a line, in this order.
_LINKED = r"\[(?:[^\]\\]|\\.)*?\]\((?:[^()\\]|\\.)*?\)"
INLINE = [
    ("LINKDEF", r"(?m)^\s*\[[^\]]+\]:\s*\S+.*$"),
    ("IMAGE", "!" + _LINKED),
    ("LINK", _LINKED),
    ("REFLINK", r"\[(?:[^\]\\]|\\.)*?\]\[[^\]]+\]"),
    ("AUTOLINK", r"<(?:https?://|mailto:)[^>]+>"),
    ("URL", r"https?://[^ ]+"),
    ("CODE", r"(?<!`)(`+)([^`\n]+?)\1(?!`)"),
    ("MATH", r"\$(?!\s)([^$\n]+?)\$(?!\$)"),
    ("FOOTREF", r"\[\^[^\]]+\]"),
    ("HTMLINLINE", r"(?s)<[A-Za-z][^>]*?>.*?</[A-Za-z][^>]*?>"),
]


def number(occurrences: DataFrame) -> DataFrame:
    """doc_id, raw, kind, number, placeholder: one for each distinct text of a document, in order of first use.

    The first use gives the kind, whatever kinds later uses have. occurrences: doc_id, pos, kind, raw.
    """
    first = occurrences.groupBy("doc_id", "raw").agg(F.min(F.struct("pos", "kind")).alias("first"))
    ranked = first.select("doc_id", "raw", "first.kind", F.row_number().over(Window.partitionBy("doc_id").orderBy("first.pos")).alias("number"))
    return ranked.withColumn("placeholder", F.concat(F.lit("__PH_"), F.col("kind"), F.lit("_"), F.lpad(F.col("number").cast("string"), 6, "0"), F.lit("__")))


def kind_counts(numbered: DataFrame) -> DataFrame:
    """doc_id, kind, n: how many distinct texts each kind froze."""
    return numbered.groupBy("doc_id", "kind").agg(F.count("*").alias("n"))


class _Store(dict):
    """Texts to placeholders, numbered as they come."""

    def freeze(self, kind: str, text: str) -> str:
        return self.setdefault(text, f"__PH_{kind}_{len(self) + 1:06d}__")


def _protect(text: str, cfg: TranslateConfig) -> tuple[str, _Store]:
    store, out = _Store(), []
    rules = [r for r in PROTECT if r[0] != "TABLE" or not cfg.translate_tables]
    for block in lex(text, rules, "plain"):
        out.append(block.text if block.kind == "plain" else store.freeze(block.kind, block.text))
    s = re.sub("\n{3,}", "\n\n", "\n\n".join(out))
    for kind, pattern in INLINE:
        opened = {"IMAGE": cfg.translate_image_alt and "IMGURL", "LINK": cfg.translate_links_text and "LINKURL"}.get(kind)

        def put(m: re.Match) -> str:
            if opened and (cut := re.match(r"(!?\[.*?)(\]\(.+\))", m[0])):  # the readable part stays open
                return cut[1] + store.freeze(opened, cut[2])
            return store.freeze(kind, m[0])

        s = re.sub(pattern, put, s)
    return s, store


def protect(docs: DataFrame, cfg: TranslateConfig, text_col: str = "md") -> DataFrame:
    """doc_id, protected, store (array of placeholder, raw in order of number).

    Blocks first, then parts of lines, pass after pass; every line stands alone afterwards, with a
    blank line between. A null text gives an empty one.
    """
    schema = "doc_id long, protected string, store array<struct<placeholder:string,raw:string>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            found = [_protect(t or "", cfg) for t in batch.column(1).to_pylist()]
            stores = [[{"placeholder": p, "raw": r} for r, p in store.items()] for _, store in found]
            kind = pa.list_(pa.struct([("placeholder", pa.string()), ("raw", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s for s, _ in found], pa.string()), pa.array(stores, kind)], ["doc_id", "protected", "store"])

    return docs.select(F.col("doc_id").cast("long"), text_col).mapInArrow(run, schema)


#: A placeholder, its number the group. A frozen text holds placeholders of earlier passes only, of which there are fewer than DEPTH.
PLACEHOLDER, DEPTH = r"__PH_[A-Z0-9]+_(\d{6,})__", 16


def restore(text: Column, store: Column, nested: bool = False) -> Column:
    """Placeholders back to texts, as if each were replaced in the whole text, the longest first.

    A text that itself holds a placeholder of an earlier turn keeps it, unless nested is set: then
    placeholders inside restored texts are restored too if they have a smaller number, as those have that
    were frozen; others were in the document already. The text
    is cut at its placeholders, and each is looked up by its number, which is its place in the store, so
    the work is the text's length and not that times the store's. What the store has at another place
    (numbers missing in a dictionary from outside) is searched for.
    """
    number = lambda m: F.regexp_extract(m, PLACEHOLDER, 1).try_cast("int")

    def entry(m: Column) -> Column:
        at = F.get(store, number(m) - 1)
        return F.when(at["placeholder"] == m, at).otherwise(F.get(F.filter(store, lambda e: e["placeholder"] == m), F.lit(0)))

    def kept(e: Column) -> Column:
        """An entry's text; placeholders that are to stay in it are marked: whose turn is not after the entry's own."""
        own, place = e["placeholder"], number(e["placeholder"])
        late = lambda m: number(m) < place if nested else (F.length(m) < F.length(own)) | ((F.length(m) == F.length(own)) & (number(m) > place))
        return F.when(~e["raw"].contains("__PH_"), e["raw"]).otherwise(each_match(e["raw"], PLACEHOLDER, lambda m: F.when(late(m), m).otherwise(F.replace(m, F.lit("__PH_"), F.lit("\0PH_")))))

    def once(t: Column) -> Column:
        put = lambda m: F.coalesce(F.get(F.transform(F.array(entry(m)), kept), F.lit(0)), m)
        return F.when(t.contains("__PH_"), each_match(t, PLACEHOLDER, put)).otherwise(t)

    found = F.aggregate(F.sequence(F.lit(1), F.lit(DEPTH)), text, lambda t, _: once(t))
    return F.replace(found, F.lit("\0PH_"), F.lit("__PH_"))


def store_json(store: Column) -> Column:
    """The dictionary of a document as JSON: map (text to placeholder), rev, kind_count."""
    kinds = F.transform(store, lambda e: F.regexp_extract(e["placeholder"], r"__PH_([A-Z0-9]+)_\d+__", 1))
    entries = lambda a, b: F.map_from_entries(F.transform(store, lambda e: F.struct(e[a], e[b])))
    counts = F.map_from_entries(F.transform(F.array_distinct(kinds), lambda k: F.struct(k, F.size(F.filter(kinds, lambda x: x == k)))))
    return F.to_json(F.struct(entries("raw", "placeholder").alias("map"), entries("placeholder", "raw").alias("rev"), counts.alias("kind_count")))


def load_store(json: Column) -> Column:
    """The store of a saved dictionary, in order of number; what has no number that fits a long comes last."""
    rev = F.from_json(json, "map map<string,string>, rev map<string,string>, kind_count map<string,int>")["rev"]
    order = lambda e: F.regexp_extract(e["placeholder"], r"_(\d+)__$", 1).try_cast("long")
    return F.array_sort(F.transform(F.map_entries(rev), lambda e: F.struct(e["key"].alias("placeholder"), e["value"].alias("raw"))), lambda a, b: F.when(order(a) < order(b), -1).when(order(a) > order(b), 1).when(order(a).isNull() & order(b).isNotNull(), 1).when(order(b).isNull() & order(a).isNotNull(), -1).otherwise(0))


def missing(text: Column, store: Column) -> Column:
    """The frozen texts that a text doesn't hold any more."""
    return F.transform(F.filter(store, lambda e: ~text.contains(e["raw"])), lambda e: e["raw"])


def holds_all(text: Column, store: Column) -> Column:
    """Whether a text holds every frozen text."""
    return F.forall(store, lambda e: text.contains(e["raw"]))


def snapshot(store: Column) -> Column:
    """A store as a map from frozen text to placeholder."""
    return F.map_from_entries(F.transform(store, lambda e: F.struct(e["raw"], e["placeholder"])))
