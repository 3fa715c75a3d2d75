"""Translation nodes: splitting, packing, unpacking, and the check of what comes back."""

from __future__ import annotations

import difflib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from foliomend.functions import lines as L
from foliomend.functions import text as T
from foliomend.operators.lines import universal_lines

#: Characters around a node's text in a group, for ids of four digits.
MARKS = 37


def split_nodes(docs: DataFrame, most: int, text_col: str = "protected") -> DataFrame:
    """doc_id, nid (from 0), origin: headings and list items alone, other lines up to a blank one together;
    what is longer than most is cut after sentence ends and filled up again."""
    # An inner explode filters by its array's size first, which computes the array again; an outer one doesn't.
    return node_arrays(docs, most, text_col).select("doc_id", F.posexplode_outer("origins").alias("nid", "origin")).where("nid IS NOT NULL")


def node_arrays(docs: DataFrame, most: int, text_col: str = "protected", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keys, origins: the nodes of split_nodes as an array, whose places are their ids. keys: columns of docs to keep."""
    # All within the document's row: what each line is, where blocks begin, and the lines of each.
    found = docs.select(*keys, F.transform(universal_lines(F.col(text_col)), lambda x: F.struct(x.alias("x"), (L.heading_at_head(x) | L.list_item_at_head(x)).alias("alone"), L.blank_line(x).alias("blank"))).alias("rows"))
    before = lambda i: F.get("rows", i - 1)
    fresh = lambda r, i: F.when((i == 0) | r["alone"] | before(i)["alone"] | before(i)["blank"], i)
    found = found.select(*keys, "rows", F.array_compact(F.transform("rows", fresh)).alias("starts"))
    lines = lambda at, k: F.slice("rows", at + 1, F.coalesce(F.get("starts", k + 1), F.size("rows")) - at)
    block = lambda at, k: F.array_join(F.transform(F.filter(lines(at, k), lambda r: ~r["blank"]), lambda r: r["x"]), "\n")
    blocks = found.select(*keys, F.transform("starts", block).alias("blocks"))
    # Of a part without outer space nothing is stripped, and a buffer that begins with none is only added to.
    parts = lambda text: F.transform(F.split(text, r"(?<=[。！？!?.])\s+"), lambda p: F.struct(p.alias("p"), ((p != "") & (L.trimmed(p) == p)).alias("clean")))
    state = F.struct(F.lit("").alias("buffer"), F.lit(False).alias("clean"), F.array().cast("array<string>").alias("done"))

    def fill(s: Column, part: Column) -> Column:
        p, empty, both = part["p"], s["buffer"] == "", F.concat(s["buffer"], F.lit(" "), part["p"])
        longer = F.when(part["clean"] & empty, p).when(part["clean"] & s["clean"], both).otherwise(L.stripped(F.when(empty, p).otherwise(both)))

        def next_state(x: Column) -> Column:
            full = (F.length(x) > most) & ~empty
            return F.struct(F.when(full, p).otherwise(x).alias("buffer"), F.when(full, part["clean"]).otherwise(True).alias("clean"), F.when(full, F.concat(s["done"], F.array(s["buffer"]))).otherwise(s["done"]).alias("done"))

        return T.bound(longer, next_state)

    def pieces(text: Column) -> Column:
        return F.when(F.length(text) <= most, F.array(text)).otherwise(F.aggregate(parts(text), state, fill, lambda s: F.concat(s["done"], F.array(s["buffer"]))))

    return blocks.select(*keys, F.filter(F.flatten(F.transform("blocks", pieces)), lambda x: x != "").alias("origins"))


def node_text(nid: Column, origin: Column) -> Column:
    """A node between its marks."""
    n = F.lpad(nid.cast("string"), 4, "0")
    n = F.when(nid < 10000, n).otherwise(nid.cast("string"))
    return F.concat(F.lit("<NODE_START_"), n, F.lit(">\n"), origin, F.lit("\n</NODE_END_"), n, F.lit(">\n\n"))


def pack_nodes(nodes: DataFrame, most: int) -> DataFrame:
    """doc_id, nid, group_id (from 0): in order of nid, a new group where the next node would not fit.

    A node longer than most has a group of its own. nodes: doc_id, nid, origin. Only a group's first
    place is kept while going through a document, and its rows are cut at these.
    """
    groups = _groups(nodes, most, lambda nid, origin: F.length(node_text(nid, origin)), lambda r: r["what"])
    groups = groups.select("doc_id", F.posexplode(F.transform("groups", lambda g: F.transform(g, lambda r: r["nid"].cast("int")))).alias("group_id", "nids"))
    return groups.select("doc_id", F.explode("nids").alias("nid"), "group_id")


def _groups(nodes: DataFrame, most: int, what: Callable[[Column, Column], Column], cost: Callable[[Column], Column]) -> DataFrame:
    """doc_id, groups: an array of arrays of (nid, what), as pack_nodes cuts them. cost: of such an entry."""
    sized = nodes.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("nid", what(F.col("nid"), F.col("origin")).alias("what")))).alias("rows"))
    return cut_groups(sized, most, cost)


def cut_groups(sized: DataFrame, most: int, cost: Callable[[Column], Column]) -> DataFrame:
    """sized with groups instead of rows, an array in order of nid: a new group where the next entry would not fit."""
    keys = [c for c in sized.columns if c != "rows"]
    state = F.struct(F.lit(0).alias("at"), F.lit(0).alias("used"), F.array().cast("array<int>").alias("starts"))

    def add(s: Column, c: Column) -> Column:
        fresh = (s["at"] == 0) | ((s["used"] + c > most) & (s["used"] > 0))
        return F.struct((s["at"] + 1).alias("at"), F.when(fresh, c).otherwise(s["used"] + c).alias("used"), F.when(fresh, F.array_append(s["starts"], s["at"] + 1)).otherwise(s["starts"]).alias("starts"))

    cut = sized.select(*keys, "rows", F.aggregate(F.transform("rows", cost), state, add)["starts"].alias("starts"))
    ends = lambda k: F.coalesce(F.get("starts", k + 1), F.size("rows") + 1)
    return cut.select(*keys, F.transform("starts", lambda at, k: F.slice("rows", at, ends(k) - at)).alias("groups"))


def group_text(group: Column) -> Column:
    """What a translator is given for a group: an array of structs with nid and origin."""
    return F.array_join(F.transform(group, lambda r: node_text(r["nid"], r["origin"])), "")


def group_cost(r: Column) -> Column:
    """The length of a node's text, without making it."""
    return F.length(r["origin"]) + (MARKS - 8) + 2 * F.greatest(F.lit(4), F.length(r["nid"].cast("string")))


def packed_payloads(nodes: DataFrame, most: int) -> DataFrame:
    """payloads(nodes, pack_nodes(nodes, most)): a document's nodes meet once, and their texts are joined where they are cut."""
    groups = _groups(nodes, most, node_text, lambda r: F.length(r["what"]))
    payload = lambda g: F.array_join(F.transform(g, lambda r: r["what"]), "")
    return groups.select("doc_id", F.posexplode_outer(F.transform("groups", payload)).alias("group_id", "payload")).where("group_id IS NOT NULL")


def payloads(nodes: DataFrame, packed: DataFrame) -> DataFrame:
    """doc_id, group_id, payload: what a translator is given."""
    rows = nodes.join(packed, ["doc_id", "nid"]).groupBy("doc_id", "group_id").agg(F.array_sort(F.collect_list(F.struct("nid", node_text(F.col("nid"), F.col("origin")).alias("text")))).alias("rows"))
    return rows.select("doc_id", "group_id", F.array_join(F.transform("rows", lambda r: r["text"]), "").alias("payload"))


#: A node between its marks in an answer.
MARKED = r"(?s)<NODE_START_(\d{4,})>.*?</NODE_END_\1>"


def inner_text(m: Column, n: Column) -> Column:
    """What is between a node's marks, stripped. It is found by their lengths; n: the number as it is written."""
    return edges_stripped(F.substring(m, F.length(n) + len("<NODE_START_>") + 1, F.length(m) - 2 * F.length(n) - len("<NODE_START_></NODE_END_>")))


def edges_stripped(s: Column) -> Column:
    return F.regexp_replace(s, r"^\s+|\s+\z", "")


def unpack(groups: DataFrame, text_col: str = "payload") -> DataFrame:
    """doc_id, nid, translated: nodes found between matching marks, stripped; of repeats the last. Marks
    whose number is no int are passed over."""
    found = groups.select("doc_id", "group_id", F.posexplode_outer(F.regexp_extract_all(text_col, F.lit(MARKED), F.lit(0))).alias("k", "m")).where("k IS NOT NULL")
    rows = found.select("doc_id", F.struct("group_id", "k").alias("at"), "m", F.regexp_extract("m", r"\d+", 0).alias("n"))
    rows = rows.select("doc_id", "at", F.col("n").try_cast("int").alias("nid"), inner_text(F.col("m"), F.col("n")).alias("translated")).where("nid IS NOT NULL")
    return rows.groupBy("doc_id", "nid").agg(F.max_by("translated", "at").alias("translated"))


def echoed(groups: Column) -> Column:
    """What comes back where every group is its own answer and no origin looks like a mark: each node's
    origin, stripped. An array of (row, new), row as in groups, an array of arrays of rows with nid and origin."""
    return F.transform(F.flatten(groups), lambda r: F.struct(r.alias("row"), echo_of(r["origin"]).alias("new")))


def echo_of(origin: Column) -> Column:
    """edges_stripped; only what has outer space is searched."""
    return F.when(F.concat(F.substring(origin, 1, 1), F.substring(origin, -1, 1)).rlike(r"\s"), edges_stripped(origin)).otherwise(origin)


def matched(groups: Column, answers: Column) -> Column:
    """The rows of echoed, with what `unpack` gives for answers: an array with each group's text or null. new is null
    for nodes that none of them holds.

    A group's own answer is asked first; what an answer holds of other groups' nodes stands before those of
    earlier groups, and serves where their own have nothing.
    """
    entry = lambda m: T.bound(F.regexp_extract(m, r"\d+", 0), lambda n: F.struct(n.try_cast("int").alias("nid"), inner_text(m, n).alias("text")))
    entries = lambda t: F.filter(F.transform(F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(MARKED), F.lit(0)), entry), lambda e: e["nid"].isNotNull())
    both = F.transform(groups, lambda g, k: F.struct(k.alias("k"), g.alias("rows"), entries(F.get(answers, k)).alias("entries")))
    own = lambda b, e: e["nid"].between(F.get(b["rows"], F.lit(0))["nid"], F.try_element_at(b["rows"], F.lit(-1))["nid"])

    def of_all(both: Column) -> Column:
        strange = F.flatten(F.transform(both, lambda b: F.transform(F.filter(b["entries"], lambda e: ~own(b, e)), lambda e: F.struct(b["k"].alias("k"), e["nid"].alias("nid"), e["text"].alias("text")))))
        return T.bound(strange, lambda strange: F.flatten(F.transform(both, lambda b: of_group(b, strange))))

    def of_group(b: Column, strange: Column) -> Column:
        # As a rule an answer holds the nodes of its group, one by one.
        in_order = F.transform(b["entries"], lambda e: e["nid"]) == F.transform(b["rows"], lambda r: r["nid"])
        last = lambda found: F.try_element_at(found, F.lit(-1))

        def new(r: Column, j: Column, ordered: Column) -> Column:
            mine = F.when(ordered, F.get(b["entries"], j)["text"]).otherwise(last(F.filter(b["entries"], lambda e: e["nid"] == r["nid"]))["text"])
            other = lambda o: F.when(o["k"] > b["k"], o["text"]).otherwise(F.coalesce(mine, o["text"]))
            return F.when(F.size(strange) == 0, mine).otherwise(T.bound(last(F.filter(strange, lambda e: e["nid"] == r["nid"])), other))

        return T.bound(in_order, lambda ordered: F.transform(b["rows"], lambda r, j: F.struct(r.alias("row"), new(r, j, ordered).alias("new"))))

    return T.bound(both, of_all)


def fill_missing(nodes: DataFrame, unpacked: DataFrame) -> DataFrame:
    """doc_id, nid, origin, translated: what came back, and what was there already where nothing did; unknown ids go.

    nodes: doc_id, nid, origin, translated."""
    return nodes.join(unpacked.withColumnRenamed("translated", "_new"), ["doc_id", "nid"], "left").select("doc_id", "nid", "origin", F.coalesce("_new", "translated").alias("translated"))


def upsert(nodes: DataFrame, retried: DataFrame) -> DataFrame:
    """Nodes with the results of a later round in place."""
    return fill_missing(nodes, retried)


#: From this likeness on a translation counts as the original.
ALIKE = 0.92


def likeness(a: str, b: str) -> float:
    """Share of characters in common, by longest matching blocks; below ALIKE a bound from above is as good,
    which the lengths, or the characters whatever their order, often give without comparing."""
    m = difflib.SequenceMatcher(None, a, b)
    return next((x for x in (m.real_quick_ratio(), m.quick_ratio()) if x < ALIKE), None) or m.ratio()


@F.pandas_udf(DoubleType())
def similarity(pairs: pd.Series) -> pd.Series:
    """The likeness of two texts; a single text is a likeness that is known already."""
    return pd.Series([float(p[0]) if len(p) == 1 else 1.0 if p[0] == p[1] else likeness(*p) for p in pairs], dtype="float64")


@F.arrow_udf(ArrayType(DoubleType()))
def similarities(pairs: pa.Array) -> pa.Array:
    """similarity for arrays of such pairs; few of them are Python's at a time."""
    flat, found = pairs.flatten(), []
    for at in range(0, len(flat), 1024):
        found += [float(p[0]) if len(p) == 1 else 1.0 if p[0] == p[1] else likeness(*p) for p in flat.slice(at, 1024).to_pylist()]
    ends = np.cumsum(np.concatenate([[0], pyarrow.compute.fill_null(pyarrow.compute.list_value_length(pairs), 0).to_numpy(zero_copy_only=False)]))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found, pa.float64()))


def succeeded(origin: Column, translated: Column, target: str, readable: bool = False) -> Column:
    """Whether a node's translation can stand: same placeholders, not empty, and either no longer like the
    original or in the target's script. Only texts without that script are compared at length."""
    return similarity(compared(origin, translated, target, readable)) < ALIKE


def compared(origin: Column, translated: Column, target: str, readable: bool = False) -> Column:
    """What similarity decides `succeeded` by.

    readable: whether all originals are known to hold text to read. The rules go in order of their cost in one expression, so that
    each is computed once, and for no row that an earlier one settles.
    """
    filled = F.coalesce(~L.blank_line(translated), F.lit(False))
    # Most failed answers are the original to the character.
    equal = origin.eqNullSafe(translated)
    same = equal | (T.placeholders(origin) == T.placeholders(F.coalesce(translated, F.lit(""))))
    known = lambda x: F.array(F.lit(str(x)))
    stale = equal | (L.stripped(origin) == L.stripped(translated))
    compared = F.when(stale, known(1)).otherwise(F.array(T.for_comparison(origin), T.for_comparison(translated)))
    if not readable:
        compared = F.when(T.is_placeholder_only(origin), known(0)).otherwise(compared)
    compared = F.when(T.has_target_script(translated, target), known(0)).otherwise(compared)
    return F.when(filled & same, compared).otherwise(known(1))


def merge_nodes(nodes: DataFrame) -> DataFrame:
    """doc_id, text: translated nodes in order, two newlines before and behind each."""
    rows = nodes.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("nid", "translated"))).alias("rows"))
    return rows.select("doc_id", F.array_join(F.transform("rows", lambda r: F.concat(F.lit("\n\n"), r["translated"], F.lit("\n\n"))), "").alias("text"))


def nodes_json(nodes: DataFrame) -> DataFrame:
    """doc_id, nodes: all nodes of a document as a JSON object by id."""
    entry = F.struct("nid", F.struct(F.col("nid"), F.col("origin").alias("origin_text"), F.col("translated").alias("translated_text")).alias("node"))
    rows = nodes.groupBy("doc_id").agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    return rows.select("doc_id", F.to_json(F.map_from_entries(F.transform("rows", lambda r: F.struct(r["nid"].cast("string"), r["node"])))).alias("nodes"))
