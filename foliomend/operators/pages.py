"""Pages: splitting, continuity across a page's end, and joining what belongs together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliomend.functions import lines as L

#: Confidence from which pages are merged.
LEVELS = {"conservative": 0.8, "moderate": 0.6, "aggressive": 0.4}


def split_pages_old(docs: DataFrame, text_col: str = "md") -> DataFrame:
    """doc_id, page (from 0), text: parts between any three hyphens; a rule's own line ends go with it."""
    joined = F.replace(F.col(text_col), F.lit("\n---\n"), F.lit("---"))
    return _split(docs, F.split(joined, "---", -1))


def split_pages_new(docs: DataFrame, text_col: str = "md") -> DataFrame:
    """doc_id, page (from 0), text: parts between rules that have a line of their own."""
    return _split(docs, F.split(F.col(text_col), "\n---\n", -1))


def _split(docs: DataFrame, parts: Column) -> DataFrame:
    """A row for each part, none for null. An inner explode would compute the parts once more, for a filter by their number."""
    return docs.select("doc_id", F.posexplode_outer(parts).alias("page", "text")).where("page IS NOT NULL")


def _ends(text: Column) -> Column:
    """The non-blank lines of a page, stripped."""
    return F.filter(F.transform(F.split(text, "\n", -1), L.trimmed), lambda x: x != "")


def continuity(pages: DataFrame) -> DataFrame:
    """For each page but a document's last: whether the next page goes on with it.

    Returns doc_id, page, continuous, confidence, reason, fix, n_end, n_start: the last two are the
    numbers of embedded lines (images, captions, tables) that the page ends and the next one begins
    with, which count in the first two rules only. pages: doc_id, page, text.
    """
    return _with_verdicts(pages).where("after IS NOT NULL").drop("text", "after")


def _with_verdicts(pages: DataFrame) -> DataFrame:
    """doc_id, page, what continuity gives, text and after: the stripped texts of the page and the next one, null for the last."""
    order = Window.partitionBy("doc_id").orderBy("page")
    own = pages.select("doc_id", "page", L.trimmed(F.col("text")).alias("text"))
    own = own.select("*", _ends(F.col("text")).alias("a"))
    # Most pages begin and end with text, so that no other line is asked what it is.
    texts = F.transform("a", lambda x, i: F.when(~L.embedded(x), i))
    at = lambda outer, place, otherwise: F.when(~L.embedded(outer), place).otherwise(otherwise)
    first, last = F.get("a", F.lit(0)), F.try_element_at("a", F.lit(-1))
    own = own.select("*", first.alias("own_first"), last.alias("last"))
    own = own.select("*", at(F.col("last"), F.size("a") - 1, F.array_max(texts)).alias("at_a"), at(F.col("own_first"), F.lit(0), F.array_min(texts)).alias("own_at"))
    own = own.select(
        "doc_id", "page", "text", "last", "at_a",
        F.size("a").alias("n_a"),
        F.get("a", F.col("at_a")).alias("end"),
        F.array_join(F.slice("a", F.greatest(F.lit(1), F.size("a") - 2), 3), " ").alias("tail"),
        F.struct(F.col("text").alias("after"), F.size("a").alias("n_b"), F.col("own_at").alias("at_b"), F.get("a", F.col("own_at")).alias("start"), F.col("own_first").alias("first"), F.array_join(F.slice("a", 1, 3), " ").alias("head")).alias("own"),
    )
    both = own.select("*", F.lead("own").over(order).alias("next")).select("*", "next.*")
    end, start, last, first = map(F.col, ("end", "start", "last", "first"))
    has = end.isNotNull() & start.isNotNull()
    verdict = lambda *x: F.struct(*(F.lit(v).alias(k) for k, v in zip(("continuous", "confidence", "reason", "fix"), x)))
    rules = (
        F.when((F.col("n_a") == 0) | (F.col("n_b") == 0), verdict(False, 1.0, "empty page", "none"))
        .when(has & end.endswith("-") & L.starts_lower(start), verdict(True, 0.95, "hyphenated word", "hyphen"))
        .when(has & ~L.ends_sentence(end) & (L.starts_lower(start) | L.continues_sentence(end, start)), verdict(True, 0.85, "split sentence", "sentence"))
        .when(last.rlike(L.REFERENCE) & first.rlike(L.REFERENCE), verdict(True, 0.9, "references", "references"))
        .when(L.has_metadata(F.col("tail")) & ~L.has_metadata(F.col("head")), verdict(False, 0.9, "metadata boundary", "none"))
        .when(L.like_heading(first) | last.rlike(L.STOP), verdict(False, 0.7, "section boundary", "none"))
        .when((F.length(last) > 30) & ~last.rlike(r"[.!?。！？:;]\z"), verdict(True, 0.6, "open paragraph", "paragraph"))
        .otherwise(verdict(False, 0.8, "undecided", "none"))
    )
    n_end = F.col("n_a") - 1 - F.coalesce("at_a", F.lit(-1))
    n_start = F.coalesce("at_b", "n_b")
    return both.select("doc_id", "page", rules.alias("v"), n_end.alias("n_end"), n_start.alias("n_start"), "text", "after").select("doc_id", "page", "v.*", "n_end", "n_start", "text", "after")


def merge_plan(pages: DataFrame, level: str = "conservative") -> DataFrame:
    """continuity, and action: merged, kept, or null for a pair that isn't tested.

    Pages are taken in twos: a merged page isn't compared with the next one. So within a run of pairs
    that could merge, every second one does, beginning with the first.
    """
    return _planned(pages, level).where("after IS NOT NULL").drop("text", "after", "taken")


def _planned(pages: DataFrame, level: str) -> DataFrame:
    """_with_verdicts, action, and taken: whether the page before takes this one in."""
    least = LEVELS.get(level, LEVELS["conservative"])
    order = Window.partitionBy("doc_id").orderBy("page")
    can = F.col("after").isNotNull() & F.col("continuous") & (F.col("confidence") >= least)
    marked = _with_verdicts(pages).withColumn("can", can)
    runs = marked.withColumn("run", F.sum(F.when(F.col("can"), 1).otherwise(0)).over(order))
    # A pair's place in its run: the pairs that can so far, without those before the last one that can't.
    place = F.col("run") - F.coalesce(F.max(F.when(~F.col("can"), F.col("run"))).over(order), F.lit(0))
    placed = runs.withColumn("merged", F.col("can") & (place % 2 == 1)).withColumn("taken", F.coalesce(F.lag("merged").over(order), F.lit(False)))
    return placed.withColumn("action", F.when(F.col("merged"), "merged").when(~F.col("taken"), "kept")).drop("can", "run", "merged")


def merge_summary(plan: DataFrame) -> DataFrame:
    """doc_id, merged, kept."""
    return plan.groupBy("doc_id").agg(F.count_if(F.col("action") == "merged").alias("merged"), F.count_if(F.col("action") == "kept").alias("kept"))


def join_two(page: Column, after: Column, fix: Column, n_end: Column, n_start: Column) -> Column:
    """The text of two pages that go on, with embedded lines at the joint moved behind the paragraph.

    Where there are none, a newline joins the pages. The numbers of embedded lines count non-blank
    lines, but are applied to all lines of the page.
    """
    a, b = F.split(page, "\n", -1), F.split(after, "\n", -1)
    full_a, full_b = _ends(page), _ends(after)
    n_text = F.size(full_a) - n_end
    cut = F.when(n_end > 0, n_text).otherwise(F.size(a))
    head = F.slice(a, 1, cut)
    tail = F.slice(b, n_start + 2, F.size(b))
    last, first = L.stripped(F.try_element_at(head, F.lit(-1))), L.stripped(F.get(b, n_start))
    joint = F.when((fix == "hyphen") & last.endswith("-"), F.concat(F.regexp_replace(last, r"-\z", ""), first))
    joint = joint.when((fix == "sentence") & (last != "") & (first != ""), F.concat(last, F.lit(" "), first)).otherwise(F.try_element_at(head, F.lit(-1)))
    whole = F.when((F.size(head) > 0) & (n_start < F.size(b)), F.concat(F.slice(head, 1, F.size(head) - 1), F.array(joint), tail)).otherwise(head)
    whole = F.when((fix == "sentence") & (last == "") & (first != ""), F.concat(head, F.array(first), tail)).otherwise(whole)
    moved = F.concat(F.array(F.lit("")), F.slice(full_a, F.greatest(n_text + 1, F.lit(1)), F.greatest(n_end, F.lit(0))), F.slice(full_b, 1, n_start))
    rich = F.array_join(F.concat(whole, moved), "\n")
    return F.when(fix.isin("hyphen", "sentence") & (n_end + n_start > 0), rich).otherwise(F.concat(page, F.lit("\n"), after))


def merge_pages(pages: DataFrame, level: str = "conservative") -> DataFrame:
    """doc_id, page, text: pages after merging, each under the number of its first page. pages: doc_id, page, text."""
    text = F.when(F.col("action") == "merged", join_two(F.col("text"), F.col("after"), F.col("fix"), F.col("n_end"), F.col("n_start"))).otherwise(F.col("text"))
    return _planned(pages, level).where("NOT taken").select("doc_id", "page", text.alias("text"))


def join_pages(pages: DataFrame, between: str = "\n\n") -> DataFrame:
    """doc_id, md."""
    rows = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page", "text"))).alias("rows"))
    return rows.select("doc_id", F.array_join(F.transform("rows", lambda r: r["text"]), between).alias("md"))
