"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every text gets its base measures. A text that passes the base goes through further rules, one after
the other, and the first that rejects it ends the cascade for it. In which order the rules come is
decided by a sample: each rule's cost is the time its expression takes there, its selectivity the
share of texts that it rejects of those the rules before it left, and the next rule is always the one
with the most rejections for its cost. The order changes the time only: a text is kept if no rule
rejects it, whichever comes first.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: Words of a window that is looked for again in the same text.
WINDOW = 5
#: The base: fewest words, and most words in hundredths of all that may lie in repeated windows.
LEAST_WORDS, MOST_REPEATED = 10, 20
#: Texts that costs and selectivities are estimated on, at most; every one in SAMPLE_EVERY, about, is taken.
SAMPLE, SAMPLE_EVERY = 2000, 10


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def occurrences(text: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))


def characters(text: Column, but: str) -> Column:
    """How many characters of the text are not in the class that `but` negates."""
    return F.length(F.regexp_replace(text, but + "+", ""))


def repeated_words(words: Column) -> Column:
    """How many words lie in windows of WINDOW words that occur twice or more, the first time included."""

    def covered(ws: Column, hashes: Column) -> Column:
        # 32 bits of the hash and the place in one long each sort as plain numbers: what has no equal neighbour there is no repeat.
        packed = F.sort_array(F.transform(hashes, lambda h, i: F.shiftleft(h, 32).bitwiseOR(i.cast("long"))))
        return let(let(packed, candidates), lambda places: exactly(ws, hashes, places))

    def candidates(packed: Column) -> Column:
        top = lambda x: F.shiftright(x, 32)
        beside = lambda x, j: F.coalesce(top(F.get(packed, j - 1)) == top(x), F.lit(False)) | F.coalesce(top(F.get(packed, j + 1)) == top(x), F.lit(False))
        return F.transform(F.filter(packed, beside), lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int"))

    def exactly(ws: Column, hashes: Column, places: Column) -> Column:
        # Equal windows next to each other: sorted by hash, then by content, then by place.
        keyed = F.transform(places, lambda i: F.struct(F.get(hashes, i).alias("h"), F.array_join(F.slice(ws, i + 1, WINDOW), " ").alias("s"), i.alias("i")))
        return let(F.array_sort(keyed), lambda k: let(repeats(k), spans))

    def repeats(k: Column) -> Column:
        same = lambda a, b: F.coalesce((a["h"] == b["h"]) & (a["s"] == b["s"]), F.lit(False))
        places = F.transform(k, lambda x, j: F.when(same(x, F.get(k, j - 1)) | same(x, F.get(k, j + 1)), x["i"]))
        return F.array_sort(F.filter(places, lambda p: p.isNotNull()))

    def spans(places: Column) -> Column:
        new = F.transform(places, lambda p, j: F.coalesce(F.least(F.get(places, j + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(new, F.lit(0).cast("long"), lambda a, b: a + b)

    def counted(ws: Column) -> Column:
        hashes = F.transform(F.slice(ws, 1, F.greatest(F.size(ws) - WINDOW + 1, F.lit(0))), lambda w, i: F.xxhash64(w, *(F.get(ws, i + k) for k in range(1, WINDOW))))
        return let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(covered(ws, hs)))

    return let(words, counted)


def measures(text: Column) -> dict[str, Column]:
    """The base measures of a text that isn't null, from its words and its lines, as columns over `_words` and `_lines`."""
    filled, words = F.col("_lines"), F.col("_words")
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": occurrences(text, SYMBOLS).cast("long"),
        "n_lines": F.size(filled).cast("long"),
        "n_dup_lines": (F.size(filled) - F.size(F.array_distinct(filled))).cast("long"),
        "n_repeat_words": repeated_words(words),
    }


@dataclass(frozen=True)
class Rule:
    """A name, and whether a text is rejected: a column over `text` and the measures, never null."""

    name: str
    rejects: Column


def share(part: Column, of: Column, hundredths: int) -> Column:
    return part * 100 > of * hundredths


def rules(text: Column) -> list[Rule]:
    """The rules beyond the base, for prose of any language that puts spaces between words."""
    n, lines, bullet = F.col("n_words"), F.col("n_lines"), r"(?m)^[ \t]*(?:[-*•●▪]|[0-9]{1,3}[.)])[ \t]"
    return [
        Rule("short_or_long_words", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)),
        Rule("symbols", share(F.col("n_symbols"), n, 10)),
        Rule("repeated_lines", (F.col("n_dup_lines") > 2) & share(F.col("n_dup_lines"), lines, 30)),
        Rule("few_letters", F.lit(100) * characters(text, r"[^\p{L}]") < 40 * F.col("word_chars")),
        Rule("digits", share(characters(text, "[^0-9]"), F.col("word_chars"), 40)),
        Rule("capitals", share(characters(text, r"[^\p{Lu}]"), F.col("word_chars"), 40)),
        Rule("bullets", share(occurrences(text, bullet), lines, 90)),
        Rule("cut_lines", share(occurrences(text, r"(?m)(?:\.\.\.|…)[ \t\r]*$"), lines, 30)),
        Rule("addresses", share(occurrences(text, r"https?://"), n, 10)),
        Rule("broken_characters", share(occurrences(text, r"[\x00-\x08\x0E-\x1F\x7F�]"), F.col("word_chars"), 1)),
        Rule("code", share(occurrences(text, r"[{};=]"), F.col("word_chars"), 5)),
        Rule("endless_word", text.rlike(r"(?:^|[\x20\x09-\x0D])[^\x20\x09-\x0D]{1000}")),
    ]


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs' ids as doc_id, whole texts as `_text` (null as empty), the base measures and base_failed."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    filled = F.filter(F.split(F.col("_text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    parts = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text")).select("doc_id", "_text", words_of(F.col("_text")).alias("_words"), filled.alias("_lines"))
    rows = parts.select("doc_id", "_text", *(c.alias(name) for name, c in measures(F.col("_text")).items()))
    failed = (F.col("n_words") < LEAST_WORDS) | share(F.col("n_repeat_words"), F.col("n_words"), MOST_REPEATED)
    return rows.withColumn("base_failed", failed)


@dataclass(frozen=True)
class Estimate:
    """A rule's nanoseconds a text and the share of texts it rejects alone, on the sample."""

    name: str
    cost: float
    rejected: float


def _now() -> Column:
    return F.reflect(F.lit("java.lang.System"), F.lit("nanoTime")).cast("long")


def estimate(rows: DataFrame, of: list[Rule], most: int = SAMPLE) -> tuple[list[Estimate], dict[tuple[bool, ...], int]]:
    """Each rule's cost and selectivity on at most `most` of the rows, and how many texts each set of rules rejects.

    The clock is read before and after each rule in the row it is applied to; the time that the clock
    itself takes is measured alike and subtracted. Partitions are read until there are enough rows, and of
    each row only the verdicts and times come to the driver.
    """
    timed = [("_idle", F.lit(False)), *((r.name, r.rejects) for r in of)]
    clocked = F.struct(*(c for name, x in timed for c in (_now().alias(f"from_{name}"), x.alias(name), _now().alias(f"to_{name}"))))
    spent = F.array(*(F.col(f"m.to_{name}") - F.col(f"m.from_{name}") for name, _ in timed))
    found = rows.select(clocked.alias("m")).select(F.array(*(F.col(f"m.{r.name}") for r in of)).alias("verdicts"), spent.alias("ns")).limit(most).collect()
    n = max(1, len(found))
    total = [sum(r["ns"][k] for r in found) / n for k in range(len(timed))]
    alone = [sum(r["verdicts"][k] for r in found) / n for k in range(len(of))]
    return [Estimate(r.name, max(total[k + 1] - total[0], 1.0), alone[k]) for k, r in enumerate(of)], dict(Counter(tuple(r["verdicts"]) for r in found))


def ordered(estimates: list[Estimate], verdicts: dict[tuple[bool, ...], int]) -> list[str]:
    """The rules' names, each time the one with the most rejections for its cost among texts not rejected
    yet; once none rejects any, the cheapest first. Ties go to the smaller name."""
    left, out = list(range(len(estimates))), []
    while left:
        gain = lambda k: sum(n for v, n in verdicts.items() if v[k]) / estimates[k].cost
        best = min(left, key=lambda k: (-gain(k), estimates[k].cost, estimates[k].name))
        verdicts = {v: n for v, n in verdicts.items() if not v[best]}
        left.remove(best)
        out.append(estimates[best].name)
    return out


def cascade(of: list[Rule]) -> Column:
    """Whether no rule rejects; those behind the first that does are not evaluated."""
    kept = F.lit(True)
    for rule in reversed(of):
        kept = F.when(rule.rejects, False).otherwise(kept)
    return kept


def plan(docs: DataFrame, of: list[Rule], id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """The order of the rules for docs, from about one text in SAMPLE_EVERY until there are SAMPLE that pass
    the base: the sample decides the order and no verdict."""
    sample = measured(docs.sample(1 / SAMPLE_EVERY, seed=11), id_col, text_col).where(~F.col("base_failed"))
    return ordered(*estimate(sample, of))


def judge(docs: DataFrame, order: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words, base_failed, kept.

    Words are runs of characters other than the six ASCII spaces; lines are cut at \\n and count if
    they hold a word. A null text has no words, so it fails the base, as an empty one does. Whole texts
    are read, within their row: nothing is shuffled, and repeated rows or ids get equal rows. Other
    columns are not read; an empty table gives an empty result. order: names of all rules in the order
    of the cascade; without it, it is estimated on a sample first.
    """
    of = {r.name: r for r in rules(F.col("_text"))}
    names = plan(docs, list(of.values()), id_col, text_col) if order is None else order
    if sorted(names) != sorted(of):
        raise ValueError(f"order must name each of {sorted(of)} once")
    rows = measured(docs, id_col, text_col)
    kept = F.when(F.col("base_failed"), False).otherwise(cascade([of[name] for name in names]))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))


ORACLE = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
p AS (
  SELECT r, doc_id, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM t
),
g AS (SELECT r, unnest(range(0, len(w) - 4)) AS i, w FROM p WHERE len(w) >= 5),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i + 1], w[i + 2], w[i + 3], w[i + 4], w[i + 5]) AS n FROM g),
c AS (SELECT r, count(DISTINCT i + k) AS n FROM h, range(0, 5) o(k) WHERE n >= 2 GROUP BY r),
m AS (
  SELECT doc_id, x, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda v: length(v))), 0) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(x, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
    CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM p LEFT JOIN c USING (r)
),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed
  OR word_chars < 2 * n_words OR word_chars > 15 * n_words
  OR 100 * n_symbols > 10 * n_words
  OR n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines
  OR 100 * len(regexp_extract_all(x, '\p{L}')) < 40 * word_chars
  OR 100 * len(regexp_extract_all(x, '[0-9]')) > 40 * word_chars
  OR 100 * len(regexp_extract_all(x, '\p{Lu}')) > 40 * word_chars
  OR 100 * len(regexp_extract_all(x, '(?m)^[ \t]*(?:[-*\x{2022}\x{25CF}\x{25AA}]|[0-9]{1,3}[.)])[ \t]')) > 90 * n_lines
  OR 100 * len(list_filter(l, lambda v: regexp_matches(v, '(?:\.\.\.|\x{2026})[ \t\r]*$'))) > 30 * n_lines
  OR 100 * len(regexp_extract_all(x, 'https?://')) > 10 * n_words
  OR 100 * len(regexp_extract_all(x, '[\x00-\x08\x0E-\x1F\x7F\x{FFFD}]')) > word_chars
  OR 100 * len(regexp_extract_all(x, '[{};=]')) > 5 * word_chars
  OR len(list_filter(w, lambda v: length(v) >= 1000)) > 0) AS kept
FROM b JOIN (SELECT x AS bx, any_value(w) AS w, any_value(l) AS l FROM p GROUP BY x) ON x = bx
"""
