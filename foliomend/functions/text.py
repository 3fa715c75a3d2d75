"""Whole-text rewrites as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
ENTITIES = [("&nbsp;", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]
JOURNAL_NOTES = [
    r"J\.\s*[A-Z]+\s+\d+[,\s]+\d+[,\s]+Article\s+\d+.*?\n?",
    r"J\.\s*[A-Z]+[,\s]+Vol\.\s*\d+[,\s]+No\.\s*\d+[,\s]+.*?Publication date:.*?\d{4}\..*?(?=\s+[A-Z]|\s*\z)",
    r"###\s+(?=Energy-Efficient|An Energy-Efficient).*?(?=\n|\z)",
    r"###\s*J\.\s*[A-Z]+[,\s]+Vol\.\s*\d+[,\s]+No\.\s*\d+[,\s]+.*?Publication date:.*?\d{4}\..*?\n",
    r"ACM\s+\d{4}-\d{3}X/\d{4}/\d+-[A-Z0-9]+\s*\n",
    r"©\s*\d{4}.*?Copyright.*?\n",
    r"Permission to make digital.*?permissions@acm\.org\.\s*\n",
    r"https://doi\.org/[X\.]+\s*\n",
    r"###?\s*[A-Z][a-z]+\s+et al\.\s*\n",
    r"\d+:\d+\s*\n",
]
RANGE, LIST = r"\[(\d+)-(\d+)\]", r"\[(\d+(?:,\s*\d+)*)\]"
DEFINITION = r"(?m)^\[(\d+)\]((?:(?!\[\d+\])[^\n])*)\n(?=^\[\d+\]|$)"
_AFTER = r"(?=[\s\)\]\}>.,!?;:，。！？；：]|\z)"
BARE_URL = r"(?<!<)(?<!\]\()(?:\A|(?<=\s)|(?<=[(\[{\"“]))(https?://[^\s\)\]\}>]+)" + _AFTER
BARE_MAIL = r"(?U)(?<!<)(?<!\]\()(?<![\w.%+-])([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})" + _AFTER
CODE_SPAN, MATH_SPAN = r"(?<!`)(`+)([^`\n]+?)\1(?!`)", r"\$(?!\s)([^$\n]+?)\$(?!\$)"
PLACEHOLDER = r"__PH_[A-Z0-9_]+__"
PRESERVED = r"@@PRESERVE_(\d+)@@[\s\S]*?@@/PRESERVE_\1@@"
MATH_BLOCK, MATH, MATH_PAREN, MATH_BRACKET = r"\$\$[\s\S]*?\$\$", r"\$[^$]*?\$", r"\\\([\s\S]*?\\\)", r"\\\[[\s\S]*?\\\]"
CODE_BLOCK, CODE, TAG, LINK = r"```[\s\S]*?```", r"`[^`]*`", r"</?[^>]+>", r"https?://\S+|www\.\S+"
UNREADABLE = [PRESERVED, PLACEHOLDER, MATH_BLOCK, MATH, MATH_PAREN, MATH_BRACKET, CODE_BLOCK, CODE, TAG, LINK]
COMPARED = [TAG, CODE_BLOCK, CODE, MATH_BLOCK, MATH, MATH_PAREN, MATH_BRACKET, LINK]
#: What a text has that one of these patterns is found in.
UNREADABLE_MARKS, COMPARED_MARKS = r"@@PRESERVE_|__PH_|[$\\`<]|https?://|www\.", r"[<`$\\]|https?://|www\."
READABLE = r"[A-Za-zÀ-ɏ一-鿿぀-ヿ가-힯]"
IMAGE_DATA = r"!\[([^\]]*)\]\((data:image/[^;]+;base64,([^)]+))\)"


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with value computed once, however often f uses it and from inside which loops. No Python function may be in value."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def decode_entities(s: Column) -> Column:
    """Five entities in a fixed order, so that doubly encoded ones are decoded twice."""
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ENTITIES, s)


def collapse_newlines(s: Column) -> Column:
    return F.regexp_replace(s, "\n{3,}", "\n\n")


def separate_metadata(s: Column) -> Column:
    """A blank line between emphasised text and a capital right after it."""
    return F.regexp_replace(s, r"(\*[^*]+\*)([A-Z][^*]*)", "$1\n\n$2")


def remove_journal_notes(s: Column, notes: list[str] = JOURNAL_NOTES) -> Column:
    return reduce(lambda t, p: F.regexp_replace(t, "(?is)" + p, ""), notes, separate_metadata(s))


def clean_whitespace(s: Column) -> Column:
    return collapse_newlines(remove_journal_notes(decode_entities(s)))


def wrap_cdata(s: Column) -> Column:
    return F.replace(s, F.lit("]]>"), F.lit("]]]]><![CDATA[>"))


def clean_inline_old(s: Column) -> Column:
    """Subscripts to an underscore, emphasis marks off."""
    sub = r"(?i)<\s*sub\s*>\s*(.*?)\s*<\s*/\s*sub\s*>"
    found = F.array_distinct(F.regexp_extract_all(s, F.lit(sub), F.lit(0)))
    plain = F.aggregate(found, s, lambda t, m: F.replace(t, m, F.concat(F.lit("_"), F.replace(F.regexp_extract(m, sub, 1), F.lit("*"), F.lit("")))))
    return F.regexp_replace(F.regexp_replace(plain, r"\*\*([^*]+)\*\*", "$1"), r"\*([^*]+)\*", "$1")


def clean_inline_new(s: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(clean_inline_old(s), r"^\*+|\*+\z", ""), r"(?U)^\s+|\s+\z", "")


def each_match(s: Column, pattern: str, rewrite: Callable[[Column], Column]) -> Column:
    """All matches replaced by their values: the text is cut at them and put together again, in one pass."""
    values = F.transform(F.regexp_extract_all(s, F.lit(pattern), F.lit(0)), rewrite)
    return F.array_join(F.zip_with(F.split(s, pattern, -1), values, lambda x, v: F.concat(x, F.coalesce(v, F.lit("")))), "")


#: Digits that a decimal holds; of longer numbers it holds the last TAIL, while those before are the same. Any number of LONG digits is a long.
DIGITS, TAIL, LONG = 38, 30, 18


def _range(m: Column, before: str, between: str) -> Column:
    """The numbers of a range [a-b], each as [a] with `before` in front of the number; none where a > b.

    A range whose numbers don't fit in a row of two gigabytes is an error, as is one of numbers of over
    DIGITS digits that differ before their last TAIL.
    """
    a, b = (F.regexp_replace(F.regexp_extract(m, RANGE, g), r"^0+(?=\d)", "") for g in (1, 2))
    same = F.when(F.length(b) > DIGITS, F.length(b) - TAIL).otherwise(0)
    head = lambda x: F.substring(x, F.lit(1), same)
    tail = lambda x: F.substring(x, same + 1, F.lit(DIGITS)).try_cast("decimal(38,0)")
    falls = (F.length(a) > F.length(b)) | ((F.length(a) == F.length(b)) & (a > b))
    count = F.when((same == 0) | ((F.length(a) == F.length(b)) & (head(a) == head(b))), tail(b) - tail(a) + 1)
    count = F.when(count * (F.length(b) + 4) < 2**31 - 1, count.try_cast("int"))
    number = lambda k: (tail(a) + k - 1).cast("decimal(38,0)").cast("string")
    whole = lambda k: F.when(same == 0, number(k)).otherwise(F.concat(head(b), F.lpad(number(k), TAIL, "0")))
    marks = F.transform(F.sequence(F.lit(1), count), lambda k: F.concat(F.lit("[" + before), whole(k), F.lit("]")))
    # Longs are counted and joined as a whole, without decimals and without a lambda for each number.
    plain = F.array_join(F.sequence(a.try_cast("long"), b.try_cast("long")).cast("array<string>"), f"]{between}[{before}")
    plain = F.concat(F.lit("[" + before), plain, F.lit("]"))
    fits = F.when(count.isNotNull(), F.when(F.length(b) <= LONG, plain).otherwise(F.array_join(marks, between))).otherwise(F.raise_error(F.concat(F.lit("a row has no room for all numbers of "), m)))
    return F.when(falls, "").otherwise(fits)


def definitions(s: Column) -> Column:
    """Lines [n] ..., followed by an empty line, another one or the end, as footnotes."""

    def one(t: Column, m: Column) -> Column:
        number, rest = F.regexp_extract(m, r"^\[(\d+)\]", 1), F.regexp_replace(F.regexp_replace(m, r"^\[\d+\]", ""), r"(?U)^\s+|\s+\z", "")
        return F.replace(t, F.concat(F.lit("["), number, F.lit("] "), rest), F.concat(F.lit("[^"), number, F.lit("]: "), rest, F.lit("\n")))

    return F.aggregate(F.regexp_extract_all(s, F.lit(DEFINITION), F.lit(0)), s, one)


def cite_ranges_old(s: Column) -> Column:
    """[a-b] as [a]...[b]."""
    return each_match(s, RANGE, lambda m: _range(m, "", ""))


def cite_singles_old(s: Column) -> Column:
    return F.regexp_replace(s, r"\[(\d+)\]", "[^$1]")


def cite_ranges_new(s: Column) -> Column:
    """[a-b] as footnote marks with spaces between."""
    return each_match(s, RANGE, lambda m: _range(m, "^", " "))


def cite_lists_new(s: Column) -> Column:
    """[1, 2] as footnote marks with spaces between; single numbers too."""
    numbers = lambda m: F.split(F.regexp_replace(m, r"(?U)[\[\]\s]", ""), ",")
    return each_match(s, LIST, lambda m: F.array_join(F.transform(numbers(m), lambda n: F.concat(F.lit("[^"), n, F.lit("]"))), " "))


#: The steps of both rewrites of references. Each uses its text more than once: where a plan selects them one
#: after the other, each is computed once.
REFERENCES_OLD = [definitions, cite_ranges_old, cite_singles_old]
REFERENCES_NEW = [definitions, cite_ranges_new, cite_lists_new]


def fix_references_old(s: Column) -> Column:
    return reduce(lambda t, step: step(t), REFERENCES_OLD, s)


def fix_references_new(s: Column) -> Column:
    return reduce(lambda t, step: step(t), REFERENCES_NEW, s)


def bracket_links(s: Column) -> Column:
    """Bare URLs and mail addresses in angle brackets; code and mathematics with spaces around."""
    s = F.regexp_replace(s, "(?=http)" + BARE_URL, "<$1>")
    # An address doesn't go beyond its line, and few lines have one.
    s = F.array_join(F.transform(F.split(s, "\n", -1), lambda x: F.when(x.contains("@"), F.regexp_replace(x, BARE_MAIL, "<mailto:$1>")).otherwise(x)), "\n")
    return F.regexp_replace(F.regexp_replace(s, "(?=`)" + CODE_SPAN, " $0 "), MATH_SPAN, " $0 ")


def _each_where(s: Column, marks: str, patterns: list[str], put: str) -> Column:
    """Pattern after pattern replaced in texts that have any of the characters that each of them begins with; null stays null."""
    return F.when(s.rlike(marks), reduce(lambda t, p: F.regexp_replace(t, p, put), patterns, s)).otherwise(s)


def _without_unreadable(s: Column) -> Column:
    return _each_where(s, UNREADABLE_MARKS, UNREADABLE, "")


def strip_unreadable(s: Column) -> Column:
    """What is left for a reader: placeholders, mathematics, code, tags, links, signs and spaces gone."""
    return F.regexp_replace(_without_unreadable(s), r"(?U)[\s\W_]+", "")


def is_placeholder_only(s: Column) -> Column:
    """Whether strip_unreadable leaves nothing READABLE, of which it leaves what is part of a word."""
    return ~_without_unreadable(s).rlike(rf"(?U)[{READABLE[1:-1]}&&[\w]]")


def for_comparison(s: Column) -> Column:
    t = F.lower(_each_where(s, COMPARED_MARKS, COMPARED, " "))
    return F.trim(F.regexp_replace(t, r"(?U)\s+", " "))


def has_target_script(s: Column, target: str) -> Column:
    t = (target or "").lower()
    if t.startswith(("zh", "chinese", "cn")):
        return s.rlike(r"[一-鿿]")
    return s.rlike("[A-Za-z]") if t.startswith(("en", "english")) else F.lit(True)


def placeholders(s: Column) -> Column:
    """All placeholders of a text, sorted: equal for equal multisets."""
    return F.array_sort(F.regexp_extract_all(s, F.lit(PLACEHOLDER), F.lit(0)))


def image_extension(data: Column) -> Column:
    head = F.hex(F.substring(data, 1, 3))
    return F.when(head.startswith("FFD8"), ".jpg").when(head == "474946", ".gif").otherwise(".png")


def document_title(file_name: Column) -> Column:
    """Parts of a file name between dots, without the last, joined by an underscore."""
    parts = F.split(file_name, r"\.")
    return F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(1))), "_")
