"""Predicates on a line or a block of text, as column expressions.

Each takes and gives a Column; a null line gives null. White space and letters are Unicode's.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that decide what a line is.
BLANK = r"^\s*$"
FENCE = r"^\s*(`{3,}|~{3,})"
HTML_CODE = r"(?i)<(pre|code|script|style)(\s|>)"
TABLE_DELIMITER = r"^\s*\|?\s*:?-{3,}:?\s*(\|\s*:?-{3,}:?\s*)+\|?\s*$"
LIST_ITEM = r"^\s{0,3}(-|\*|\+|\d{1,9}\.)\s+"
HEADING = r"^\s{0,3}#{1,6}\s+"
IMAGE = r"^!\[.*?\]\(.*?\)$"
CAPTION = r"^(Fig\.|Figure|Table|Tab\.)\s+\d+"
NUMBERED_HEADING = r"^\d+\.?\s+[A-Z]"
HTML_TABLE = r"(?i)<(table|tr|td|th|tbody|/table>|/tr>|/td>|/th>|/thead>|/tbody>)"
REFERENCE = r"^\[\d+\]|^\(\d+\)|^\d+\."
METADATA = ["E-mail:", "Manuscript received", "Digital Object Identifier", "Date of publication", "University of", "Department of", r"@\w+\.(com|edu|org)", "Recommended for acceptance"]
GENERATED = r"^\*Generated from PDF.*\*$|^\*\d+ pages\*$"
ALGORITHM = r"(?i)^\s*\*?\*?\s*Algorithm\s+\d+"
STOP = r"[.!?。！？]\s*$"
STOP_QUOTED = r"[.!?。！？][\"'」』)]?\s*$"
ABBREVIATION = r"(?i)\b(Dr|Mr|Ms|Mrs|Prof|Fig|Tab|etc|vs|Inc|Ltd|Co|Jr|Sr|Ph\.D|M\.D|B\.A|M\.A|D\.D\.S|U\.S|U\.K|E\.U|i\.e|e\.g)\.\s*$"
SHORT_ABBREVIATION = r"\b(Dr|Mr|Ms|Mrs|Prof|Fig|Tab|etc|vs|Inc|Ltd|Co)\.\s*$"
OPEN_TAIL = [r"\b(and|or|but|with|have|has|had|the|a|an|in|on|at|to|from|by|for)\s*$", r"[,;:(-]\s*$", r"\s+(is|are|was|were|be|been|being)\s*$"]
LIST_STARTS = [r"^\d+\.", r"^[a-z]\)", r"^[•·▪▫◦‣⁃]", r"^[-*+]"]
VERB_PAIRS = [
    (r"\b(have|has|had)\s*$", r"^(been|done|made|used|found|shown|given|taken|seen|known)"),
    (r"\b(is|are|was|were|be|being|been)\s*$", r"^(used|made|found|shown|given|based|considered)"),
    (r"\b(will|would|could|should|may|might|must)\s*$", r"^(be|have|use|make|find|show)"),
]
PREPOSITION_TAIL = r"\b(in|on|at|to|from|with|by|for|of)\s*$"
CONJUNCTION_TAIL = r"\b(and|or|but|nor|yet|so)\s*$"
BLOCK_HTML = r"(?i)^<(address|article|aside|blockquote|body|caption|center|col|colgroup|dd|details|dialog|div|dl|dt|fieldset|figcaption|figure|footer|form|frame|frameset|h[1-6]|head|header|hr|html|legend|li|link|main|menu|nav|noframes|ol|optgroup|option|p|param|section|summary|table|tbody|td|tfoot|th|thead|title|tr|ul|video|audio|canvas)\b"
ALGORITHM_STEP_OLD = [
    r"(?i)^\*\*\s*(Input|Inputs|Output|Outputs|Procedure|Requires?|Ensure|Precondition|Postcondition)\s*:?\s*\*\*",
    r"(?i)^(Input|Inputs|Output|Outputs|Procedure|Requires?|Ensure|Precondition|Postcondition)\s*:?",
    r"^\d+\s*[:.)]\s",
    r"(?i)^(function|procedure|for|while|if|else|repeat|return|end)\b",
]
ALGORITHM_STEP_NEW = [r"^\d+\s*[:.)] ", r"(?i)^(Input|Output|Require|Ensure):", r"(?i)^(function|procedure|for|while|if|else|repeat|return|end)\b"]


def stripped(s: Column) -> Column:
    return F.regexp_replace(s, r"(?U)^\s+|\s+\z", "")


def trimmed(s: Column) -> Column:
    """`stripped` for a column or a lambda's variable, which is used more than once: only what has outer space is searched."""
    ends = F.concat(F.substring(s, 1, 1), F.substring(s, -1, 1))
    return F.when(ends.rlike(r"(?U)\s"), stripped(s)).otherwise(s)


def blank_line(s: Column) -> Column:
    """`is_blank` for a column or a lambda's variable: what begins with more than space isn't searched."""
    return F.when(F.substring(s, 1, 1).rlike(r"(?U)\S"), False).otherwise(is_blank(s))


def heading_at_head(s: Column) -> Column:
    """is_heading, which asks for ten characters at most."""
    return F.substring(s, 1, 10).rlike(HEADING)


def list_item_at_head(s: Column) -> Column:
    """is_list_item, which asks for fourteen characters at most."""
    return F.substring(s, 1, 14).rlike(LIST_ITEM)


def any_of(s: Column, patterns: list[str], flags: str = "") -> Column:
    return s.rlike(flags + "(?:" + ")|(?:".join(patterns) + ")")


def is_blank(s: Column) -> Column:
    return stripped(s) == ""


def fence(s: Column) -> Column:
    """The fence that the line opens with, or an empty string."""
    return F.regexp_extract(s, FENCE, 1)


def is_math_fence(s: Column) -> Column:
    return stripped(s) == "$$"


def html_code_tag(s: Column) -> Column:
    return F.lower(F.regexp_extract(s, HTML_CODE, 1))


def closes_html(s: Column, tag: str) -> Column:
    return s.rlike(rf"(?i)</{tag}\s*>")


def block_html_tag(s: Column) -> Column:
    """The tag of the HTML block that the line begins; comments, CDATA and instructions by their own names; else ''."""
    t = F.regexp_replace(s, r"(?U)^\s+", "")
    return F.when(t.startswith("<!--"), "__comment__").when(t.startswith("<![CDATA["), "__cdata__").when(t.startswith("<?"), "__pi__").otherwise(F.lower(F.regexp_extract(t, BLOCK_HTML, 1)))


def has_pipe(s: Column) -> Column:
    return s.contains("|")


def is_table_delimiter(s: Column) -> Column:
    return s.rlike(TABLE_DELIMITER)


def is_list_item(s: Column) -> Column:
    return s.rlike(LIST_ITEM)


def is_heading(s: Column) -> Column:
    return s.rlike(HEADING)


def like_heading(s: Column) -> Column:
    """Looser: a hash, a number before a capital, or a short line that begins with a capital and has no final dot."""
    return s.startswith("#") | s.rlike(NUMBERED_HEADING) | ((F.length(s) < 80) & s.rlike(r"^\p{Lu}") & ~s.endswith("."))


def is_image(s: Column) -> Column:
    return s.rlike(IMAGE)


def is_caption(s: Column) -> Column:
    return stripped(s).rlike(CAPTION)


def is_html_table(s: Column) -> Column:
    return s.rlike(HTML_TABLE)


def is_markdown_table(s: Column) -> Column:
    pipes = F.length(s) - F.length(F.replace(s, F.lit("|"), F.lit("")))
    return (pipes >= 2) | ((pipes == 1) & F.replace(s, F.lit("|"), F.lit("")).rlike(r"^[\s\-:]+$"))


def element(s: Column) -> Column:
    """image, figure, table_html, table_markdown or text."""
    t = stripped(s)
    return F.when(is_image(t), "image").when(t.rlike(CAPTION), "figure").when(is_html_table(t), "table_html").when(is_markdown_table(t), "table_markdown").otherwise("text")


def ends_sentence(s: Column) -> Column:
    t = stripped(s)
    return (t != "") & ~t.rlike(ABBREVIATION) & t.rlike(STOP_QUOTED)


def is_incomplete(s: Column) -> Column:
    """A line of ten or more characters whose sentence seems to go on."""
    t = stripped(s)
    stop = t.rlike(STOP)
    return (F.length(t) >= 10) & F.when(stop, t.rlike(SHORT_ABBREVIATION)).otherwise(any_of(t, OPEN_TAIL, "(?i)") | (F.length(t) > 50))


def continues_sentence(before: Column, after: Column) -> Column:
    """Whether words across a gap belong together: auxiliary and participle, or a hanging preposition or conjunction."""
    a, b = stripped(before), stripped(after)
    found = any_of(a, [PREPOSITION_TAIL, CONJUNCTION_TAIL], "(?i)")
    for p, q in VERB_PAIRS:
        found |= a.rlike("(?i)" + p) & b.rlike("(?i)" + q)
    return found


def continues_paragraph(before: Column, after: Column) -> Column:
    """Whether a line goes on the paragraph of the line before it."""
    a, b = stripped(before), stripped(after)
    own = F.when(b.rlike(r"^\p{javaLowerCase}"), True).when(is_incomplete(a), ~((F.length(b) > 100) & ends_sentence(b)))
    listed = any_of(a, LIST_STARTS) & any_of(b, LIST_STARTS)
    rest = F.when(listed, False).otherwise(a.endswith('"') & b.contains('"'))
    return F.when((a == "") | (b == "") | (element(b) != "text") | like_heading(b), False).otherwise(F.coalesce(own, rest))


def is_algorithm_header(s: Column) -> Column:
    return stripped(s).rlike(ALGORITHM)


def continues_algorithm_old(s: Column) -> Column:
    t = stripped(s)
    return (t == "") | (t == "***") | any_of(t, ALGORITHM_STEP_OLD)


def continues_algorithm_new(s: Column) -> Column:
    t = stripped(s)
    return (t == "") | (t == "***") | any_of(t, ALGORITHM_STEP_NEW)


def is_generated_note(s: Column) -> Column:
    return stripped(s).rlike(GENERATED)


def has_metadata(s: Column) -> Column:
    return any_of(s, METADATA, "(?i)")


def starts_lower(s: Column) -> Column:
    return s.rlike(r"^\p{javaLowerCase}")


def common_words(before: Column, after: Column) -> Column:
    """How many distinct words two texts share."""
    words = lambda s: F.filter(F.split(F.lower(s), r"(?U)\s+"), lambda w: w != "")
    return F.size(F.array_intersect(words(before), words(after)))


def split_confidence(before: Column, after: Column) -> Column:
    """How sure it is that two texts are one paragraph: an open sentence, a lower-case start, common words."""
    n = common_words(before, after)
    score = F.when(~before.rlike(STOP), 0.3).otherwise(0.0) + F.when(starts_lower(after), 0.4).otherwise(0.0)
    return F.least(F.lit(1.0), score + F.when(n > 1, F.least(F.lit(0.3), n * 0.1)).otherwise(0.0))


def is_paragraph_split(before: Column, after: Column) -> Column:
    return ~before.rlike(STOP) & (starts_lower(after) | (common_words(before, after) > 1))


# Of lines that are stripped already. Each asks for a mark or a character first that the pattern can't do without,
# and searches a line's head or tail for what stands there, instead of looking at every place of every line.

#: Longer than what OPEN_TAIL and both abbreviations take of a line's end, and a character before it.
TAIL = 16


def head(t: Column) -> Column:
    return F.substring(t, 1, TAIL)


def tail(t: Column) -> Column:
    """A line's end in which a word's boundaries are those that they are in the line; one that begins with a mark
    that belongs to the character before it is the whole line."""
    end = F.substring(t, -TAIL, TAIL)
    return F.when(end.rlike(r"^\p{Mn}"), t).otherwise(end)


def last_is(end: Column, marks: str) -> Column:
    return F.substring(end, -1, 1).isin(*marks)


def stops(end: Column) -> Column:
    """STOP; end: tail(t)."""
    return last_is(end, ".!?。！？")


def short_abbreviation(end: Column) -> Column:
    """SHORT_ABBREVIATION; end: tail(t)."""
    return last_is(end, ".") & end.rlike(SHORT_ABBREVIATION)


def ends_quoted(end: Column) -> Column:
    """STOP_QUOTED, and no ABBREVIATION; end: tail(t)."""
    return F.substring(end, -2, 2).rlike(STOP_QUOTED) & ~(last_is(end, ".") & end.rlike(ABBREVIATION))


def hangs(end: Column) -> Column:
    """Any of OPEN_TAIL; end: tail(t)."""
    return F.substring(end, -1, 1).rlike("[A-Za-z,;:(-]") & any_of(end, OPEN_TAIL, "(?i)")


def digit_first(head: Column) -> Column:
    return F.substring(head, 1, 1).between("0", "9")


def listed(t: Column, head: Column) -> Column:
    """Any of LIST_STARTS; head: head(t)."""
    return F.when(digit_first(head), t.rlike(LIST_STARTS[0])).otherwise(any_of(F.substring(head, 1, 2), LIST_STARTS))


def heads(t: Column, head: Column) -> Column:
    """like_heading; head: head(t)."""
    return t.startswith("#") | (digit_first(head) & t.rlike(NUMBERED_HEADING)) | (F.substring(head, 1, 1).rlike(r"^\p{Lu}") & (F.length(t) < 80) & ~t.endswith("."))


def image(t: Column) -> Column:
    return t.startswith("![") & is_image(t)


def caption(t: Column) -> Column:
    return (t.startswith("Fig") | t.startswith("Tab")) & t.rlike(CAPTION)


def html_table(t: Column) -> Column:
    return t.contains("<") & is_html_table(t)


def pipes(t: Column) -> Column:
    return t.contains("|") & is_markdown_table(t)


def embedded(t: Column) -> Column:
    """Whether `element` is anything but text."""
    return image(t) | caption(t) | html_table(t) | pipes(t)


def algorithm_step(t: Column, head: Column, patterns: list[str]) -> Column:
    """Any of the steps, which take no more than a line's head where it is no number and not bold; head: head(t)."""
    return any_of(F.when(digit_first(head) | t.startswith("*"), t).otherwise(head), patterns)
