"""The line predicates once more, in SQL, for comparison."""

from __future__ import annotations

from functools import reduce

from foliomend.functions import lines as L


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def matches(x: str, pattern: str) -> str:
    """A search; a word's beginning is told by Unicode's letters, which this dialect's own mark isn't."""
    return f"regexp_matches({x}, {quoted(pattern.replace(chr(92) + 'b(', '(?:^|[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_])('))})"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def any_of(x: str, patterns: list[str], flags: str = "") -> str:
    return "(" + " OR ".join(matches(x, flags + p) for p in patterns) + ")"


def element(x: str) -> str:
    t = strip(x)
    return f"CASE WHEN {matches(t, L.IMAGE)} THEN 'image' WHEN {matches(t, L.CAPTION)} THEN 'figure' WHEN {matches(t, L.HTML_TABLE)} THEN 'table_html' WHEN {pipe_row(t)} THEN 'table_markdown' ELSE 'text' END"


def pipe_row(x: str) -> str:
    pipes = f"(length({x}) - length(replace({x}, '|', '')))"
    return f"({pipes} >= 2 OR ({pipes} = 1 AND " + matches(f"replace({x}, '|', '')", r"^[\s\-:]+$") + "))"


def like_heading(x: str) -> str:
    return f"(starts_with({x}, '#') OR {matches(x, L.NUMBERED_HEADING)} OR (length({x}) < 80 AND " + matches(x, r"^\p{Lu}") + f" AND NOT ends_with({x}, '.')))"


def ends_sentence(x: str) -> str:
    t = strip(x)
    return f"({t} <> '' AND NOT {matches(t, L.ABBREVIATION)} AND {matches(t, L.STOP_QUOTED)})"


def incomplete(x: str) -> str:
    t = strip(x)
    return f"(length({t}) >= 10 AND CASE WHEN {matches(t, L.STOP)} THEN {matches(t, L.SHORT_ABBREVIATION)} ELSE {any_of(t, L.OPEN_TAIL, '(?i)')} OR length({t}) > 50 END)"


def continues_sentence(a: str, b: str) -> str:
    pairs = " OR ".join(f"({matches(strip(a), '(?i)' + p)} AND {matches(strip(b), '(?i)' + q)})" for p, q in L.VERB_PAIRS)
    return f"({any_of(strip(a), [L.PREPOSITION_TAIL, L.CONJUNCTION_TAIL], '(?i)')} OR {pairs})"


def starts_lower(x: str) -> str:
    return matches(x, r"^\p{Ll}")


def continues_paragraph(a: str, b: str) -> str:
    p, q = strip(a), strip(b)
    return (
        f"CASE WHEN {p} = '' OR {q} = '' OR {element(b)} <> 'text' OR {like_heading(q)} THEN false WHEN {starts_lower(q)} THEN true"
        f" WHEN {incomplete(p)} THEN NOT (length({q}) > 100 AND {ends_sentence(q)})"
        f" WHEN {any_of(p, L.LIST_STARTS)} AND {any_of(q, L.LIST_STARTS)} THEN false ELSE ends_with({p}, '\"') AND contains({q}, '\"') END"
    )


def block_html(x: str) -> str:
    t = f"ltrim({x})"
    return f"CASE WHEN starts_with({t}, '<!--') THEN '__comment__' WHEN starts_with({t}, '<![CDATA[') THEN '__cdata__' WHEN starts_with({t}, '<?') THEN '__pi__' ELSE lower(regexp_extract({t}, {quoted(L.BLOCK_HTML)}, 1)) END"


def chained(x: str, steps: list[tuple[str, str]]) -> str:
    """Literal replacements, one after the other."""
    return reduce(lambda s, e: f"replace({s}, {quoted(e[0])}, {quoted(e[1])})", steps, x)


def patterns(x: str, steps: list[tuple[str, str]]) -> str:
    return reduce(lambda s, e: f"regexp_replace({s}, {quoted(e[0])}, {quoted(e[1])}, 'g')", steps, x)
