"""Blocks, joined pages, citations and nodes once more, in SQL, for comparison.

Patterns stand here in full, so that a wrong one elsewhere shows.
"""

from __future__ import annotations

from foliomend.plans.oracle import continues_paragraph, ends_sentence, incomplete, pipe_row, quoted, starts_lower, strip

_START = "'^\\s+'"
#: Closing lines of a block that line o opens, and whether the closing line belongs to it.
_FENCE = r"regexp_extract({x}.x, '^\s*(`{{3,}}|~{{3,}})', 1)"
_DELIMITER = r"'^\s*\|?\s*:?-{3,}:?\s*(\|\s*:?-{3,}:?\s*)+\|?\s*$'"
_HEADING = r"'^\s{0,3}#{1,6}\s+'"
_ALGORITHM = r"'(?i)^\s*\*?\*?\s*Algorithm\s+\d+'"
_TAGS = "address|article|aside|blockquote|body|caption|center|col|colgroup|dd|details|dialog|div|dl|dt|fieldset|figcaption|figure|footer|form|frame|frameset|h[1-6]|head|header|hr|html|legend|li|link|main|menu|nav|noframes|ol|optgroup|option|p|param|section|summary|table|tbody|td|tfoot|th|thead|title|tr|ul|video|audio|canvas"
_VOID = "'col', 'embed', 'hr', 'link', 'param'"

#: (kind, whether line o opens it, whether line c closes it, the first line after o that may, lines that the closing one is left out by).
_FENCED = (_FENCE.format(x="o") + " <> ''", f"starts_with(regexp_replace(c.x, {_START}, ''), {_FENCE.format(x='o')})", 1, 0)
_MATH = (f"{strip('o.x')} = '$$'", f"{strip('c.x')} = '$$'", 1, 0)
_TABLE = (f"contains(o.x, '|') AND regexp_matches(o.following, {_DELIMITER})", f"(NOT contains(c.x, '|') OR {strip('c.x')} = '')", 2, 1)
_ALONE = "true"
REPAIR = [
    ("code_fence", *_FENCED),
    ("math_block", *_MATH),
    ("table", *_TABLE),
    ("heading", f"regexp_matches(o.y, {_HEADING})", _ALONE, 0, 0),
    ("algorithm", f"regexp_matches({strip('o.x')}, {_ALGORITHM})", f"(regexp_matches({strip('c.x')}, {_HEADING}) OR regexp_matches({strip('c.x')}, {_ALGORITHM}))", 1, 1),
    ("metadata", rf"regexp_matches({strip('o.x')}, '^\*Generated from PDF.*\*$|^\*\d+ pages\*$')", _ALONE, 0, 0),
    ("blank", f"{strip('o.x')} = ''", _ALONE, 0, 0),
    ("text", "true", _ALONE, 0, 0),
]
_CODE = r"lower(regexp_extract(o.y, '(?i)<(pre|code|script|style)(\s|>)', 1))"
_LEFT = f"regexp_replace(o.y, {_START}, '')"
_BLOCK = rf"lower(regexp_extract({_LEFT}, '(?i)^<({_TAGS})\b', 1))"
PROTECT = [
    ("CODEFENCE", *_FENCED),
    ("HTMLBLOCK", f"{_CODE} <> ''", rf"regexp_matches(c.y, '(?i)</' || {_CODE} || '\s*>')", 0, 0),
    *[("HTMLBLOCK", f"starts_with({_LEFT}, '{a}')", f"contains(c.y, '{b}')", 0, 0) for a, b in (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<?", "?>"))],
    ("HTMLBLOCK", f"{_BLOCK} IN ({_VOID})", _ALONE, 0, 0),
    ("HTMLBLOCK", f"{_BLOCK} <> ''", "depth", 0, 0),
    ("MATHBLOCK", *_MATH),
    ("TABLE", *_TABLE),
    ("FOOTDEF", r"regexp_matches(o.y, '^\[\^[^\]]+\]:')", rf"NOT (regexp_matches(c.y, '^\s{{4,}}') OR {strip('c.x')} = '')", 1, 1),
    ("INDENTCODE", "(starts_with(o.y, '    ') OR starts_with(o.y, chr(9)))", "NOT (starts_with(c.y, '    ') OR starts_with(c.y, chr(9)))", 1, 1),
    ("plain", "true", _ALONE, 0, 0),
]


def _ends(n: int, kind: str, opens: str, closes: str, least: int, out: int) -> str:
    """Each line that rule n lets open a block, with the block's last line."""
    if closes == _ALONE:
        return f"SELECT doc_id, page, n, {n} AS rule, '{kind}' AS kind, n AS last FROM ln o WHERE {opens}"
    pairs = f"FROM ln o JOIN ln c ON c.doc_id = o.doc_id AND c.page = o.page AND c.n >= o.n + {least}"
    if closes == "depth":
        count = rf"len(regexp_extract_all(c.y, '(?i)<' || {_BLOCK} || '\b')) - len(regexp_extract_all(c.y, '(?i)<' || {_BLOCK} || '\b[^>]*/>')) - len(regexp_extract_all(c.y, '(?i)</' || {_BLOCK} || '\s*>'))"
        found = f"SELECT o.doc_id, o.page, o.n, c.n AS m, sum({count}) OVER (PARTITION BY o.doc_id, o.page, o.n ORDER BY c.n) AS depth {pairs} WHERE {opens}"
        closing = f"SELECT doc_id, page, n, min(m) AS m FROM ({found}) WHERE depth <= 0 GROUP BY ALL"
    else:
        closing = f"SELECT o.doc_id, o.page, o.n, min(c.n) AS m {pairs} WHERE {opens} AND {closes} GROUP BY ALL"
    return f"SELECT o.doc_id, o.page, o.n, {n} AS rule, '{kind}' AS kind, coalesce(k.m - {out}, o.top) AS last FROM ln o LEFT JOIN ({closing}) k ON k.doc_id = o.doc_id AND k.page = o.page AND k.n = o.n WHERE {opens}"


def lexed(pages: str, rules: list[tuple], keep_blank: bool = False) -> str:
    """Expressions up to b(doc_id, page, block, kind, first, last, text): the blocks of the pages in `pages` (doc_id, page, text).

    To be used after WITH RECURSIVE.
    """
    some = "" if keep_blank else "WHERE kind <> 'blank'"
    return f"""{pages}, li AS (SELECT doc_id, page, ends_with(text, chr(10)) AS ended, CASE WHEN text = '' THEN [] WHEN ends_with(text, chr(10)) THEN string_split(substr(text, 1, length(text) - 1), chr(10)) ELSE string_split(text, chr(10)) END AS l FROM pg),
ln AS (SELECT doc_id, page, CAST(i - 1 AS INTEGER) AS n, CAST(len(l) - 1 AS INTEGER) AS top, l[i] AS x, l[i] || CASE WHEN i < len(l) OR ended THEN chr(10) ELSE '' END AS y, CASE WHEN i < len(l) THEN l[i + 1] ELSE '' END AS following FROM li, unnest(range(1, len(l) + 1)) r(i)),
en AS ({' UNION ALL '.join(_ends(n, *rule) for n, rule in enumerate(rules))}),
e AS (SELECT doc_id, page, n, arg_min(kind, rule) AS kind, arg_min(last, rule) AS last FROM en GROUP BY ALL),
tops AS (SELECT DISTINCT doc_id, page, top FROM ln),
walk AS (SELECT doc_id, page, 0 AS n, top FROM tops UNION ALL SELECT w.doc_id, w.page, e.last + 1, w.top FROM walk w JOIN e ON e.doc_id = w.doc_id AND e.page = w.page AND e.n = w.n WHERE e.last < w.top),
bk AS (SELECT e.doc_id, e.page, e.kind, e.n AS first, e.last, regexp_replace(string_agg(ln.x, chr(10) ORDER BY ln.n), '\\n+$', '') AS text
  FROM walk JOIN e ON e.doc_id = walk.doc_id AND e.page = walk.page AND e.n = walk.n JOIN ln ON ln.doc_id = e.doc_id AND ln.page = e.page AND ln.n BETWEEN e.n AND e.last GROUP BY ALL),
b AS (SELECT doc_id, page, CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY first) - 1 AS INTEGER) AS block, kind, CAST(first AS INTEGER) AS first, CAST(last AS INTEGER) AS last, text FROM bk {some})"""


_OPEN = rf"NOT regexp_matches({{0}}, '[.!?。！？]\s*$')"
_COMMON = r"len(list_intersect(list_distinct(list_filter(string_split_regex(lower({0}), '\s+'), lambda w: w <> '')), list_distinct(list_filter(string_split_regex(lower({1}), '\s+'), lambda w: w <> ''))))"
_SURE = f"CASE WHEN {_OPEN.format('a')} THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN {starts_lower('c')} THEN 0.4::DOUBLE ELSE 0.0::DOUBLE END + CASE WHEN k > 1 THEN least(0.3::DOUBLE, k * 0.1::DOUBLE) ELSE 0.0::DOUBLE END"

#: After lexed: rt(...), the blocks with paragraphs that tables interrupt joined, going from block to block.
REPAIRED = f"""kp AS (SELECT * REPLACE (CAST(row_number() OVER (PARTITION BY doc_id, page ORDER BY block) - 1 AS INTEGER) AS block) FROM b WHERE kind <> 'metadata'),
pa AS (SELECT *, lead(kind) OVER w AS k1, lead(kind, 2) OVER w AS k2, lead(text, 2) OVER w AS t2, {strip('text')} AS a, {strip('lead(text, 2) OVER w')} AS c FROM kp WINDOW w AS (PARTITION BY doc_id, page ORDER BY block)),
cn AS (SELECT *, coalesce(kind = 'text' AND k1 = 'table' AND k2 = 'text' AND {_OPEN.format('a')} AND {starts_lower('c')}, false) AS can FROM pa),
go AS (SELECT doc_id, page, block, can AS merged, false AS one, false AS two FROM cn WHERE block = 0 UNION ALL SELECT cn.doc_id, cn.page, cn.block, cn.can AND NOT go.one, go.merged, go.one FROM go JOIN cn ON cn.doc_id = go.doc_id AND cn.page = go.page AND cn.block = go.block + 1),
rt AS (SELECT cn.doc_id, cn.page, cn.block, kind, first, last, CASE WHEN go.merged THEN regexp_replace(text, '\\s+$', '') || ' ' || regexp_replace(t2, '^\\s+', '') ELSE text END AS text, go.merged
  FROM cn JOIN go ON go.doc_id = cn.doc_id AND go.page = cn.page AND go.block = cn.block WHERE NOT go.two)"""

#: After lexed: st(...), what every text, other block, text looks like.
SPLIT_TYPES = f"""tw AS (SELECT doc_id, page, block, kind, lead(kind) OVER w AS m, lead(kind, 2) OVER w AS third, {strip('text')} AS a, {strip('lead(text, 2) OVER w')} AS c FROM b WINDOW w AS (PARTITION BY doc_id, page ORDER BY block)),
ti AS (SELECT *, {_COMMON.format('a', 'c')} AS k FROM tw WHERE kind = 'text' AND m <> 'text' AND third = 'text'),
to_ AS (SELECT *, {_OPEN.format('a')} AND ({starts_lower('c')} OR k > 1) AS open, least(1.0::DOUBLE, {_SURE}) AS sure FROM ti),
st AS (SELECT doc_id, page, block, CASE WHEN m = 'table' THEN 'table_split' WHEN m IN ('code_fence', 'algorithm') THEN 'code_split' ELSE 'other_split' END AS type, CASE WHEN m = 'table' THEN sure WHEN m IN ('code_fence', 'algorithm') THEN 0.6::DOUBLE ELSE 0.5::DOUBLE END AS confidence,
  CASE WHEN m = 'table' THEN 'merge_around_table' WHEN m IN ('code_fence', 'algorithm') THEN 'merge_around_code' ELSE 'merge_conservative' END AS strategy FROM to_ WHERE open AND (m IN ('table', 'code_fence', 'algorithm') OR k > 2))"""

#: After lexed: why two blocks in a row could be one.
BLOCK_PAIRS = f"""np AS (SELECT *, lead(kind) OVER w AS k, lead(text) OVER w AS t FROM b WINDOW w AS (PARTITION BY doc_id, page ORDER BY block))
SELECT doc_id, page, block, CASE WHEN kind = 'metadata' OR k = 'metadata' THEN 'metadata' WHEN kind <> k THEN 'other kind' WHEN kind = 'text' AND ends_with({strip('text')}, '-') AND {starts_lower(strip('t'))} THEN 'hyphenated word'
WHEN kind = 'text' AND length({strip('text')}) > 50 AND {_OPEN.format(strip('text'))} THEN 'open sentence' ELSE 'no reason' END AS why FROM np WHERE k IS NOT NULL"""


def pages_new(docs: str) -> str:
    """pg(doc_id, page, text): parts between rules, after c(doc_id, md)."""
    return f"{docs}, sp AS (SELECT doc_id, string_split(md, chr(10) || '---' || chr(10)) AS p FROM c), pg AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS page, p[i] AS text FROM sp, unnest(range(1, len(p) + 1)) r(i))"


# ------------------------------------------------------------------- pages

_FULL = f"list_filter(list_transform(string_split({{0}}, chr(10)), lambda v: {strip('v')}), lambda v: v <> '')"

#: After plan(doc_id, page, fix, n_end, n_start, action) and g(doc_id, page, text): mp(doc_id, page, text), the pages after merging.
MERGED = f"""tx AS (SELECT g.doc_id, g.page, {strip('g.text')} AS a, lead({strip('g.text')}) OVER w AS b, plan.fix, plan.n_end, plan.n_start, plan.action = 'merged' AS merged, coalesce(lag(plan.action) OVER w = 'merged', false) AS taken
  FROM g LEFT JOIN plan ON plan.doc_id = g.doc_id AND plan.page = g.page WINDOW w AS (PARTITION BY g.doc_id ORDER BY g.page)),
tl AS (SELECT *, string_split(a, chr(10)) AS la, string_split(b, chr(10)) AS lb, {_FULL.format('a')} AS fa, {_FULL.format('b')} AS fb FROM tx),
th AS (SELECT *, CASE WHEN n_end > 0 THEN la[:len(fa) - n_end] ELSE la END AS head, lb[n_start + 2:] AS tail, {strip('lb[n_start + 1]')} AS beg, fa[len(fa) - n_end + 1:] AS moved_a, fb[:n_start] AS moved_b FROM tl),
tj AS (SELECT *, {strip('head[len(head)]')} AS fin FROM th),
tr AS (SELECT *, CASE WHEN len(head) > 0 AND n_start < len(lb) THEN list_concat(list_concat(head[:len(head) - 1], [CASE WHEN fix = 'hyphen' AND ends_with(fin, '-') THEN substr(fin, 1, length(fin) - 1) || beg WHEN fix = 'sentence' AND fin <> '' AND beg <> '' THEN fin || ' ' || beg ELSE head[len(head)] END]), tail) ELSE head END AS whole FROM tj),
mp AS (SELECT doc_id, page, CASE WHEN NOT coalesce(merged, false) THEN a WHEN fix IN ('hyphen', 'sentence') AND n_end + n_start > 0
  THEN array_to_string(list_concat(list_concat(CASE WHEN fix = 'sentence' AND fin = '' AND beg <> '' THEN list_concat(list_concat(head, [beg]), tail) ELSE whole END, ['']), list_concat(CASE WHEN n_end > 0 THEN moved_a ELSE [] END, moved_b)), chr(10)) ELSE a || chr(10) || b END AS text FROM tr WHERE NOT taken)"""


# --------------------------------------------------------------- citations


def definitions(text: str, name: str) -> str:
    """name(doc_id, md): c(doc_id, md) of `text` with reference definitions as footnotes: lines [n] ..., followed by an empty line, another or the end."""
    whole = r"regexp_matches(ls[i], '^\[\d+\]') AND NOT regexp_matches(regexp_replace(ls[i], '^\[\d+\]', ''), '\[\d+\]') AND i < len(ls) AND (ls[i + 1] = '' OR regexp_matches(ls[i + 1], '^\[\d+\]'))"
    rest, number = strip(r"regexp_replace(d, '^\[\d+\]', '')"), r"regexp_extract(d, '^\[(\d+)\]', 1)"
    return f"""dl AS (SELECT doc_id, md, string_split(md, chr(10)) AS ls FROM {text}), dd AS (SELECT doc_id, md, list_transform(list_filter(range(1, len(ls) + 1), lambda i: {whole}), lambda i: ls[i]) AS ds FROM dl),
{name} AS (SELECT doc_id, list_reduce(list_concat([md], ds), lambda s, d: replace(s, '[' || {number} || '] ' || {rest}, '[^' || {number} || ']: ' || {rest} || chr(10))) AS md FROM dd)"""


def ranges(md: str, mark: str, between: str) -> str:
    numbers = r"range(CAST(regexp_extract(m, '\[(\d+)-', 1) AS BIGINT), CAST(regexp_extract(m, '-(\d+)\]', 1) AS BIGINT) + 1)"
    value = f"array_to_string(list_transform({numbers}, lambda v: '[{mark}' || CAST(v AS VARCHAR) || ']'), '{between}')"
    return rf"list_reduce(list_concat([{md}], list_distinct(regexp_extract_all({md}, '\[(\d+)-(\d+)\]'))), lambda s, m: replace(s, m, {value}))"


def lists(md: str) -> str:
    return rf"list_reduce(list_concat([{md}], list_distinct(regexp_extract_all({md}, '\[(\d+(?:,\s*\d+)*)\]', 1))), lambda s, m: replace(s, '[' || m || ']', array_to_string(list_transform(string_split(m, ','), lambda v: '[^' || trim(v) || ']'), ' ')))"


# ----------------------------------------------------- the whole new repair


def _lines_of(docs: str, name: str) -> str:
    return f"{name} AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS n, string_split(md, chr(10))[i] AS x FROM {docs}, unnest(range(1, len(string_split(md, chr(10))) + 1)) r(i))"


def _shape(pattern: str, group: int) -> str:
    return f"regexp_extract(x, '{pattern}', {group})"


_ROMAN, _NUMBER = r"^(?:#{1,6})?\s*(Sec(?:tion)?\.\s+)?([IVX]+)\.\s+(.+)$", r"^(?:#{1,6})?\s*(\d+(?:\.\d+)*?)\.\s+(.+)$"
_UPPER, _LOWER = r"^(?:#{1,6})?\s*([A-Z])\.\s+(.+)$", r"^(?:#{1,6})?\s*([a-z])\.\s+(.+)$"


def _letter(pattern: str) -> str:
    return f"regexp_matches(x, '{pattern}') AND NOT regexp_matches({_shape(pattern, 2)}, '^[A-Z][a-z]')"


#: After h1(doc_id, n, x): hm(doc_id, md), texts with numbered headings at their levels.
_TITLED = rf"""h2 AS (SELECT *, bool_or(regexp_matches(x, '^#{{1,6}}?\s*(?:Sec(?:tion)?\.\s+)?[IVX]+\.\s+')) OVER (PARTITION BY doc_id) AS roman FROM h1),
h3 AS (SELECT doc_id, n, CASE WHEN roman AND regexp_matches(x, '{_ROMAN}') THEN '# ' || {_shape(_ROMAN, 1)} || {_shape(_ROMAN, 2)} || '. ' || {_shape(_ROMAN, 3)}
WHEN regexp_matches(x, '{_NUMBER}') THEN repeat('#', CAST(least(6, len(string_split({_shape(_NUMBER, 1)}, '.')) + CASE WHEN roman THEN 1 ELSE 0 END) AS INTEGER)) || ' ' || {_shape(_NUMBER, 1)} || '. ' || {_shape(_NUMBER, 2)}
WHEN {_letter(_UPPER)} THEN '### ' || {_shape(_UPPER, 1)} || '. ' || {_shape(_UPPER, 2)} WHEN {_letter(_LOWER)} THEN '#### ' || {_shape(_LOWER, 1)} || '. ' || {_shape(_LOWER, 2)} ELSE x END AS x FROM h2),
hm AS (SELECT doc_id, string_agg(x, chr(10) ORDER BY n) AS md FROM h3 GROUP BY doc_id)"""

#: After f1(doc_id, n, x): fm(doc_id, md), texts with bold algorithms between fences.
_FENCED_TEXTS = rf"""f2 AS (SELECT *, regexp_matches(x, '^\*\*Algorithm\s+\d+\*\*') AS title FROM f1),
f3 AS (SELECT *, sum(CASE WHEN title OR {strip('x')} = '' OR starts_with(x, '#') OR starts_with(x, 'Fig.') OR starts_with(x, 'Table') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS run FROM f2),
f4 AS (SELECT doc_id, run, min(n) AS first, max(n) AS last FROM f3 GROUP BY doc_id, run HAVING arg_min(title, n) AND max(n) > min(n)),
fm AS (SELECT doc_id, string_agg(CASE WHEN n = first THEN '```' || chr(10) ELSE '' END || x || CASE WHEN n = last THEN chr(10) || '```' ELSE '' END, chr(10) ORDER BY n) AS md FROM f3 LEFT JOIN f4 USING (doc_id, run) GROUP BY doc_id)"""

DOUBLE = "regexp_replace({0}, '\\n{{3,}}', chr(10) || chr(10), 'g')"


def fixed_new(docs: str, cleaned: str) -> str:
    """The new repair of c(doc_id, md) in `docs`; cleaned: the last step, an expression of md."""
    return f"""WITH RECURSIVE {lexed(pages_new(docs), REPAIR)}, {REPAIRED},
j1 AS (SELECT doc_id, {DOUBLE.format("string_agg(text, chr(10) || chr(10) ORDER BY page, block)")} AS md FROM rt GROUP BY doc_id),
j2 AS (SELECT c.doc_id, coalesce(j1.md, '') AS md FROM c LEFT JOIN j1 USING (doc_id)), {_lines_of('j2', 'h1')}, {_TITLED}, {definitions('hm', 'df')},
rg AS (SELECT doc_id, {ranges('md', '^', ' ')} AS md FROM df), rl AS (SELECT doc_id, {lists('md')} AS md FROM rg), {_lines_of('rl', 'f1')}, {_FENCED_TEXTS}
SELECT doc_id, {DOUBLE.format(cleaned)} AS md FROM fm"""


# ------------------------------------------------- interrupted paragraphs

_HTML = r"'(?i)<(table|tr|td|th|tbody|/table>|/tr>|/td>|/th>|/thead>|/tbody>)'"
_CAPTIONED = r"'^(Fig\.|Figure|Table|Tab\.)\s+\d+'"


def embedded(docs: str) -> str:
    """c(doc_id, md) in `docs` with interrupted paragraphs whole and the elements behind them.

    First what each line is, then where an element that begins there ends, then for each line with an
    open sentence how far its paragraph reaches, at last a walk over the text.
    """
    blank = lambda x: f"{strip(x)} = ''"
    image = r"regexp_matches(t, '^!\[.*?\]\(.*?\)$')"
    says_html = f"regexp_matches(t, {_HTML})"
    last = "CASE WHEN len(w.part) > 0 THEN w.part[len(w.part)] ELSE w.parts[len(w.parts)] END"
    closed = "CASE WHEN len(part) > 0 THEN list_append(parts, array_to_string(part, ' ')) ELSE parts END"
    joined = r"""list_reduce(list_concat([''], parts), lambda o, r: CASE WHEN regexp_replace(r, '^\s+|\s+$', '', 'g') = '' THEN o WHEN o = '' THEN regexp_replace(r, '^\s+|\s+$', '', 'g')
WHEN ends_with(o, '-') AND regexp_matches(r, '^\p{Ll}') THEN substr(o, 1, length(o) - 1) || regexp_replace(r, '^\s+|\s+$', '', 'g')
WHEN NOT ends_with(o, '-') AND NOT regexp_matches(o, '[.!?,;:]\s*$') AND regexp_matches(regexp_replace(r, '^\s+|\s+$', '', 'g'), '^[.,;:!?)]') THEN o || regexp_replace(r, '^\s+|\s+$', '', 'g') ELSE o || ' ' || regexp_replace(r, '^\s+|\s+$', '', 'g') END)"""
    return f"""WITH RECURSIVE {docs}, e0 AS (SELECT doc_id, string_split(md, chr(10)) AS l FROM c WHERE md IS NOT NULL),
e1 AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS n, CAST(len(l) AS INTEGER) AS size, l, l[i] AS x, {strip('l[i]')} AS t FROM e0, unnest(range(1, len(l) + 1)) r(i)),
e2 AS (SELECT *, {image} AS image, {says_html} AS html, {pipe_row('t')} AS pipe, regexp_matches(t, {_CAPTIONED}) AS cap, {image} OR contains(t, '<img') OR {says_html} OR {pipe_row('t')} AS hit FROM e1),
e3 AS (SELECT *, cap AND (coalesce(bool_or(hit) OVER (w ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING), false) OR coalesce(bool_or(hit) OVER (w ROWS BETWEEN 1 FOLLOWING AND 2 FOLLOWING), false)) AS captions FROM e2 WINDOW w AS (PARTITION BY doc_id ORDER BY n)),
e4 AS (SELECT *, CASE WHEN image THEN 'image' WHEN cap AND captions THEN 'caption' WHEN html THEN 'html' WHEN pipe THEN 'pipe' ELSE 'text' END AS kind FROM e3),
pe AS (SELECT o.doc_id, o.n, min(c.n) AS stop FROM e4 o JOIN e4 c ON c.doc_id = o.doc_id AND c.n > o.n AND NOT c.pipe WHERE o.kind = 'pipe' GROUP BY ALL),
hd AS (SELECT o.doc_id, o.n, c.n AS m, contains(lower(o.x), '<table') AS own, sum((length(lower(c.x)) - length(replace(lower(c.x), '<table', ''))) // 6 - (length(lower(c.x)) - length(replace(lower(c.x), '</table>', ''))) // 8) OVER (PARTITION BY o.doc_id, o.n ORDER BY c.n) AS depth,
  NOT regexp_matches({strip("coalesce(c.l[c.n + 2], '')")}, {_HTML}) AS over FROM e4 o JOIN e4 c ON c.doc_id = o.doc_id AND c.n >= o.n WHERE o.kind = 'html'),
he AS (SELECT doc_id, n, min(m) + 1 AS stop FROM hd WHERE depth = 0 AND (own OR (m > n AND over)) GROUP BY ALL),
e5 AS (SELECT e4.*, CASE kind WHEN 'image' THEN n + 1 WHEN 'pipe' THEN coalesce(pe.stop, size) WHEN 'html' THEN coalesce(he.stop, size) END AS base FROM e4 LEFT JOIN pe USING (doc_id, n) LEFT JOIN he USING (doc_id, n)),
k AS (SELECT a.doc_id, a.n, a.size, a.l, a.x, a.kind, CASE WHEN a.n + 1 < a.size AND {blank('a.l[a.n + 2]')} THEN 1 ELSE 0 END AS gap, a.base FROM e5 a WHERE kind <> 'text'),
el AS (SELECT k.doc_id, k.n, CASE WHEN k.kind = 'caption' THEN CASE WHEN b.kind IN ('image', 'html', 'pipe') THEN list_concat(list_concat([k.x], CASE WHEN gap = 1 THEN [''] ELSE [] END), k.l[k.n + gap + 2:b.base]) ELSE list_concat([k.x], CASE WHEN gap = 1 THEN [''] ELSE [] END) END
    WHEN k.kind = 'image' AND k.base + 1 < k.size AND {blank('k.l[k.base + 1]')} THEN CASE WHEN c2.captions THEN list_concat(k.l[k.n + 1:k.base], ['', k.l[k.base + 2]]) ELSE k.l[k.n + 1:k.base] END
    WHEN c1.captions THEN k.l[k.n + 1:k.base + 1] ELSE k.l[k.n + 1:k.base] END AS taken,
  CASE WHEN k.kind = 'caption' THEN CASE WHEN b.kind IN ('image', 'html', 'pipe') THEN b.base ELSE k.n + 1 + gap END
    WHEN k.kind = 'image' AND k.base + 1 < k.size AND {blank('k.l[k.base + 1]')} THEN CASE WHEN c2.captions THEN k.base + 2 ELSE k.base END WHEN c1.captions THEN k.base + 1 ELSE k.base END AS nxt
  FROM k LEFT JOIN e5 b ON b.doc_id = k.doc_id AND b.n = k.n + 1 + gap AND k.kind = 'caption' LEFT JOIN e5 c1 ON c1.doc_id = k.doc_id AND c1.n = k.base LEFT JOIN e5 c2 ON c2.doc_id = k.doc_id AND c2.n = k.base + 1),
ef AS (SELECT e5.doc_id, e5.n, e5.size, e5.x, e5.kind, el.taken, CAST(el.nxt AS INTEGER) AS nxt, {ends_sentence('e5.x')} AND e5.n + 1 < e5.size AND {blank('e5.l[e5.n + 2]')} AS final FROM e5 LEFT JOIN el USING (doc_id, n)),
w AS (SELECT doc_id, n AS i, CAST(n + 1 AS INTEGER) AS j, [x] AS part, []::VARCHAR[] AS parts, []::VARCHAR[] AS els, n + 1 >= size AS stop FROM ef WHERE {incomplete('x')}
  UNION ALL SELECT w.doc_id, w.i, CASE WHEN f.kind <> 'text' THEN f.nxt WHEN {continues_paragraph(f'({last})', 'f.x')} THEN w.j + 1 ELSE w.j END,
    CASE WHEN f.kind <> 'text' THEN []::VARCHAR[] WHEN {continues_paragraph(f'({last})', 'f.x')} THEN list_append(w.part, f.x) ELSE w.part END,
    CASE WHEN f.kind <> 'text' AND len(w.part) > 0 THEN list_append(w.parts, array_to_string(w.part, ' ')) ELSE w.parts END, CASE WHEN f.kind <> 'text' THEN list_concat(list_append(w.els, ''), f.taken) ELSE w.els END,
    CASE WHEN f.kind <> 'text' THEN f.nxt >= f.size WHEN {continues_paragraph(f'({last})', 'f.x')} THEN f.final OR w.j + 1 >= f.size ELSE true END
  FROM w JOIN ef f ON f.doc_id = w.doc_id AND f.n = w.j WHERE NOT w.stop),
wp AS (SELECT doc_id, i, j, {closed} AS parts, els FROM w WHERE stop), wf AS (SELECT doc_id, i, j, list_concat(list_append([{joined}], '')[:1], list_append(els, '')) AS lines FROM wp WHERE len(parts) >= 2 OR len(els) > 0),
go AS (SELECT ef.doc_id, ef.n, coalesce(wf.j, ef.n + 1) AS after, coalesce(wf.lines, [ef.x]) AS lines FROM ef LEFT JOIN wf ON wf.doc_id = ef.doc_id AND wf.i = ef.n),
st AS (SELECT doc_id, 0 AS n FROM e0 UNION ALL SELECT st.doc_id, CAST(go.after AS INTEGER) FROM st JOIN go ON go.doc_id = st.doc_id AND go.n = st.n),
em AS (SELECT doc_id, string_agg(array_to_string(go.lines, chr(10)), chr(10) ORDER BY go.n) AS md FROM st JOIN go USING (doc_id, n) GROUP BY doc_id)
SELECT c.doc_id, em.md FROM c LEFT JOIN em USING (doc_id)"""


# -------------------------------------------------------------- pseudocode

_TITLE = r"(?i)^\s*(?:\*\*)?\s*(?:Algorithm|算法)\s+([A-Za-z0-9.-]+)?\s*(?:\*\*)?\s*(.*)$"
_STEPS_OLD = [
    r"(?i)^\*\*\s*(Input|Inputs|Output|Outputs|Procedure|Requires?|Ensure|Precondition|Postcondition)\s*:?\s*\*\*",
    r"(?i)^(Input|Inputs|Output|Outputs|Procedure|Requires?|Ensure|Precondition|Postcondition)\s*:?",
    r"^\d+\s*[:.)]\s",
    r"(?i)^(function|procedure|for|while|if|else|repeat|return|end)\b",
]
_STEPS_NEW = [r"^\d+\s*[:.)] ", r"(?i)^(Input|Output|Require|Ensure):", r"(?i)^(function|procedure|for|while|if|else|repeat|return|end)\b"]


def _unmarked(x: str) -> str:
    """Subscripts to an underscore, emphasis marks off."""
    sub = r"(?i)<\s*sub\s*>\s*(.*?)\s*<\s*/\s*sub\s*>"
    plain = f"list_reduce(list_concat([{x}], list_distinct(regexp_extract_all({x}, '{sub}'))), lambda s, m: replace(s, m, '_' || replace(regexp_extract(m, '{sub}', 1), '*', '')))"
    return rf"regexp_replace(regexp_replace({plain}, '\*\*([^*]+)\*\*', '\1', 'g'), '\*([^*]+)\*', '\1', 'g')"


def pseudocode(docs: str, old: bool) -> str:
    """c(doc_id, md) in `docs` with algorithms as fenced code, titles as comments."""
    steps = " OR ".join(f"regexp_matches(t, '{p}')" for p in (_STEPS_OLD if old else _STEPS_NEW))
    label = r"(?i)^\s*\*\*\s*(Input|Output|Procedure|Requires?|Ensure)\s*[:：]?\s*\*\*"
    first_step = "least(" + ("min(CASE WHEN c.hard THEN c.n END), min(CASE WHEN c.free AND c.n > o.step THEN c.n END))" if old else "min(CASE WHEN c.hard THEN c.n END), min(CASE WHEN c.free THEN c.n END))")
    head = f"""CASE WHEN coalesce({strip(f"regexp_extract(x, '{_TITLE}', 1)")}, '') || {strip(f"regexp_extract(x, '{_TITLE}', 2)")} <> '' THEN {strip(f"'Algorithm ' || {strip(f"regexp_extract(x, '{_TITLE}', 1)")} || ': ' || {strip(f"regexp_extract(x, '{_TITLE}', 2)")}")} ELSE 'Algorithm' END"""
    return rf"""WITH RECURSIVE {docs}, pl AS (SELECT doc_id, CASE WHEN md = '' THEN [] WHEN ends_with(md, chr(10)) THEN string_split(substr(md, 1, length(md) - 1), chr(10)) ELSE string_split(md, chr(10)) END AS l FROM c WHERE md IS NOT NULL),
p1 AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS n, CAST(len(l) - 1 AS INTEGER) AS top, l[i] AS x, {strip('l[i]')} AS t FROM pl, unnest(range(1, len(l) + 1)) r(i)),
p2 AS (SELECT *, starts_with(t, '```') AS fence, regexp_matches(x, '{_TITLE}') AS title, regexp_matches(t, '^\d+\s*[:.)]\s') AS step, t NOT IN ('', '***') AND NOT ({steps}) AS free,
  starts_with(t, '```') OR regexp_matches(x, '^\s*#{{1,6}}\s') OR (regexp_matches(x, '^\s*\*\*.+\*\*\s*$') AND NOT regexp_matches(x, '{label}')) AS hard FROM p1),
p3 AS (SELECT *, sum(CASE WHEN fence THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) % 2 = 1 AS inside FROM p2),
p4 AS (SELECT o.doc_id, o.n, min(CASE WHEN c.step THEN c.n END) AS step FROM p3 o JOIN p3 c ON c.doc_id = o.doc_id AND c.n > o.n WHERE o.title AND NOT o.inside GROUP BY ALL),
p5 AS (SELECT o.doc_id, o.n, {first_step} AS stop FROM p4 o JOIN p3 c ON c.doc_id = o.doc_id AND c.n > o.n GROUP BY ALL),
p6 AS (SELECT p3.*, title AND NOT inside AS opens, CASE WHEN title AND NOT inside THEN coalesce(p5.stop - 1, top) ELSE p3.n END AS last FROM p3 LEFT JOIN p5 USING (doc_id, n)),
go AS (SELECT doc_id, n, opens, last, top FROM p6 WHERE n = 0 UNION ALL SELECT p6.doc_id, p6.n, p6.opens, p6.last, p6.top FROM go JOIN p6 ON p6.doc_id = go.doc_id AND p6.n = go.last + 1 WHERE go.last < go.top),
p7 AS (SELECT p6.doc_id, p6.n, CASE WHEN NOT go.opens THEN p6.x ELSE CASE WHEN p6.n = go.n THEN '```pseudo' || chr(10) || '// ' || {_unmarked(head.replace('(x,', '(p6.x,'))} WHEN p6.t = '***' THEN '// ' || repeat('-', 40) ELSE {_unmarked('p6.x')} END || CASE WHEN p6.n = go.last THEN chr(10) || '```' ELSE '' END END AS x
  FROM go JOIN p6 ON p6.doc_id = go.doc_id AND p6.n BETWEEN go.n AND go.last)
SELECT c.doc_id, CASE WHEN c.md IS NOT NULL THEN coalesce(p8.md, '') END AS md FROM c LEFT JOIN (SELECT doc_id, string_agg(x, chr(10) ORDER BY n) AS md FROM p7 GROUP BY doc_id) p8 USING (doc_id)"""


# ----------------------------------------------------- the whole old repair


def bracketed(x: str) -> str:
    """Bare links and mail addresses in angle brackets, code and mathematics with spaces around. Characters that the
    rules only look at are matched and put back; addresses are done twice, as neighbours share such a character."""
    after = r"([\s)\]}>.,!?;:，。！？；：]|$)"
    mail = rf"(^|[^\p{{L}}\p{{N}}\p{{M}}_.%+\-<(]|[^\]]\(|^\()([A-Za-z0-9._%+-]+)@([A-Za-z0-9.-]+\.[A-Za-z]{{2,}}){after}"
    steps = [(r"(^|[\s\[{\"“]|[^\]]\(|^\()(https?://[^\s)\]}>]+)", r"\1<\2>"), (mail, "\\1<mailto:\\2\1\\3>\\4"), (mail, "\\1<mailto:\\2\1\\3>\\4"), ("\1", "@")]
    steps += [(r"(^|[^`])(`[^`\n]+`)([^`]|$)", r"\1 \2 \3"), (r"(\$[^\s$][^$\n]*?\$)([^$]|$)", r" \1 \2")]
    for pattern, put in steps:
        x = f"regexp_replace({x}, {quoted(pattern)}, {quoted(put)}, 'g')"
    return x


def retitled_old(lines: str) -> str:
    """doc_id, md: texts of l(doc_id, n, x), which `lines` ends with, with hash headings at their levels."""
    hashes = r"^(?:#{1,6})+\s*"
    kinds = {"roman": hashes + r"(?:Sec(?:tion)?\.?\s+)?([IVX]+)\.?\s+(.+)$", "number": hashes + r"(\d+(?:\.\d+)*?)\.?\s+(.+)$", "upper": hashes + r"([A-Z])\.?\s+([A-Z].+)$", "lower": hashes + r"([a-z])\.?\s+(.+)$"}
    kind = "CASE " + " ".join(f"WHEN regexp_matches(x, '{p}') THEN '{k}'" for k, p in kinds.items()) + " END"
    part = lambda g: "CASE kind " + " ".join(f"WHEN '{k}' THEN regexp_extract(x, '{p}', {g})" for k, p in kinds.items()) + " END"
    level = "least(6, CASE kind WHEN 'roman' THEN 2 WHEN 'number' THEN CASE WHEN roman THEN 3 ELSE 2 END + length(number) - length(replace(number, '.', '')) WHEN 'upper' THEN 3 ELSE 4 END)"
    return f"""WITH {lines}, k1 AS (SELECT *, {kind} AS kind FROM l), k2 AS (SELECT *, {part(1)} AS number, {part(2)} AS title, coalesce(bool_or(kind = 'roman') OVER (PARTITION BY doc_id), false) AS roman FROM k1)
SELECT doc_id, string_agg(CASE WHEN kind IS NULL THEN x ELSE repeat('#', CAST({level} AS INTEGER)) || ' ' || CASE WHEN kind = 'roman' AND contains(x, 'Sec') THEN 'Sec ' ELSE '' END || number || '. ' || title END, chr(10) ORDER BY n) AS md FROM k2 GROUP BY doc_id"""


def fixed_old(docs: str, lines: str, pages: str, plan: str) -> str:
    """The old repair of c(doc_id, md) in `docs`.

    lines: on to l(doc_id, n, x). pages: from c on to g(doc_id, page, text). plan: from g on to plan, as MERGED takes it.
    A page's key stands for a document's where pages are repaired.
    """
    keyed = "c AS (SELECT {{'d': doc_id, 'p': page}} AS doc_id, text AS md FROM ({0}))".format
    repaired = lambda inner: f"SELECT doc_id.d AS doc_id, doc_id.p AS page, md AS text FROM ({embedded(keyed(inner))})"
    titled = f"c AS ({retitled_old(lines)})"
    first = repaired(f"WITH {titled}, {pages} SELECT doc_id, page, text FROM g")
    merged = repaired(f"WITH RECURSIVE g AS ({first}), {plan}, {MERGED} SELECT doc_id, page, text FROM mp")
    whole = embedded(f"c AS (SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY page) AS md FROM ({merged}) GROUP BY doc_id)")
    one = f"SELECT doc_id, any_value(text) AS only, count(*) AS pages FROM ({first}) GROUP BY doc_id"
    chosen = f"SELECT o.doc_id, CASE WHEN o.pages = 1 THEN o.only ELSE w.md END AS md FROM ({one}) o JOIN ({whole}) w USING (doc_id)"
    cited = rf"WITH c AS ({chosen}), {definitions('c', 'df')}, rg AS (SELECT doc_id, {ranges('md', '', '')} AS md FROM df) SELECT doc_id, regexp_replace(md, '\[(\d+)\]', '[^\1]', 'g') AS md FROM rg"
    decoded = "md"
    for a, b in (("&nbsp;", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        decoded = f"replace({decoded}, {quoted(a)}, {quoted(b)})"
    coded = f"c AS (SELECT doc_id, {decoded} AS md FROM ({pseudocode(f'c AS ({cited})', old=True)}))"
    blocks = f"WITH RECURSIVE {lexed(coded + ', pg AS (SELECT doc_id, 0 AS page, md AS text FROM c)', PROTECT, keep_blank=True)}"
    spaced = f"{blocks} SELECT c.doc_id, coalesce({DOUBLE.format('j.md')}, '') AS md FROM c LEFT JOIN (SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY block) AS md FROM b GROUP BY doc_id) j USING (doc_id)"
    return f"SELECT doc_id, {DOUBLE.format(bracketed('md'))} AS md FROM ({spaced})"


# ------------------------------------------------------------------- nodes


def nodes(docs: str, most: int) -> str:
    """nd(doc_id, nid, origin): the nodes of c(doc_id, md)."""
    alone = r"(regexp_matches(x, '^\s{0,3}#{1,6}\s+') OR regexp_matches(x, '^\s{0,3}(-|\*|\+|\d{1,9}\.)\s+'))"
    longer = strip("CASE WHEN s.b = '' THEN p.b ELSE s.b || ' ' || p.b END")
    full = f"length({longer}) > {most} AND s.b <> ''"
    parts = r"string_split(regexp_replace(text, '([。！？!?.])\s+', '\1' || chr(1), 'g'), chr(1))"
    return f"""{docs}, nl AS (SELECT doc_id, CASE WHEN ends_with(md, chr(10)) THEN string_split(substr(md, 1, length(md) - 1), chr(10)) WHEN md = '' THEN [] ELSE string_split(md, chr(10)) END AS l FROM c),
nx AS (SELECT doc_id, i AS n, l[i] AS x FROM nl, unnest(range(1, len(l) + 1)) r(i)), na AS (SELECT *, {alone} AS alone, {strip('x')} = '' AS blank FROM nx),
nf AS (SELECT *, alone OR coalesce(lag(alone OR blank) OVER (PARTITION BY doc_id ORDER BY n), false) AS fresh FROM na),
nr AS (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS run FROM nf),
nb AS (SELECT doc_id, run, string_agg(x, chr(10) ORDER BY n) AS text FROM nr WHERE NOT blank GROUP BY doc_id, run),
nz AS (SELECT doc_id, run, text, list_reduce(list_concat([{{'b': '', 'd': []::VARCHAR[]}}], list_transform({parts}, lambda p: {{'b': p, 'd': []::VARCHAR[]}})),
  lambda s, p: {{'b': CASE WHEN {full} THEN p.b ELSE {longer} END, 'd': CASE WHEN {full} THEN list_append(s.d, s.b) ELSE s.d END}}) AS v FROM nb),
ny AS (SELECT doc_id, run, CASE WHEN length(text) <= {most} THEN [text] ELSE list_append(v.d, v.b) END AS o FROM nz),
nw AS (SELECT doc_id, run, i AS k, o[i] AS origin FROM ny, unnest(range(1, len(o) + 1)) r(i) WHERE o[i] <> ''),
nd AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY run, k) - 1 AS INTEGER) AS nid, origin FROM nw)"""


# ------------------------------------------------------------------- marks


def escaped(x: str) -> str:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        x = f"replace({x}, {quoted(a)}, {quoted(b)})"
    return x
