"""Single rules on small rows, and window forms against plain loops."""

import itertools
import pickle
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from foliomend.functions import lines as L
from foliomend.functions import text as T
from foliomend.operators import blocks as B
from foliomend.operators import embedded as E
from foliomend.operators import figures as G
from foliomend.operators import headings as H
from foliomend.operators import lines as O
from foliomend.operators import nodes as N
from foliomend.operators import pages as P
from foliomend.operators import placeholders as PH
from foliomend.plans import config, fix, translate


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, md string")


def column(spark, f, *texts):
    return [r[0] for r in docs(spark, *texts).orderBy("doc_id").select(f(F.col("md"))).collect()]


def test_text_rules(spark):
    assert column(spark, T.decode_entities, "&amp;lt;", None, "") == ["<", None, ""]
    assert column(spark, T.cite_ranges_old, "[1-3]", "[5-2]") == ["[1][2][3]", ""]
    assert column(spark, T.cite_ranges_new, "[1-3]") == ["[^1] [^2] [^3]"]
    big, long = 10**37 - 2, int("7" * 60)
    plain = lambda a, b: "".join(f"[{k}]" for k in range(a, b + 1))
    assert column(spark, T.cite_ranges_old, "[1-25000]", f"[{big}-{big + 4}]", f"[0{long}-{long + 2}]", f"[{long}-{long - 1}]", f"[{long}-3]") == [plain(1, 25000), plain(big, big + 4), plain(long, long + 2), "", ""]
    for m in ("[1-9999999999]", f"[3-{long}]"):
        with pytest.raises(Exception, match="a row has no room"):
            column(spark, T.cite_ranges_old, m)
    assert column(spark, T.cite_lists_new, "[1, 2,3] [4]") == ["[^1] [^2] [^3] [^4]"]
    assert column(spark, T.fix_references_old, "see [2]\n[1] A. B\n[2] C\n") == ["see [^2]\n[^1]: A. B\n\n[^2]: C\n\n"]
    assert column(spark, T.bracket_links, "at https://a.org/x, or me@b.org.", "`c` $d$") == ["at <https://a.org/x,> or <mailto:me@b.org>.", " `c`   $d$ "]
    assert column(spark, T.collapse_newlines, "a\n\n\n\nb") == ["a\n\nb"]
    assert column(spark, T.clean_inline_new, "x<sub>*i*</sub> **b** *c**") == ["x_i b c"]
    assert column(spark, T.is_placeholder_only, "__PH_URL_000001__ $x$ !", "word") == [True, False]
    assert column(spark, T.document_title, "a.b.jsonl", "x") == ["a_b", "x"]


def test_line_rules(spark):
    assert column(spark, L.ends_sentence, "So it is.", "see Fig.", "he said.\"", "open", "") == [True, False, True, False, False]
    assert column(spark, L.is_incomplete, "this goes on and", "short", "It ends here.", "according to Dr.") == [True, False, False, True]
    assert column(spark, L.element, "![a](b)", "Fig. 1 x", "<td>", "a|b|c", "a | b", "x") == ["image", "figure", "table_html", "table_markdown", "text", "text"]
    assert column(spark, L.block_html_tag, " <div>", "<!-- x", "<?x", "<![CDATA[", "text") == ["div", "__comment__", "__pi__", "__cdata__", ""]
    assert column(spark, lambda c: L.closes_html(c, "pre"), "</PRE >", "<pre>") == [True, False]


def pages(spark, *texts):
    return spark.createDataFrame([(0, i, t) for i, t in enumerate(texts)], "doc_id long, page int, text string")


@pytest.mark.parametrize(
    ("a", "b", "fix_type", "text"),
    [
        ("x exam-", "ple of", "hyphen", "x exam-\nple of"),
        ("x exam-\n![a](b)", "ple of", "hyphen", "x example of\n\n![a](b)"),
        ("we have", "Used it. More", "sentence", None),
        ("[1] A", "[2] B", "references", "[1] A\n[2] B"),
    ],
)
def test_pages_that_go_on(spark, a, b, fix_type, text):
    p = pages(spark, a, b)
    row = P.continuity(p).collect()[0]
    assert row.fix == fix_type and row.continuous
    merged = [r.text for r in P.merge_pages(p).collect()]
    assert len(merged) == 1 and (text is None or merged[0] == text)


def test_pages_are_taken_in_twos(spark):
    p = pages(spark, "a and", "b and", "c and", "d and")
    actions = [r.action for r in P.merge_plan(p).orderBy("page").collect()]
    assert actions == ["merged", None, "merged"]
    assert [r.text for r in P.merge_pages(p).orderBy("page").collect()] == ["a and\nb and", "c and\nd and"]
    assert P.merge_plan(pages(spark, "only")).count() == 0
    assert [r.reason for r in P.continuity(pages(spark, "", "x")).collect()] == ["empty page"]


def test_headings(spark):
    d = docs(spark, "# IV. Results\n## 2.1 Data\n# A. Big\n# b. small", "1. item\nA. Word here\nB. a thing")
    lines = O.split_lines(d)
    old = {(r.doc_id, r.n): r.line for r in H.relevel_old(lines).collect()}
    assert old == {(0, 0): "## IV. Results", (0, 1): "#### 2.1. Data", (0, 2): "### A. Big", (0, 3): "#### b. small"}
    new = {(r.doc_id, r.n): r.line for r in H.relevel_new(lines).collect()}
    assert new[1, 0] == "# 1. item" and (1, 1) not in new and new[1, 2] == "### B. a thing" and new[0, 0] == "# IV. Results"


def cluster_loop(kinds):
    """Figures in a row with one caption before them, or one behind them if there is none before."""
    member, i = [False] * len(kinds), 0
    while i < len(kinds):
        j = i + (kinds[i] == "caption")
        k = j
        while k < len(kinds) and kinds[k] == "figure":
            k += 1
        if k == j:
            i += 1
            continue
        if j == i and k < len(kinds) and kinds[k] == "caption":
            k += 1
        member[i:k] = [True] * (k - i)
        i = k
    return member


def test_clusters_against_a_loop(spark):
    rows, want = [], []
    for d, kinds in enumerate(k for n in range(1, 6) for k in itertools.product(["figure", "caption", "other"], repeat=n)):
        rows += [(d, i, k, "") for i, k in enumerate(kinds)]
        want += cluster_loop(kinds)
    blocks = spark.createDataFrame(rows, "doc_id long, pos int, kind string, text string")
    assert [r.member for r in G.clusters(blocks).orderBy("doc_id", "pos").collect()] == want


def test_figures_move_once(spark):
    d = docs(spark, "intro\n# H\ntext\n![a](b)\nFig. 1 x\nmore\n|a|b|\n|---|---|\nend")
    rows = G.figures_first(G.figure_blocks(O.split_lines(d))).orderBy("place").collect()
    assert [r.text for r in rows] == ["intro", "# H", "![a](b)", "Fig. 1 x", "|a|b|\n|---|---|", "text", "more", "end"]


def test_blocks(spark):
    text = "a\n```\nx\n```\n$$\ny\n$$\n|a|b|\n|---|---|\n|1|2|\nb\n# H\nAlgorithm 1\n1: x\n\n# I\n*3 pages*\n~~~\nopen"
    kinds = [b.kind for b in B.lex(text, B.REPAIR, "text")]
    assert kinds == ["text", "code_fence", "math_block", "table", "text", "heading", "algorithm", "heading", "metadata", "code_fence"]
    text = "<div>\n<div>\n</div>\n</div>\nx\n<br>\n[^1]: n\n    more\n\n    code\n<!-- a\nb -->\n<pre>\nopen"
    kinds = [b.kind for b in B.lex(text, B.PROTECT, "plain")]
    assert kinds == ["HTMLBLOCK", "plain", "plain", "FOOTDEF", "HTMLBLOCK", "HTMLBLOCK"]
    assert "".join(b.text for b in B.lex(text, B.PROTECT, "plain")) == text


def test_tables_inside_paragraphs(spark):
    rng, rows, want = random.Random(3), [], []
    for d in range(60):
        kinds = [rng.choice(["open", "table", "other"]) for _ in range(9)]
        rows += [(d, 0, i, "table" if k == "table" else "text" if k == "open" else "heading", i, i, "some words without a stop here") for i, k in enumerate(kinds)]
        i, out = 0, []
        while i < len(kinds):  # a text, a table, a text: one text and the table
            if kinds[i : i + 3] == ["open", "table", "open"]:
                out += [True, False]
                kinds[i : i + 3] = ["open", "table"]
                i += 1
            else:
                out += [False] if kinds[i] != "table" or not out or not out[-1] else []
                i += 1
        want.append((d, sum(out)))
    blocks = spark.createDataFrame(rows, "doc_id long, page int, block int, kind string, first int, last int, text string")
    got = B.repair_tables(blocks).groupBy("doc_id").agg(F.count_if("merged")).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want


def test_embedded(spark):
    text = "This sentence is about the\n![a](b)\nFig. 1. c\nthing that ends here.\n\nNew one."
    assert column(spark, E.repair_column, text, "Short.\nAnother.", None, "") == ["This sentence is about the thing that ends here.\n\n![a](b)\nFig. 1. c\n\n\nNew one.", "Short.\nAnother.", None, ""]
    assert E.joined(["exam-", "ple", ", and", " so"]) == "example, and so"
    assert column(spark, E.wrap_pseudocode_column, "**Algorithm 2** Sort\n1: do *x*\n***\nfree text\ntail", None) == ["```pseudo\n// Algorithm 2: Sort\n1: do x\n// " + "-" * 40 + "\n```\nfree text\ntail", None]


def test_protect_and_restore(spark):
    text = "See [a](http://x.org) and `code` and `code`.\n\n```\nx = 1\n```\nplain $y$ ![i](j) [^1] <b>z</b>"
    rows = PH.protect(docs(spark, text, None, ""), config.default_config())
    row = rows.where("doc_id = 0").select("protected", "store", PH.restore(F.col("protected"), F.col("store"), nested=True).alias("back"), PH.load_store(PH.store_json(F.col("store"))).alias("again")).collect()[0]
    assert not re.search(r"http|code|\$|z", row.protected) and row.protected.count("__PH_CODE_") == 2
    assert re.sub(r"\s+", " ", row.back) == re.sub(r"\s+", " ", text)
    assert row.again == row.store
    assert [r.protected for r in rows.orderBy("doc_id").collect()][1:] == ["", ""]


def test_nodes(spark):
    d = docs(spark, "# H\nline one\nline two\n\n- item\nlast. " + "word " * 30 + "end. " + "tail " * 20).withColumnRenamed("md", "protected")
    nodes = N.split_nodes(d, 120)
    texts = [r.origin for r in nodes.orderBy("nid").collect()]
    assert texts[:3] == ["# H", "line one\nline two", "- item"] and len(texts) == 6
    packed = {r.nid: r.group_id for r in N.pack_nodes(nodes, 160).collect()}
    assert [packed[i] for i in range(6)] == [0, 0, 0, 1, 2, 3]
    back = N.unpack(N.payloads(nodes, N.pack_nodes(nodes, 160)))
    assert {r.nid: r.translated for r in back.collect()} == {i: t.strip() for i, t in enumerate(texts)}


def test_translation(spark):
    d = docs(spark, "# Title\n\nSome text with `code`.\n\n- item", "", None)
    texts, nodes, _ = translate.translate(d)
    got = {r.doc_id: r.text for r in texts.collect()}
    assert got[0] == "\n\n# Title\n\nSome text with `code`.\n\n- item\n\n" and got[1] == got[2] == ""
    upper = lambda t, s, g: re.sub(r"(__PH_\w+__|</?NODE_\w+>)|[a-z]+", lambda m: m[1] or m[0].upper(), t)
    cfg = config.TranslateConfig(target_lang="en", translator_type="echo")
    texts, _, _ = translate.translate(d, cfg, upper)
    assert "SOME TEXT WITH `code`." in {r.doc_id: r.text for r in texts.collect()}[0]
    broken = lambda t, s, g: t.replace("__PH_", "PH")
    texts, _, _ = translate.translate(d, cfg, broken)
    assert "Some text with `code`." in {r.doc_id: r.text for r in texts.collect()}[0]
    with pytest.raises(ValueError):
        translate.translator_for(config.TranslateConfig())


def test_config(tmp_path):
    (tmp_path / "a.toml").write_text('target_lang = "en"\nunknown = 1\n[translator_config]\nmodel = "m"\n')
    (tmp_path / "a.json").write_text('{"max_chunk_chars": 10}')
    (tmp_path / "a.yaml").write_text("parallel_groups: 4\n")
    cfg, options = config.load_config(str(tmp_path / "a.toml"))
    assert cfg.target_lang == "en" and options == {"model": "m"} and cfg.max_chunk_chars == 3000
    assert config.load_config(str(tmp_path / "a.json"))[0].max_chunk_chars == 10
    assert config.load_config(str(tmp_path / "a.yaml"))[0].parallel_groups == 4
    (tmp_path / "a.ini").write_text("")
    with pytest.raises(ValueError):
        config.load_config(str(tmp_path / "a.ini"))


def test_whole_repairs(spark):
    d = docs(spark, "# 1. A\nThe word goes on and\n---\nends here [1].\n---\nEnd.", "one page &amp; no rule", "", None)
    old, plan = fix.fix_old(d)
    got = {r.doc_id: r.md for r in old.collect()}
    assert "## 1. A" in got[0] and "[^1]" in got[0] and got[1] == "one page & no rule"
    assert {r.page: r.action for r in plan.where("doc_id = 0").collect()} == {0: "merged", 1: None}
    new = {r.doc_id: r.md for r in fix.fix_new(d).collect()}
    assert "# 1. A" in new[0] and "[^1]" in new[0] and new[2] == ""


BIG = "9" * 20


def test_hostile_numbers(spark):
    """Numbers of any length, reversed ranges, marks that are no node's."""
    huge = "9" * 60
    texts = [f"[{BIG}-5] a", f"[{huge}-{huge}] b", f"[{BIG}-{BIG}] d", "[0-2][3-3]", "[5-2]", None, "", f"[{BIG}]", f"[1,{BIG}]"]
    assert column(spark, T.cite_ranges_old, *texts) == [" a", f"[{huge}] b", f"[{BIG}] d", "[0][1][2][3]", "", None, "", f"[{BIG}]", f"[1,{BIG}]"]
    assert column(spark, T.cite_lists_new, *texts)[-2:] == [f"[^{BIG}]", f"[^1] [^{BIG}]"]
    assert len(column(spark, T.fix_references_old, *texts)) == len(column(spark, T.fix_references_new, *texts)) == len(texts)
    old, _ = fix.fix_old(docs(spark, *texts))
    assert old.count() == fix.fix_new(docs(spark, *texts)).count() == len(texts)
    answer = f"<NODE_START_{BIG}>\nx\n</NODE_END_{BIG}>\n<NODE_START_0001>\ny\n</NODE_END_0001><NODE_START_0002>z</NODE_END_0003><NODE_START_0001>again</NODE_END_0001>"
    groups = spark.createDataFrame([(1, 0, answer)], "doc_id long, group_id int, payload string")
    assert [tuple(r) for r in N.unpack(groups).collect()] == [(1, 1, "again")]
    store = f'{{"map":{{}},"rev":{{"__PH_URL_{BIG}__":"far","__PH_URL_000002__":"b","odd":"c","__PH_URL_000001__":"a"}},"kind_count":{{}}}}'
    got = [e.raw for e in column(spark, PH.load_store, store)[0]]
    assert got[:2] == ["a", "b"] and sorted(got[2:]) == ["c", "far"]


def test_many_matches_in_one_pass(spark):
    text = " ".join(f"[{i}-{i + 2}]" for i in range(1, 3000))
    want = " ".join(f"[^{i}] [^{i + 1}] [^{i + 2}]" for i in range(1, 3000))
    assert column(spark, T.cite_ranges_new, text) == [want]


def test_store_rules(spark):
    store = F.array(F.struct(F.lit("__PH_URL_000001__").alias("placeholder"), F.lit("a.org").alias("raw")), F.struct(F.lit("__PH_CODE_000002__").alias("placeholder"), F.lit("`c`").alias("raw")))
    assert column(spark, lambda c: PH.missing(c, store), "a.org", "a.org `c`") == [["`c`"], []]
    assert column(spark, lambda c: PH.holds_all(c, store), "a.org", "a.org `c`") == [False, True]
    assert column(spark, lambda c: PH.snapshot(store), "x") == [{"a.org": "__PH_URL_000001__", "`c`": "__PH_CODE_000002__"}]


class Model:
    """A stub of a model's client that fails, answers late, loses marks and invents ids."""

    def __init__(self, fail=0):
        self.fail, self.calls = fail, 0

    def chat(self, model, messages):
        self.calls += 1
        if self.calls <= self.fail:
            raise OSError("not there")
        return {"message": {"content": messages[1]["content"]}}


def test_model_options(monkeypatch):
    slept = []
    monkeypatch.setattr(translate.time, "sleep", slept.append)
    with pytest.raises(ValueError):
        translate.translator_for(config.TranslateConfig(translator_type="ollama"), {"host": "h"})
    call = translate.translator_for(config.TranslateConfig(translator_type="ollama"), {"model": "m"})
    assert (call.host, call.tries) == ("http://localhost:11434", 3)
    call.client = Model(fail=2)
    assert "a]]]]><![CDATA[>b" in call("a]]>b", "en", "zh") and slept == [2.5, 4.0]
    call.client, call.tries = Model(fail=9), 2
    assert call("text", None, "zh") == "text" and call.client.calls == 2
    assert pickle.loads(pickle.dumps(call)).client is None


def test_translation_with_a_bad_model(spark):
    """Every node comes out once; what fails keeps its original; retries see failed nodes only."""
    d = docs(spark, "# Title one\n\nSome `code` here.\n\nAnother paragraph.\n\n$x$\n\nlast words", "plain text")

    def model(text, source, target):
        time.sleep(0.01)
        text = text.replace("<NODE_START_0001>", "<NODE_START_99999999999>").replace("__PH_CODE", "PH_CODE")
        return re.sub(r"(</?NODE_\w+>)|([A-Z]?[a-z]{3,})", lambda m: m[1] or "译" + m[2].upper(), text) + "<NODE_START_0777>\ninvented\n</NODE_END_0777>"

    cfg = config.TranslateConfig(target_lang="zh", parallel_groups=4, max_chunk_chars=60, retry_times=2)
    texts, nodes, _ = translate.translate(d, cfg, model)
    rows = nodes.orderBy("doc_id", "nid").collect()
    assert [(r.doc_id, r.nid) for r in rows] == [(0, 0), (0, 1), (0, 2), (0, 3), (0, 4), (1, 0)]
    assert [r.outcome for r in rows] == ["translated", "failed", "translated", "skipped", "translated", "translated"]
    assert rows[1].translated == rows[1].origin and rows[0].translated == "# 译TITLE 译ONE"
    got = {r.doc_id: r.text for r in texts.collect()}
    assert "Some `code` here." in got[0] and "$x$" in got[0] and "invented" not in got[0]
    counts = {r.doc_id: (r.skipped, r.translated, r.retried, r.failed) for r in translate.outcomes(nodes).collect()}
    assert counts == {0: (1, 3, 0, 1), 1: (0, 1, 0, 0)}


def test_late_success(spark):
    """A node that only comes back in smaller groups counts as retried."""
    d = docs(spark, "\n\n".join(f"paragraph {w} with words " * 20 for w in ("one", "two", "three", "four")))
    model = lambda t, s, g: t.replace("paragraph", "段落") if len(t) < 1000 else ""
    _, nodes, _ = translate.translate(d, config.TranslateConfig(target_lang="zh", max_chunk_chars=1500, retry_times=1), model)
    assert {r.outcome for r in nodes.collect()} == {"retried"}


def test_packing_by_a_loop(spark):
    rng, rows, want = random.Random(5), [], {}
    for d in range(20):
        used, group = 0, -1
        for nid in range(rng.randrange(1, 40)):
            size = rng.choice([1, 50, 200, 900])
            rows.append((d, nid, "x" * size))
            cost = size + N.MARKS
            if group < 0 or (used + cost > 600 and used):
                group, used = group + 1, 0
            used += cost
            want[d, nid] = group
    nodes = spark.createDataFrame(rows, "doc_id long, nid int, origin string")
    assert {(r.doc_id, r.nid): r.group_id for r in N.pack_nodes(nodes, 600).collect()} == want


def test_figures_in_whole_documents(spark):
    text = "intro\ngoes on\n\n# A\n\n```\n# no heading\n![no](figure)\n```\n\npara one\npara two\n\n|a|b|\n|---|---|\n|1|2|\nTable 1. t\n\n- item\n- item\n\n<table>\n<tr></tr>\n</table>\n"
    got = column(spark, lambda c: c, *[r.md for r in G.moved(docs(spark, text, "", None)).orderBy("doc_id").collect()])
    assert got == ["intro\ngoes on\n\n# A\n\n|a|b|\n|---|---|\n|1|2|\n\nTable 1. t\n\n<table>\n<tr></tr>\n</table>\n\n```\n# no heading\n![no](figure)\n```\n\npara one\npara two\n\n- item\n- item", "", ""]


def test_reorganised(spark):
    md = "![r](r.png)\n# A\ntext one\n![a](a.png)\nFig. 1. of a\ntext two\n| t |\n|---|\n# B\nFig. 2. alone\n![b](b.png)"
    got = G.reorganised(G.figure_blocks(O.split_lines(docs(spark, md)))).collect()
    assert [r.md.split("\n\n") for r in got] == [["![r](r.png)", "# A", "![a](a.png)", "Fig. 1. of a", "| t |\n|---|", "text one", "text two", "# B", "![b](b.png)", "Fig. 2. alone"]]
