"""Nodes are found within their document's row and meet once for their groups; checks look at short heads first."""

from pyspark.sql import functions as F

from foliomend.functions import lines as L
from foliomend.functions import text as T
from foliomend.operators import nodes as N
from foliomend.plans import translate
from tests.test_line_marks import odd_lines


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning")


def documents(spark):
    lines = odd_lines(3000)
    return spark.createDataFrame([(k, "\n".join(lines[k * 30 : k * 30 + 30])) for k in range(100)] + [(100, None), (101, ""), (102, "\n \n"), (103, "1. a\nb\n\n\n# c\nd. e! f")], "doc_id long, md string")


def test_nodes_need_no_shuffle(spark):
    found = N.split_nodes(documents(spark), 40, "md")
    assert exchanges(found) == 0
    assert [r.origin for r in found.where("doc_id = 103").orderBy("nid").collect()] == ["1. a", "b", "# c", "d. e! f"]
    assert found.where("doc_id BETWEEN 100 AND 102").count() == 0


def test_payloads_by_one_shuffle(spark):
    nodes = N.split_nodes(documents(spark), 40, "md")
    packed = N.packed_payloads(nodes, 200)
    assert exchanges(packed) == 1
    plain = N.payloads(nodes, N.pack_nodes(nodes, 200))
    assert sorted(map(tuple, packed.collect())) == sorted(map(tuple, plain.collect()))
    back = {(r.doc_id, r.nid): r.translated for r in N.unpack(packed).collect()}
    assert back == {(r.doc_id, r.nid): r.origin.strip(" \t\n\x0b\f\r") for r in nodes.collect()}


def test_heads_tell_what_the_patterns_tell(spark):
    lines = [*odd_lines(3000), " " * 3 + "1" * 9 + ". x", "1" * 10 + ". x", "   ###### x", "####### x", "×÷", "$x$ ÷", "_ é", "www.a b", "@@PRESERVE_1@@ a @@/PRESERVE_1@@", "぀・゠"]
    x = F.col("x")
    rows = spark.createDataFrame([(v,) for v in lines], "x string").select(
        (L.is_heading(x) == L.heading_at_head(x)) & (L.is_list_item(x) == L.list_item_at_head(x)) & (L.is_blank(x) == L.blank_line(x)),
        T.is_placeholder_only(x) == ~T.strip_unreadable(x).rlike(T.READABLE),
    )
    assert set(map(tuple, rows.collect())) == {(True, True)}


def test_groups_of_a_translation_meet_once(spark, monkeypatch):
    """The nodes of a round are shuffled once on their way to the translator."""
    seen, plain = [], translate.written
    monkeypatch.setattr(translate, "written", lambda df, name: (name == "groups" and seen.append(exchanges(df)), plain(df, name))[1])
    docs = spark.createDataFrame([(1, "# Title\n\nSome text to read.\n"), (2, "中文 text.")], "doc_id long, md string")
    texts = {r.doc_id: r.text.strip() for r in translate.translate(docs)[0].collect()}
    assert texts == {1: "# Title\n\nSome text to read.", 2: "中文 text."}
    assert len(seen) > 1 and set(seen) == {1}
