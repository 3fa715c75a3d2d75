"""Work that must be dealt over tasks, and memory that must not follow a batch."""

import random
import re

import pyarrow as pa
from pyspark.sql import functions as F

from foliomend.functions import text as T
from foliomend.functions.batches import cuts, text_bytes
from foliomend.operators import blocks as B
from foliomend.operators import nodes as N
from foliomend.operators import pages as P
from foliomend.operators import parts as PT
from foliomend.operators import placeholders as PH
from foliomend.plans import config, registry
from foliomend.sources import pages as R
from foliomend.sources import sinks

TABLES = "/root/testdata/sf0.001"


def test_long_ranges_are_dealt(spark):
    assert registry.QUERIES["cite_long_ranges"](spark, TABLES).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_ranges_around_a_long(spark):
    """The same marks for numbers that are longs and for those that are not."""
    for a in (0, 8, 999_999_999_999_999_990, 10**18 - 3, 10**18, 10**19, 10**37):
        md = spark.createDataFrame([(f"x [{a}-{a + 5}] y [{a}-{a}] [{a + 1}-{a}]",)], "md string").select(T.cite_ranges_new(F.col("md")), T.cite_ranges_old(F.col("md"))).head()
        for got, before, between in zip(md, ("^", ""), (" ", "")):
            assert got == f"x {between.join(f'[{before}{n}]' for n in range(a, a + 6))} y [{before}{a}] "


def test_batches_are_cut_by_their_texts():
    texts = pa.array(["a" * 10, None, "b" * 25, "", "c" * 9, "d" * 9, "é" * 5])
    assert list(cuts(texts, most=20)) == [(0, 2), (2, 1), (3, 3), (6, 1)]
    assert list(cuts(texts.slice(2), most=20, rows=1)) == [(k, 1) for k in range(5)]
    lists = pa.array([["a" * 10, "b" * 8], None, [], ["c" * 30], ["d", None]])
    assert text_bytes(lists).tolist() == [18, 0, 0, 30, 1] and text_bytes(lists.slice(3)).tolist() == [30, 1]
    assert list(cuts(pa.array([], pa.string()))) == []


class Taken:
    """Stands for a DataFrame and keeps the function that its batches go through."""

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        return run


def test_no_batch_is_held_whole(spark):
    """Rows of one batch leave in slices."""
    ids, pages, texts = pa.array(range(3000), pa.int64()), pa.array([0] * 3000, pa.int32()), pa.array(["a\n\n```\nb\n```\n"] * 3000)
    for run, columns in ((B.lex_blocks(Taken()), [ids, pages, texts]), (PH.protect(Taken(), config.default_config()), [ids, texts]), (B.rewritten(Taken(), B.respaced), [ids, texts])):
        found = list(run(iter([pa.RecordBatch.from_arrays(columns, [f"c{k}" for k in range(len(columns))])])))
        assert len(found) == 3
        assert [i for b in found for i in dict.fromkeys(b.column(0).to_pylist())] == list(range(3000))

def test_states_pass_without_a_group_for_each_page(spark):
    """Pages whose maps meet in one task; no state of a page reaches the next one."""
    pages = spark.createDataFrame([(d, p, "x\n```\n" * (d % 2 + 1) + "y\n" * 5) for d in range(40) for p in range(20)], "doc_id long, page int, text string")
    columns = ["doc_id", "page", "block", "kind", "first", "last", "text"]
    shown = lambda rows: sorted(tuple(r[c] for c in columns) for r in rows.collect())
    plans = []
    keep = PT.written
    try:
        PT.written = lambda df, name: plans.append(df._jdf.queryExecution().toString()) or keep(df, name)
        assert shown(PT.lex_blocks_in_parts(pages, most=2)) == shown(B.lex_blocks(pages))
    finally:
        PT.written = keep
    assert len(plans) == 1 and "FlatMapGroups" not in plans[0]


def test_written_files_are_found_by_their_manifest(spark, tmp_path):
    """The same records and pages as from listed folders; many files to a task."""
    record = '{"page_no": %d, "md_content_path": "p"}'
    files = [(f"records/d{k}.jsonl", "\r\n".join([record % 2, " ", record % 1]) + "\n" * (k % 3)) for k in range(300)] + [("pages/a b/1.md", "é\nx"), ("pages/2.md", "")]
    rows = spark.createDataFrame(files, "path string, content string")
    for _ in range(2):
        sinks.write_files(rows, str(tmp_path))
    (tmp_path / "pages" / "3.md").write_text("no run has written this")
    (tmp_path / "pages" / "2.md").unlink()
    shown = lambda df: sorted(tuple(r) for r in df.withColumn("doc", R._local(F.col("doc"))).collect())
    got = R.records_in(R.read_written(spark, str(tmp_path), "records"))
    assert shown(got) == shown(R.read_records(spark, f"{tmp_path}/records").select(got.columns)) and got.count() == 600
    assert got.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert [r.value for r in R.read_written(spark, str(tmp_path), "pages").collect()] == ["é\nx"]


def test_merge_lists_no_folder_of_pages(spark, monkeypatch):
    def listed(*_, **__):
        raise AssertionError("a folder of page files was listed")

    monkeypatch.setattr(R, "read_files", listed)
    monkeypatch.setattr(R, "read_records", listed)
    assert registry.QUERIES["merge_from_files"](spark, TABLES).columns == ["doc", "md"]


def test_arrays_are_computed_once(spark):
    """No filter by an array's size stands below the step that makes rows of it; null texts have no rows."""
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a\n---\nb. c")], "doc_id long, md string").repartition(2)
    for df, want in ((P.split_pages_old(docs), 3), (P.split_pages_new(docs), 3), (N.split_nodes(docs, 6, "md"), 2)):
        plan = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
        assert not [x for x in plan if x.lstrip(" +-:").startswith("Filter") and "size(" in x]
        assert df.where("doc_id <> 1").count() == df.count() >= want


def test_nodes_are_filled_as_by_the_plain_rule(spark):
    """Parts with and without outer space, Unicode's too, against the rule in Python."""
    rng, spaces = random.Random(5), " \t 　"
    rows = [(i, "".join(rng.choice(["ab", "cde.", "f!", "。", " ", " ", "　", "x" * 9]) for _ in range(rng.randrange(30)))) for i in range(300)]

    def plain(text, most):
        if len(text) <= most:
            return [text] if text else []
        done, buffer = [], ""
        for p in re.split(r"(?<=[。！？!?.])[ \t]+", text):
            longer = (p if not buffer else f"{buffer} {p}").strip(spaces)
            if len(longer) > most and buffer:
                done, buffer = [*done, buffer], p
            else:
                buffer = longer
        return [x for x in [*done, buffer] if x]

    docs = spark.createDataFrame([(i, f"z{t}") for i, t in rows], "doc_id long, md string")
    got = {}
    for r in N.split_nodes(docs, 12, "md").orderBy("doc_id", "nid").collect():
        got.setdefault(r.doc_id, []).append(r.origin)
    assert got == {i: plain(f"z{t}", 12) for i, t in rows}
