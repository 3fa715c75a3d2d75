"""Readers, writers and the folder stream."""

import json
import re

import pytest
from pyspark.sql import functions as F

from foliomend import __main__ as main

from foliomend.functions import text as T
from foliomend.plans import merge
from foliomend.sources import pages as R
from foliomend.sources import sinks
from foliomend.streaming.folders import process_new

GIF = "R0lGODlhAQABAAAAACw="


def test_records_to_documents(spark, tmp_path):
    (tmp_path / "md").mkdir()
    (tmp_path / "md" / "a.md").write_text(f"one ![x](data:image/gif;base64,{GIF}) ![y](data:image/gif;base64,{GIF})")
    records = [{"page_no": 1, "md_content_path": "file:" + str(tmp_path / "none.md"), "extra": 1}, {"md_content_path": "file://" + str(tmp_path / "md" / "a.md"), "file_path": "/in/doc.pdf"}]
    (tmp_path / "d.jsonl").write_text("\n".join(map(json.dumps, records)) + "\n\n")
    read = R.read_records(spark, str(tmp_path / "d.jsonl"))
    assert read.count() == 2
    pages = R.with_content(read, R.read_files(spark, str(tmp_path / "md")))
    assert [(r.place, r.page_no, r.content[:3]) for r in pages.orderBy("place").collect()] == [(1, 0, "one"), (2, 1, "")]
    images = R.images(pages)
    assert [(r.image, r.ext, r.rel_path) for r in images.orderBy("image").collect()] == [(1, ".gif", "images/page_000_img_001.gif"), (2, ".gif", "images/page_000_img_002.gif")]
    linked = R.link_images(pages, images)
    md = R.concatenate(linked, titles=True, header=True).collect()[0].md
    assert md == "# doc\n\n*Generated from PDF with 2 pages*\n\n---\n\n## Page 1\n\none ![x](images/page_000_img_001.gif) ![y](images/page_000_img_002.gif)\n\n---\n\n## Page 2\n\n---\n\n"
    meta = json.loads(R.metadata_json(pages).collect()[0].json)
    assert meta["total_pages"] == 2 and meta["source_pdf"] == "/in/doc.pdf" and meta["pages"][0]["embedded_images"] == 2 and not meta["pages"][0]["has_content_nohf"]


def test_bad_image_data(spark):
    pages = spark.createDataFrame([("d", 0, "![x](data:image/png;base64,A)")], "doc string, page_no long, content string")
    row = R.images(pages).collect()[0]
    assert row.bytes is None and row.rel_path is None


def test_image_kinds(spark):
    d = spark.sql("SELECT explode(array(unhex('FFD8FF'), unhex('474946'), unhex('89504E'))) AS b")
    assert [r[0] for r in d.select(T.image_extension(F.col("b"))).collect()] == [".jpg", ".gif", ".png"]


def test_sinks(spark, tmp_path):
    docs = spark.createDataFrame([("a", "x\ny"), ("b", "")], "doc string, md string")
    sinks.write_texts(docs, str(tmp_path / "out"))
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {("a", "x\ny"), ("b", "")}
    md = "# A<B {body}\n\none *x* `*y*` [l](u)\ntwo\n\n- i\n- **j**\n1. k\n\n| a | b |\n|---|---|\n| `c` | d |\n\n```py\n# no heading <\n```\n## C\n<div>\n<b>raw</b>\n</div>"
    page = sinks.html_pages(spark.createDataFrame([(0, md)], "doc_id long, md string"), F.lit("{body}")).collect()[0].html
    for part in (
        '<h1 id="h1">A&lt;B {body}</h1>', '<p>one <em>x</em> <code>*y*</code> <a href="u">l</a>\ntwo</p>', "<ul><li>i</li>\n<li><strong>j</strong></li></ul>", "<ol><li>k</li></ol>",
        "<table>\n<tr><th>a</th><th>b</th></tr>\n<tr><td><code>c</code></td><td>d</td></tr>\n</table>", "<pre><code># no heading &lt;</code></pre>", '<h2 id="h2">C</h2>', "<div>\n<b>raw</b>\n</div>", "<title>{body}</title>",
    ):
        assert page.count(part) == 1, part
    links, anchors = re.findall(r'href="#(\w+)"', page), re.findall(r'id="(\w+)"', page)
    assert links == anchors == ["h1", "h2"]


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([("a/x.md", "é"), ("a/b/y.md", ""), ("../z.md", "out"), ("/w.md", "out"), (None, "x"), ("n.md", None)], "path string, content string")
    for _ in range(2):
        sinks.write_files(rows.repartition(3), str(tmp_path / "out"))
    assert {str(f.relative_to(tmp_path)): f.read_text() for f in tmp_path.rglob("*") if f.is_file() and sinks.MANIFEST not in f.parts} == {"out/a/x.md": "é", "out/a/b/y.md": ""}
    sinks.write_files(spark.createDataFrame([("i.gif", bytearray(b"GIF"))], "path string, content binary"), f"file://{tmp_path}/img")
    assert (tmp_path / "img" / "i.gif").read_bytes() == b"GIF"


def test_rendered(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, md string").withColumn("html", F.lit(3))
    assert {r.doc_id: r.html for r in sinks.rendered(docs, lambda t: f"<p>{t}</p>").collect()} == {1: "<p>a</p>", 2: None}


def test_merge_from_files_to_files(spark, tmp_path):
    (tmp_path / "in" / "md").mkdir(parents=True)
    for name, text in (("a0", f"zero ![x](data:image/gif;base64,{GIF})"), ("a0n", "zero"), ("b0", "only")):
        (tmp_path / "in" / "md" / f"{name}.md").write_text(text)
    at = lambda n: str(tmp_path / "in" / "md" / f"{n}.md")
    (tmp_path / "in" / "a.x.jsonl").write_text("\n".join(map(json.dumps, [{"page_no": 1, "file_path": "/p/a.pdf"}, {"page_no": 0, "file_path": "/p/a.pdf", "md_content_path": at("a0"), "md_content_nohf_path": at("a0n")}])))
    (tmp_path / "in" / "b.jsonl").write_text(json.dumps({"md_content_path": at("b0")}) + "\n \n")
    out = str(tmp_path / "out")
    main.main(["merge", str(tmp_path / "in" / "*.jsonl"), str(tmp_path / "in" / "md"), "-o", out])
    files = {str(f.relative_to(tmp_path / "out")) for f in (tmp_path / "out").rglob("*") if f.is_file() and sinks.MANIFEST not in f.parts}
    assert files == {"a.x/a_x_embedded.md", "a.x/a_x_external.md", "a.x/metadata.json", "a.x/images/page_000_img_001.gif", "b/b_embedded.md", "b/b_external.md", "b/metadata.json"}
    read = lambda f: (tmp_path / "out" / f).read_text()
    assert read("a.x/a_x_embedded.md") == f"zero ![x](data:image/gif;base64,{GIF})\n\n---\n\n---\n\n"
    assert read("a.x/a_x_external.md").startswith("# a\n\n*Generated from PDF with 2 pages*\n\n---\n\nzero ![x](images/page_000_img_001.gif)")
    meta = json.loads(read("a.x/metadata.json"))
    assert meta["total_pages"] == 2 and [p["embedded_images"] for p in meta["pages"]] == [1, 0]
    # What is there isn't done again; headers and footers can be left out.
    (tmp_path / "out" / "b" / "b_embedded.md").write_text("mine")
    merge.run(spark, str(tmp_path / "in" / "*.jsonl"), str(tmp_path / "in" / "md"), out, plain=True, titles=True)
    assert read("b/b_embedded.md") == "mine"
    merge.run(spark, str(tmp_path / "in" / "a.x.jsonl"), str(tmp_path / "in" / "md"), str(tmp_path / "again"), plain=True, titles=True)
    assert (tmp_path / "again" / "a.x" / "a_x_embedded.md").read_text() == "## Page 1\n\nzero\n\n---\n\n## Page 2\n\n---\n\n"
    assert json.loads((tmp_path / "again" / "a.x" / "metadata.json").read_text())["pages"][0]["embedded_images"] == 1


def test_command_lines(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "d.md").write_text("# 1. Title\n\nSome text [1].\n\n![a](b.png)\n\nFig. 1. c\n")
    (tmp_path / "c.json").write_text('{"translator_type": "echo", "target_lang": "en"}')
    for command, more in (("fix", ["--rules", "old"]), ("figures", []), ("translate", ["-c", str(tmp_path / "c.json"), "-s", "de"])):
        main.main([command, str(tmp_path / "in"), "-o", str(tmp_path / command), *more])
    assert (tmp_path / "fix" / "d.md").read_text().startswith("## 1. Title")
    assert (tmp_path / "figures" / "d.md").read_text() == "# 1. Title\n\n![a](b.png)\n\nFig. 1. c\n\nSome text [1]."
    assert {f.name for f in (tmp_path / "translate").iterdir() if f.name != sinks.MANIFEST} == {"d.md", "d.protected.md", "d.protected.json", "d.nodes.json"}
    assert "Some text [1]." in (tmp_path / "translate" / "d.md").read_text()
    with pytest.raises(SystemExit):
        main.main(["nothing"])


def test_folder_stream(spark, tmp_path):
    folder, out, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    folder.mkdir()

    def run():
        process_new(spark, str(folder), out, log, lambda b: b.select("path", F.length("md").alias("n"))).awaitTermination(60)
        return spark.read.parquet(out).count()

    (folder / "a.md").write_text("abc")
    assert run() == 1
    assert run() == 1
    (folder / "b.md").write_text("d")
    assert run() == 2


def test_skip_existing(spark):
    have = spark.createDataFrame([("a",)], "name string")
    want = spark.createDataFrame([("a",), ("b",)], "name string")
    assert [r.name for r in R.without_output(want, have).collect()] == ["b"]


def test_default_output_is_relative(spark, tmp_path, monkeypatch):
    """Without -o, output is a folder below the working folder of the default file system."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "d.md").write_text("# 1. Title")
    home = spark._jvm.org.apache.hadoop.fs.Path("output")
    files = home.getFileSystem(spark._jsc.hadoopConfiguration())
    before = files.getWorkingDirectory()
    files.setWorkingDirectory(spark._jvm.org.apache.hadoop.fs.Path(str(tmp_path)))
    try:
        main.main(["fix", str(tmp_path / "in")])
    finally:
        files.setWorkingDirectory(before)
    assert (tmp_path / "output" / "d.md").read_text().startswith("# 1. Title")


def test_names_below_the_input(spark, tmp_path):
    for folder in ("a b", "c"):
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / "d+%20.md").write_text(f"text of {folder}")
    main.main(["fix", str(tmp_path / "in"), "-o", str(tmp_path / "out")])
    assert {f: (tmp_path / "out" / f / "d+%20.md").read_text() for f in ("a b", "c")} == {"a b": "text of a b", "c": "text of c"}
    assert {r.path: r.bytes for r in sinks.manifest(spark, str(tmp_path / "out")).collect()} == {"a b/d+%20.md": 11, "c/d+%20.md": 9}
    with pytest.raises(ValueError, match="would be written as x"):
        sinks.checked_names(spark.createDataFrame([("x",), ("x",), ("y",)], "name string"))


def test_pages_in_folders_with_spaces(spark, tmp_path):
    (tmp_path / "m d").mkdir()
    (tmp_path / "m d" / "p 1.md").write_text("one")
    (tmp_path / "r 1.jsonl").write_text(json.dumps({"md_content_path": str(tmp_path / "m d" / "p 1.md")}))
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "r 1.jsonl").write_text(json.dumps({"md_content_path": str(tmp_path / "m d" / "p 1.md")}))
    with pytest.raises(ValueError, match="would be written as r 1"):
        merge.run(spark, [str(tmp_path / "r 1.jsonl"), str(tmp_path / "deep")], str(tmp_path / "m d"), str(tmp_path / "o"), plain=False)
    merge.run(spark, str(tmp_path / "r 1.jsonl"), str(tmp_path / "m d"), str(tmp_path / "o"), plain=False)
    assert (tmp_path / "o" / "r 1" / "r 1_embedded.md").read_text() == "one\n\n---\n\n"


def test_a_broken_run_leaves_no_manifest(spark, tmp_path):
    fail = F.udf(lambda x: 1 / 0 if x == "b.md" else x)
    rows = spark.createDataFrame([("a.md", "x"), ("b.md", "y")], "path string, content string").repartition(2)
    with pytest.raises(Exception, match="ZeroDivisionError"):
        sinks.write_files(rows.withColumn("content", fail("path")), str(tmp_path / "out"))
    assert sinks.manifest(spark, str(tmp_path / "out")).count() == 0
    sinks.write_files(rows, str(tmp_path / "out"))
    assert sorted(r.path for r in sinks.manifest(spark, str(tmp_path / "out")).collect()) == ["a.md", "b.md"]


def test_a_broken_merge_is_completed(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "p.md").write_text("one")
    (tmp_path / "in" / "d.jsonl").write_text(json.dumps({"md_content_path": str(tmp_path / "in" / "p.md")}))
    (tmp_path / "out" / "d").mkdir(parents=True)
    (tmp_path / "out" / "d" / "d_embedded.md").write_text("half")
    for _ in range(2):
        merge.run(spark, str(tmp_path / "in" / "*.jsonl"), str(tmp_path / "in"), str(tmp_path / "out"), plain=False)
    assert (tmp_path / "out" / "d" / "d_embedded.md").read_text() == "one\n\n---\n\n" and (tmp_path / "out" / "d" / "metadata.json").exists()
    assert len([f for f in (tmp_path / "out" / sinks.MANIFEST).iterdir()]) == 2 and sinks.manifest(spark, str(tmp_path / "out")).count() == 3


def test_running_image_numbers(spark):
    x = f"![x](data:image/gif;base64,{GIF})"
    pages = spark.createDataFrame([("d", 5, 1, f"{x} {x}"), ("d", 7, 2, ""), ("d", 7, 3, x), ("e", 0, 1, x)], "doc string, page_no long, place int, content string")
    got = R.images(pages, running=True).orderBy("doc", "image").collect()
    assert [r.rel_path for r in got] == ["images/page_005_img_001.gif", "images/page_005_img_002.gif", "images/page_007_img_003.gif", "images/page_000_img_001.gif"]
