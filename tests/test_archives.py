"""Small files in archives: the same rows as from files by themselves, for a fraction of the disk and its entries."""

import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from foliomend.plans import registry
from foliomend.sources import pages as R
from foliomend.sources import sinks
from foliomend.sources.shared import shared_dir

FILES = [(f"pages/d{k % 50}/{k}.md", f"é text of {k}\r\n" * (k % 4)) for k in range(400)] + [("records/r.jsonl", "{}"), ("../out.md", "x"), ("n.md", None), (None, "x"), ("pagesque.md", "no page")]


def blocks(folder):
    return sum(p.stat().st_blocks * 512 for p in Path(folder).rglob("*"))


def test_archived_files_are_the_same(spark, tmp_path):
    rows = spark.createDataFrame(FILES, "path string, content string").withColumn("more", F.lit(1)).repartition(4)
    sinks.write_files(rows, str(tmp_path / "files"))
    sinks.write_files(rows, str(tmp_path / "archives"), archived=True)
    for below in ("pages", "records", ""):
        shown = lambda name, **how: sorted((r.path.split(f"/{name}/")[1], r.value) for r in R.read_written(spark, str(tmp_path / name), below, **how).collect())
        assert shown("archives", archived=True) == shown("files") and shown("archives") == shown("files", archived=True) == []
    assert R.read_written(spark, str(tmp_path / "archives"), "pages", archived=True).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = sinks.manifest(spark, str(tmp_path / "archives"), "path string, bytes long, archive string, more int").collect()
    assert len(made) == 402 and {r.more for r in made} == {1} and {r.archive for r in made} == {f"archives/{p.name}" for p in (tmp_path / "archives" / "archives").iterdir()}
    assert {r.path: r.bytes for r in made} == {p: len(c.encode()) for p, c in FILES if p and c is not None and ".." not in p}
    assert 10 * blocks(tmp_path / "archives") < blocks(tmp_path / "files")


def test_archives_are_bounded(tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "ARCHIVE", 1000)
    made = sinks.Archives(sinks.Folder(f"file://{tmp_path}"))
    places = [made.put(f"{k}.md", b"x" * 300) for k in range(10)]
    made.close()
    made.close()
    assert [places.count(p) for p in dict.fromkeys(places)] == [4, 4, 2] and places == sorted(places, key=list(dict.fromkeys(places)).index)
    assert zipfile.ZipFile(tmp_path / places[0]).namelist() == ["0.md", "1.md", "2.md", "3.md"]


def test_a_broken_run_leaves_no_archive_to_read(spark, tmp_path):
    fail = F.udf(lambda x: 1 / 0 if x == "b.md" else x)
    rows = spark.createDataFrame([("a.md", "x"), ("b.md", "y")], "path string, content string").repartition(2)
    with pytest.raises(Exception, match="ZeroDivisionError"):
        sinks.write_files(rows.withColumn("content", fail("path")), str(tmp_path), archived=True)
    sinks.write_files(rows, str(tmp_path), archived=True)
    assert sorted(r.value for r in R.read_written(spark, str(tmp_path), archived=True).collect()) == ["x", "y"]


def test_merge_leaves_few_files(spark):
    """The page files of a merge take no block of the disk each, and go when the pages are a table."""
    before = set(Path(shared_dir(spark)).iterdir())
    found = registry.QUERIES["merge_from_files"](spark, "/root/testdata/sf0.001")
    pages = registry._records(spark, "/root/testdata/sf0.001").where("content <> ''").count()
    new = set(Path(shared_dir(spark)).iterdir()) - before
    assert [d.name.split("-")[0] for d in new] == ["pages"]
    assert found.count() == 200 and sum(1 for d in new for p in d.rglob("*") if p.is_file()) < pages / 4
