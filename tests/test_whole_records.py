"""Queries over nodes and page records leave none out."""

from pyspark.sql import functions as F

from foliomend.operators import nodes as N
from foliomend.plans import registry

TABLES = "/root/testdata/sf0.001"


def test_all_nodes_are_unpacked(spark):
    assert registry.QUERIES["node_unpack"](spark, TABLES).count() == registry._line_nodes(spark, TABLES).count()


def test_missing_ids(spark):
    nodes = spark.createDataFrame([(1, 1, "one"), (1, 4, "four"), (2, 3, "three")], "doc_id long, nid int, origin string")
    got = N.unpack(N.payloads(nodes, N.pack_nodes(nodes, 600))).collect()
    assert sorted((r.doc_id, r.nid, r.translated) for r in got) == [(1, 1, "one"), (1, 4, "four"), (2, 3, "three")]


def test_only_added_pages_are_blank(spark):
    records = registry._records(spark, TABLES)
    last = records.groupBy("doc").agg(F.max("place").alias("place"))
    blank = records.where("content = ''")
    assert blank.count() == last.count() == blank.join(last, ["doc", "place"]).count()
