"""A translation keeps one state of its nodes on disk, and finds answers in a document's row as `unpack` does over rows."""

import random
import time
from pathlib import Path

from pyspark.sql import functions as F

from foliomend.operators import nodes as N
from foliomend.plans import config, translate
from foliomend.sources.shared import shared_dir, written_and_cleaned


def tables(spark):
    return {p.name: sum(f.stat().st_size for f in p.rglob("*.parquet")) for p in Path(shared_dir(spark)).iterdir()}


def test_rounds_leave_one_state(spark):
    """Four rounds that all fail leave what is protected and the last state, with no text twice in it."""
    rng = random.Random(3)
    texts = ["\n\n".join("".join(rng.choice("abcdefghij klm.") for _ in range(300)) for _ in range(20)) for _ in range(60)]
    before = tables(spark)
    found, nodes, protected = translate.translate(spark.createDataFrame(list(enumerate(texts)), "doc_id long, md string"))
    left = {k: v for k, v in tables(spark).items() if k not in before}
    assert sorted(k.split("-")[0] for k in left) == ["protected", "round"]
    size = {k.split("-")[0]: v for k, v in left.items()}
    assert size["round"] < 1.3 * size["protected"]
    assert found.count() == 60 and {r.outcome for r in nodes.collect()} == {"failed"} and protected.columns == ["doc_id", "protected", "store"]


def test_what_was_shuffled_goes_with_its_query(spark):
    """No file of the shuffle stays when the table is there; the setting holds for the writing only."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {x for x in blocks.getAllFiles().mkString("\n").split("\n") if "shuffle_" in x}
    old = files()
    table = written_and_cleaned(spark.range(1000).repartition(3, "id"), "some")
    until = time.time() + 20
    while files() - old and time.time() < until:
        time.sleep(0.2)
    assert not files() - old and spark.conf.get(key, None) == before and table.count() == 1000


def test_answers_in_a_row_and_in_rows(spark):
    """Answers with repeats, marks of other groups, lost nodes and none at all."""
    rng = random.Random(7)
    rows, answers = [], []
    for d in range(150):
        ids = sorted(rng.sample(range(60), rng.randrange(1, 25)))
        cuts = sorted({0, *(rng.randrange(len(ids)) for _ in range(3))})
        groups = [ids[a:b] for a, b in zip(cuts, [*cuts[1:], None])]
        mark = lambda n, t: f"<NODE_START_{n:04d}>\n{t}\n</NODE_END_{n:04d}>\n\n"
        said = []
        for g in groups:
            kind = rng.randrange(4)
            held = g if kind == 0 else [rng.choice([*g, *ids, 99]) for _ in g] if kind == 1 else [x for x in g if rng.random() < 0.7]
            said.append(None if kind == 3 and rng.random() < 0.5 else "".join(mark(n, rng.choice([" a", "b ", "", "c\td"])) for n in held))
        rows.append((d, [[(n, f"o{n}") for n in g] for g in groups], said))
        answers += [(d, k, t) for k, t in enumerate(said)]
    docs = spark.createDataFrame(rows, "doc_id long, groups array<array<struct<nid:int,origin:string>>>, said array<string>")
    got = docs.select("doc_id", F.explode(N.matched(F.col("groups"), F.col("said"))).alias("f")).select("doc_id", "f.row.nid", "f.new").collect()
    want = {(r.doc_id, r.nid): r.translated for r in N.unpack(spark.createDataFrame(answers, "doc_id long, group_id int, payload string")).collect()}
    assert len(got) == sum(len(g) for _, gs, _ in rows for g in gs)
    assert {(r.doc_id, r.nid): r.new for r in got} == {(d, n): want.get((d, n)) for d, gs, _ in rows for g in gs for n, _ in g}
    echo = docs.select("doc_id", "groups", F.transform("groups", N.group_text).alias("said"))
    same = echo.select((N.matched(F.col("groups"), F.col("said")) == N.echoed(F.col("groups"))).alias("same")).distinct().collect()
    assert [r.same for r in same] == [True]


def test_marks_in_a_text(spark):
    """A text that holds marks itself is read as an answer is."""
    docs = spark.createDataFrame([(1, "one </NODE_END_0000> two 中\n\nthree"), (2, " four 中")], "doc_id long, md string")
    _, nodes, _ = translate.translate(docs, config.default_config())
    got = {(r.doc_id, r.nid): (r.translated, r.outcome) for r in nodes.collect()}
    assert got == {(1, 0): ("one", "translated"), (1, 1): ("three", "failed"), (2, 0): ("four 中", "translated")}
