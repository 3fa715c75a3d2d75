"""Stages of the pipeline on odd tables."""

import corpus_pipeline as p


def test_no_language_is_known(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, None, None), (3, "12 !?", None), (4, "日本語", None)], "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in p.reject_no_language(spark, docs, "").collect()) == [1, 4]


def test_one_of_a_near_group(spark):
    """Whatever ids the rows of a group have, one stays; rows with clashing names are of no account."""
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(None, text, "x"), (None, text + " y", "x"), (4, text + " z", "x"), (4, text + " q", "x"), (None, "apart from all others", "x"), (None, None, "x"), (9, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row string")
    assert sorted((r.doc_id or 0, (r.text or "")[:5]) for r in p.drop_near_copies(spark, docs, "").collect()) == [(0, ""), (0, "apart"), (4, "w0 w1"), (9, "")]


def test_which_of_repeated_rows(spark):
    """Among rows with one id and equal texts the choice doesn't depend on how they are dealt."""
    rows = [(1, "a b", n) for n in range(30)] + [(1, "a  b", 99)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    found = {tuple(p.drop_copies(spark, d, "").collect()) for d in (docs, docs.repartition(3), docs.orderBy("n_chars").coalesce(1))}
    assert len(found) == 1 and len(found.pop()) == 1
