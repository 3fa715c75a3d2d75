"""Calls of a model: equal payloads once, answers kept over broken runs, a bound on calls at a time."""

import collections
import sys
import time
import uuid
from pathlib import Path

import pytest
from pyspark import cloudpickle

from foliomend.plans import config, translate

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers don't see the tests


class Model:
    """Translates by capitals, and leaves a file for each call; `breaks` fails once for a payload that holds it."""

    name = "capitals"

    def __init__(self, folder: Path, breaks: str = "", seconds: float = 0.0):
        self.folder, self.breaks, self.seconds = folder, breaks, seconds
        (folder / "calls").mkdir(parents=True, exist_ok=True)
        (folder / "now").mkdir(exist_ok=True)

    def __call__(self, text, source, target):
        if self.breaks and self.breaks in text and not (self.folder / "broken").exists():
            (self.folder / "broken").touch()
            raise RuntimeError("the model broke")
        running = self.folder / "now" / uuid.uuid4().hex
        running.touch()
        (self.folder / "calls" / uuid.uuid4().hex).write_text(f"{len(list((self.folder / 'now').iterdir()))}\n{text}")
        time.sleep(self.seconds)
        running.unlink()
        return "".join(x if x.startswith("<") else x.upper() for x in text.splitlines(keepends=True))

    def made(self):
        return [f.read_text().split("\n", 1) for f in (self.folder / "calls").iterdir()]


def documents(spark, n, text=lambda i: f"The first line of {i}.\n\nAnd the second one of {i}."):
    return spark.createDataFrame([(i, text(i)) for i in range(n)], "doc_id long, md string").repartition(4)


CFG = config.TranslateConfig(source_lang="en", target_lang="fr", max_chunk_chars=200, translator_type="echo", parallel_groups=2)


def test_a_broken_run_asks_for_nothing_twice(spark, tmp_path):
    model = Model(tmp_path, breaks="one of 7.")
    docs = documents(spark, 24)
    with pytest.raises(Exception, match="the model broke"):
        translate.translate(docs, CFG, model, kept=str(tmp_path / "answers"))
    before = len(model.made())
    texts, nodes, _ = translate.translate(docs, CFG, model, kept=str(tmp_path / "answers"))
    assert {r.doc_id: r.text.strip() for r in texts.collect()} == {i: f"THE FIRST LINE OF {i}.\n\nAND THE SECOND ONE OF {i}." for i in range(24)}
    assert 0 < before < 24 and max(collections.Counter(p for _, p in model.made()).values()) == 1 and len(model.made()) == 24
    again, _, _ = translate.translate(docs, CFG, model, kept=str(tmp_path / "answers"))
    assert again.count() == 24 and len(model.made()) == 24
    # Another target language is another question.
    translate.translate(docs, CFG.with_languages(None, "de"), model, kept=str(tmp_path / "answers"))
    assert len(model.made()) == 48


def test_equal_payloads_are_one_call(spark, tmp_path):
    model = Model(tmp_path)
    texts, nodes, _ = translate.translate(documents(spark, 30, lambda i: f"The same line for all of {i % 3}."), CFG, model)
    assert len(model.made()) == 3 and texts.count() == 30 and {r.outcome for r in nodes.collect()} == {"translated"}


def test_calls_at_a_time_are_bounded(spark, tmp_path):
    model = Model(tmp_path, seconds=0.05)
    translate.translate(documents(spark, 40), CFG, model, calls=2)
    assert len(model.made()) == 40 and max(int(n) for n, _ in model.made()) <= 2
    wide = Model(tmp_path / "wide", seconds=0.2)
    translate.translate(documents(spark, 40), CFG, wide, calls=8)
    assert 2 < max(int(n) for n, _ in wide.made()) <= 8


def test_a_failed_answer_is_not_kept(spark, tmp_path):
    asked = translate.call_groups(spark.createDataFrame([(1, 0, "as it is")], "doc_id long, group_id int, payload string"), translate.echo, CFG, kept=translate.Kept(str(tmp_path / "a")))
    assert [r.payload for r in asked.collect()] == ["as it is"]
    assert translate.Kept(str(tmp_path / "a")).table(spark).count() == 0 and not (tmp_path / "a" / "calls").exists()
