"""Quality rules, collocations and centroids against plain Python, on odd rows and on texts by rule."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foliomend.llm import centroids, collocations, quality, topk

SPACE = r"[\x20\x09-\x0D]"
ODD = ["", None, " \t\n", "a", "Été ÇA va", "x" * 70000, "a b " * 9000, "日本語 テキスト 12", "\U0001f600 ▁x |#", "one two\x0bthree\x0cfour\r\nfive", "a\n\na\n \na\nb\n"]


def table(spark, texts, lang=lambda i: "en"):
    rows = [(i, t, lang(i), "x", 1, 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, _text string, n_words int, f int")


# ---------------------------------------------------------------------- 11


def plain_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    times = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {i + k for i in range(len(words) - 4) if times[tuple(words[i : i + 5])] > 1 for k in range(5)}
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(inside), n < 10 or 100 * len(inside) > 20 * n


def quality_texts():
    rng = random.Random(3)
    some = [f"w{i}" for i in range(9)]
    out = list(ODD)
    for _ in range(60):
        parts = [rng.choice(some) + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(rng.randrange(60))]
        out.append("".join(parts))
    return out + ["a b c d e a b c d e", "a b c d a b c d a b c d a", " ".join(map(str, range(40))) + " " + " ".join(map(str, range(5)))]


def test_quality_measures(spark):
    texts = quality_texts()
    got = {r.doc_id: tuple(r)[1:8] for r in quality.judge(table(spark, texts)).collect()}
    assert got == {i: plain_measures(t) for i, t in enumerate(texts)}


def test_quality_every_rule_rejects_and_prose_stays(spark):
    prose = "The river ran slowly past the old mill, and nobody in the village knew why. " + " ".join(f"Word{chr(97 + i % 26)}{chr(97 + i // 26)} here" for i in range(40))
    bad = {
        "short_or_long_words": " ".join("a" * 1 for _ in range(3)) + " " + " ".join(chr(97 + i % 26) for i in range(60)),
        "symbols": " ".join(f"word{chr(97 + i % 26)}{i} |" for i in range(60)),
        "repeated_lines": "\n".join([f"this line comes {chr(97 + i)}gain" for i in range(8)] + ["one more line stays"] * 5),
        "few_letters": " ".join(f"({i})-[{i + 7}],.{i}" for i in range(60)),
        "digits": " ".join(f"abc{i:05d}" for i in range(60)),
        "capitals": " ".join(f"WORD{chr(65 + i % 26)}{chr(65 + i // 26)}" for i in range(60)),
        "bullets": "\n".join(f"- item number {chr(97 + i)}" for i in range(20)),
        "cut_lines": "\n".join(f"this is the start of {chr(97 + i)}..." for i in range(20)),
        "addresses": " ".join(f"see https://site.example/{chr(97 + i % 26)}page" for i in range(30)),
        "broken_characters": prose.replace("e", "�"),
        "code": " ".join(f"x{chr(97 + i % 26)}={{y;}};" for i in range(40)),
        "endless_word": prose + " " + "q" * 1200,
    }
    of = quality.rules(F.col("_text"))
    assert {r.name for r in of} == set(bad)
    rows = quality.measured(table(spark, [prose, *bad.values()])).select("doc_id", *(r.rejects.alias(r.name) for r in of)).orderBy("doc_id").collect()
    assert not any(tuple(rows[0])[1:])
    for row, name in zip(rows[1:], bad):
        assert row[name], name
    assert not any(v is None for r in rows for v in r)


def test_quality_order_changes_no_verdict(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    names = [r.name for r in quality.rules(F.col("_text"))]
    runs = [sorted(map(tuple, quality.judge(docs, order).collect())) for order in (names, names[::-1], None)]
    assert runs[0] == runs[1] == runs[2] and any(r[-1] for r in runs[0]) and not all(r[-1] for r in runs[0])
    with pytest.raises(ValueError):
        quality.judge(docs, names[1:])


def test_quality_cascade_goes_by_rejections_for_cost():
    cost = lambda name, c: quality.Estimate(name, c, 0.0)
    # b rejects most for its cost; of what it leaves, c rejects nothing, so a comes before it.
    verdicts = {(True, False, False): 10, (False, True, True): 30, (False, False, False): 60}
    assert quality.ordered([cost("a", 10.0), cost("b", 10.0), cost("c", 11.0)], verdicts) == ["b", "a", "c"]
    assert quality.ordered([cost("a", 10.0), cost("b", 300.0), cost("c", 31.0)], verdicts) == ["a", "c", "b"]
    assert quality.ordered([cost("b", 2.0), cost("a", 2.0), cost("c", 1.0)], {}) == ["c", "a", "b"]


def test_quality_estimates_cover_the_sample(spark):
    of = quality.rules(F.col("_text"))
    rows = quality.measured(table(spark, [t for t in quality_texts() if t]))
    estimates, verdicts = quality.estimate(rows, of)
    assert sum(verdicts.values()) == rows.count() and all(e.cost >= 1 and 0 <= e.rejected <= 1 for e in estimates)


def test_quality_empty_table_and_plan(spark):
    empty = quality.judge(table(spark, ["x"]).limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    plan = quality.judge(table(spark, ODD), [r.name for r in quality.rules(F.col("_text"))])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# ---------------------------------------------------------------------- 12


def plain_collocations(rows, longest, fewest, inside, top):
    f = collections.Counter()
    n = collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i : i + m])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= fewest}
    dropped = set()
    for (lang, words), b in candidates.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                part = (lang, words[i : i + m])
                if 100 * b >= inside * f[part]:
                    dropped.add(part)
    out = collections.defaultdict(list)
    for (lang, words), a in candidates.items():
        if (lang, words) not in dropped:
            cuts = [(1000000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out[lang].append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, le, r, n[lang], -s) for lang, found in out.items() for i, (s, a, p, le, r) in enumerate(sorted(found)[:top]))


def phrases():
    rng = random.Random(5)
    words = ["the", "The", "of", "new", "york", "city", "é", "É", "日本", "x#", "a b", "\U0001f600"]
    texts = list(ODD)
    for _ in range(150):
        k = rng.randrange(1, len(words))
        texts.append("".join(rng.choice(words[:k]) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(rng.randrange(80))))
    return texts + ["new york city"] * 30 + ["NEW YORK"] * 5


@pytest.mark.parametrize("longest,fewest", [(3, 10), (2, 3), (4, 5)])
def test_collocations(spark, longest, fewest):
    texts = phrases()
    langs = ["en", "fr", None, "und"]
    docs = table(spark, texts, lambda i: langs[i % 4]).repartition(3)
    got = sorted(map(tuple, collocations.collocations(docs, longest, fewest).collect()))
    assert got == plain_collocations([(langs[i % 4], t) for i, t in enumerate(texts)], longest, fewest, 50, 2000)


def test_collocations_small_shards_and_steps(spark, monkeypatch):
    texts = phrases()
    for shard, step in ((1, 3), (200, 1), (5000, 7)):
        found = collections.Counter()
        monkeypatch.setattr(collocations, "STEP", step)
        held, size = [], 0
        for t in [*texts, None]:
            if t is None or size >= shard:
                s = collocations.Shard([pa.array(held)])
                for batch in collocations.counted(s, "en", 1, 3, None):
                    for r in batch.to_pylist():
                        found[r["words"], r["phrase"]] += r["f"]
                held, size = [], 0
            held.append(t or "")
            size += len(t or "")
        plain = plain_counts(texts)
        assert found == plain


def plain_counts(texts):
    out = collections.Counter()
    for text in texts:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            if words:
                out[0, ""] += len(words)
            for m in range(1, 4):
                for i in range(len(words) - m + 1):
                    out[m, " ".join(words[i : i + m])] += 1
    return out


def test_collocations_filter_loses_no_frequent_phrase(spark):
    texts = phrases()
    plain = plain_counts(texts)
    docs = table(spark, texts).select(F.lit("en").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    pairs = [("en", p) for (m, p), f in plain.items() if m == 2 and f >= 10]
    often = spark.sparkContext.broadcast(collocations.bit_filter(spark.createDataFrame(pairs, "lang string, phrase string")))
    got = {r.phrase: r.f for r in collocations.summed(collocations.counts(docs, 3, 3, often)).collect()}
    wanted = {p: f for (m, p), f in plain.items() if m == 3 and all(("en", q) in set(pairs) for q in (p.rsplit(" ", 1)[0], p.split(" ", 1)[1]))}
    assert got == wanted and {p for (m, p), f in plain.items() if m == 3 and f >= 10} <= set(got)


def test_collocations_large_counts_are_exact(spark):
    f = spark.createDataFrame([("x", 1, "p", 10**12), ("x", 1, "q", 10**12 + 1), ("x", 2, "p q", 10**12 - 1)], "lang string, words int, phrase string, f long")
    row = collocations.scored(f.where("words = 2").withColumnRenamed("f", "a"), f, 3).collect()[0]
    assert (row.l, row.r, row.score) == (10**12, 10**12 + 1, 1000000 * (10**12 - 1) ** 2 // (10**12 * (10**12 + 1)))


def test_collocations_empty(spark):
    for docs in (table(spark, ["x"]).limit(0), table(spark, [None, "", " ", "a b"])):
        assert collocations.collocations(docs).count() == 0


# ---------------------------------------------------------------------- 13


def plain_clusters(rows, k, rounds, size, seed=2):
    kept = [(i, [math.floor(256 * x) if abs(x) < 1e15 else int(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    order = sorted(kept, key=lambda r: (r[0] is None, digest(r[0]), r[1]))
    centres = [list(v) for _, v in order[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        for j in range(len(centres)):
            own = [v for (_, v), a in zip(kept, at) if a == j]
            if own:
                centres[j] = [sum(x) // len(own) for x in zip(*own)]
    last = [(i, *near(v)) for i, v in kept]
    inertia = collections.Counter()
    for _, d, j in last:
        inertia[j] += d
    cut = lambda x: min(x, 2**63 - 1)
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i is None, i or 0), j, cut(d), cut(inertia[j]), cut(sum(inertia.values())), sha[j]) for i, d, j in last)


def vector_rows(kind):
    rng = np.random.default_rng(7)
    if kind == "groups":
        middle = rng.normal(size=(30, 6)) * 3
        return [(i, [float(x) for x in middle[i % 30] + rng.normal(size=6) * 0.2]) for i in range(900)]
    if kind == "ties":  # few values, many equal distances and equal vectors
        return [(i % 150, [float(x) / 256 for x in rng.integers(-2, 3, 6)]) for i in range(400)]
    if kind == "huge":
        return [(i, [float(x) for x in rng.normal(size=6) * 10.0 ** rng.integers(0, 12)]) for i in range(300)]
    nan = float("nan")
    odd = [(1, None), (2, []), (3, [1.0] * 5), (4, [1.0] * 7), (5, [1.0] * 5 + [None]), (6, [1.0] * 5 + [nan]), (7, [1.0] * 5 + [float("inf")]), (None, [0.5] * 6), (None, [0.25] * 6), (8, [-0.001] * 6), (8, [-0.001] * 6)]
    return odd + [(20 + i, [float(x) for x in rng.normal(size=6)]) for i in range(50)]


def shown(frame):
    return sorted(((r.vec_id is None, r.vec_id or 0), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in frame.collect())


@pytest.mark.parametrize("kind,k", [("groups", 30), ("ties", 25), ("huge", 12), ("odd", 20), ("odd", 100)])
def test_centroids(spark, kind, k):
    rows = vector_rows(kind)
    docs = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, id int, cluster int").repartition(3)
    assert shown(centroids.clustered(docs, k=k, size=6)) == plain_clusters(rows, k, 5, 6)


def test_centroids_empty(spark):
    docs = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<double>")
    for d in (docs, docs.limit(0)):
        got = centroids.clustered(d)
        assert got.count() == 0 and got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_bounds_exclude_and_never_wrongly():
    rng = np.random.default_rng(2)
    middle = rng.integers(-4000, 4000, (40, 16))
    v = (middle[rng.integers(0, 40, 4000)] + rng.integers(-200, 200, (4000, 16))).astype(float)
    now = centroids.Round(v[:40].astype(np.int64), centroids.grouped(v[:40].astype(np.int64)), None)
    state, scanned = (None, None, None), []
    for _ in range(6):
        *state, done = now.assign(v, *state)
        cluster = state[0]
        assert (cluster == centroids.squares(v, now.centroids).argmin(axis=1)).all()
        scanned.append(done)
        new = now.centroids.copy()
        for c in np.unique(cluster):
            new[c] = np.floor(v[cluster == c].mean(axis=0) + 1e-9).astype(np.int64)
        moved = centroids.above(centroids.roots(((new - now.centroids) ** 2).sum(axis=1)))
        now = centroids.Round(new, now.groups, moved)
    assert scanned[0] == v.shape[0] * 40 and sum(scanned[1:]) < 5 * scanned[0] / 3


# ----------------------------------------------------------------------- 4


def test_top_k_of_many_equal_rows(spark):
    rows = [(1, [1.0, 0.0])] * 400 + [(2, [1.0, 0.0])] * 3 + [(3, [0.5, 0.5]), (None, [1.0, 1.0])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(docs, F.col("vec_id") == 3, k=5, scale=4, shards=3).collect())
    assert got == [(3, i + 1, 1, 8) for i in range(5)]
    got = sorted((r.rank, r.vec_id) for r in topk.top_k(docs, F.col("vec_id") == 1, k=5, scale=4, shards=3).collect())
    assert got == [(1, 2), (2, 2), (3, 2), (4, 3)]
