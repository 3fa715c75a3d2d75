"""The operators of the llm subpackage against brute force, round trips and held-out data."""

import collections
import json
import re
import zlib
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foliomend.llm import chat_format, exact_dedup, lang_id, license_scan, near_dedup, packing, sentencepiece_codec, token_counts, topk, toxicity
from foliomend.llm.common import mix, sampled, word_hashes, written
from foliomend.llm.queries import ORACLES, QUERIES, TOXIC_FROM, tokenizer_path, toxicity_model
from foliomend.llm.unigram import vocabulary

TABLES = "/root/testdata/sf0.001"
WORDS = tokenizer_path("word_bpe_49k.json")
PIECES = tokenizer_path("piece_bpe_32k.model")
ODD = ["", None, " \t\n", "a", "Été ÇA va", "ΣΑΣ İi", "x" * 70000, "a b " * 9000, "<|endoftext|> <|ENDOFTEXT|>", "one two three", "日本語 テキスト 12", "it's can't, (yes)!", "é café", "\U0001f600 ▁x"]


def table(spark, texts, **more):
    rows = [(i, t, "x", "en") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, lang string")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{TABLES}/documents.parquet")


@pytest.fixture(scope="module")
def frame(documents):
    return documents.toPandas()


# ---------------------------------------------------------------------- 1


def check_packing(result, ids, window):
    seen = collections.Counter()
    for r in result.itertuples():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        seen[r.doc_id] += r.length
    assert seen == {k: len(v) for k, v in ids.items() if len(v)}
    for _, g in result.sort_values("offset").groupby("sequence_id"):
        assert (g.offset == g.length.cumsum() - g.length).all() and g.length.sum() <= window


def test_packing(spark, frame, documents):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORDS)
    one = lambda s: np.array(t.encode(s or "", add_special_tokens=False).ids + [1], "<u4")
    got = QUERIES["op1_pack_sequences"](spark, TABLES).toPandas()
    check_packing(got, {k: one(s) for k, s in zip(frame.doc_id, frame.text)}, 2048)
    used = got.groupby("sequence_id").length.sum()
    assert 1 - used.sum() / (2048 * len(used)) < 0.03
    odd = packing.pack(table(spark, ODD), WORDS, window=64, units=16).toPandas()
    check_packing(odd, {i: one(s) for i, s in enumerate(ODD)}, 64)
    assert packing.pack(table(spark, []), WORDS).count() == 0
    assert packing.pack(table(spark, [None]), WORDS, end_id=None).count() == 0


def test_other_tokenizers(tmp_path):
    """A file that normalises or splits in another way is used as it is, not word by word."""
    from tokenizers import Tokenizer

    assert packing.by_words(WORDS)
    found = json.loads(Path(WORDS).read_text())
    found["normalizer"] = {"type": "NFC"}
    (tmp_path / "t.json").write_text(json.dumps(found))
    other = Tokenizer.from_file(str(tmp_path / "t.json"))
    ids, own = packing.WordIds(str(tmp_path / "t.json")), packing.WordIds(WORDS)
    assert not ids.by_words and own.by_words
    text = "Upper Case  words\n and <|endoftext|> more"
    assert ids.of(text) == np.array(other.encode(text, add_special_tokens=False).ids, "<u4").tobytes() != own.of(text)


def test_packing_of_repeated_rows(spark):
    docs = table(spark, ["one two"]).union(table(spark, ["one two"])).union(table(spark, ["one two"]))
    got = packing.pack(docs, WORDS, window=8, units=8).collect()
    assert len(got) == 3 and len({(r.sequence_id, r.offset) for r in got}) == 3


def test_packing_plan():
    rng = np.random.default_rng(0)
    a, b = rng.random((12, 30)), rng.random(12)
    x = packing.nnls(a, b)
    g = a.T @ (b - a @ x)
    assert (x >= 0).all() and g.max() < 1e-7 and np.abs(g[x > 0]).max() < 1e-7
    for histogram in ({}, {8: 3}, {1: 1000}, {5: 7, 3: 900}, {int(n): int(c) for n, c in zip(range(1, 33), rng.integers(0, 500, 32))}):
        chosen, held = packing.plan(histogram, 32), collections.Counter()
        for parts, times in chosen:
            assert sum(parts) <= 32 and times > 0
            for n in parts:
                held[n] += times
        assert held == {n: c for n, c in histogram.items() if c}


# ---------------------------------------------------------------------- 2


def brute_components(texts, words, percent):
    sets = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        k = min(words, len(w))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return [(len(s), r) for s, r in zip(sets, root)]


def edited(rng, words, n):
    words = list(words)
    for i in rng.choice(len(words), n, replace=False):
        words[i] = f"new{rng.integers(10**9)}"
    return " ".join(words)


def test_near_duplicates(spark):
    rng = np.random.default_rng(5)
    base = [f"w{rng.integers(400)}" for _ in range(120)]
    texts = [" ".join(base), " ".join(base).upper(), None, "", " \n", "a", "A", "a b", "a b c d e f g h i j", "a b c d e f g h i j k"]
    texts += [edited(rng, base, n) for n in rng.integers(0, 14, 150)]  # a group with links and near misses
    texts += ["shared words here " + edited(rng, base[:40], 20) for _ in range(20)]
    got = near_dedup.near_duplicates(table(spark, texts), words=2).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id) for r in got] == brute_components(texts, 2, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert near_dedup.near_duplicates(table(spark, [])).count() == 0
    twice = table(spark, ["a b c", "a b c"]).union(table(spark, ["a b c", "other words here now"]))
    assert sorted((r.doc_id, r.component_id) for r in near_dedup.near_duplicates(twice, words=2).collect()) == [(0, 0), (0, 0), (1, 0), (1, 1)]


def test_near_duplicates_of_documents(spark, frame):
    got = QUERIES["op2_near_dedup"](spark, TABLES).orderBy("doc_id").collect()
    f = frame.sort_values("doc_id")
    want = brute_components(list(f.text), 2, 80)
    ids = list(f.doc_id)
    assert [(r.n_shingles, r.component_id) for r in got] == [(n, ids[r]) for n, r in want]


def test_index_guarantee(spark):
    """Signatures within DISTANCE share a key; pairs are planted at every distance, also the most even ones."""
    rng = np.random.default_rng(1)
    n, w = near_dedup.CHUNKS, near_dedup.WIDTH
    base = rng.integers(0, 1 << near_dedup.BITS, (1, near_dedup.SYMBOLS)).astype(np.uint16)
    keys = set(near_dedup.keys_of(base)[0].tolist())
    others, far = [], []
    for d in range(near_dedup.DISTANCE + 2):
        for even in (False, True):
            wrong = np.concatenate([rng.permutation(n) * w + rng.integers(0, w // 2), rng.permutation(n) * w + w - 1])[:d] if even else rng.choice(near_dedup.SYMBOLS, d, replace=False)
            other = base.copy()
            other[0, wrong] ^= rng.integers(1, 1 << near_dedup.BITS, len(wrong)).astype(np.uint16)
            shared = keys & set(near_dedup.keys_of(other)[0].tolist())
            assert shared or d > near_dedup.DISTANCE
            far.append(bool(shared) or d <= near_dedup.DISTANCE)
            others.append((d, near_dedup.packed(base)[0].tolist(), near_dedup.packed(other)[0].tolist()))
    assert not far[-1]  # two errors in every chunk: the bound is tight
    rows = spark.createDataFrame(others, "d long, a array<long>, b array<long>")
    assert all(r.d == r.got for r in rows.select("d", near_dedup.distance(F.col("a"), F.col("b")).alias("got")).collect())


def test_signatures_hold_the_index(spark):
    """What signed() gives are the keys of the packed symbols, and nothing finer."""
    for r in near_dedup.signed(table(spark, ["a b c d", "some other words", "x"]), 2, "doc_id", "text").collect():
        symbols = np.array(r.sig, np.int64).view(np.uint16)[None, : near_dedup.SYMBOLS]
        assert near_dedup.keys_of(symbols)[0].view(np.int64).tolist() == list(r["keys"])


def test_recall_near_the_threshold(spark):
    """All pairs with similarities of 0.80 to 0.85, one pair a vocabulary, so that no path goes round a lost link."""
    rng = np.random.default_rng(8)
    texts, linked = [], 0
    for pair in range(300):
        base = [f"p{pair}w{i}" for i in range(100)]
        # k words changed one by one, apart from each other: 2 k of 99 shingles differ on each side
        k = int(rng.integers(3, 7))
        other = list(base)
        for i in range(k):
            other[5 + 12 * i] += "x"
        linked += 100 * (99 - 2 * k) >= 80 * (99 + 2 * k)
        texts += [" ".join(base), " ".join(other)]
    got = near_dedup.near_duplicates(table(spark, texts), words=2).collect()
    assert sum(r.component_id != r.doc_id for r in got) == linked > 100


def test_one_row_stays(spark):
    text = " ".join(f"w{i}" for i in range(60))
    long = " ".join(f"l{i}" for i in range(150000))
    rows = [(None, text), (None, text + " x"), (5, text + " y"), (5, text + " z"), (5, text), (7, ""), (None, None), (8, "alone here"), (11, long), (10, long + " x")]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
    assert sorted(r.doc_id or 0 for r in got if r.stays) == [0, 5, 7, 8, 10]


def test_block_links():
    sets = [np.arange(0, 10, dtype=np.uint64), np.arange(1, 11, dtype=np.uint64), np.arange(100, 110, dtype=np.uint64)]
    ids = np.arange(3)
    assert near_dedup.block_links(ids, ids, sets, ids, ids, sets, 80) == [(0, 1), (1, 0)]


def test_word_hashes():
    texts = ["A b", None, "", "b  a\nB", "x" * 600000 + " b"]
    words = []
    for _, h, n in word_hashes(pa.array(texts)):
        words += np.split(h, np.cumsum(n)[:-1])
    assert [len(w) for w in words] == [2, 0, 0, 3, 2]
    assert words[0][0] == words[3][1] and words[0][1] == words[3][0] == words[3][2] == words[4][1]


# ---------------------------------------------------------------------- 3


def test_toxicity(spark, documents):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    grade = F.when(F.col("toxic") == 1, 2 - F.col("quality")).otherwise(0)
    known = labels.where("doc_id % 3 <> 0").select("doc_id", grade.alias("grade"))
    model = toxicity.train(known, docs, 3)
    assert (np.diff(model.thresholds) >= 0).all()
    seen = toxicity.score(docs, model).join(labels.where("doc_id % 3 = 0"), "doc_id").toPandas()
    flagged = seen.toxic_probability >= TOXIC_FROM
    assert flagged[seen.toxic == 1].mean() > 0.9 and flagged[seen.toxic == 0].mean() < 0.01
    assert seen.severity[seen.toxic == 1].mean() > seen.severity[seen.toxic == 0].mean() + 0.5
    odd = toxicity.score(table(spark, ODD), model).toPandas()
    assert len(odd) == len(ODD) and odd.severity[:3].sum() == 0 and odd.notna().all().all()
    none = toxicity.train(known.where("false"), docs, 3)
    assert toxicity.score(table(spark, ["x", None]), none).count() == 2
    assert toxicity.score(table(spark, []), model).count() == 0


def test_ordinal_gradient():
    """The gradient by finite differences; the fit by a second method, plain ascent from another start."""
    rng = np.random.default_rng(2)
    grade = rng.integers(0, 3, 300)
    index = [np.unique([int(g) if rng.random() < 0.8 else 9, 3 + int(rng.integers(5))]) for g in grade]
    ones = [np.ones(len(i)) for i in index]
    model = toxicity.fit(index, ones, grade, 3, dimensions=16, most=16, ridge=0.01, rounds=3000)
    score = np.array([model.table(16)[i].sum() for i in index])
    p = model.at_least(score)
    each = np.column_stack([np.ones(300), p]) - np.column_stack([p, np.zeros(300)])
    assert (each.argmax(axis=1) == grade).mean() > 0.7 and (np.diff(model.thresholds) >= 0).all()
    # The same objective, over the features that the fit has chosen.
    column = [np.searchsorted(model.slots, i[np.isin(i, model.slots)]) for i in index]
    low = grade == 0
    weight = np.where(low, 0.5 / low.sum(), 0.5 / (~low).sum())
    flat = np.concatenate(column)
    of = toxicity.Likelihood(np.repeat(np.arange(300), [len(c) for c in column]), flat, np.ones(len(flat)), grade, weight, 3, len(model.slots), 0.01)
    at = rng.normal(size=len(model.slots) + 2)
    numeric = [(of(at + e)[0] - of(at - e)[0]) / 2e-6 for e in 1e-6 * np.eye(len(at))]
    assert np.allclose(of(at)[1], numeric, atol=1e-6)
    for _ in range(20000):
        at = at + of(at)[1]
    assert np.allclose(at[: len(model.slots)], model.weights, atol=0.02) and np.allclose(of.thresholds(at), model.thresholds, atol=0.02)


def test_toxicity_by_hand(spark):
    """The query's scores recomputed from the model, text by text, without the operator's code."""
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    model = toxicity_model(spark, docs, TABLES)
    weights = dict(zip(model.slots.tolist(), model.weights.tolist()))
    got = QUERIES["op3_toxicity"](spark, TABLES).toPandas().set_index("doc_id")
    for doc, text in docs.where("doc_id % 5 = 0").select("doc_id", "text").collect():
        data = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in f" {text or ''} ".encode().lower())
        seen = [data[i : i + 5] for i in range(len(data) - 4) if 32 not in data[i + 1 : i + 4]]
        total = sum(weights.get(int(mix(np.array([int.from_bytes(w, "big")], np.uint64))[0]) % toxicity.DIMENSIONS, 0.0) for w in seen)
        p = [1 / (1 + np.exp(t - total / max(1, len(seen)) ** 0.5)) if seen else 0.0 for t in model.thresholds]
        assert abs(got.severity[doc] - sum(p)) < 1e-3 and got.toxic[doc] == (p[0] >= TOXIC_FROM)


@pytest.mark.parametrize("copies", [300, 3000])
def test_samples_are_bounded(spark, copies):
    """Copies of a row, of its label or both train as one row."""
    one = spark.range(copies).select(F.lit(7).cast("long").alias("doc_id"), F.lit("some words here").alias("text"), F.lit("en").alias("lang"))
    other = spark.range(100, 140).select(F.col("id").alias("doc_id"), F.concat(F.lit("andere Worte "), F.col("id").cast("string")).alias("text"), F.lit("de").alias("lang"))
    docs = one.unionByName(other)
    seen = {}

    def spy(name):
        def fit(rows, *more, **named):
            seen[name] = len(rows)
        return fit

    with pytest.MonkeyPatch.context() as m:
        m.setattr(toxicity, "fit", spy("toxicity"))
        toxicity.train(docs.select("doc_id", F.lit(1).alias("grade")), docs, 2, per_grade=30)
        m.setattr(lang_id, "fit", spy("language"))
        lang_id.train(docs, sample=20)
    assert seen == {"toxicity": 30, "language": 20}
    assert sampled(one.select(F.col("doc_id").alias("id"), "lang"), "lang", 5).count() == 1


# ---------------------------------------------------------------------- 4


def test_top_k(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(700)]
    rows += [(700, None), (701, [float("nan")] + [0.0] * 7), (702, [None] * 8), (703, [float("inf")] * 8), (704, [1.0, 2.0]), (705, []), (None, [1.0] * 8)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = collections.defaultdict(list)
    for r in topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5, shards=3).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    ints = {i: np.floor(256 * np.array((v or []) + [0.0] * (8 - len(v or [])))).astype(int) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    for q in (i for i in ints if i % 50 == 0):
        best = sorted(((-int(ints[q] @ ints[i]), i) for i in ints if i != q))[:5]
        assert got[q] == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert len(got) == 14
    assert topk.top_k(vectors.where("vec_id < 3"), F.col("vec_id") == 0).count() == 2
    assert topk.top_k(vectors.where("false"), F.col("vec_id") == 0).count() == 0


def test_repeated_and_huge_vectors(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 1.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (1, [0.0, 3.0]), (-1, [5.0, 5.0]), (2, [1e30, 1.0]), (3, [-1e308, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = [(r.rank, r.vec_id, r.score) for r in topk.top_k(vectors, F.col("vec_id") == 0, k=7, scale=1).orderBy("rank").collect()]
    assert got == [(1, 2, 2**63 - 1), (2, -1, 10), (3, 1, 3), (4, 1, 2), (5, 1, 2), (6, 3, -(2**63) + 1)]


def test_blocks_are_pruned():
    """Vectors that lie in groups, mixed in any order: exact results from a part of the blocks."""
    rng = np.random.default_rng(6)
    centres = rng.integers(-200, 200, (40, 16))
    vectors = (centres[rng.integers(0, 40, 2000)] + rng.integers(-3, 4, (2000, 16))).astype(float)
    shard, queries = topk.Shard(np.arange(2000), vectors), vectors[:50]
    want = [sorted(range(2000), key=lambda i: (-int(q @ vectors[i]), i))[:5] for q in queries]
    for floors in (np.full(50, -topk.LONG), np.array([int(np.sort(vectors @ q)[-5]) for q in queries])):
        shard.scored = 0
        ids, scores, real = shard.search(np.full(50, -5), queries, floors, 5)
        assert real.all() and ids.tolist() == want
        assert shard.scored < 0.3 * 50 * 2000


# ----------------------------------------------------------------- 5 and 10


@pytest.fixture(scope="module")
def unigram():
    import sentencepiece
    from tokenizers import Tokenizer, models

    m = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    t = Tokenizer(models.Unigram([(m.id_to_piece(i), m.get_score(i)) for i in range(m.get_piece_size())], 0, True))
    return lambda s: t.encode("▁" + s.replace(" ", "▁"), add_special_tokens=False).ids if s else []


def test_token_counts(spark, frame, unigram):
    got = {r.doc_id: r.n_tokens for r in QUERIES["op5_token_counts"](spark, TABLES).collect()}
    assert got == {i: len(unigram(t or "")) for i, t in zip(frame.doc_id, frame.text)}
    odd = [r.n_tokens for r in token_counts.token_counts(table(spark, ODD), PIECES).orderBy("doc_id").collect()]
    assert odd == [len(unigram(t or "")) for t in ODD]
    assert token_counts.token_counts(table(spark, []), PIECES).count() == 0


def test_sentencepiece(spark, frame, unigram):
    rows = sentencepiece_codec.encode(table(spark, [*ODD, *frame.text]), PIECES).orderBy("doc_id").collect()
    assert [list(r.ids) for r in rows] == [unigram(t or "") for t in [*ODD, *frame.text]]
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(table(spark, ODD), PIECES), PIECES).orderBy("doc_id").collect()
    assert [r.decoded for r in back] == [(t or "").replace("▁", " ") for t in ODD]
    got = QUERIES["op10_sentencepiece"](spark, TABLES).toPandas().set_index("doc_id")
    assert got.round_trip.all()
    for i, t in list(zip(frame.doc_id, frame.text))[:20]:
        ids = np.array(unigram(t or ""), "<u4")
        assert got.n_pieces[i] == len(ids) and got.ids_crc32[i] == zlib.crc32(ids.tobytes())
    ids = spark.createDataFrame([(0, None), (1, []), (2, [99999, 1, 300])], "doc_id long, ids array<int>")
    shown = [r.decoded for r in sentencepiece_codec.decode(ids, PIECES).orderBy("doc_id").collect()]
    assert shown[:2] == [None, ""] and shown[2] == vocabulary(PIECES).shown[300].decode().removeprefix(" ")


def test_false_hits_of_hashes(monkeypatch):
    """With a hash that anagrams share, results are those of compared characters."""
    true = sentencepiece_codec.Encoder(PIECES)
    weak = sentencepiece_codec.Encoder.__new__(sentencepiece_codec.Encoder)
    weak.__dict__.update(true.__dict__, kept={})
    few = [i for i in range(len(true.ids)) if true.lengths[i] <= 3]
    sums = np.array([int(true.codes[true.at[i] : true.at[i + 1]].sum() + true.lengths[i]) for i in few], np.uint64)
    _, first = np.unique(sums, return_index=True)  # one piece for each hash
    keep = np.array(few)[first]
    order = np.argsort(sums[first], kind="stable")
    weak.keys, weak.lengths, weak.ids, weak.scores, weak.at = sums[first][order], true.lengths[keep][order], true.ids[keep][order], true.scores[keep][order], None
    chars = [true.codes[true.at[i] : true.at[i + 1]] for i in keep[order]]
    weak.codes, weak.at = np.concatenate(chars), np.concatenate([[0], np.cumsum([len(c) for c in chars])])
    weak.power = np.ones_like(true.power)
    monkeypatch.setattr(sentencepiece_codec, "_BASE", np.uint64(1))
    weak.maybe = np.ones_like(true.maybe)
    careful = []
    whole = weak.viterbi
    weak.viterbi = lambda parts, careful_=False, **more: (careful.append(bool(more)), whole(parts, **more))[1]
    words = ["▁the", "▁eht", "▁nets", "▁sent", "▁tens"]
    got = [weak.viterbi([w])[0] for w in words]
    assert got == [whole([w], careful=True)[0] for w in words] and any(careful)
    pieces = {int(i): "".join(map(chr, c)) for i, c in zip(weak.ids, chars)}
    assert ["".join(pieces.get(int(i), "") for i in np.frombuffer(g, np.uint32)) for g in got] == words


# ---------------------------------------------------------------------- 6


def test_chat(spark):
    rows = [(1, 2, "user", "b"), (1, 1, "user", "a<|im_end|>\\<|"), (1, 3, "assistant", "\\\\n<\\|x"), (1, 3, "assistant", "again"), (2, None, None, None), (None, 1, "assi<|stant\nx", ""), (3, 1, "assistant", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit("clash"))
    out = chat_format.format_conversations(turns)
    back = {r.conv_id: [tuple(t) for t in r.turns] for r in out.select("conv_id", chat_format.read_back(F.col("formatted")).alias("turns")).collect()}
    assert back == {1: [("user", "a<|im_end|>\\<|"), ("user", "b"), ("assistant", "\\\\n<\\|x"), ("assistant", "again")], 2: [("", "")], None: [("assi<|stant\nx", "")], 3: [("assistant", "")]}
    row = chat_format.digests(out).where("conv_id = 1").collect()[0]
    assert row.n_turns == 4 and row.loss_chars == len("\\\\n<\\|xagain")
    formatted = out.where("conv_id = 1").collect()[0].formatted
    assert formatted.count("<|im_start|>") == 2 and formatted.count("<|im_next|>") == 2
    assert chat_format.format_conversations(turns.where("false")).count() == 0


def test_long_chat(spark):
    """Spans of a conversation of many runs of turns, one by one."""
    rows = [(1, i, "assistant" if i % 3 else "user", f"text {i} " * (i % 4)) for i in range(3 * chat_format.RUN + 7)]
    row = chat_format.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()[0]
    assert [row.formatted[s.start : s.start + s.length] for s in row.loss_spans] == [r[3] for r in rows if r[2] == "assistant"]


# ---------------------------------------------------------------------- 7


def test_languages(spark, documents):
    got = QUERIES["op7_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    seen = got.join(docs, "doc_id").where("held_out").toPandas()
    assert (seen.lang_pred == seen.lang).mean() > 0.97 and seen.score.between(0, 1).all()
    assert (seen.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    model = lang_id.train(documents)
    odd = lang_id.identify(table(spark, [*ODD, "12 !?", "∑ ½ €"]), model).orderBy("doc_id").toPandas()
    und = odd.lang_pred == "und"
    assert list(und[[0, 1, 2, len(ODD), len(ODD) + 1]]) == [True] * 5 and not und[3:12].any()
    assert lang_id.identify(table(spark, ["words"]), lang_id.train(documents.where("false"))).collect()[0].lang_pred == "und"
    assert lang_id.identify(table(spark, []), model).count() == 0


def test_kernel_scores():
    """The linear form is the kernel form."""
    rng = np.random.default_rng(3)
    rows = rng.random((40, lang_id.SLOTS)) < 0.01
    model = lang_id.fit(rows, ["a", "b"] * 20, landmarks=10)
    k = rows.astype(float) @ rows[:10].T / np.sqrt(rows.sum(1)[:, None] * rows[:10].sum(1)[None, :])
    assert np.allclose(model.scores(rows), k @ model.coefficients + model.bias, atol=1e-3)


def test_languages_by_hand(spark):
    """A small fit by a second method, least squares on the kernel's map, and the query's rows from it."""
    rng = np.random.default_rng(9)
    rows = rng.random((60, lang_id.SLOTS)) < 0.004
    names = [("a", "b", "c")[i % 3] for i in range(60)]
    for i, n in enumerate(names):
        rows[i, 10 * "abc".index(n) : 10 * "abc".index(n) + 10] = True
    model = lang_id.fit(rows, names, landmarks=30, ridge=1e-3)
    unit = rows / np.sqrt(rows.sum(axis=1, keepdims=True))
    value, vector = np.linalg.eigh(unit[:30] @ unit[:30].T)
    phi = np.column_stack([unit @ unit[:30].T @ vector / np.sqrt(value), np.ones(60)])
    y = np.where(np.array(names)[:, None] == np.array(["a", "b", "c"]), 1.0, -1.0)
    penalty = np.sqrt(1e-3) * np.eye(31)[:30]  # rows weigh 1/60 each, the constant is free
    want = phi @ np.linalg.lstsq(np.vstack([phi, penalty]), np.vstack([y, np.zeros((30, 3))]), rcond=None)[0]
    assert np.allclose(model.scores(rows), want, atol=2e-3) and (want.argmax(axis=1) == y.argmax(axis=1)).all()
    # The query: presence of n-grams by sets, and the kernel with each landmark one by one.
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    model = lang_id.train(docs)
    got = QUERIES["op7_language_id"](spark, TABLES).toPandas().set_index("doc_id")
    for doc, text in docs.where("doc_id % 7 = 0").select("doc_id", "text").collect():
        row = np.zeros(lang_id.SLOTS, bool)
        lang_id.presence((text or "").encode(), row)
        if not any(map(str.isalpha, text or "")):
            assert got.lang_pred[doc] == "und"
            continue
        kernel = [model.landmarks[row, k].sum(dtype=float) / row.sum() ** 0.5 for k in range(model.landmarks.shape[1])]
        values = [sum(k * c for k, c in zip(kernel, model.coefficients[:, j])) + model.bias[j] for j in range(len(model.languages))]
        assert got.lang_pred[doc] == model.languages[int(np.argmax(values))] and abs(got.score[doc] - min(1, max(0, (max(values) + 1) / 2))) < 1e-3


# ------------------------------------------------------------------ 8 and 9


def brute_licence(text):
    best, units = None, set()
    for line, unit in enumerate([(text or ""), *(text or "").split("\n")]) if text is not None else []:
        own = set(license_scan.bigrams(unit))
        for name, template in license_scan.TEMPLATES:
            other = set(license_scan.bigrams(template))
            dice = 2 * len(own & other) / (len(own) + len(other))
            if dice >= 0.8:
                units.add(line)
                best = min(best or (0, "", 0), (-dice, name, line))
    return (best[1], -best[0], best[2], len(units)) if best else (None, None, None, 0)


def test_licences(spark):
    texts = [*ODD, "intro\nLicensed under CC BY-NC 4.0.\nmore", "  RELEASED under the mit license", license_scan.TEMPLATES[3][1], "All rights reserved.\nAll rights reserved.", "all rights were reserved"]
    texts += [license_scan.TEMPLATES[14][1].replace("free of charge", "for nothing")]
    got = [(r.license, r.dice, r.line_no, r.n_units) for r in license_scan.scan(table(spark, texts)).orderBy("doc_id").collect()]
    assert got == [brute_licence(t) for t in texts]
    assert license_scan.scan(table(spark, [])).count() == 0
    assert license_scan.scan(table(spark, ["All rights reserved."]), [("one", "word")]).collect()[0].license is None


def brute_copies(texts):
    plain = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in texts]
    size = collections.Counter(plain)
    return [(plain.index(p), size[p], plain.index(p) == i) for i, p in enumerate(plain)]


@pytest.mark.parametrize("identify", [exact_dedup.hashed, lambda c: F.length(c)])
def test_copies(spark, identify):
    long = "Word after word. " * 3000
    texts = [*ODD, "a", " a", "\ta", "a \n b", "a b", long, long, long + "x", "x" + long, long.replace(" ", "\n"), "y" * 70000, "x" * 70000]
    got = exact_dedup.exact_duplicates(table(spark, texts), identify=identify).orderBy("doc_id").collect()
    assert [(r.keep_id, r.group_size, r.kept) for r in got] == brute_copies(texts)
    again = exact_dedup.exact_duplicates(table(spark, ["a", "a"]).union(table(spark, ["a"]))).collect()
    assert sorted((r.doc_id, r.keep_id, r.kept) for r in again) == [(0, 0, False), (0, 0, True), (1, 0, False)]
    assert exact_dedup.exact_duplicates(table(spark, [])).count() == 0


def test_chunks_follow_content(spark):
    """One character put in front changes few chunks, whatever the text is made of."""
    rng = np.random.default_rng(11)
    made = {
        "words": " ".join(f"w{i}" for i in rng.integers(0, 10**6, 20000)),
        "code": "".join(f"f{i}(x[{i}]);" for i in rng.integers(0, 10**6, 9000)),
        "japanese": "".join("漢字かな交じり文、"[: int(k)] for k in rng.integers(1, 10, 30000)),
        "base64": "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"), 100000)),
    }
    both = table(spark, [x for t in made.values() for x in (t, "Q" + t)]).select("doc_id", exact_dedup.chunked(F.col("text")).alias("c")).orderBy("doc_id").collect()
    for a, b in zip(both[::2], both[1::2]):
        assert len(a.c) > 15 and len(set(a.c) - set(b.c)) <= 3


def test_chunks_are_the_text(spark):
    texts = ["", "a", "Word after word. " * 3000, "x" * 70000, "日本語。" * 9000, "a|b;" * 9000]
    rows = table(spark, texts).select(F.array_join(exact_dedup.chunked(F.col("text")), "").alias("t")).collect()
    assert [r.t for r in rows] == texts


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    import glob
    import os

    import duckdb

    db = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    want = db.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, TABLES)
    assert sorted(got.columns) == sorted(columns)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr) == sorted(map(tuple, want.fetchall()), key=repr)


def test_repeated_and_long_rows(spark, documents):
    """Repeated rows get equal rows, long texts are whole, columns with clashing names are of no account."""
    long = "some word " * 30000 + "Released under the MIT License."
    once = table(spark, [long, "a b", None, ""]).withColumns({c: F.lit(1) for c in ("ids", "license", "n_tokens", "grade", "verdict", "plain", "row", "severity")})
    ids = lang_id.train(documents.limit(100))
    none = toxicity.OrdinalModel(np.zeros(0, int), np.zeros(0), np.array([0.5]))
    for f in (
        lambda d: license_scan.scan(d),
        lambda d: token_counts.token_counts(d, PIECES),
        lambda d: sentencepiece_codec.digests(sentencepiece_codec.decode(sentencepiece_codec.encode(d, PIECES), PIECES)),
        lambda d: lang_id.identify(d, ids),
        lambda d: toxicity.score(d, none),
    ):
        rows = collections.Counter(f(once.union(once)).collect())
        assert len(rows) == 4 and set(rows.values()) == {2}
    assert license_scan.scan(once).where("doc_id = 0").head().license == "mit"
    assert sentencepiece_codec.digests(sentencepiece_codec.decode(sentencepiece_codec.encode(once, PIECES), PIECES)).where("NOT round_trip").count() == 0


# ---------------------------------------------------------------- pipeline


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    extra = spark.createDataFrame([(10**6, "123 !!", "en", "s", 6), (10**6 + 1, None, None, None, None)], docs.schema)
    docs = docs.union(extra).union(docs.where("doc_id = 3"))
    kept = {}
    for name, stage in p.STAGES:
        after = stage(spark, docs, "/root/testdata/sf0.01")
        kept[name] = after.toPandas()
        if name == "packing":
            break
        assert after.schema == docs.schema
        before, docs = docs.toPandas(), written(after, name)
        left = set(kept[name].doc_id)
        gone = before[~before.doc_id.isin(left)]
        if name == "toxicity":
            labels = pd.read_parquet("/root/testdata/sf0.01/labels.parquet").set_index("doc_id").toxic
            assert labels.reindex(gone.doc_id).dropna().mean() > 0.9
        elif name == "language":
            assert set(gone.doc_id) == {10**6, 10**6 + 1}
        elif name == "exact_dedup":
            plain = before.text.str.replace(r"[\x20\x09-\x0D]+", " ", regex=True)
            assert sorted(kept[name].doc_id) == sorted(before.groupby(plain).doc_id.min())
        else:
            b = before.sort_values("doc_id")
            roots = brute_components(list(b.text), 5, 80)
            ids = list(b.doc_id)
            assert left == {ids[r] for i, (_, r) in enumerate(roots)}
    assert set(kept["packing"].doc_id) == set(kept["near_dedup"].doc_id)
