"""Licence notices inside lines and over several lines."""

import random
import textwrap

from foliomend.llm import license_scan as S


def test_passages(spark):
    named = dict(S.TEMPLATES + S.COMPLETE)
    wrapped = "Some words first.\n\n" + textwrap.fill(named["mit-permission"], 76) + "\n\nAnd other words after it."
    edited = wrapped.replace("without restriction", "with no restriction at all").replace("copies of", "all copies of", 1)
    texts = ["This code was written in 2020. Released under the MIT License.", wrapped, edited, textwrap.fill(named["mit-full"], 60), "x\n" + textwrap.fill(named["bsd-2-clause-full"], 60) + "\nz"]
    texts += ["Released under\nthe MIT\nLicense. More.", "the license of the mit was released under it", "", None, "\n\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [(r.license, r.dice and round(r.dice, 3), r.line_no) for r in S.scan(docs).orderBy("doc_id").collect()]
    assert got[:2] == [("mit", 1.0, 1), ("mit-permission", 1.0, 3)]
    assert got[2][0] == "mit-permission" and 0.9 < got[2][1] < 1 and got[2][2] == 3
    assert got[3] == ("mit-full", 1.0, 0)
    assert got[4][1] == 1.0 and got[4][0].startswith("bsd-2-clause")
    assert got[5] == ("mit", 1.0, 1) and got[6:] == [(None, None, None)] * 4


def best_passage(text, name, least=0.8):
    """The highest coefficient of any run of words."""
    w, t = S.words(text), set(S.bigrams(dict(S.TEMPLATES)[name]))
    runs = (set(zip(w[i:j], w[i + 1 : j])) for i in range(len(w)) for j in range(i + 2, len(w) + 1))
    best = max(2 * len({" ".join(p) for p in r} & t) / (len(r) + len(t)) for r in runs)
    return best if best >= least else None


def test_passages_by_brute_force(spark):
    one = [t for t in S.TEMPLATES if t[0] == "gpl-3.0"]
    texts = ["a b this work is licensed under a GNU General Public License, version 3 or later c d", "This work is licensed\nunder the new GNU General\nPublic License version 3, it is", "license under this work general public"]
    got = [r.dice for r in S.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), one).orderBy("doc_id").collect()]
    want = [best_passage(t, "gpl-3.0") for t in texts]
    assert [g and round(g, 9) for g in got] == [x and round(x, 9) for x in want] and any(want)


def runs_best(text, template, least=0.8):
    """The highest coefficient of any run of words with the template, grown word by word."""
    w, t = S.words(text), set(S.bigrams(template))
    grams = [f"{a} {b}" for a, b in zip(w, w[1:])]
    best = 0.0
    for i in range(len(grams)):
        seen, own = set(), 0
        for g in grams[i:]:
            if g not in seen:
                seen.add(g)
                own += g in t
            best = max(best, 2 * own / (len(seen) + len(t)))
    return best if best >= least - 1e-12 else None


def test_every_template_with_repeated_words(spark):
    rng = random.Random(4)
    for name, template in S.TEMPLATES + S.COMPLETE:
        own, texts = S.words(template), []
        for _ in range(8):
            w = [x for word in own for x in [word] * rng.choice([1, 1, 1, 1, 1, 1, 1, 1, 1, 3])]
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(w) + 1)
                w[at:at] = w[max(0, at - rng.randrange(1, 6)) : at] * rng.randrange(1, 4)
            w = [x if rng.random() > 0.02 else "other" for x in w]
            texts.append(" ".join(["before", "it", *w, "and", "behind"]).replace(" the ", "\nthe ", rng.randrange(3)))
        got = [r.dice for r in S.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), [(name, template)]).orderBy("doc_id").collect()]
        assert [g and round(g, 9) for g in got] == [x and round(x, 9) for x in (runs_best(t, template) for t in texts)], name


def test_long_texts_with_repeated_notices(spark):
    texts = ["Released under under under under under the MIT License.", "Released under the MIT License.\n" * 5000, "word " * 100000 + "released under the mit license " + "word " * 100, "released under the " * 30000]
    texts[0] = "inside " + texts[0] + " other words"
    got = [(r.license, r.dice and round(r.dice, 3), r.n_units) for r in S.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == [("mit", 0.889, 1), ("mit", 1.0, 5001), ("mit", 1.0, 1), (None, None, 0)]
