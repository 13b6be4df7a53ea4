"""Language ID and toxicity: exactness of the parts, held-out accuracy, odd rows."""

import itertools
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tellus.llm import langid, queries, toxicity
from tests.llm.helpers import empty, odd, prose, rows, write

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (2, 0, None), (None, 1, 1), (77, 0, 1), (8, None, 0), (9, 1, 0)],
                                   "doc_id long, quality int, toxic int").withColumn("y", F.lit("x")).withColumn("id", F.lit(3))
    return write(spark, str(tmp_path_factory.mktemp("odd")), documents=odd(spark), labels=labels)


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    return write(spark, str(tmp_path_factory.mktemp("none")), documents=empty(spark), labels=labels)


# ---------------------------------------------------------------- op7

def brute_phrases(sample, text):
    """Greedy cross-parsing by substring search."""
    n = i = 0
    while i < len(text):
        k = 1
        while i + k < len(text) and text[i:i + k + 1] in sample:
            k += 1
        n, i = n + 1, i + k
    return n


def test_automaton_accepts_substrings_only():
    text = "abracadabra banana"
    states = langid.suffix_automaton(text)

    def accepts(s):
        at = 0
        for c in s:
            if c not in states[at]:
                return False
            at = states[at][c]
        return True
    assert all(accepts(text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1))
    assert all(accepts("".join(s)) == ("".join(s) in text) for s in itertools.product("abrcd n", repeat=4))


def test_phrases_against_substring_search():
    r = random.Random(1)
    samples = {"a": prose(1, 60), "b": prose(2, 60).upper(), "c": "xyz " * 9}
    m = langid.Model(samples)
    texts = [prose(i, r.randint(1, 40)) for i in range(20)] + ["x", "Éé", "qqq", "zyx", "a"]
    got = m.phrases([m.encode(t) for t in texts])
    for t, row in zip(texts, got):
        assert row.tolist() == [brute_phrases(langid.normal(samples[k]), langid.normal(t)) for k in m.languages], t


def test_every_character_of_a_large_alphabet_counts():
    """Over 255 characters in the samples, beyond 16 bits too."""
    r = random.Random(2)
    han = [chr(0x4E00 + i) for i in range(900)] + [chr(0x20000 + i) for i in range(40)]
    words = ["".join(r.choices(han, k=r.randint(1, 4))) for _ in range(400)]
    samples = {"zh": " ".join(r.choices(words, k=3000)), "ko": " ".join("".join(chr(0xAC00 + r.randrange(600)) for _ in range(3)) for _ in range(900)), "en": prose(1, 300)}
    m = langid.Model(samples)
    texts = [" ".join(r.choices(words, k=n)) for n in (1, 5, 40)] + [samples["ko"][70:300], samples["zh"][50:90] + " and the was " + samples["ko"][:9], prose(3, 20), "龘ꙮ"]
    got = m.phrases([m.encode(t) for t in texts])
    for t, row in zip(texts, got):
        assert row.tolist() == [brute_phrases(langid.normal(samples[k]), langid.normal(t)) for k in m.languages], t
    lang, _, rate = m.predict(texts)
    assert lang[1:4] == ["zh", "zh", "ko"] and max(rate[1:4]) < langid.REJECT_RATE


def test_op7_on_odd_rows(spark, folder, nothing):
    got = queries.op7_cross_parsing(spark, folder).collect()
    assert len(got) == len(rows())
    by = {r.doc_id: r for r in got}
    for i in (4, 5, 6, 7):
        assert by[i].lang_pred == "und" and by[i].score == 0
    assert all(r.lang_pred in ("en", "de", "und") and 0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert queries.op7_cross_parsing(spark, nothing).count() == 0
    none = write(spark, nothing + "-nolang", documents=odd(spark).withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in queries.op7_cross_parsing(spark, none).collect()} == {"und"}
    short = langid.Model({"en": prose(1)}).predict(["Q", "qx", "zqxj" * 30])
    assert short[2][0] < langid.REJECT_RATE and short[2][1] < langid.REJECT_RATE <= short[2][2]
    kept = langid.keep_known(odd(spark))
    assert kept.columns == odd(spark).columns and not {4, 5, 6, 7} & {r.doc_id for r in kept.collect()}


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_held_out_language(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    r = queries.op7_cross_parsing(spark, DATA).join(docs, "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert r[0] >= 0.97


# ---------------------------------------------------------------- op5

def test_marginals_against_enumeration():
    r = np.random.default_rng(3)
    t = r.normal(size=(2, 2))
    odds = [r.normal(size=n) for n in (1, 5, 0, 8, 3)]
    for o, p in zip(odds, toxicity.marginals(odds, t)):
        total, hits = 0.0, np.zeros(len(o))
        for y in itertools.product((0, 1), repeat=len(o)):
            w = np.exp(sum(o[i] * y[i] for i in range(len(o))) + sum(t[a, b] for a, b in zip(y, y[1:])))
            total += w
            hits += w * np.array(y)
        assert np.allclose(p, hits / total)


def test_spans_are_offsets_of_the_text():
    text = "Oh, you BAD bad  thing; fine."
    p = np.array([0.1, 0.2, 0.9, 0.6, 0.1, 0.0])
    s, = toxicity.spans(text, p)
    assert text[s["start"]:s["end"]] == "BAD bad" and s["p"] == 0.9


def test_op5_on_odd_rows(spark, folder, nothing):
    got = queries.op5_crf_toxicity(spark, folder).collect()
    assert len(got) == len(rows()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[4].score == by[5].score and by[1].score == by[3].score
    assert queries.op5_crf_toxicity(spark, nothing).count() == 0
    assert {r.score for r in queries.op5_crf_toxicity(spark, write(spark, nothing + "-nolabel", documents=odd(spark), labels=spark.read.parquet(f"{nothing}/labels.parquet"))).collect()} == {0.0}
    kept = toxicity.keep_clean(odd(spark), spark.read.parquet(f"{nothing}/labels.parquet"))
    assert kept.columns == odd(spark).columns and kept.count() == len(rows())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_held_out_toxicity(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet").select("doc_id", "toxic")
    d = queries.op5_crf_toxicity(spark, DATA).join(labels, "doc_id").filter("held_out").toPandas()
    assert (d.predicted == d.toxic).mean() >= 0.93
    assert d.predicted[d.toxic == 0].mean() <= 0.03


def test_planted_insults_are_tagged(spark):
    texts = [prose(i, 80) for i in range(150)]
    r = random.Random(5)
    bad = []
    for i in range(60):
        w = prose(1000 + i, 80).split()
        for k in range(4):
            w.insert(r.randrange(len(w)), r.choice(["grunkle", "snarfed", "grunklest"]))
        bad.append(" ".join(w))
    m = toxicity.train(texts + bad, [0] * 150 + [1] * 60, [1.0] * 210)
    score, p = m.scores([prose(5000, 90), prose(5001, 40) + " you grunkle, snarfed and " + prose(5002, 30) + " grunkle snarfed", ""])
    assert score[0] < 0.5 < score[1] and score[2] < 0.5
    text = "a calm word and grunkle then"
    s = toxicity.spans(text, m.scores([text])[1][0], 0.3)
    assert [text[x["start"]:x["end"]] for x in s] == ["grunkle"]
