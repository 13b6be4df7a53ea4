"""Importance resampling, filter audit and token counts against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tellus.llm import filter_audit, queries, resampling, spans, token_counts
from tests.llm.helpers import LONG, empty, odd, prose, rows, write

MODEL = P.path("piece_bpe_32k.model")
ODD_TEXTS = ["", " ", "\n", "a", "A\x00B c\x1cd", "  two  spaces ", "tab\tand\r\nline\x0b\x0c", "▁ sign ▁▁x▁", "a▁b ▁", "<s></s><unk><0x0A> <pad>",
             "日本語のテキスト 日本語", "𝒳𝒴 😀😀", "ﬁ ﬀ é", "x" * 5000, " " * 5000, "　a b​c", "日" * 3000, "#!$", "ABC def", "1234567890 " * 40,
             "word, word. word; (word) [word] word-word word's", "퟿￿\U0010ffff", "a" * 63 + " " + "a" * 64 + " " + "a" * 65 + " " + "a" * 66]


def noise(seed, n):
    r = random.Random(seed)
    return "".join(r.choice(" \t\n,.#$aAbBéß日▁0 9z") for _ in range(n))


TEXTS = ODD_TEXTS + [noise(i, 700) for i in range(30)] + [prose(i, 90) for i in range(10)]


@pytest.fixture(params=[None, 64, 1000])
def block(request, monkeypatch):
    """Blocks of the usual size and so small that most texts are cut."""
    if request.param:
        monkeypatch.setattr(spans, "BLOCK_BYTES", request.param)
        monkeypatch.setattr(spans, "_WINDOW", 16)


def same_as_sql(df, con, sql):
    rel, names = con.sql(sql), sorted(df.columns)
    assert names == sorted(rel.columns)
    theirs = [tuple(r[rel.columns.index(c)] for c in names) for r in rel.fetchall()]
    return sorted(map(repr, (tuple(r[c] for c in names) for r in df.collect()))) == sorted(map(repr, theirs))


# ---------------------------------------------------------------- spans

def test_spans_are_compared_by_bytes():
    words = [prose(i, 3).encode()[:i % 90] for i in range(400)] + [b"", b"a", b"a\x00", b"\x00"] * 3
    buf = np.frombuffer(b"".join(words) + bytes(8), np.uint8)
    length = np.array([len(w) for w in words])
    start = np.cumsum(length) - length
    entry, h, _ = spans.insert(buf, start, length)
    assert len(set(entry)) == len(set(words)) and all(words[e] == w for e, w in zip(entry, words))
    seeds = np.arange(len(words)) % 2
    entry, _, _ = spans.insert(buf, start, length, seeds)
    assert len(set(entry)) == len(set(zip(words, seeds)))


def test_spans_with_equal_hashes_stay_apart(monkeypatch):
    """With every hash alike, only the comparison of bytes is left."""
    monkeypatch.setattr(spans, "hashes", lambda buf, starts, lengths, seeds=0: np.zeros(len(starts), np.uint64))
    words = [str(i % 50).encode() for i in range(200)]
    buf = np.frombuffer(b"".join(words) + bytes(8), np.uint8)
    length = np.array([len(w) for w in words])
    entry, _, _ = spans.insert(buf, np.cumsum(length) - length, length)
    assert len(set(entry)) == 50 and all(words[e] == w for e, w in zip(entry, words))
    kinds = sorted(set(words))
    table = spans.LengthTable(kinds[:30], list(range(30)))
    assert table.find(buf, np.cumsum(length) - length, length).tolist() == [kinds.index(w) if w in kinds[:30] else -1 for w in words]


# ---------------------------------------------------------------- op11

def test_crc_of_spans():
    words = [w.encode() for w in TEXTS]
    buf = np.frombuffer(b"".join(words) + bytes(8), np.uint8)
    length = np.array([len(w) for w in words])
    assert resampling.crc32s(buf, np.cumsum(length) - length, length).tolist() == [zlib.crc32(w) for w in words]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def buckets_of(text):
    return [zlib.crc32(w.encode()) % 10000 for w in re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))]


def test_buckets_of_cut_texts(block):
    found = collections.defaultdict(list)
    for row, bucket in resampling._buckets(pa.array(TEXTS), 10000):
        for r, b in zip(row.tolist(), bucket.tolist()):
            found[r].append(b)
    assert [found[i] for i in range(len(TEXTS))] == [buckets_of(t) for t in TEXTS]


def resampled(docs, target):
    """Brute force: (doc_id, n_features, weight, score) of every row, and the ids drawn in order."""
    s, t = collections.Counter(), collections.Counter()
    for _, x in docs:
        s.update(buckets_of(x))
    for x in target:
        t.update(buckets_of(x))
    S, T = sum(s.values()), sum(t.values())
    out = []
    for i, x in docs:
        f = buckets_of(x)
        w = sum(math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    return out, fit[:len(fit) // 10]


@pytest.mark.parametrize("copies", [1, 40])
def test_resampling_equals_brute_force(spark, copies):
    r = random.Random(5)
    docs = [(i, prose(r.randrange(60), r.choice([5, 19, 20, 60]))) for i in range(230)] + [(1000 + i, t) for i, t in enumerate(TEXTS)]
    docs += [(7, prose(3, 50)), (7, prose(3, 50)), (None, prose(4, 40)), (None, None), (5, None)] + [(11, prose(1, 45))] * copies
    target = [prose(1000 + i, 30) for i in range(5)] + [None, ""]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = resampling.resample(d, spark.createDataFrame([(t,) for t in target], "text string")).collect()
    every, drawn = resampled(docs, target)
    order = lambda r: repr(r)
    assert sorted(((g.doc_id, g.n_features, g.weight, g.score) for g in got), key=order) == sorted(every, key=order)
    won = sorted((g for g in got if g["rank"] is not None), key=lambda g: g["rank"])
    assert [g["rank"] for g in won] == list(range(1, len(drawn) + 1))
    assert [(g.doc_id, g.n_features, g.weight, g.score) for g in won] == drawn


def test_cutoff_splits_ties(spark):
    r = random.Random(1)
    data = [(r.randrange(3), r.randrange(-4, 4), r.randrange(2), r.randrange(1, 4)) for _ in range(60)]
    d = spark.createDataFrame(data, "a long, b long, c long, n long").cache()
    whole = sorted(x[:3] for x in data for _ in range(x[3]))
    for wanted in (1, 17, len(whole) // 2, len(whole)):
        at, within = resampling.cutoff(d, ["a", "b", "c"], "n", wanted)
        assert tuple(at) == whole[wanted - 1]
        assert within == wanted - sum(w < tuple(at) for w in whole)
    d.unpersist()


def test_op11_odd_rows_and_sql(spark, tmp_path):
    bench = spark.createDataFrame([(1, prose(5)), (2, None)], "item_id long, text string")
    f = write(spark, str(tmp_path), documents=odd(spark), benchmark=bench)
    out = queries.op11_importance_resampling(spark, f)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"] and out.count() == len(rows())
    assert {t for _, t in out.dtypes} == {"bigint"}
    plain = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, prose(i, 25)) for i in range(150)]
    g = write(spark, str(tmp_path / "sql"), documents=spark.createDataFrame(plain, "doc_id long, text string"), benchmark=bench)
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{g}/{t}.parquet/*.parquet'")
    assert same_as_sql(queries.op11_importance_resampling(spark, g), con, queries.oracle_sql()["op11_importance_resampling"])
    none = write(spark, str(tmp_path / "none"), documents=empty(spark), benchmark=bench.limit(0))
    assert queries.op11_importance_resampling(spark, none).count() == 0
    short = write(spark, str(tmp_path / "short"), documents=spark.createDataFrame([(1, "too short")], "doc_id long, text string"), benchmark=bench.limit(0))
    assert [r["rank"] for r in queries.op11_importance_resampling(spark, short).collect()] == [None]


# ---------------------------------------------------------------- op12

def counted(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))]


def test_signals_of_cut_texts(block):
    found = filter_audit._signals(*spans.utf8(pa.array(TEXTS)))
    assert found.tolist() == [counted(t) for t in TEXTS]
    sliced = pa.array(["before", *TEXTS, "behind"]).slice(1, len(TEXTS))
    assert filter_audit._signals(*spans.utf8(sliced)).tolist() == found.tolist()
    assert filter_audit._signals(*spans.utf8(pa.array(TEXTS, pa.large_string()))).tolist() == found.tolist()
    assert filter_audit._signals(*spans.utf8(pa.array([], pa.string()))).shape == (0, 5)


def audited(docs, labels):
    """Brute force: apply every order to every part, document by document."""
    least, fails, out = {}, [], {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, lang in docs:
        t = t or ""
        n, distinct, capitals, points, symbols = counted(t)
        bad = {f for f, x in zip("ABCDE", (n < 100, 100 * distinct < 80 * n, 100 * capitals > 10 * points, symbols > 0, i is not None and least[t] < i)) if x}
        good, toxic = (any(l[0] == i and l[k] == 1 for l in labels if i is not None) for k in (1, 2))
        fails.append((lang or "", bad, good, toxic))
    for part in {f[0] for f in fails}:
        mine = [f for f in fails if f[0] == part]
        shapley = collections.Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                out[part, order, step] = [len(left) - len(gone), len(gone), sum(f in x[1] for x in mine) - len(gone),
                                          sum(x[1] == {f} for x in mine), sum(x[2] for x in gone), sum(x[3] for x in gone)]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return sorted((*k, *v) for k, v in out.items())


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_audit_equals_brute_force(spark, tmp_path):
    r = random.Random(8)
    texts = [prose(1, 150), "dup", None, "", prose(2, 99), prose(3, 100), " ".join(f"w{i}" for i in range(120)), " ".join(f"W{i}" for i in range(120)) + " #", LONG]
    docs = [(i, r.choice(texts), r.choice(["en", "de", None])) for i in range(90)]
    docs += [(200 + i, t, "xx") for i, t in enumerate(TEXTS)] + [(5, "dup", "de"), (5, "dup", "en"), (None, "dup", "en"), (None, "", None), (500, "alone", ""), (500, "alone", "")]
    labels = [(i, r.randrange(2), r.randrange(2)) for i in range(0, 300, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (6, None, 1), (9999, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("n", F.lit(1)).withColumn("a.b", F.lit(1)).withColumn("pattern", F.lit("x"))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit(0))
    got = filter_audit.audit(d, lab)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == audited(docs, labels)
    f = write(spark, str(tmp_path), documents=d, labels=lab)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{f}/{t}.parquet/*.parquet'")
    assert same_as_sql(queries.op12_filter_audit(spark, f), con, queries.oracle_sql()["op12_filter_audit"])


def test_op12_odd_rows(spark, tmp_path):
    lab = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    f = write(spark, str(tmp_path), documents=odd(spark), labels=lab)
    out = sorted(map(tuple, queries.op12_filter_audit(spark, f).collect()))
    assert out == audited([(a, b, c) for a, b, c, _, _ in rows()], [(1, 1, 0)])
    none = write(spark, str(tmp_path / "none"), documents=empty(spark), labels=lab.limit(0))
    assert queries.op12_filter_audit(spark, none).count() == 0


# ---------------------------------------------------------------- op13

def library(texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return [len(sp.encode(t)) for t in texts]


@pytest.mark.parametrize("known", [0, 500])
def test_token_counts_of_cut_texts(block, known):
    model = token_counts.Pieces(MODEL)
    keys = sorted({w.encode() for t in TEXTS for w in re.findall(" ?[a-z]+", t) if len(w) <= 48})[:known]
    table = spans.LengthTable(keys, model.lengths(keys))
    data, offsets = spans.utf8(pa.array([" " + t if t else "" for t in TEXTS]))
    assert model.count(data, offsets, table).tolist() == library(TEXTS)
    assert model.count(data, offsets, table).tolist() == library(TEXTS)  # from the cache


def test_cache_stays_small(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_ROWS", 50)
    model = token_counts.Pieces(MODEL)
    keys = [f" w{i}".encode() for i in range(300)]
    assert model.lengths(keys) == [n for n in library(k.decode()[1:] for k in keys)]
    assert len(model.cache) <= 50


def test_op13_odd_rows(spark, tmp_path):
    f = write(spark, str(tmp_path), documents=odd(spark).unionByName(
        spark.createDataFrame([(1000 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string"), allowMissingColumns=True))
    out = queries.op13_token_counts(spark, f)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    every = [(i, t or "") for i, t, *_ in rows()] + [(1000 + i, t) for i, t in enumerate(TEXTS)]
    expect = [(i, len(t.encode()), n, n > 4096) for (i, t), n in zip(every, library(t for _, t in every))]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, expect))
    none = write(spark, str(tmp_path / "none"), documents=empty(spark))
    assert queries.op13_token_counts(spark, none).count() == 0


def test_very_long_runs_count_whole(spark):
    texts = [" " * 1_500_000, "x" * 300_000, "日" * 200_000, "ab " * 400_000]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    out = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(d, MODEL).collect()}
    assert [out[i] for i in range(4)] == library(texts)
