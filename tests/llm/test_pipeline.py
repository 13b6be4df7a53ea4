"""The pipeline stage by stage, on odd rows and against what each stage promises."""

import collections
import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tellus.llm import simhash
from tests.llm.helpers import empty, odd, prose, write

DATA = "/root/testdata/sf0.001"
LABELS = "doc_id long, quality int, toxic int"


def stages(spark, docs, folder, base):
    out = []
    for name, f in cp.STAGES:
        path = f"{base}/{name}"
        f(spark, docs, folder).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_on_odd_rows(spark, tmp_path):
    docs = odd(spark)
    folder = write(spark, str(tmp_path / "in"), documents=docs, labels=spark.createDataFrame([(1, 1, None)], LABELS))
    d = spark.read.parquet(f"{folder}/documents.parquet")
    lang, clean, near, cut, packed = stages(spark, d, folder, str(tmp_path))
    for s in (lang, clean, near, cut):
        assert s.columns == docs.columns
    ids = [r.doc_id for r in lang.collect()]
    assert not {4, 5, 6, 7} & set(ids) and {1, 2, 3, 8, 9, 11} <= set(ids)
    assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in clean.collect())  # no labels, nothing goes
    kept = collections.Counter(r.doc_id for r in near.collect())
    assert kept[1] == 1 and kept[3] == 0 and kept[2] == 1 and kept[10] == 0
    assert cut.count() == near.count()
    assert {r.doc_id for r in packed.collect()} == set(kept)
    assert cp.run(spark, folder).count() == packed.count()


def test_empty_table(spark, tmp_path):
    folder = write(spark, str(tmp_path), documents=empty(spark), labels=spark.createDataFrame([], LABELS))
    assert cp.run(spark, folder).count() == 0


def test_planted_cases(spark, tmp_path):
    passage = " ".join(f"passage{i} {w}" for i, w in enumerate(prose(7, 70).split()))
    rows = [(i, prose(i, 150), "en") for i in range(1, 101)]
    rows += [(201, rows[4][1], "en"), (202, rows[5][1], "en")]                         # exact copies
    rows += [(301, prose(301, 60) + " " + passage, "en"), (302, passage + " " + prose(302, 60), "en")]
    r = []
    for i in range(400, 440):
        w = prose(i, 100).split()
        for k in range(6):
            w.insert(11 * k + 3, ["grunkle", "snarfed"][k % 2])
        r.append((i, " ".join(w), "en"))
    d = spark.createDataFrame([(*x, "s", len(x[1])) for x in rows + r], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(x[0], 1, 0) for x in rows] + [(x[0], 0, 1) for x in r[:30]], LABELS)
    folder = write(spark, str(tmp_path / "in"), documents=d, labels=labels)
    lang, clean, near, cut, packed = stages(spark, d, folder, str(tmp_path))
    assert lang.count() == d.count()
    ids = {x.doc_id for x in clean.collect()}
    assert not ids & set(range(400, 440)) and ids >= set(range(1, 101))
    ids = {x.doc_id for x in near.collect()}
    assert not ids & {201, 202} and ids >= {*range(1, 101), 301, 302}
    texts = {x.doc_id: x.text for x in cut.collect()}
    assert "passage30" not in texts[301] and "passage30" not in texts[302]
    assert texts[301].startswith(prose(301, 60)) and texts[50] == prose(50, 150)


@pytest.mark.parametrize("n", [51, 60])
def test_short_repeated_passages_go(spark, n):
    passage = " ".join(f"p{i}" for i in range(n))
    assert len(passage) < 400
    rows = [(1, prose(1, 60) + " " + passage, 1), (2, passage + " " + prose(2, 60), 1), (3, " ".join(f"p{i}" for i in range(50)) + " own end", 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = {r.doc_id: r.text for r in cp.passages(spark, d, "").collect()}
    assert got[1].strip() == prose(1, 60) and got[2].strip() == prose(2, 60) and got[3] == rows[2][1]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_one_of_each_group_stays_on_the_test_tables(spark):
    d = spark.read.parquet(f"{DATA}/documents.parquet")
    groups = simhash.near_duplicates(d).groupBy().agg(F.countDistinct("component_id")).first()[0]
    kept = simhash.keep_one(d)
    assert kept.count() == groups
    assert simhash.near_duplicates(kept).filter("doc_id <> component_id").count() == 0
