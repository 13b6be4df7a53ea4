import pytest

from tellus.plans.audit import run_audit
from tellus.plans.repair import repair
from tests import fixtures as FX


@pytest.fixture(scope="module")
def repaired(spark):
    t, ch = repair(FX.staging(spark))
    return t, {r.rule_id: r.changed_rows for r in ch.collect()}


def test_change_counts(repaired):
    _, ch = repaired
    assert ch == {
        "R01": 1, "R02": 2, "R03": 3, "R04": 2,
        "R05": 1, "R06": 2, "R07": 2, "R08": 1, "R09": 3, "R10": 2, "R11": 4, "R12": 2, "R13": 1,
        "R14": 1, "R15": 2, "R16": 2, "R17": 1, "R18": 2, "R19": 1, "R20": 1, "R21": 1, "R22": 1,
        "R23": 2,
    }


def test_reaudit_after(spark, repaired):
    t, _ = repaired
    r = {x.control_id: x.failing_rows for x in
         run_audit(t, phase="after", run_id="r1", as_of=FX.AS_OF).collect()}
    kept = {"C04": 2, "C07": 1, "U03": 1, "V02": 1, "V08": 2, "Co01": 1, "Co02": 2,
            "Co03": 1, "Co04": 1, "Co05": 2}
    for cid, n in r.items():
        assert n == kept.get(cid, 0), cid


def test_row_outcomes(repaired):
    t, _ = repaired
    ev = {r.id: r for r in t["event"].collect()}
    assert ev["E_DUP"].title == "Dup v2"
    assert ev[None].title == "No id 2"
    assert ev["E_BADLINK"].title == "Bad link" and ev["E_BADLINK"].link == "https://example.com/x"
    assert ev["E_TWODAYS"].link == "https://ftp://z"
    assert ev["TEST_0001"].description == ""
    src = {r.id: r.url for r in t["source"].collect()}
    assert src["s_noscheme"] == "https://example.com/x" and src["s_slashes"] == "//b"
    cat = {r.id: r.title for r in t["category"].collect()}
    assert cat["c_blank"] == "c_blank" and cat["c_null"] == "c_null"
    geo = [(r.event_id, r.date, r.coordinates) for r in t["geometry"].collect()]
    assert ("TEST_0001", "2026-09-19T18:00:00Z", "[-118.3, 34.1]") in geo
    assert ("TEST_0001", "2026-09-19T18:00:00Z", "[-118.30, 34.10]") not in geo
    assert sum(1 for g in geo if g[0] == "E_FUTURE" and g[2] == "[1, 2]") == 1  # NULL type kept
    q = {r.id: r for r in t["earthquake"].collect()}
    assert q["q_dup"].place == "second" and q["q_mag_null"].mag_type == "unknown"
    assert "q_depth" not in q and "q_edge" in q


def test_idempotent(spark, repaired):
    t, _ = repaired
    t2, ch2 = repair(t)
    assert all(r.changed_rows == 0 for r in ch2.collect())
    for name in t:
        a = sorted(map(tuple, t[name].collect()), key=repr)
        b = sorted(map(tuple, t2[name].collect()), key=repr)
        assert a == b, name


def test_documented_order(spark):
    t, ch = repair(FX.staging(spark), order=("impute", "correct", "delete"))
    ch = {r.rule_id: r.changed_rows for r in ch.collect()}
    # correcting first fixes the link of E_BADLINK before deletes; counts differ only by order
    assert ch["R16"] == 2 and ch["R09"] == 3


def test_quality_run_96_rows(spark, tmp_dir):
    from tellus.plans.quality_run import quality_run
    from tellus.sources.tables import seed_tables
    pub = seed_tables(spark)
    pub["earthquake"] = FX.staging(spark)["earthquake"].drop("_ingested_at")
    rep, _, _ = quality_run(FX.staging(spark), pub, run_id="r9", as_of=FX.AS_OF,
                            report_path=tmp_dir + "/report")
    rows = spark.read.parquet(tmp_dir + "/report").collect()
    assert len(rows) == 96
    by = {}
    for r in rows:
        by[(r.phase, r.table_name.split(".")[0])] = by.get((r.phase, r.table_name.split(".")[0]), 0) + 1
    assert by == {("before", "staging"): 32, ("before", "public"): 32, ("after", "staging"): 32}
