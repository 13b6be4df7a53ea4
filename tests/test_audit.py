import duckdb
import pytest

from tellus.plans.audit import hazard_controls, run_audit
from tellus.sources.tables import seed_tables
from tests import fixtures as FX

# Independent SQL statement of each control, run by DuckDB on the same rows:
# (total query, failing query).
def _cnt(t, where=None):
    return f"SELECT COUNT(*) FROM {t}" + (f" WHERE {where}" if where else "")


def _dup(t, keys):
    return f"SELECT COALESCE(SUM(c - 1), 0) FROM (SELECT COUNT(*) c FROM {t} GROUP BY {keys} HAVING COUNT(*) > 1)"


def _orph(child, ck, parent):
    return f"SELECT COUNT(*) FROM {child} x WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.id = x.{ck})"


AS_OF = "TIMESTAMP '2026-09-25 00:00:00'"
SQL = {
    "C01": ("event", "title IS NULL OR trim(title, ' ') = ''"),
    "C02": ("event", "description IS NULL"),
    "C03": ("event", "link IS NULL"),
    "C04": ("earthquake", "magnitude IS NULL"),
    "C05": ("earthquake", "mag_type IS NULL"),
    "C06": ("earthquake", "place IS NULL"),
    "C07": ("earthquake", "depth_km IS NULL"),
    "C08": ("earthquake", "longitude IS NULL OR latitude IS NULL"),
    "C09": ("geometry", "coordinates IS NULL"),
    "V01": ("event", "link IS NOT NULL AND NOT regexp_matches(link, '^https?://')"),
    "V02": ("source", "url IS NOT NULL AND NOT regexp_matches(url, '^https?://')"),
    "V03": ("earthquake", "longitude IS NOT NULL AND (longitude < -180 OR longitude > 180)"),
    "V04": ("earthquake", "latitude IS NOT NULL AND (latitude < -90 OR latitude > 90)"),
    "V05": ("earthquake", "magnitude IS NOT NULL AND (magnitude < -1 OR magnitude > 10)"),
    "V06": ("earthquake", "depth_km IS NOT NULL AND depth_km < 0"),
    "V07": ("geometry", "type IS NOT NULL AND type NOT IN ('Point', 'Polygon')"),
    "V08": ("geometry", "type = 'Point' AND coordinates IS NOT NULL AND "
                        "(NOT json_valid(coordinates) OR json_type(coordinates) <> 'ARRAY' "
                        "OR json_array_length(coordinates) < 2)"),
    "Co02": ("earthquake", "tsunami AND (magnitude IS NULL OR magnitude < 6.5)"),
    "Co03": ("earthquake", f"time > {AS_OF} + INTERVAL 1 DAY"),
    "Co04": ("earthquake", f"time < {AS_OF} - INTERVAL 365 DAY"),
    "Co05": ("event", f"closed IS NOT NULL AND closed > {AS_OF} + INTERVAL 1 DAY"),
}
SET_SQL = {
    "U01": (_cnt("event"), _dup("event", "id")),
    "U02": (_cnt("earthquake"), _dup("earthquake", "id")),
    "U03": (_cnt("earthquake"), _dup("earthquake", "date_trunc('minute', time), round(CAST(latitude AS DECIMAL(18,6)), 1), "
                                     "round(CAST(longitude AS DECIMAL(18,6)), 1), round(CAST(magnitude AS DECIMAL(18,6)), 1)")),
    "U04": (_cnt("category"), _dup("category", "id")),
    "U05": (_cnt("source"), _dup("source", "id")),
    "Co01": (_cnt("event", "closed IS NOT NULL"),
             "SELECT COUNT(*) FROM event e WHERE e.closed IS NOT NULL AND e.closed < "
             "(SELECT MIN(TRY_CAST(g.date AS TIMESTAMPTZ)::TIMESTAMP) FROM geometry g WHERE g.event_id = e.id)"),
    "I01": (_cnt("event_category"), _orph("event_category", "event_id", "event")),
    "I02": (_cnt("event_category"), _orph("event_category", "category_id", "category")),
    "I03": (_cnt("event_source"), _orph("event_source", "event_id", "event")),
    "I04": (_cnt("event_source"), _orph("event_source", "source_id", "source")),
    "I05": (_cnt("geometry"), _orph("geometry", "event_id", "event")),
}


def _duck_expected():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    FX.duck(con)
    out = {}
    for cid, (t, where) in SQL.items():
        out[cid] = (con.execute(_cnt(t)).fetchone()[0], con.execute(_cnt(t, where)).fetchone()[0])
    for cid, (tq, fq) in SET_SQL.items():
        out[cid] = (con.execute(tq).fetchone()[0], con.execute(fq).fetchone()[0])
    return out


@pytest.fixture(scope="module")
def report(spark):
    r = run_audit(FX.staging(spark), phase="before", run_id="r1", run_at=FX.T2, as_of=FX.AS_OF)
    return {row.control_id: row for row in r.collect()}


def test_all_32_controls_present(report):
    assert len(report) == 32
    assert {c.id for c in hazard_controls()} == set(report)


def test_controls_match_independent_sql(report):
    exp = _duck_expected()
    assert set(exp) == set(report)
    got = {k: (v.total_rows, v.failing_rows) for k, v in report.items()}
    assert got == exp


def test_some_known_counts(report):
    assert (report["C01"].total_rows, report["C01"].failing_rows) == (15, 2)  # NULL and spaces; a tab survives trim
    assert report["U01"].failing_rows == 2  # E_DUP + the NULL-id group
    assert report["I02"].failing_rows == 2  # unknown category and NULL key (NOT EXISTS)
    assert report["V08"].failing_rows == 2  # [1] and an object
    assert report["Co01"].failing_rows == 1 and report["Co01"].total_rows == 4
    assert report["U03"].failing_rows == 2  # exact dup + fuzzy copy
    assert report["C01"].table_name == "staging.event"
    assert report["C01"].fail_rate == round(2 / 15, 4)


def test_seed_expectations(spark):
    t = seed_tables(spark)
    t["earthquake"] = spark.createDataFrame([], "id string, time timestamp, magnitude double, "
                                            "mag_type string, place string, longitude double, "
                                            "latitude double, depth_km double, tsunami boolean, "
                                            "significance int, url string")
    r = {x.control_id: x for x in run_audit(t, schema="public", as_of="2026-09-21 00:00:00").collect()}
    assert (r["Co01"].total_rows, r["Co01"].failing_rows) == (1, 0)
    assert (r["C02"].total_rows, r["C02"].failing_rows) == (3, 3)
    for cid, row in r.items():
        if cid != "C02":
            assert row.failing_rows == 0, cid
    assert r["C04"].fail_rate == 0.0 and r["C04"].total_rows == 0


def test_fused_scan_one_aggregate_per_table(spark):
    r = run_audit(FX.staging(spark), as_of=FX.AS_OF, run_id="x",
                  controls=[c for c in hazard_controls() if c.table == "earthquake" and c.id.startswith("V")])
    plan = r._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
