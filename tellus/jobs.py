"""Command-line jobs (``spark-submit tellus/jobs.py <command> ...`` or
``python -m tellus.jobs <command> ...``).

ingest      Kafka topics -> raw JSONL lake (Structured Streaming)
clean-load  lake -> staging + clean snapshots + event_earthquake (entry 1)
load        what landed in the lake since the last load -> one version of all clean tables
sync        lake event feed -> clean snapshots, record by record isolation (entry 5)
audit       staging (+ public) snapshots -> report rows, repaired staging (entry 2)
report      summary of the latest run from the report table
"""

from __future__ import annotations

import argparse
import sys


from tellus import schemas as SC
from tellus.plans import clean_load as PL
from tellus.plans import incremental as INC
from tellus.plans import report as RP
from tellus.plans import upsert as UP
from tellus.plans.quality_run import quality_run
from tellus.session import get_session
from tellus.sources import feeds as FD
from tellus.sources import sinks as K
from tellus.streaming import lake as LK

STAGING = ("event", "category", "source", "geometry", "event_category", "event_source", "earthquake")


def _clean_load(spark, a) -> None:
    ev = FD.read_lake(spark, a.lake, a.event_source, SC.EVENT_RECORD)
    qk = FD.read_lake(spark, a.lake, a.quake_source, SC.QUAKE_RECORD)
    if a.require_both and not FD.is_ready(ev, qk):
        raise SystemExit("a feed has no records yet")  # the scheduler tries again
    tables = PL.run(ev, qk, max_km=a.max_km, max_hours=a.max_hours, checkpoint=True)
    tables["quarantine.line"] = FD.corrupt_lines(ev).unionByName(FD.corrupt_lines(qk))
    v = K.publish_tables({n.replace(".", "/") if "." in n else f"public/{n}": df for n, df in tables.items()}, a.out)
    print(f"version {v.version}, tables {len(v.tables)}")


def _load(spark, a) -> None:
    v = INC.load(spark, a.lake, a.tables, a.ledger, event_source=a.event_source, quake_source=a.quake_source,
                 max_files=a.max_files, max_km=a.max_km, max_hours=a.max_hours)
    print(f"version {v.version}, load {v.load}")


def _sync(spark, a) -> None:
    ev = FD.read_lake(spark, a.lake, a.event_source, SC.EVENT_RECORD)
    # six tables and the counts derive from the records: parse the lake once
    ev = K.materialize(spark, ev.drop("_raw", "_file", "_corrupt"), "sync-records")
    names = [n for n in STAGING if n != "earthquake"]
    now = K.pin(spark, a.tables)
    refs = {}
    for name, schema in (("categories", SC.CATEGORY_RECORD), ("sources", SC.SOURCE_RECORD)):
        path = getattr(a, name)
        if path:
            refs[name] = FD.reference_rows(FD.read_envelopes(spark, path), name, schema=schema, fallback=None)
    tables, counts = UP.sync({n: now.read(f"public/{n}") for n in names}, ev, **refs)
    v = K.publish_tables({f"public/{n}": tables[n] for n in names}, a.tables)
    done = counts.first()
    print(f"processed {done.processed}, failed {done.failed}, version {v.version}")


def _audit(spark, a) -> None:
    now = K.pin(spark, a.tables)
    staging = {n: now.read(f"staging/{n}") for n in STAGING}
    public = {n: now.read(f"public/{n}") for n in STAGING} if a.with_public else None
    _, repaired, changes = quality_run(staging, public, as_of=a.as_of, report_path=a.report,
                                       materialize=lambda name, df: K.materialize(spark, df, name))
    K.publish_tables({f"staging/{n}": df for n, df in repaired.items()}, a.tables)
    if a.changes:
        changes.write.mode("append").parquet(a.changes)


def _report(spark, a) -> None:
    RP.summary(spark.read.parquet(a.report)).show(truncate=False)


def _ingest(spark, a) -> None:
    msgs = LK.kafka_stream(spark, a.kafka, a.topics.split(","), min_offsets=a.min_offsets, max_delay=a.max_delay)
    q = LK.ingest(msgs, a.lake, a.checkpoint, processing_time=a.every, available_now=a.once,
                  order=("partition", "offset"), quarantine=a.quarantine or a.lake.rstrip("/") + "-quarantine")
    q.awaitTermination()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tellus")
    sub = p.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("clean-load")
    c.add_argument("--lake", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--event-source", default="eonet")
    c.add_argument("--quake-source", default="usgs")
    c.add_argument("--require-both", action="store_true", help="stop unless both feeds have records (S10)")
    c.add_argument("--max-km", type=float, default=500.0)
    c.add_argument("--max-hours", type=float, default=168.0)
    n = sub.add_parser("load")
    n.add_argument("--lake", required=True)
    n.add_argument("--tables", required=True)
    n.add_argument("--ledger", required=True, help="checkpoint folder of the loads")
    n.add_argument("--event-source", default="eonet")
    n.add_argument("--quake-source", default="usgs")
    n.add_argument("--max-files", type=int, help="lake files of a version at most")
    n.add_argument("--max-km", type=float, default=500.0)
    n.add_argument("--max-hours", type=float, default=168.0)
    a = sub.add_parser("audit")
    a.add_argument("--tables", required=True)
    a.add_argument("--report", required=True)
    a.add_argument("--changes")
    a.add_argument("--as-of")
    a.add_argument("--with-public", action="store_true")
    s = sub.add_parser("sync")
    s.add_argument("--lake", required=True)
    s.add_argument("--tables", required=True)
    s.add_argument("--event-source", default="eonet")
    s.add_argument("--categories", help="folder of reference category envelopes")
    s.add_argument("--sources", help="folder of reference source envelopes")
    r = sub.add_parser("report")
    r.add_argument("--report", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--kafka", required=True)
    i.add_argument("--topics", default="eonet.events,usgs.earthquakes")
    i.add_argument("--lake", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--quarantine", help="folder of messages that hold no JSON object; default: beside the lake")
    i.add_argument("--min-offsets", type=int, default=200)
    i.add_argument("--max-delay", default="30s")
    i.add_argument("--every", default="1 second")
    i.add_argument("--once", action="store_true")
    for x in (c, n, a, s, r):
        x.add_argument("--checkpoint-dir", help="shared folder; needed on a cluster unless spark.checkpoint.dir is set")
    return p


COMMANDS = {"clean-load": _clean_load, "load": _load, "sync": _sync, "audit": _audit, "report": _report, "ingest": _ingest}


def main(argv=None, spark=None) -> None:
    args = parser().parse_args(argv)
    spark = spark or get_session(f"tellus-{args.cmd}", checkpoint_dir=getattr(args, "checkpoint_dir", None))
    COMMANDS[args.cmd](spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
