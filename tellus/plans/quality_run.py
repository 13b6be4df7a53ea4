"""Entry 2: one quality run (section 3.2).

audit staging (phase before) + audit public (phase before, told apart by
the ``table_name`` prefix) -> repair staging -> re-audit staging (phase
after). 32 controls x 3 = 96 report rows per run, appended once.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from tellus.plans.audit import hazard_controls, run_audit
from tellus.plans.repair import DEFAULT_ORDER, repair
from tellus.sources.sinks import append_report


def quality_run(staging: Mapping[str, DataFrame], public: Mapping[str, DataFrame] | None = None, *,
                controls: Sequence | None = None, run_id: str | None = None, run_at=None,
                as_of=None, order: Sequence[str] = DEFAULT_ORDER, report_path: str | None = None,
                materialize=None):
    """Returns ``(report, repaired_staging, changes)``; the report is
    appended to ``report_path`` when given (partitioned by run).
    ``materialize(name, df)`` writes what a repair stage changed, so the next
    stage, its counts and the audit read written tables (see ``repair``)."""
    controls = hazard_controls() if controls is None else list(controls)
    run_id = run_id or str(uuid.uuid4())
    run_at = run_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    kw = dict(controls=controls, run_id=run_id, run_at=run_at, as_of=as_of)
    parts = [run_audit(staging, phase="before", schema="staging", **kw)]
    if public is not None:
        parts.append(run_audit(public, phase="before", schema="public", **kw))
    repaired, changes = repair(staging, order, materialize)
    parts.append(run_audit(repaired, phase="after", schema="staging", **kw))
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    if report_path:
        append_report(report, report_path)
    return report, repaired, changes
