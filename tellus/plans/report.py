"""Quality-report queries.

The report is an append-only fact table (one row per control, phase and
run). "Latest run" is a global ``max_by`` - exactly one row - which is then
broadcast; the size bound is structural, not estimated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tellus.functions.scalars import exact_ratio


def latest_run_id(report: DataFrame) -> DataFrame:
    """O3: ``run_id`` of the most recent run (one row)."""
    return report.agg(F.max_by("run_id", F.struct("run_at", "run_id")).alias("run_id"))


def _only_run(report: DataFrame, run_id=None) -> DataFrame:
    if run_id is not None:
        return report.filter(F.col("run_id") == run_id)
    return report.join(F.broadcast(latest_run_id(report)), "run_id", "left_semi")


def summary(report: DataFrame, run_id=None) -> DataFrame:
    """Q13 / Q14 (A8): per phase and dimension: controls, anomalies,
    failed controls."""
    r = _only_run(report, run_id)
    return (r.groupBy("phase", "dimension")
             .agg(F.count(F.lit(1)).alias("controls"),
                  F.sum("failing_rows").cast("long").alias("anomalies"),
                  F.count_if(F.col("failing_rows") > 0).alias("failed_controls"))
             .orderBy("phase", "dimension"))


def failing_controls(report: DataFrame, run_id=None) -> DataFrame:
    """Q15: failing controls of a run with a percentage."""
    r = _only_run(report, run_id).filter(F.col("failing_rows") > 0)
    return (r.select("phase", "control_id", "dimension", "table_name", "total_rows",
                     "failing_rows", F.round(F.col("fail_rate") * 100, 2).alias("fail_pct"),
                     "details")
             .orderBy(F.col("phase").desc(), "dimension", "control_id"))


def run_history(report: DataFrame) -> DataFrame:
    """Q16 (A10): anomalies per run and phase, newest first."""
    return (report.groupBy("run_id", "run_at", "phase")
                  .agg(F.sum("failing_rows").cast("long").alias("anomalies"))
                  .orderBy(F.col("run_at").desc_nulls_first(), "phase"))


def extract(report: DataFrame, run_id=None) -> DataFrame:
    """Q17: full extract of a run (latest by default)."""
    r = _only_run(report, run_id)
    return (r.select("phase", "dimension", "control_id", "table_name", "total_rows",
                     "failing_rows", F.round(F.col("fail_rate") * 100, 2).alias("fail_pct"),
                     "details")
             .orderBy("phase", "dimension", "control_id"))


def anomalies_by_dimension(report: DataFrame, phase: str = "before",
                           prefix: str = "staging.") -> DataFrame:
    """Q18 (A11, F10)."""
    r = report.filter((F.col("phase") == phase) & F.col("table_name").startswith(prefix))
    return (r.groupBy("dimension")
             .agg(F.count(F.lit(1)).alias("controls"),
                  F.sum("failing_rows").cast("long").alias("anomalies"))
             .orderBy(F.col("anomalies").desc_nulls_first(), "dimension"))


def run_details(report: DataFrame, run_id) -> DataFrame:
    """Q19 (F11, O4)."""
    return (report.filter(F.col("run_id") == run_id)
                  .select("phase", "control_id", "dimension", "table_name", "total_rows",
                          "failing_rows", "fail_rate", "details")
                  .orderBy("phase", "control_id"))


def before_after(report: DataFrame, run_id=None, table_prefix: str | None = None) -> DataFrame:
    """Q24: per control, failing rows before and after repair, and the
    totals: anomalies before, after, resolved and resolution rate.

    One grouped pass (pivot by phase as conditional sums), no self join.
    """
    r = _only_run(report, run_id)
    if table_prefix:
        r = r.filter(F.col("table_name").startswith(table_prefix))
    per = (r.groupBy("control_id", "table_name")
             .agg(F.sum(F.when(F.col("phase") == "before", F.col("failing_rows"))).cast("long").alias("before_rows"),
                  F.sum(F.when(F.col("phase") == "after", F.col("failing_rows"))).cast("long").alias("after_rows")))
    return per.filter(F.col("after_rows").isNotNull() & F.col("before_rows").isNotNull()).agg(
        F.sum("before_rows").cast("long").alias("anomalies_before"),
        F.sum("after_rows").cast("long").alias("anomalies_after"),
        F.sum(F.col("before_rows") - F.col("after_rows")).cast("long").alias("resolved"),
        exact_ratio(F.sum(F.col("before_rows") - F.col("after_rows")), F.sum("before_rows"), 4)
         .alias("resolution_rate"))


def stalled(metrics: DataFrame, *, minutes: int = 15) -> DataFrame:
    """Q23: sources whose raw volume grew while the clean count stayed flat
    for longer than ``minutes``.

    ``metrics``: snapshots ``(at timestamp, source, raw_lines, clean_rows)``.
    The window is per source (one row per snapshot, small per source).
    """
    w = Window.partitionBy("source").orderBy("at")
    m = (metrics.withColumn("_prev_clean", F.lag("clean_rows").over(w))
                .withColumn("_flat", F.col("clean_rows") == F.col("_prev_clean"))
                .withColumn("_grp", F.sum(F.when(F.col("_flat"), 0).otherwise(1)).over(w)))
    runs = (m.groupBy("source", "_grp")
             .agg(F.min("at").alias("since"), F.max("at").alias("until"),
                  (F.max("raw_lines") - F.min("raw_lines")).alias("raw_growth")))
    dur = (F.unix_timestamp("until") - F.unix_timestamp("since")) / 60.0
    return (runs.filter((dur > minutes) & (F.col("raw_growth") > 0))
                .select("source", "since", "until", "raw_growth",
                        F.round(dur, 1).alias("flat_minutes")))
