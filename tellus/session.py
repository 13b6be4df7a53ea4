"""SparkSession construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins/aggregates at runtime
# (partition coalescing, skew-join splitting, broadcast conversion based on
# *measured* sizes); ANSI stays on, so every parse goes through try_* forms.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # the driver keeps the text of every plan that it ran, 1000 of them by default, also without a UI
    "spark.sql.ui.retainedExecutions": "20",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "tellus", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None, checkpoint_dir: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` is only set when given: on a cluster it comes from
    spark-submit. ``shuffle_partitions`` should be sized so one shuffle
    partition stays well under executor memory at the target scale
    (roughly total shuffle bytes / 128 MB); AQE coalesces the excess.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    # A reused session may predate our builder: the session-level SQL
    # settings are still applied (static ones like the UI cannot change).
    for k, v in conf.items():
        if k.startswith("spark.sql.") and not k.startswith("spark.sql.ui."):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("WARN")
    if checkpoint_dir:
        spark.conf.set("spark.checkpoint.dir", checkpoint_dir)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage visible to every
    executor; without it a job stops here. Only a ``local`` session (tests)
    gets a temporary folder of its own.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "local")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        d = tempfile.mkdtemp(prefix="tellus-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        sc = spark.sparkContext
    except (AttributeError, PySparkException):  # Spark Connect has none
        return d
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    Used for lake/snapshot outputs of jobs so that lineage can be cut by a
    written table rather than by executor-local state.
    """
    base = ensure_checkpoint_dir(spark)
    name = "-".join(parts + (uuid.uuid4().hex[:12],)) if parts else uuid.uuid4().hex
    return os.path.join(base.rstrip("/"), "tellus", name)
