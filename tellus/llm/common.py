"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tellus.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's setting by which a finished job's shuffle files go at once.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: the lineage
    is cut and a lost executor costs no recomputation beyond this point, so
    the shuffle files behind the table go as soon as it stands."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", label)
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made, once what was made of them is
    written too."""
    for t in tables:
        spark = t.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


#: Rows handed to a Python worker at a time: whole texts, so not too many.
BATCH_ROWS = 512


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the memory of Python workers by the rows of an Arrow batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def give_back() -> None:
    """Return freed memory to the system at the end of a task: a Python
    worker lives on, and the next stage's task should find it small."""
    gc.collect()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its own counsel
        pass


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def columns(df: DataFrame) -> list[Column]:
    """The columns of ``df``, whatever signs their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def fold(doc_id: Column) -> Column:
    """``crc32(doc_id as text) mod 5``; 0 is held out. Null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def held_out(doc_id: Column) -> Column:
    """True for fold 0. A null id is held out too: it is never learnt from."""
    return F.coalesce(fold(doc_id) == 0, F.lit(True))
