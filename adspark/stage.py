"""Materialising a step that several later steps read."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Spark then deletes a query's shuffle files when it ends, not when the driver's memory is next collected.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _writing = threading.Lock(), {"now": 0, "before": None}


def shared_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names, or None."""
    return spark.conf.get(CHECKPOINT_CONF, None) or None


def _base(spark: SparkSession) -> str | None:
    shared = shared_dir(spark)
    return shared and f"{shared.rstrip('/')}/adspark-{spark.sparkContext.applicationId}"


@contextmanager
def _no_files_left(spark: SparkSession):
    """What a step shuffles isn't read again once it is written: without this it stays on the disks until the driver happens to collect it.
    Steps may be written by several threads; the last one restores the setting."""
    with _lock:
        if not _writing["now"]:
            _writing["before"] = spark.conf.get(CLEANUP_CONF, None)
            spark.conf.set(CLEANUP_CONF, "true")
        _writing["now"] += 1
    try:
        yield
    finally:
        with _lock:
            _writing["now"] -= 1
            if not _writing["now"]:
                spark.conf.unset(CLEANUP_CONF) if _writing["before"] is None else spark.conf.set(CLEANUP_CONF, _writing["before"])


def stage(df: DataFrame, name: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: a lost executor costs a re-read and not a re-computation, and readers
    prune columns and know the size. Without a shared folder the plan stays lazy: results are the
    same, shared steps are computed again. ``name`` also registers the result as a temporary view.
    """
    base = _base(df.sparkSession)
    if base:
        path = f"{base}/{uuid.uuid4().hex}"
        with _no_files_left(df.sparkSession):
            df.write.parquet(path)
        df = df.sparkSession.read.schema(df.schema).parquet(path)
    if name:
        df.createOrReplaceTempView(name)
    return df


def written(df: DataFrame) -> DataFrame:
    """:func:`stage` for steps that must not be computed twice: without a shared folder, and Spark local, in a local one."""
    if _base(df.sparkSession):
        return stage(df)
    path = work_dir(df.sparkSession)
    with _no_files_left(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_with(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
    """:func:`written`, and aggregates of the rows taken while they are written, without a job of their own.

    They are taken in the writing tasks, of which each partition counts once, however often a task is tried.
    """
    seen = Observation()
    out = written(df.observe(seen, *[m.alias(n) for n, m in measures.items()]))
    return out, dict(seen.get)


def written_counted(df: DataFrame, whole: str, parts: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """The written rows, and a row ``stage, rows`` for all of them (``whole``) and for those that meet each test."""
    tests = {f"_{k}": F.count_if(test) for k, test in enumerate(parts.values())}
    out, seen = written_with(df, _all=F.count(F.lit(1)), **tests)
    counts = [(whole, seen["_all"]), *((name, seen[f"_{k}"]) for k, name in enumerate(parts))]
    return out, df.sparkSession.createDataFrame(counts, "stage string, rows long")


def drop_stages(spark: SparkSession) -> None:
    """Delete what this application staged. Call it when the results have been written."""
    base = _base(spark)
    if base:
        path = spark._jvm.org.apache.hadoop.fs.Path(base)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def work_dir(spark: SparkSession) -> str:
    """A new folder for written results: in the shared folder, or local if Spark itself is local."""
    base = _base(spark)
    if base:
        return f"{base}/{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="adspark-")
    raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder")
