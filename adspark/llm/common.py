"""Tables kept between steps, Arrow batches in bounded pieces, and components of links."""

from __future__ import annotations

import hashlib
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Rows in an Arrow batch. Texts may be long, so batches are far below Spark's default.
BATCH_ROWS = 500
#: Bytes of text whose words a filter stage holds as arrays at once: several stages run in the same Python workers, which keep the most that any of them took.
PIECE = 1 << 19


def _home(spark: SparkSession) -> str:
    base = spark.conf.get(CHECKPOINT_CONF, None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors see: below spark.checkpoint.dir.

    Only where that setting is missing and Spark runs in one JVM, as in tests, a local folder serves.
    """
    path = f"{_home(spark)}/{uuid.uuid4().hex}"
    if _OWNERS:
        _OWNERS[-1].append(path)
    return path


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="adspark-llm-")


#: The folders made inside each :func:`owned` block that is open.
_OWNERS: list[list[str]] = []


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def owned(spark: SparkSession) -> Iterator[None]:
    """What is kept inside the block is deleted at its end, so results that read it must have been written by then."""
    _OWNERS.append([])
    try:
        yield
    finally:
        for path in _OWNERS.pop():
            remove(spark, path)


def drop_kept(spark: SparkSession) -> None:
    """Delete all that this application kept. Call it when the results have been written."""
    remove(spark, _home(spark))


def keep(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut, a lost executor costs a re-read."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells its rows apart whenever it is read, and the name of that column.

    Rows of a table of files have their file and place in it. Other rows are numbered in a kept copy.
    """
    name = "row"
    while name in map(str.lower, docs.columns):
        name += "_"
    if docs._jdf.queryExecution().analyzed().children().isEmpty():  # a scan
        try:
            at = docs.metadataColumn("_metadata")
            return docs.withColumn(name, F.struct(F.xxhash64(at["file_path"]).alias("file"), at["row_index"].alias("place"))), name
        except AnalysisException:
            pass
    return keep(docs.withColumn(name, F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("place")))), name


def without(docs: DataFrame, row: str, bad: DataFrame) -> DataFrame:
    """``docs`` of :func:`numbered` without the rows that ``bad`` has in its one column, and without their numbers."""
    bad = keep(bad.toDF("bad"))
    return docs.join(bad, docs[row] == bad["bad"], "left_anti").drop(row)


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of few rows, so that long texts don't fill a Python worker; and this package for the workers."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    _ship(spark.sparkContext)


@lru_cache(maxsize=8)
def _ship(context: SparkContext) -> None:
    """Send this package's code to the workers once, so that they need no PYTHONPATH."""
    root = Path(__file__).resolve().parents[1]
    name = Path(os.path.realpath(tempfile.mkdtemp(prefix="adspark-code-"))) / "adspark_code.zip"
    with zipfile.ZipFile(name, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(str(name))


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    small_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def pieces(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``most`` bytes of text, or one row if that row is longer."""
    sizes = [x or 0 for x in pc.binary_length(batch.column(column)).to_pylist()]
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield batch.slice(start)


def gathered(batches: Iterator[pa.RecordBatch], column: str, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in batches of about ``most`` bytes of text, or one row if that row is longer."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in pieces(batch, column, most):
            n = part.column(column).nbytes
            if held and size + n > most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
            held.append(part)
            size += n
    if held and sum(map(len, held)):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def joined_sha256(pieces: DataFrame, key: str, order: list[str], piece: str, glue: str) -> DataFrame:
    """``key`` and sha256 (hexadecimal) of its pieces of text in ``order``, joined by ``glue``; null pieces add nothing.

    Such a digest is serial by definition. The pieces of a key stream through one task, of which it holds one batch.
    """
    kind = dict(pieces.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state, empty = None, None, True
        for batch in batches:
            names, found = [], []
            for at, text in zip(batch.column(key).to_pylist(), batch.column(piece).to_pylist()):
                if state is None or at != name:
                    if state is not None:
                        names.append(name)
                        found.append(state.hexdigest())
                    name, state, empty = at, hashlib.sha256(), True
                if text is not None:
                    state.update((text if empty else glue + text).encode())
                    empty = False
            yield pa.RecordBatch.from_arrays([pa.array(names, batch.schema.field(key).type), pa.array(found, pa.string())], [key, "sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], batch.schema.field(key).type), pa.array([state.hexdigest()])], [key, "sha256"])

    ordered = pieces.select(key, *order, piece).repartition(key).sortWithinPartitions(key, *order)
    return map_arrow(ordered, run, f"{key} {kind}, sha256 string")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node of an edge that isn't its component's smallest node.

    Alternates large-star and small-star rounds; each edge is one row at all times, so no group is ever gathered. What a
    round needs per node is a minimum, combined before the shuffle, and is joined from a written table so
    that Spark can split a hub's rows. The number of rounds grows with the logarithm of the longest path.
    """
    pairs = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now = keep(pairs)
    state = _state(now)
    while state[0]:
        both = now.select("u", "v").unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = keep(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = keep(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.withColumnRenamed("m", "v")).distinct())
        now = keep(small)
        state, before = _state(now), state
        if state == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    """A count and a sum of hashes: equal for equal sets of edges."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                    F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return tuple(row)
