"""CSV input and listings of delivered files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from adspark.stage import written_with

CORRUPT = "_corrupt_record"


class BadRowsError(RuntimeError):
    """More rows could not be read than the budget allows."""


def read_csv(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Headered CSV with a declared schema. A malformed row fails the job."""
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
            .options(**options).csv(path))


def _permissive(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    with_bad = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(with_bad).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("escape", "\\")
            .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
            .options(**options).csv(path))


def read_csv_tolerant(spark: SparkSession, path: str, schema: T.StructType,
                      max_errors: int, **options) -> tuple[DataFrame, DataFrame]:
    """The readable rows of a CSV, and the text of the rejected ones, at most ``max_errors``.

    Parsed once, into a written table, and the rejected rows are counted on the way: Spark refuses to query the column of broken
    rows alone on the raw file, because nothing else would be parsed then.
    """
    parsed = _permissive(spark, path, schema, **options)
    parsed, seen = written_with(parsed, bad=F.count(CORRUPT))
    bad = seen["bad"]
    if bad > max_errors:
        raise BadRowsError(f"{bad} bad rows in {path}, at most {max_errors} allowed")
    return (parsed.where(F.col(CORRUPT).isNull()).select(*[F.col(f.name) for f in schema]),
            parsed.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("rejected")))


def report_manifest(spark: SparkSession, folder: str, name_pattern: str = "*.csv") -> DataFrame:
    """Files delivered per destination folder. Only names and sizes are read, not the contents."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", name_pattern)
            .option("recursiveFileLookup", True).load(folder)
            .select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("destination"),
                    F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
                    F.col("length").alias("bytes"))
            .groupBy("destination")
            .agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes")))
