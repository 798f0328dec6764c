"""Scans and sinks: input files, result files, reports."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quire.constants import SIDECARS
from quire.functions.media import is_listed, kind_of, mime_of, too_large
from quire.functions.text import name, stem


def listed_files(spark: SparkSession, uri: str, recursive: bool = False, most: int | None = None) -> DataFrame:
    """(path, filename, length) of the supported files under uri, sorted by path; contents aren't read.

    Works for every file system that Spark reads; recursive is for object stores, whose prefixes have no folders.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(uri).drop("content")
    out = files.where(is_listed(F.col("path"))).select("path", name(F.col("path")).alias("filename"), "length").orderBy("path")
    return out if most is None else out.limit(most)


def admitted(files: DataFrame, most_mb: float = 200) -> DataFrame:
    """files with kind, mime and rejection (input_too_large, unsupported_type or null). A filter on it comes before any read."""
    out = files.withColumn("mime", mime_of(F.col("path")))
    out = out.withColumn("kind", kind_of(F.col("path"), F.col("mime")))
    return out.withColumn("rejection", F.when(too_large(F.col("length"), most_mb), "input_too_large").when(F.col("kind") == "unknown", "unsupported_type"))


def contents(spark: SparkSession, uri: str, most_mb: float = 200, recursive: bool = False) -> DataFrame:
    """(path, length, content) of the files under uri within the size cap; the cap is pushed to the scan."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(uri)
    kept = files.where(F.col("length") <= int(most_mb * 1024 * 1024)) if most_mb > 0 else files
    return kept.where(is_listed(F.col("path"))).select("path", "length", "content")


def digests(files: DataFrame) -> DataFrame:
    """files (content) with sha256."""
    return files.withColumn("sha256", F.sha2("content", 256)).drop("content")


def bucket_and_key(uri: Column) -> Column:
    """(bucket, key) of an object store's URI."""
    return F.struct(F.try_parse_url(uri, F.lit("HOST")).alias("bucket"), F.regexp_replace(F.coalesce(F.try_parse_url(uri, F.lit("PATH")), F.lit("")), "^/", "").alias("key"))


def write_each(df: DataFrame, folder: str, body: str = "markdown", key: str = "doc_id", suffix: str = ".md") -> DataFrame:
    """Writes a file <key><suffix> for each row into folder and returns (path, bytes).

    By pyarrow's file systems, from the executors; a row written twice by a repeated task gives the same file. The returned frame is
    lazy: nothing is written before an action, and each action writes again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        for b in batches:
            paths, sizes = [], []
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                data = (text or "").encode()
                with system.open_output_stream(path := f"{base}/{k}{suffix}") as out:
                    out.write(data)
                paths.append(path)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], ["path", "bytes"])

    return df.select(F.col(key).cast("string"), F.col(body).cast("string")).mapInArrow(run, "path string, bytes long")


def write_json(df: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """Writes each row as <key>.json, indented; see write_each."""
    return write_each(df.select(F.col(key).alias(key), F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"}).alias("_body")), folder, "_body", key, ".json")


ROUTE_COLUMNS = ("doc_id", "route", "pages", "vlm_pages", "throttled_pages", "routes", "reason")


def write_route_csv(records: DataFrame, path: str) -> None:
    """Route records as CSV with a header, in the fixed columns. One file for a report of one row a document; drop coalesce for more."""
    records.select(*ROUTE_COLUMNS).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_route_csv(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, route): the two columns that reports need."""
    schema = ", ".join(f"{c} {'long' if c in ('pages', 'vlm_pages', 'throttled_pages') else 'string'}" for c in ROUTE_COLUMNS)
    return spark.read.schema(schema).option("header", True).csv(path).select("doc_id", "route")


RESULT = T.StructType([
    T.StructField("markdown", T.StringType()),
    T.StructField("page_routes", T.ArrayType(T.StructType([
        T.StructField("page_index", T.IntegerType()), T.StructField("route", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("n_chars", T.LongType()),
        T.StructField("engine_quality_passes", T.BooleanType()), T.StructField("vlm_quality_passes", T.BooleanType()),
    ]))),
    T.StructField("_corrupt", T.StringType()),
])


def read_results(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(page routes, skipped files) of the result JSONs in folder; side files are left out, and broken ones are in the second."""
    raw = spark.read.schema(RESULT).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(folder).withColumn("path", F.input_file_name())
    raw = raw.where(~name(F.col("path")).isin(*SIDECARS))
    good = raw.where("page_routes IS NOT NULL").select(stem(F.col("path")).alias("doc_id"), F.explode("page_routes").alias("r")).select("doc_id", "r.*")
    return good, raw.where("page_routes IS NULL").select("path", F.when(F.col("_corrupt").isNotNull(), "bad_json").otherwise("no_routes").alias("why"))


def read_grades_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the grader's CSV with the last name in folder."""
    files = spark.read.format("binaryFile").load(folder).where(F.lower("path").endswith(".csv")).agg(F.max("path")).first()[0]
    return spark.read.option("header", True).csv(files)


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value) of log files; line_no rises within a file and in the order of files."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), "value")
