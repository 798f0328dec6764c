"""Shared helpers: the shared scratch folder, lineage cuts and Arrow plumbing."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Characters that separate words everywhere in this subpackage.
SPACES = r"\x20\x09-\x0D"
WORD = rf"[^{SPACES}]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only where the driver is the whole cluster, an unset one is
    replaced by a folder of our own, which goes when Python ends."""
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if where:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(where)
        return where
    if sc.getCheckpointDir() is None:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir is unset: the driver and the executors need a folder that they share")
        own = tempfile.mkdtemp(prefix="quire-")
        atexit.register(shutil.rmtree, own, True)
        sc.setCheckpointDir(own)
    return sc.getCheckpointDir()


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, what: str, by: str | None = None) -> DataFrame:
    """df written as Parquet to the shared folder and read again: cuts the lineage, and survives the loss of executors. by: a column
    of few values that has a folder for each, so that a filter on it reads only those."""
    spark = df.sparkSession
    (df.write.partitionBy(by) if by else df.write).parquet(path := scratch(spark, what))
    return spark.read.schema(df.schema).parquet(path)


def pinned(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of a small result."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def small(df: DataFrame, most: int = 400_000) -> DataFrame:
    """df, marked for broadcast if it has at most most rows (which the caller keeps narrow); it should be pinned, as it is counted."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def free(columns: list[str], prefix: str) -> list[str]:
    """columns, of which those that begin with an operator's own prefix have other names that clash with none."""
    return [f"~{k}~{c}" if c.startswith(prefix) else c for k, c in enumerate(columns)]


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most so many rows from here on in this session, for queries over whole texts: the default of 10,000 long
    texts is held several times over by each task and its worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def arrow_map(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(f, schema)


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 of a string column, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def crc_mod(column: str, n: int):
    """crc32 of the id written as text, modulo n; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n
