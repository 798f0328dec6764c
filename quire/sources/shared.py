"""The folder that driver and executors share, and tables written there."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import NullType


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
    of few values that has a folder for each, so that a filter on it reads only those. Columns of no type become strings."""
    spark = df.sparkSession
    untyped = {f.name: F.lit(None).cast("string") for f in df.schema if isinstance(f.dataType, NullType)}
    df = df.withColumns(untyped) if untyped else df
    (df.write.partitionBy(by) if by else df.write).parquet(path := scratch(spark, what))
    return spark.read.schema(df.schema).parquet(path)
