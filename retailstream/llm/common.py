"""Helpers shared by the operators: inputs, shared scratch tables, text patterns."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# white space of the word and line contracts: space and \t \n \v \f \r
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

_LOCAL_SCRATCH: dict[str, str] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a plain local session may go without the setting (tests); it gets a
    temporary folder.  Anywhere else a missing setting is an error, because a
    folder of one machine cannot be read by the others.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="llm-scratch-")
    return _LOCAL_SCRATCH[app]


def bound_batches(df: DataFrame, size: str = "8m") -> None:
    """Have the session send Python at most ``size`` of rows at a time.

    The default of 64 MB is held several times over in a worker (Arrow, Python
    strings, arrays), for each core of an executor; whole texts fill it.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage: when an executor is lost, later stages start again
    from the table.  Every call writes to a path of its own.
    """
    path = f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
