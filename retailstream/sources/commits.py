"""Which micro-batches of a file topic are complete.

A micro-batch's files go to a folder named by the query and the batch, so a job
that starts over with a new checkpoint (a new query id, batches from 0 again)
never writes over what an earlier run left.  When all files are there, an entry
in ``_commits`` lists the folder; ``read_committed`` reads listed folders only, so
a half-written batch is never seen.  A replay of a listed batch writes nothing; a
replay of one that broke off before it was listed writes it anew.

The entry of a batch has a path of its own, so knowing whether a batch is listed
does not depend on how many there are.  Readers that watch the topic's folder
as a stream of files see a broken-off batch's files too, and again on its replay.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

COMMITS = "_commits"
ENTRY = "folder string, run string, batch_id long"


def folder_name(batch_id: int, run: str | None) -> str:
    return f"batch={batch_id}" if run is None else f"batch={run}-{batch_id}"


def _entry(where: str, batch_id: int, run: str | None) -> str:
    return os.path.join(where, COMMITS, f"run={run}", f"id={batch_id}")


def is_committed(spark: SparkSession, where: str, batch_id: int, run: str | None) -> bool:
    try:
        return bool(spark.read.schema(ENTRY).parquet(_entry(where, batch_id, run)).take(1))
    except AnalysisException:   # no such entry
        return False


def write_batch(df: DataFrame, where: str, batch_id: int, run: str | None = None, fmt: str = "parquet",
                partition_by: Sequence[str] = ()) -> bool:
    """Write a micro-batch once: False if it was there already.

    ``run`` is the id of the streaming query.  Without one, a batch is only known by
    its number, and a later batch of that number replaces it.
    """
    spark = df.sparkSession
    if run is not None and is_committed(spark, where, batch_id, run):
        return False
    name = folder_name(batch_id, run)
    df.write.mode("overwrite").partitionBy(*partition_by).format(fmt).save(os.path.join(where, name))
    (spark.createDataFrame([(name, run, batch_id)], ENTRY).coalesce(1)
     .write.mode("overwrite").parquet(_entry(where, batch_id, run)))
    return True


def committed(spark: SparkSession, where: str) -> list[str]:
    """The listed folders, by query and batch."""
    rows = spark.read.schema(ENTRY).option("recursiveFileLookup", "true").parquet(os.path.join(where, COMMITS)).collect()
    return [r["folder"] for r in sorted(rows, key=lambda r: (r["run"] or "", r["batch_id"]))]


def read_committed(spark: SparkSession, where: str, fmt: str = "parquet",
                   schema: StructType | str | None = None) -> DataFrame:
    """The rows of all complete batches (with their folder as ``batch``)."""
    reader = spark.read.format(fmt).option("basePath", where)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load([os.path.join(where, f) for f in committed(spark, where)])
