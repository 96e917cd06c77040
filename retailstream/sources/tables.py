"""Readers for the supplied parquet tables and for persisted statistics tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailstream.sources import commits

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Catalog:
    """Lazy access to the parquet tables of one scale-factor folder.

    Every read is a plain ``spark.read.parquet`` so projections and filters of the
    query above reach the scan (``ReadSchema`` / ``PushedFilters``).  A catalog
    lists each table once, so make one per query (or per micro-batch): files that
    land later are seen by the next one.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._made: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.once(name, lambda: self.spark.read.parquet(os.path.join(self.root, f"{name}.parquet")))

    def once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A DataFrame that several parts of one query share, built once."""
        if name not in self._made:
            self._made[name] = build()
        return self._made[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TEST_TABLES:
            return self.table(name)
        raise AttributeError(name)


def read_stats(spark: SparkSession, path: str, date: str | None = None) -> DataFrame:
    """SRC-6 + PRJ-13: read a statistics table written partitioned by ``dt``.

    ``date`` ('yyyy-MM-dd') becomes a partition filter, so only that day's folder
    is listed and scanned.  Of a table that micro-batches write, only the complete
    batches are read.
    """
    try:
        df = commits.read_committed(spark, path)
    except AnalysisException:   # not written in batches
        df = spark.read.parquet(path)
    dt_type = df.schema["dt"].dataType
    if date is not None:  # compare in the discovered type so the folder filter prunes
        df = df.where(F.col("dt") == F.lit(date).cast(dt_type))
    # partition discovery may type dt as a date; reports use the 'yyyy-MM-dd' text
    return df if dt_type.simpleString() == "string" else df.withColumn("dt", F.col("dt").cast("string"))


def materialize(df: DataFrame, name: str, root: str | None = None) -> DataFrame:
    """Write ``df`` as a parquet table and read it back, cutting its lineage:
    after an executor loss, later stages recompute from this table instead of
    from the raw inputs.  The default location is a folder under the shared
    ``spark.checkpoint.dir`` of the session (set by the cluster)."""
    from retailstream.session import ensure_checkpoint_dir
    path = os.path.join(root or os.path.join(ensure_checkpoint_dir(df.sparkSession), "tables"), name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
