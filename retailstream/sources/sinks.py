"""Sinks (SNK-1..6).  File sinks write a micro-batch once: its folder is named by
the query and the batch and listed when it is complete (``sources.commits``), so
a replay never duplicates rows and a new checkpoint never writes over old ones.
The Kafka and JDBC forms are at-least-once: a replayed batch is sent again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from retailstream.sources import commits, dimstore


def to_json_value(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Row -> ``value`` JSON text (null fields omitted, FN-13)."""
    return df.select(F.to_json(F.struct(*(cols or df.columns))).alias("value"))


def write_topic(df: DataFrame, where: str, fmt: str = "parquet", batch_id: int | None = None,
                options: dict | None = None, run: str | None = None) -> None:
    """SNK-1 (batch / inside foreachBatch): append JSON rows to a topic.
    Files: a folder of ``where`` for each batch of the query ``run``; Kafka: topic name."""
    out = to_json_value(df)
    if fmt == "kafka":
        out.write.format("kafka").option("topic", where).options(**(options or {})).save()
        return
    if batch_id is None:
        out.write.mode("append").format(fmt).save(where)
    else:
        commits.write_batch(out, where, batch_id, run, fmt)


def write_routed(df: DataFrame, where: str, topic_col: str = "sink_table", payload: str = "data",
                 fmt: str = "parquet", batch_id: int | None = None, options: dict | None = None,
                 run: str | None = None) -> None:
    """SNK-2: each row goes to the topic named in ``topic_col``; payload = the
    ``payload`` map only, as JSON.  Kafka uses the per-row ``topic`` column
    (at-least-once); files are partitioned by topic."""
    out = df.select(F.col(topic_col).alias("topic"), F.to_json(F.col(payload)).alias("value"))
    if fmt == "kafka":
        out.write.format("kafka").options(**(options or {})).save()
        return
    if batch_id is None:
        out.write.mode("append").partitionBy("topic").format(fmt).save(where)
    else:
        commits.write_batch(out, where, batch_id, run, fmt, ["topic"])


def ensure_dim_table(spark: SparkSession, path: str, schema: StructType, pk: str | None = None) -> DataFrame:
    """SNK-4: create an empty dimension table with ``schema`` if missing; return it.  The key is ``pk``, by
    default ``id`` or else the first column."""
    names = schema.fieldNames()
    dimstore.create(spark, path, names, pk or ("id" if "id" in names else names[0]))
    return dimstore.read(spark, path)


def read_dimension(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A version of a dimension table, by default the current one."""
    return dimstore.read(spark, path, version)


def upsert_dimension_table(spark: SparkSession, changes: DataFrame, path: str, pk: str = "id",
                           token: str | int | None = None, compact_at: int = 16) -> int:
    """SNK-3: add ``changes`` (dimension columns, ``seq``, ``type`` and, where changes carry only some columns,
    ``_present``) to the table at ``path``; the number of the run that holds them.

    Only the changed keys are written.  ``token`` names the batch (query and batch
    id): a replay adds nothing.  Buckets that have ``compact_at`` runs are merged.
    """
    no = dimstore.apply(spark, changes, path, token)
    dimstore.compact(spark, path, compact_at)
    return no


def write_stats(df: DataFrame, path: str, columns: Sequence[str], batch_id: int | None = None,
                run: str | None = None) -> None:
    """SNK-5: append result rows with an explicit column list (transient
    helper columns are never written), partitioned by ``dt`` = day of ``stt``,
    so day reports prune to one folder."""
    out = df.select(*columns).withColumn("dt", F.substring("stt", 1, 10))
    if batch_id is None:
        out.write.mode("append").partitionBy("dt").parquet(path)
    else:
        commits.write_batch(out, path, batch_id, run, partition_by=["dt"])


def write_stats_jdbc(df: DataFrame, url: str, table: str, columns: Sequence[str], batch_size: int = 5,
                     properties: dict | None = None) -> None:
    """SNK-5, SQL-store form: append by explicit column order with the JDBC
    batch size as a parameter (the reference uses 5).  The endpoint and
    credentials are arguments; nothing is hard-coded."""
    df.select(*columns).write.option("batchsize", batch_size).jdbc(url, table, mode="append",
                                                                   properties=properties or {})


class LateRows(StreamingQueryListener):
    """LT-1: all rows that the watermark dropped as late, by query id, from the
    progress of every batch (the reference loses them silently).  Add it with
    ``spark.streams.addListener`` before the queries start."""

    def __init__(self):
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        key = str(event.progress.id)
        self.dropped[key] = self.dropped.get(key, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def console(df: DataFrame, name: str):
    """SNK-6: debug print of a stream."""
    return df.writeStream.format("console").option("truncate", "false").queryName(name)
