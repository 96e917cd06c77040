"""Topic and table sources (SRC-1..5).

A "topic" is a stream of JSON text rows.  Production reads Kafka
(``fmt="kafka"``, the connector jar must be on the classpath); tests and
replays read files.  Every reader returns ``value STRING`` plus ``seq`` (the
arrival order: from Kafka's offset, or a column of the file) so the same operators
run on both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from retailstream.functions.timefmt import parse_ts

MAX_PARTITIONS = 1 << 16   # of a topic


def read_topic(spark: SparkSession, where: str, streaming: bool = True, fmt: str = "parquet",
               options: dict | None = None, schema: StructType | None = None) -> DataFrame:
    """SRC-1: a JSON-text topic as ``value, seq``.

    * ``fmt="kafka"``: ``where`` is the topic name; ``options`` carry
      ``kafka.bootstrap.servers`` etc.; ``startingOffsets=latest`` by default,
      as the reference starts from the latest offset.
    * ``fmt="parquet"``/``"json"``: ``where`` is a folder of files that hold
      ``value`` and ``seq`` columns (``schema`` is required for streams).
    """
    opts = dict(options or {})
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "latest")
        df = reader.format("kafka").option("subscribe", where).options(**opts).load()
        # offsets order one partition, and a key's records are all in one: with the
        # partition's number at the end they are unique in the topic too
        seq = F.col("offset") * MAX_PARTITIONS + F.col("partition")
        return df.select(F.col("value").cast("string").alias("value"), seq.alias("seq"),
                         F.col("partition"), F.col("timestamp").alias("ingest_time"))
    r = reader.format(fmt).options(**opts)
    if schema is not None:
        r = r.schema(schema)
    return r.load(where)


def json_table(topic: DataFrame, schema: StructType, event_time, delay: str | None = None,
               view: str | None = None) -> DataFrame:
    """SRC-2: typed columns from JSON text, a computed event-time column ``rt``
    (a Column over the parsed fields), an optional watermark, and an optional
    temp view for Spark SQL (the reference's ``CREATE TABLE ... WATERMARK``)."""
    parsed = topic.select(F.from_json("value", schema).alias("r")).select("r.*")
    df = parsed.withColumn("rt", event_time)
    if delay is not None:
        df = df.withWatermark("rt", delay)
    if view:
        df.createOrReplaceTempView(view)
    return df


def event_time_or_ingest(text_col: str, ingest_col: str = "ingest_time"):
    """WM-4: event time parsed from text, falling back to the record time on a
    parse error (as TIMESTAMP for watermarks)."""
    return F.coalesce(parse_ts(text_col).cast("timestamp"), F.col(ingest_col))
