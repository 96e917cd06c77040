"""Change-data-capture jobs: flatten envelopes (CDC-1), drop deletes (PRJ-3),
config-driven routing with a column whitelist (JN-1, PRJ-6, PRJ-7), current
state of a changelog (CDC-2) and dimension upsert (SNK-3/4).

"Latest row per key" is ``max_by(row, seq)`` in a ``groupBy`` — a partial
aggregation, so a key with a huge number of changes is pre-reduced in every
task instead of being sorted in one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from retailstream.operators.sequence import with_neighbor
from retailstream.schemas import TABLE_PROCESS


def _empty_map() -> F.Column:
    return F.create_map().cast("map<string,string>")


# Fixed values (must equal the reference's change and routing codes):
# envelope op codes -> change types (snapshot reads count as inserts, D13),
# and the config sinkType values of dimension and fact routes.
OP_TYPES = {"c": "insert", "r": "insert", "u": "update", "d": "delete"}
SINK_DIM = "hbase"
SINK_FACT = "kafka"


def flatten_changes(envelopes: DataFrame, topic: str = "topic") -> DataFrame:
    """CDC-1: ``server.db.table`` topic + op/before/after -> ``database,
    tableName, type, data, before`` (+ every other input column, e.g. seq).
    A null ``after``/``before`` becomes an empty map."""
    parts = F.split(F.col(topic), r"\.")
    t = F.lit(None).cast("string")
    for code, name in OP_TYPES.items():
        t = F.when(F.col("op") == code, name).otherwise(t)
    rest = [c for c in envelopes.columns if c not in (topic, "op", "before", "after")]
    return envelopes.select(parts.getItem(1).alias("database"), parts.getItem(2).alias("tableName"),
                            F.coalesce(t, F.lower("op")).alias("type"),
                            F.coalesce(F.col("after"), _empty_map()).alias("data"),
                            F.coalesce(F.col("before"), _empty_map()).alias("before"), *rest)


def drop_deletes(changes: DataFrame) -> DataFrame:
    """PRJ-3: remove delete records (null type is kept, as in the reference)."""
    return changes.where(F.col("type").isNull() | (F.col("type") != "delete"))


def table_process(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Routing config rows ``(sourceTable, operateType, sinkType, sinkTable,
    sinkColumns, sinkPk, sinkExtend[, seq])``; later seq wins per key."""
    schema = StructType(TABLE_PROCESS.fields + [StructField("seq", StringType())])
    rows = [tuple(r) + (None,) * (8 - len(r)) for r in rows]
    df = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows], schema)
    return df.withColumn("seq", F.col("seq").cast("long"))


def latest_config(config: DataFrame) -> DataFrame:
    """One config per ``sourceTable, operateType``: the one with the largest seq
    (or the last arrived when seq is absent: callers pass seq)."""
    cols = [c for c in config.columns if c not in ("sourceTable", "operateType")]
    order = F.coalesce(F.col("seq"), F.lit(0)) if "seq" in config.columns else F.lit(0)
    g = config.groupBy("sourceTable", "operateType").agg(F.max_by(F.struct(*cols), order).alias("c"))
    return g.select("sourceTable", "operateType", "c.*")


def dimension_sources(config: DataFrame) -> list[str]:
    """The source tables that any config sends to a dimension table (names of tables: a short list)."""
    rows = config.where(F.col("sinkType") == SINK_DIM).select("sourceTable").distinct().collect()
    return sorted(r[0] for r in rows if r[0] is not None)


def whitelist(data: str, columns: str) -> F.Column:
    """PRJ-6: keep map entries whose key is in the comma list (exact match)."""
    return F.map_filter(F.col(data), lambda k, v: F.array_contains(F.split(F.col(columns), ","), k))


ROUTES = ("fact", "dim", "unknown_sink", "no_config")


def route_changes(changes: DataFrame, config: DataFrame) -> DataFrame:
    """JN-1 + PRJ-6 + PRJ-7: attach the config of ``tableName + type``, keep the
    whitelisted columns, and label each row's ``route``: 'fact' (kafka),
    'dim' (hbase), 'unknown_sink' or 'no_config' (both dropped by the reference;
    kept here as reject outputs)."""
    cfg = latest_config(config).select(
        F.col("sourceTable").alias("_src"), F.col("operateType").alias("_op"),
        F.col("sinkType").alias("sink_type"), F.col("sinkTable").alias("sink_table"),
        F.col("sinkColumns").alias("sink_columns"), F.col("sinkPk").alias("sink_pk"))
    return _labelled(changes.join(cfg, (F.col("tableName") == F.col("_src")) & (F.col("type") == F.col("_op")), "left"))


FOREVER = (1 << 63) - 1


def config_intervals(changes: DataFrame, snapshot: DataFrame | None = None, table: str = "table_process") -> DataFrame:
    """The routing config over time: its columns and ``valid_from, valid_to`` (end excluded), by ``seq``.

    ``changes`` are the flattened change records of the config table, in one order of
    ``seq`` with the records to be routed; ``snapshot`` holds the configs from before
    the first record.  A config is valid until its ``sourceTable, operateType`` is
    set or deleted again.
    """
    names = [f.name for f in TABLE_PROCESS]
    own = changes.where(F.col("tableName") == table)
    image = F.when(F.size("data") > 0, F.col("data")).otherwise(F.col("before"))
    rows = own.select(*[image[n].alias(n) for n in names], "seq", (F.col("type") == "delete").alias("_gone"))
    if snapshot is not None:
        rows = rows.unionByName(snapshot.select(*names, F.lit(-FOREVER).alias("seq"), F.lit(False).alias("_gone")))
    along = Window.partitionBy("sourceTable", "operateType").orderBy("seq")
    return (rows.withColumn("valid_to", F.coalesce(F.lead("seq").over(along), F.lit(FOREVER)))
            .where(~F.coalesce("_gone", F.lit(False)))
            .select(*names, F.col("seq").alias("valid_from"), "valid_to"))


def route_changes_as_of(changes: DataFrame, intervals: DataFrame) -> DataFrame:
    """``route_changes`` by the config that was valid when the record came (JN-1, PRJ-7).

    A record is placed by ``seq`` in the ``intervals`` (``config_intervals``) of its
    table and type; they do not overlap, so it meets one at most.  Before its config
    came, and after it was deleted, a record has none.  The records of a table that
    holds most of them are one side of an equi-join, which is split by rows; the
    other side has one row for each change of a config.
    """
    known = intervals.select(
        F.col("sourceTable").alias("_src"), F.col("operateType").alias("_op"), F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"), F.col("sinkType").alias("sink_type"), F.col("sinkTable").alias("sink_table"),
        F.col("sinkColumns").alias("sink_columns"), F.col("sinkPk").alias("sink_pk"))
    met = ((F.col("tableName") == F.col("_src")) & (F.col("type") == F.col("_op"))
           & (F.col("seq") >= F.col("_from")) & (F.col("seq") < F.col("_to")))
    return _labelled(changes.join(known, met, "left")).drop("_from", "_to")


def _labelled(joined: DataFrame) -> DataFrame:
    """``route`` and whitelisted ``data`` of records joined to their config (or none)."""
    route = (F.when(F.col("_src").isNull(), "no_config").when(F.col("sink_type") == SINK_FACT, "fact")
             .when(F.col("sink_type") == SINK_DIM, "dim").otherwise("unknown_sink"))
    data = F.when(F.col("sink_columns").isNotNull(), whitelist("data", "sink_columns")).otherwise(F.col("data"))
    return joined.withColumns({"data": data, "route": route}).drop("_src", "_op")


def split_routes(routed: DataFrame) -> dict[str, DataFrame]:
    return {r: routed.where(F.col("route") == r) for r in ROUTES}


def latest_per_key(df: DataFrame, keys: Sequence[str], seq: str = "seq") -> DataFrame:
    """The row with the largest ``seq`` per key (partial aggregation)."""
    others = [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.col(seq)).alias("_last"))
    return g.select(*keys, "_last.*")


def keyed_changes(changes: DataFrame, pk: str = "id") -> DataFrame:
    """Flattened changes with ``pk``, the key of the changed row (from its image before, if there is none after)."""
    return changes.withColumn("pk", F.coalesce(F.col("data")[pk], F.col("before")[pk])).where(
        F.col("pk").isNotNull() & F.col("seq").isNotNull())


SEQ_BUCKET = 1 << 20   # changes of a key that are compared in one task, at most


def changelog_retractions(changes: DataFrame, pk: str = "id", bucket: int = SEQ_BUCKET) -> DataFrame:
    """CDC-2 as a changelog: ``tableName, pk, seq, kind, data`` for the whole feed.

    What ``streaming.processors.changelog_stream`` gives for the feed in order: an
    image that a change replaces is taken back (``-U``, ``-D``), the new one is given
    (``+I``, ``+U``).  Each change sets the whole row, so the one before it (by
    ``seq``) tells all; a key with very many changes is cut into ranges of ``seq``.
    """
    rows = keyed_changes(changes, pk).select(
        "tableName", "pk", "seq", F.when(F.coalesce("type", F.lit("")) != "delete", F.col("data")).alias("image"))
    # maps cannot be compared: their sorted entries can
    rows = rows.withColumn("flat", F.array_sort(F.map_entries("image")))
    near = with_neighbor(rows, ["tableName", "pk"], ["seq"], F.floor(F.col("seq") / bucket), ["flat"], "prev", "was_")
    gone, none = F.col("flat").isNull(), F.col("was_flat").isNull()
    out = near.where(~F.col("flat").eqNullSafe(F.col("was_flat"))).withColumn("out", F.array(
        F.when(~none, F.struct(F.when(gone, "-D").otherwise("-U").alias("kind"), F.map_from_entries("was_flat").alias("data"))),
        F.when(~gone, F.struct(F.when(none, "+I").otherwise("+U").alias("kind"), F.col("image").alias("data")))))
    return (out.select("tableName", "pk", "seq", F.explode(F.filter("out", lambda x: x.isNotNull())).alias("o"))
            .select("tableName", "pk", "seq", "o.kind", "o.data"))


def changelog_state(changes: DataFrame, pk: str = "id", table: str = "tableName") -> DataFrame:
    """CDC-2: current state of every table in a flattened changelog: the last
    change per (table, pk) by seq; keys whose last change is a delete vanish."""
    keyed = changes.withColumn("_pk", F.coalesce(F.col("data")[pk], F.col("before")[pk]))
    last = latest_per_key(keyed, [table, "_pk"])
    return last.where(F.col("type").isNull() | (F.col("type") != "delete")).drop("_pk")


def dim_schema(sink_columns: str, sink_pk: str | None = None) -> StructType:
    """SNK-4: the all-string schema of a dimension table (pk defaults to 'id';
    the extension clause is a storage-engine option and is ignored)."""
    cols = [c for c in sink_columns.split(",")]
    pk = sink_pk or "id"
    if pk not in cols:
        cols = [pk] + cols
    return StructType([StructField(c, StringType()) for c in cols])


PRESENT = "_present"   # names of the columns that a change carries


def dim_rows(routed_dim: DataFrame, columns: Sequence[str], sink_table: str | None = None) -> DataFrame:
    """Project routed dimension changes to ``columns`` (strings) + seq + type +
    the names of the columns each change carries."""
    x = routed_dim if sink_table is None else routed_dim.where(F.col("sink_table") == sink_table)
    return x.select(*[F.col("data")[c].alias(c) for c in columns], "seq", "type", F.map_keys("data").alias(PRESENT))


def upsert_dimension(current: DataFrame | None, changes: DataFrame, pk: str = "id",
                     seq: str = "seq") -> DataFrame:
    """SNK-3 (batch form): new table state from the current rows and the changes.

    A change sets the columns it carries and leaves the others as they were (all
    columns, if it does not say which); the latest ``seq`` wins column by column,
    and values from before a key's last delete are gone (D6).  Columns that only
    one of the two tables has are kept.  One partial aggregation by key.
    """
    own = [c for c in changes.columns if c not in (pk, seq, "type", PRESENT)]
    extra = [c for c in current.columns if c not in (pk, seq, *own)] if current is not None else []
    cols = own + extra
    names = F.array(*[F.lit(c) for c in own]).cast("array<string>")
    rows = changes.select(pk, seq, F.coalesce("type", F.lit("")).alias("type"), *own,
                          *[F.lit(None).cast("string").alias(c) for c in extra],
                          (F.col(PRESENT) if PRESENT in changes.columns else names).alias(PRESENT))
    if current is not None:
        there = [c for c in cols if c in current.columns]
        rows = rows.unionByName(current.select(
            pk, seq, F.lit("").alias("type"),
            *[F.col(c) if c in there else F.lit(None).cast("string").alias(c) for c in cols],
            F.array(*[F.lit(c) for c in there]).cast("array<string>").alias(PRESENT)))
    upsert = F.col("type") != "delete"
    latest = rows.groupBy(pk).agg(
        F.max(F.when(upsert, F.col(seq))).alias("_last"), F.max(F.when(~upsert, F.col(seq))).alias("_gone"),
        *[F.max_by(F.struct(F.col(c).alias("v"), F.col(seq).alias("s")),
                   F.when(upsert & F.array_contains(PRESENT, c), F.col(seq))).alias(c) for c in cols])
    alive = F.col("_last").isNotNull() & (F.col("_gone").isNull() | (F.col("_last") > F.col("_gone")))
    since = lambda c: F.col("_gone").isNull() | (F.col(c)["s"] > F.col("_gone"))
    order = [c for c in changes.columns if c not in ("type", PRESENT)] + extra
    out = {pk: F.col(pk), seq: F.col("_last").alias(seq),
           **{c: F.when(since(c), F.col(c)["v"]).alias(c) for c in cols}}
    return latest.where(alive).select(*[out[c] for c in order])


def fold_changes(changes: DataFrame, pk: str = "id", seq: str = "seq") -> DataFrame:
    """Changes of dimension rows (as for ``upsert_dimension``) as one row for each key, to be merged with
    others: ``_last`` and ``_gone``, the largest seq that set and that deleted the key, and for each column
    the last value (as text) that a change carried, with its seq (``s``, ``v``)."""
    cols = [c for c in changes.columns if c not in (pk, seq, "type", PRESENT)]
    upsert = F.coalesce("type", F.lit("")) != "delete"
    def carried(c: str) -> Column:
        return upsert & F.array_contains(PRESENT, c) if PRESENT in changes.columns else upsert
    return changes.groupBy(F.col(pk).cast("string").alias(pk)).agg(
        F.max(F.when(upsert, F.col(seq))).alias("_last"), F.max(F.when(~upsert, F.col(seq))).alias("_gone"),
        *[F.max(F.when(carried(c), F.struct(F.col(seq).alias("s"), F.col(c).cast("string").alias("v")))).alias(c)
          for c in cols])


def merge_folded(rows: DataFrame, pk: str = "id") -> DataFrame:
    """Folded rows of the same keys, in any number and order, as one for each key."""
    return rows.groupBy(pk).agg(*[F.max(c).alias(c) for c in rows.columns if c != pk])


def folded_state(rows: DataFrame, pk: str = "id", seq: str = "seq") -> DataFrame:
    """The dimension rows that folded ones stand for: pk, columns, seq; deleted keys are gone, and so are
    values from before a key's last delete."""
    alive = F.col("_last").isNotNull() & (F.col("_gone").isNull() | (F.col("_last") > F.col("_gone")))
    cols = [c for c in rows.columns if c not in (pk, "_last", "_gone")]
    return rows.where(alive).select(
        pk, *[F.when(F.col("_gone").isNull() | (F.col(c)["s"] > F.col("_gone")), F.col(c)["v"]).alias(c) for c in cols],
        F.col("_last").alias(seq))


def snapshot_then_changes(snapshot: DataFrame, changes: DataFrame, pk: str = "id", table: str | None = None,
                          snapshot_seq: int = -1) -> DataFrame:
    """SRC-4: a table's snapshot (plain columns) followed by its flattened
    change records -> current state (CDC-2).  Snapshot rows become inserts
    ordered before every change (``snapshot_seq``)."""
    cols = [c for c in snapshot.columns]
    snap = snapshot.select(
        F.lit(None).cast("string").alias("database"),
        (F.lit(table) if table else F.lit(None)).cast("string").alias("tableName"),
        F.lit("insert").alias("type"),
        F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).cast("string"))]).alias("data"),
        F.create_map().cast("map<string,string>").alias("before"),
        F.lit(snapshot_seq).cast("long").alias("seq"))
    ch = changes.select("database", "tableName", "type", "data", "before", "seq")
    if table:
        ch = ch.where(F.col("tableName") == table)
        snap = snap.withColumn("tableName", F.lit(table))
    return changelog_state(snap.unionByName(ch), pk=pk)


def routing_config(snapshot: DataFrame, changes: DataFrame, table: str = "table_process") -> DataFrame:
    """The routing config as it stands: the config table's snapshot, then its change
    records (flattened), by ``sourceTable, operateType``; deleted configs are gone.
    For the ``load_config`` of the router job."""
    def keyed(m: F.Column) -> F.Column:
        return F.when(F.size(m) > 0, F.map_concat(m, F.create_map(
            F.lit("_key"), F.concat_ws(":", m["sourceTable"], m["operateType"])))).otherwise(m)
    snap = snapshot.withColumn("_key", F.concat_ws(":", "sourceTable", "operateType"))
    own = changes.where(F.col("tableName") == table).withColumns(
        {"data": keyed(F.col("data")), "before": keyed(F.col("before"))})
    st = snapshot_then_changes(snap, own, pk="_key", table=table)
    return st.select(*[F.col("data")[f.name].alias(f.name) for f in TABLE_PROCESS], "seq")


def register_current_state(changes: DataFrame, view: str, columns: Sequence[str], pk: str = "id",
                           table: str | None = None) -> DataFrame:
    """SRC-5: expose the current state of a changelog as a SQL view with typed
    columns (strings), to be queried with ``spark.sql`` like the reference's
    CDC table."""
    st = changelog_state(changes if table is None else changes.where(F.col("tableName") == table), pk=pk)
    out = st.select(*[F.col("data")[c].alias(c) for c in columns])
    out.createOrReplaceTempView(view)
    return out
