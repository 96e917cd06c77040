"""Dimension tables that take changes without being rewritten (SNK-3).

A table is a folder of *runs*.  A run holds, per bucket (a hash of the key), one
row for each key that its batch changed, sorted by key: the largest ``seq`` that
set the key, the largest that deleted it, and for each column its last value and
the ``seq`` of that (``cdc.fold_changes``).  Rows of one key from any number of runs
merge by largest ``seq``, in any order and as often as one likes, so the table is
merged when it is read, and a batch of k keys writes at most k files.

Compaction merges the runs of the buckets that have many into a *base* run, which
replaces them there; buckets with a single run are read as they are, without a
shuffle.  ``_runs`` lists the finished runs with their columns and buckets: a
reader takes the listed ones only, and columns may be added by any batch.  One
writer at a time.
"""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from retailstream.operators import cdc

BUCKETS = 32
RUN = "no long, token string, base boolean, pk string, n_buckets int, columns array<string>, buckets array<int>"


def _bucket(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(n)).cast("int")


def runs(spark: SparkSession, path: str, version: int | None = None) -> list[Row]:
    """The finished runs up to ``version`` (default: all), one entry a batch."""
    rows = spark.read.schema(RUN).option("recursiveFileLookup", "true").parquet(os.path.join(path, "_runs")).collect()
    return sorted((r for r in rows if version is None or r["no"] <= version), key=lambda r: r["no"])


def _list(spark: SparkSession, path: str, *entry) -> None:
    """Add a run; its entry is replaced as a whole when a broken-off batch is written again."""
    spark.createDataFrame([entry], RUN).coalesce(1).write.mode("overwrite").parquet(
        os.path.join(path, "_runs", f"no={entry[0]}"))


def create(spark: SparkSession, path: str, columns: Sequence[str], pk: str = "id", n_buckets: int = BUCKETS) -> None:
    """An empty table, if there is none at ``path`` (SNK-4)."""
    try:
        runs(spark, path)
    except AnalysisException:
        _list(spark, path, 0, None, True, pk, n_buckets, [c for c in columns if c != pk], [])


def _columns(entries: Sequence[Row]) -> list[str]:
    return list(dict.fromkeys(c for e in entries for c in e["columns"]))


def _schema(pk: str, columns: Sequence[str]) -> StructType:
    value = StructType([StructField("s", LongType()), StructField("v", StringType())])
    return StructType([StructField(pk, StringType()), StructField("_last", LongType()), StructField("_gone", LongType()),
                       *[StructField(c, value) for c in columns], StructField("key_bucket", IntegerType())])


def live(entries: Sequence[Row]) -> dict[int, list[int]]:
    """Per bucket, the runs that hold its rows: the last base and the batches after it."""
    out: dict[int, list[int]] = defaultdict(list)
    for e in entries:
        for b in e["buckets"]:
            out[b] = [e["no"]] if e["base"] else [*out[b], e["no"]]
    return dict(out)


def _rows(spark: SparkSession, path: str, entries: Sequence[Row], held: dict[int, list[int]]) -> DataFrame:
    schema = _schema(entries[0]["pk"], _columns(entries))
    folders = [f"{path}/data/run={no}/key_bucket={b}" for b, nos in sorted(held.items()) for no in nos]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).select(*schema.fieldNames())


def _write_run(spark: SparkSession, rows: DataFrame, path: str, no: int, token: str | None, base: bool, first: Row,
               columns: Sequence[str]) -> None:
    pk, folder = first["pk"], f"{path}/data/run={no}"
    out = rows.withColumn("key_bucket", _bucket(F.col(pk), first["n_buckets"])).where(F.col(pk).isNotNull())
    (out.repartition("key_bucket").sortWithinPartitions("key_bucket", pk)
     .write.mode("overwrite").partitionBy("key_bucket").parquet(folder))
    there = spark.read.schema(_schema(pk, columns)).parquet(folder).select("key_bucket").distinct().collect()
    _list(spark, path, no, token, base, pk, first["n_buckets"], list(columns), sorted(r["key_bucket"] for r in there))


def apply(spark: SparkSession, changes: DataFrame, path: str, token: str | int | None = None) -> int:
    """Add a batch of ``changes`` (pk, ``seq``, ``type``, columns and, where changes carry only
    some of them, ``_present``) as a run; its number.  A batch whose ``token`` is listed is there already.
    Rows without a key are left out.  New columns are added to the table."""
    entries = runs(spark, path)
    token = None if token is None else str(token)
    for e in entries:
        if token is not None and e["token"] == token:
            return e["no"]
    pk, no = entries[0]["pk"], entries[-1]["no"] + 1
    folded = cdc.fold_changes(changes, pk)
    columns = [c for c in folded.columns if c not in (pk, "_last", "_gone")]
    _write_run(spark, folded, path, no, token, False, entries[0], columns)
    return no


def has(spark: SparkSession, path: str, token: str | int) -> bool:
    """Whether the batch named ``token`` is in the table; False also where there is no table."""
    try:
        return any(e["token"] == str(token) for e in runs(spark, path))
    except AnalysisException:
        return False


def lookup(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """The rows of ``keys`` (one column, distinct): pk, columns, ``seq``.

    Buckets without any of the keys are not read, and rows of other keys go before
    runs are merged, so what moves follows the keys, not the table.
    """
    entries = runs(spark, path)
    pk = entries[0]["pk"]
    keys = keys.select(F.col(keys.columns[0]).cast("string").alias(pk))
    own = {r[0] for r in keys.select(_bucket(F.col(pk), entries[0]["n_buckets"])).distinct().collect()}
    held = {b: nos for b, nos in live(entries).items() if b in own}
    rows = _rows(spark, path, entries, held).drop("key_bucket").join(keys, pk, "left_semi")
    return cdc.folded_state(cdc.merge_folded(rows, pk), pk)


def read(spark: SparkSession, path: str, version: int | None = None, keys: Sequence[str] | None = None) -> DataFrame:
    """The table after run ``version`` (default: as it is): pk, columns, ``seq``.  With ``keys``, only their
    buckets are read."""
    entries = runs(spark, path, version)
    pk, held = entries[0]["pk"], live(entries)
    if keys is not None:
        wanted = spark.createDataFrame([(str(k),) for k in keys], "k string")
        own = {r[0] for r in wanted.select(_bucket(F.col("k"), entries[0]["n_buckets"])).distinct().collect()}
        held = {b: nos for b, nos in held.items() if b in own}
    single = {b: nos for b, nos in held.items() if len(nos) == 1}
    several = {b: nos for b, nos in held.items() if len(nos) > 1}
    rows = _rows(spark, path, entries, single).drop("key_bucket")
    if several:
        rows = rows.unionByName(cdc.merge_folded(_rows(spark, path, entries, several).drop("key_bucket"), pk))
    out = cdc.folded_state(rows, pk)
    return out if keys is None else out.where(F.col(pk).isin([str(k) for k in keys]))


def compact(spark: SparkSession, path: str, least_runs: int = 8) -> int | None:
    """Merge the runs of every bucket that has at least ``least_runs``; the base run's number, if one was needed."""
    entries = runs(spark, path)
    held = {b: nos for b, nos in live(entries).items() if len(nos) >= max(2, least_runs)}
    if not held:
        return None
    merged = cdc.merge_folded(_rows(spark, path, entries, held).drop("key_bucket"), entries[0]["pk"])
    no = entries[-1]["no"] + 1
    _write_run(spark, merged, path, no, None, True, entries[0], _columns(entries))
    return no


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Delete the files that base runs have replaced (older versions can no longer be read); how many folders."""
    entries = runs(spark, path)
    used = {(no, b) for b, nos in live(entries).items() for no in nos}
    old = [(e["no"], b) for e in entries for b in e["buckets"] if (e["no"], b) not in used]
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    dropped = 0
    for no, b in old:
        folder = hadoop(f"{path}/data/run={no}/key_bucket={b}")
        dropped += folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return dropped
