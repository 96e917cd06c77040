"""Exact distinct counts that can be merged (AG-2, AG-8): sets of ids beside a window row.

``count(distinct)`` of a window cannot be added to another's.  Here a window row's
ids are kept as *containers*: ids are cut into buckets of 32,768
(``bitmap_bucket_number``), and a bucket's ids are a sorted array of 2-byte positions
while they are few, a 4 KB bitmap beyond that, so that neither many thin windows nor
one dense one is large.  Containers of any windows, and of any groups of keys, merge
into those of the whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ARRAY_MAX = 2048   # positions of 2 bytes: as large as a bitmap


def _bitmaps(sets: DataFrame, group: Sequence[str]) -> DataFrame:
    return (sets.select(*group, F.explode("ids").alias("pos")).groupBy(*group)
            .agg(F.bitmap_construct_agg(F.col("pos").cast("long")).alias("bits")))


def _union(arrays: DataFrame, bitmaps: DataFrame, group: Sequence[str]) -> DataFrame:
    return arrays.select(*group, F.array_sort("ids").alias("ids")).unionByName(
        bitmaps.select(*group, "bits"), allowMissingColumns=True)


def containers(rows: DataFrame, by: Sequence[str], id_col: str) -> DataFrame:
    """``{by}, bucket, ids, bits``: the distinct ids (whole numbers) of each group, as
    ``ids`` or ``bits``.  Null ids are in no set; rows with a null in ``by`` are left out."""
    group = [*by, "bucket"]
    x = rows.dropna(subset=[*by, id_col]).select(
        *by, F.bitmap_bucket_number(id_col).alias("bucket"), F.bitmap_bit_position(id_col).cast("short").alias("pos"))
    # a set holds at most a bucket's 32,768 positions, however many rows there are
    sets = x.groupBy(*group).agg(F.collect_set("pos").alias("ids"))
    large = F.size("ids") > ARRAY_MAX
    return _union(sets.where(~large), _bitmaps(sets.where(large), group), group)


def merge(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Containers of ``parts`` united by ``by``, columns of ``parts`` that are coarser than
    those they were made by."""
    group = [*by, "bucket"]
    parts = parts.dropna(subset=list(by))
    dense = parts.where("bits IS NOT NULL").select(*group, "bits")
    sets = (parts.where("ids IS NOT NULL").select(*group, F.explode("ids").alias("pos"))
            .groupBy(*group).agg(F.collect_set("pos").alias("ids")))
    sets = sets.join(dense.select(*group, F.lit(True).alias("_dense")).distinct(), group, "left")
    as_bits = F.coalesce("_dense", F.lit(False)) | (F.size("ids") > ARRAY_MAX)
    bitmaps = (dense.unionByName(_bitmaps(sets.where(as_bits), group))
               .groupBy(*group).agg(F.bitmap_or_agg("bits").alias("bits")))
    return _union(sets.where(~as_bits), bitmaps, group)


def count(merged: DataFrame, by: Sequence[str], name: str = "n") -> DataFrame:
    """Distinct ids of each group, of containers made or merged by ``by``."""
    one = F.when(F.col("bits").isNotNull(), F.bitmap_count("bits")).otherwise(F.size("ids").cast("long"))
    return merged.groupBy(*by).agg(F.sum(one).alias(name))
