"""Target-distribution importance resampling with hashed word n-grams.

Features are all runs of 1 and 2 consecutive words; a feature's bucket is the
CRC-32 of its bytes modulo the number of buckets.  A document weighs as much as
the mean gain of its features, the gain being the log ratio of the bucket's
share in the target to its share in the documents, and documents are drawn by
weight plus Gumbel noise (sampling without replacement in proportion to the
weights).

Length-bucketed CRC matrices.  The distinct features of a slice of texts are
grouped by length in bytes; a group is a two-dimensional uint8 array, and the
checksums of all its rows are updated column by column with one table lookup
each.  The buckets are then scattered back to the features' places.  Features
longer than ``MAX_COLUMNS`` bytes (one endless word) are no group worth a matrix
and get the same checksum from zlib.

Texts are read once: their buckets are written as a table of 2 bytes a feature,
which the counts and the weights are taken from.  What a task holds is bounded
by a slice of texts and a vector of ``buckets`` counts, as is what the driver
gets (one gain a bucket).  Ranks come from a range sort of narrow rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailstream.llm.common import bound_batches, stored

SLICE_BYTES = 1 << 20    # text whose features are hashed at a time
MAX_COLUMNS = 1 << 12
WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")   # of lower-cased UTF-8


def crc_table() -> np.ndarray:
    """CRC-32 of each byte value, by eight steps of the reversed polynomial."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(0xEDB88320), crc >> 1)
    return crc


_TABLE = crc_table()


def crc32_matrix(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of a two-dimensional uint8 array, all rows a column at a time."""
    crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(rows.T):
        crc = _TABLE[(crc ^ column) & 0xFF] ^ (crc >> 8)
    return crc ^ np.uint32(0xFFFFFFFF)


def crc32_all(features: list[bytes]) -> np.ndarray:
    """CRC-32 of each of ``features``, grouped by length."""
    out = np.zeros(len(features), np.uint32)
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, cuts) if len(order) else []:
        length = int(lengths[group[0]])
        if length > MAX_COLUMNS:
            out[group] = [zlib.crc32(features[i]) for i in group]
        else:
            matrix = np.frombuffer(b"".join([features[i] for i in group.tolist()]), np.uint8)
            out[group] = crc32_matrix(matrix.reshape(len(group), length))
    return out


def feature_buckets(texts: list[bytes], buckets: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(words of each text, buckets of each text's features: single words, then pairs)."""
    per_text = [WORDS.findall(t.lower()) for t in texts]   # bytes: lowers A-Z only
    n = np.fromiter(map(len, per_text), np.int64, len(texts))
    coded = pa.array([w for words in per_text for w in words], pa.binary()).dictionary_encode()
    del per_text
    words, at = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
    if not words:
        return n, [np.zeros(0, np.int64)] * len(texts)
    single = (crc32_all(words) % buckets).astype(np.int64)[at]
    ends = np.cumsum(n)
    inside = np.ones(len(at), bool)          # a pair begins at every word but a text's last
    inside[ends[n > 0] - 1] = False
    first = np.flatnonzero(inside)
    codes, which = np.unique(at[first] * len(words) + at[first + 1], return_inverse=True) if len(first) else (
        np.zeros(0, np.int64), np.zeros(0, np.int64))
    a, b = (codes // len(words)).tolist(), (codes % len(words)).tolist()
    pairs = (crc32_all([words[i] + b" " + words[j] for i, j in zip(a, b, strict=True)]) % buckets).astype(np.int64)[which]
    pair_ends = np.cumsum(np.maximum(n - 1, 0))
    return n, [np.concatenate([single[e - k:e], pairs[p - max(k - 1, 0):p]])
               for k, e, p in zip(n.tolist(), ends.tolist(), pair_ends.tolist(), strict=True)]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    first, held = 0, 0
    for i, size in enumerate(pc.binary_length(texts).to_pylist()):
        if held and held + size > SLICE_BYTES:
            yield first, i
            first, held = i, 0
        held += size
    if first < len(texts):
        yield first, len(texts)


def _width(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def _hashed(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, last in _slices(b.column(1)):
                n, found = feature_buckets(b.column(1).slice(first, last - first).to_pylist(), buckets)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, last - first), pa.array(n), pa.array([len(f) for f in found], pa.int64()),
                     pa.array([f.astype(_width(buckets)).tobytes() for f in found], pa.binary())],
                    ["id", "n_words", "n_features", "buckets"])
    return run


def hashed_features(rows: DataFrame, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """``id, n_words, n_features, buckets`` (little-endian numbers, as bytes) of each row."""
    bound_batches(rows)
    base = rows.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    kind = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(_hashed(buckets), f"id {kind}, n_words long, n_features long, buckets binary")


def bucket_counts(features: DataFrame, buckets: int) -> DataFrame:
    """``bucket, n``: features in each bucket that has any; a task sends one row a bucket at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for row in b.column(0):
                total += np.bincount(np.frombuffer(row.as_buffer(), _width(buckets)), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])
    return (features.select("buckets").mapInArrow(run, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 ln) of the smoothed ratio of each bucket's share in ``target`` to that in ``docs``
    (both ``bucket, n``); one whole number a bucket, whatever the corpus."""
    spark = docs.sparkSession
    both = (spark.range(buckets).select(F.col("id").cast("int").alias("bucket"))
            .join(docs.withColumnRenamed("n", "s"), "bucket", "left")
            .join(target.withColumnRenamed("n", "t"), "bucket", "left").na.fill(0, ["s", "t"]))
    big_s, big_t = (x.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] for x in (docs, target))
    up = (F.col("t") + F.lit(1.0)) * F.lit(float(big_s + buckets))
    down = (F.col("s") + F.lit(1.0)) * F.lit(float(big_t + buckets))
    rows = both.select("bucket", F.floor(F.lit(1000.0) * F.log(up / down)).alias("gain")).collect()
    gains = np.zeros(buckets, np.int64)
    for r in rows:
        gains[r["bucket"]] = r["gain"]
    return gains


def _weighed(gains: np.ndarray, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = (np.frombuffer(row.as_buffer(), _width(buckets)) for row in b.column("buckets"))
            weight = [int(gains[x].sum()) // len(x) if len(x) else 0 for x in held]   # // goes down
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("n_words"), b.column("n_features"),
                                              pa.array(weight, pa.int64())], ["id", "n_words", "n_features", "weight"])
    return run


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_id: str = "item_id", target_text: str = "text", buckets: int = 10_000, percent: int = 25,
             least_words: int = 20, seed: int = 7) -> DataFrame:
    """Per row of ``docs``: ``{id_col}, n_features, weight, score, rank`` (all long but the id).

    ``weight``: mean gain of the row's features in thousandths, rounded down (0
    without features).  ``score``: weight plus Gumbel noise in thousandths, from the
    SHA-256 of ``seed:id``.  Of the N rows with ``least_words`` words or more, the
    floor(percent * N / 100) highest scores are drawn and ranked from 1, ties to
    the smaller id, then to fewer features; ``rank`` is null for the others.

    A null text has no words; a null id counts as the empty text and ranks last
    among ties.  Repeated rows count and are ranked each.  Other columns are
    ignored, whatever their names.  Empty ``docs`` give no rows; with an empty
    ``target`` gains only follow the documents' own counts.
    """
    own = stored(hashed_features(docs, id_col, text_col, buckets), "importance-features")
    goal = stored(hashed_features(target, target_id, target_text, buckets), "importance-target")
    gains = bucket_gains(stored(bucket_counts(own, buckets), "importance-counts"),
                         stored(bucket_counts(goal, buckets), "importance-target-counts"), buckets)
    kind = own.schema["id"].dataType.simpleString()
    weighed = own.mapInArrow(_weighed(gains, buckets), f"id {kind}, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = stored(weighed.select("id", "n_features", "weight", (F.col("weight") + noise).alias("score"),
                                   (F.col("n_words") >= least_words).alias("able"),
                                   F.monotonically_increasing_id().alias("row")), "importance-scores")
    draws = percent * scored.where("able").count() // 100
    # ranges of the sorted order, each a partition; its rows count on from those of the ranges before
    order = [F.desc("able"), F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features"), F.asc("row")]
    ranged = stored(scored.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "importance-ranges")
    sizes = stored(ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")), "importance-sizes")   # a row a partition
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) + F.col("before")
    ranked = ranged.join(before, "part").withColumn("place", place)
    return ranked.select(F.col("id").alias(id_col), "n_features", "weight", "score",
                         F.when(F.col("able") & (F.col("place") <= draws), F.col("place")).alias("rank"))
