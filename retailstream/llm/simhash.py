"""SimHash near-dedup: pivot distance tables over fingerprints, links verified by bits.

Pivots.  Reference fingerprints are fixed, and each fingerprint's Hamming
distances to all of them, taken quarter by quarter of the 64 bits, are its
coordinates.  By the triangle inequality two fingerprints that differ in k bits
differ by at most k in each coordinate, and their differences over the four
quarters add up to at most k.  With k = 2 two quarters differ in nothing, so
all coordinates there are equal: the coordinates of two quarters (six ways) are
a bucket key, and no link is missed.  Inside a bucket pairs go when any pivot's
whole distance differs by more than k, and the rest is verified bit by bit.

Buckets.  Equal texts are one fingerprint before any of this.  A bucket of more
than ``MAX_BUCKET`` fingerprints is not compared as it is: its members get finer
keys the same way, from the pivot distances in the parts of the 32 bits that
were still free, and again, down to 8 free bits, where a bucket holds at most
256 different fingerprints.  So a bucket's pairs are bounded, and none is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailstream.llm.common import bound_batches, stored
from retailstream.llm.graph import components

N_PIVOTS = 12      # 5 bits each in a long: distances in a quarter are 0 to 16
MAX_BUCKET = 64    # fingerprints compared pair by pair; larger buckets are split exactly
# free bits: four quarters, then of two free quarters four eighths, and so on
LEVELS = (16, 8, 4)


def pivots(n: int = N_PIVOTS) -> list[int]:
    """The reference fingerprints: XXH64 of their numbers, as signed longs."""
    return [int(np.uint64(xxhash.xxh64_intdigest(str(i).encode(), 0)).astype(np.int64)) for i in range(n)]


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority bits of XXH64 (seed 42) over the shingles of the lower-cased words."""
    words = text.lower().split()   # of bytes: A-Z only; space and \t to \r
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(grams), 1 << 16):   # long texts in parts: the counts add up
        part = grams[at:at + (1 << 16)]
        hashes = np.fromiter((digest(g, 42) for g in part), np.uint64, len(part))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(grams), bitorder="little").view("<i8")[0])


def _fingerprints(shingle: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [fingerprint(t, shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.int64())], ["id", "fp"])
    return of


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _coordinates(fp: Column, mask: Column | int) -> Column:
    """Distances to all pivots within ``mask``, packed in one long."""
    mask = F.lit(_signed(mask)) if isinstance(mask, int) else mask
    code = F.lit(0).cast("long")
    for j, pivot in enumerate(pivots()):
        distance = F.bit_count(fp.bitwiseXOR(F.lit(pivot)).bitwiseAND(mask)).cast("long")
        code = code.bitwiseOR(F.shiftleft(distance, 5 * j))
    return code


def _keys(fps: DataFrame, width: int) -> DataFrame:
    """Re-key ``fp, key, free`` (free: mask of the bits the key leaves open).

    The free bits are cut into four parts of ``width`` bits; for each two parts
    there is a key with the pivot coordinates of both, and the other two stay free.
    """
    rows = []
    free_at = [F.lit(_signed(((1 << width) - 1) << (width * p))) for p in range(64 // width)]
    # the parts of this width inside the free mask, from the lowest on
    parts = F.filter(F.array(*free_at), lambda m: m.bitwiseAND(F.col("free")) == m)
    split = fps.withColumn("parts", parts)
    for a, b in combinations(range(4), 2):
        pa_, pb = F.get("parts", F.lit(a)), F.get("parts", F.lit(b))
        both = pa_.bitwiseOR(pb)
        rows.append(F.struct(
            F.concat_ws(":", "key", both, _coordinates(F.col("fp"), pa_), _coordinates(F.col("fp"), pb)).alias("key"),
            F.col("free").bitwiseAND(F.bitwise_not(both)).alias("free")))
    return (split.select("fp", F.explode(F.array(*rows)).alias("k"))
            .select("fp", F.xxhash64("k.key").alias("key"), F.col("k.free").alias("free")))


def _pairs(members: DataFrame, max_bits: int) -> DataFrame:
    """Links within buckets: by pivots first, then by bits."""
    a = members.select("key", F.col("fp").alias("u"))
    b = members.select("key", F.col("fp").alias("v"))
    apart = F.greatest(*[F.abs(F.bit_count(F.col("u").bitwiseXOR(F.lit(p)))
                               - F.bit_count(F.col("v").bitwiseXOR(F.lit(p)))) for p in pivots()])
    return (a.join(b, "key").where((F.col("u") < F.col("v")) & (apart <= max_bits)
                                   & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits))
            .select("u", "v"))


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """All pairs ``u, v`` of the distinct fingerprints ``fp`` that differ in 1 to ``max_bits`` bits."""
    if not 0 <= max_bits <= 2:
        raise ValueError("two equal quarters of four are only certain up to 2 bits")
    keyed = fps.select("fp", F.lit(0).cast("long").alias("key"), F.lit(-1).cast("long").alias("free"))
    found = None
    for width in LEVELS:
        keyed = stored(_keys(keyed, width), f"pivot-keys-{width}")
        sizes = stored(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "pivot-buckets")
        last = width == LEVELS[-1]
        small = sizes if last else sizes.where(F.col("n") <= MAX_BUCKET)
        pairs = _pairs(stored(keyed.join(small.select("key"), "key", "left_semi"), "pivot-members"), max_bits)
        found = pairs if found is None else found.unionByName(pairs)
        if last or not sizes.where(F.col("n") > MAX_BUCKET).take(1):
            break
        keyed = keyed.join(sizes.where(F.col("n") > MAX_BUCKET).select("key"), "key", "left_semi")
    return found.distinct()


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int, *carry: Column,
             ) -> tuple[DataFrame, DataFrame]:
    """(``id, fp`` and the columns ``carry`` of each row, ``fp, least, component, component_id`` of each fingerprint)."""
    bound_batches(docs)
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.struct(F.col(id_col).alias("id"), *carry).alias("row"), text.cast("binary").alias("t"))
    kind = base.schema["row"].dataType.simpleString()
    printed = stored(base.mapInArrow(_fingerprints(shingle), f"id {kind}, fp long").select("id.*", "fp"), "fingerprints")
    classes = stored(printed.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint-classes")
    reached = components(stored(links(classes, max_bits), "fingerprint-links"))
    linked = classes.join(reached.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    linked = stored(linked, "fingerprint-components")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    return printed, stored(linked.join(least, "component"), "fingerprint-names")


def group_firsts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 max_bits: int = 2) -> DataFrame:
    """The rows that each group of near-duplicates is known by: ``id, digest, fp, alone``.

    They have the group's least id and, of the fingerprints with that id in the
    group, the least.  ``digest`` is the SHA-256 of the text (null: empty); a row of
    ``docs`` is such a row when its id and digest are listed.  ``alone``: no other row
    has this id and fingerprint.  Groups without any id are left out.
    """
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    printed, named = _grouped(docs, id_col, text_col, shingle, max_bits, digest.alias("digest"))
    # the group's least id lies on the fingerprint that has it as its own least id
    first = (named.where(F.col("least") == F.col("component_id")).groupBy("component")
             .agg(F.min("fp").alias("fp"), F.first("component_id").alias("id")).select("id", "fp"))
    rows = stored(printed.where("id IS NOT NULL").groupBy("id", "fp", "digest").agg(F.count(F.lit(1)).alias("n")),
                  "fingerprint-rows")
    # one row of an id and fingerprint: neither copies nor other spellings
    n_rows = rows.groupBy("id", "fp").agg(F.sum("n").alias("n_rows")).join(first, ["id", "fp"], "left_semi")
    return (rows.join(stored(n_rows, "fingerprint-firsts"), ["id", "fp"])
            .select("id", "digest", "fp", (F.col("n_rows") == 1).alias("alone")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2) -> DataFrame:
    """Per row of ``docs``: ``{id_col}, fingerprint, component_id``.

    ``fingerprint``: 16 hex digits; bit i is set when it is set in more than half
    of the XXH64 hashes (seed 42) of the text's shingles of ``shingle`` words,
    repeats included, A-Z lowered; a text with fewer words is one shingle, one
    without words has fingerprint zero.  Documents whose fingerprints differ in at
    most ``max_bits`` bits are linked; ``component_id`` is the least id reachable.

    A null text has no words.  Rows with the same id are fingerprinted each.  Null
    ids take part in links; a component without any id has a null one.  Other
    columns are ignored, whatever their names.  An empty table gives no rows.
    """
    printed, named = _grouped(docs, id_col, text_col, shingle, max_bits)
    return printed.join(named.select("fp", "component_id"), "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
