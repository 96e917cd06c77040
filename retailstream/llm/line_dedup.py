"""Line dedup: levelled sorted runs of line hashes, merged batch by batch.

Lines that are long enough and found in enough documents are kept only in the
document with the largest id.  Documents come in batches of falling ids, and
the lines already met are held as *runs*: tables sorted by line hash, each hash
in one run only.  A batch merge-anti-joins its lines with the runs; those left
are met for the first time, so the batch holds their largest document, and they
become a run of their own.  As soon as a level has ``fanout`` runs these are
merged into one run of the next level, so a batch reads few, large runs.

How often a line occurs must be known before any line can go, so one pass
counts the documents of each line first (partial sums: a line in a third of all
documents is one row per task), and only frequent lines enter the batches.
Texts never move in the batches, only (hash, id) pairs do; at the end the lines
to drop are sent to their documents by id.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailstream.llm.common import bound_batches, stored


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of a line stripped of white space at both ends, A-Z lowered;
    None if that has fewer than ``min_chars`` code points."""
    key = line.strip().lower()  # of bytes: space and \t to \r, and A-Z, nothing else
    # a code point takes 1 to 4 bytes: decode only when the bytes leave it open
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _long_lines(min_chars: int):
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, keys = [], []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = {line_key(x, min_chars) for x in text.split(b"\n")} - {None}
                ids.extend([doc_id] * len(found))
                keys.extend(found)
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), pa.array(keys, pa.binary())],
                                             ["id", "key"])
    return lines


def _without(min_chars: int):
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, drop in zip(b.column("text").to_pylist(), b.column("drop").to_pylist(), strict=True):
                lines = text.count(b"\n") + 1
                n_lines.append(lines)
                if drop:
                    gone = set(drop)
                    kept = [x for x in text.split(b"\n") if line_key(x, min_chars) not in gone]
                    n_dropped.append(lines - len(kept))
                    text = b"\n".join(kept)
                else:
                    n_dropped.append(0)
                texts.append(text)
            at = b.schema.get_field_index("text")
            out = b.select([n for n in b.schema.names if n not in ("drop", "text")])
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                 pa.array(texts, b.schema.field(at).type)], [*out.schema.names, "n_lines", "n_dropped", "text"])
    return rewrite


def line_holders(lines: DataFrame, n_batches: int, fanout: int) -> DataFrame:
    """``key, holder``: the largest id of each key in ``lines`` (``id, key``), by levelled runs."""
    cuts = lines.agg(F.percentile_approx("id", [i / n_batches for i in range(1, n_batches)])).first()[0] or []
    cuts = sorted(set(cuts))
    levels: list[list[DataFrame]] = [[]]

    def all_runs() -> DataFrame | None:
        out = None
        for run in (r for level in levels for r in level):
            out = run if out is None else out.unionByName(run)
        return out

    # batches of falling ids: (last cut, inf), ..., (-inf, first cut]
    bounds = list(zip([None, *cuts], [*cuts, None], strict=True))[::-1]
    for above, upto in bounds:
        batch = lines
        if above is not None:
            batch = batch.where(F.col("id") > above)
        if upto is not None:
            batch = batch.where(F.col("id") <= upto)
        own = batch.groupBy("key").agg(F.max("id").alias("holder"))
        runs = all_runs()
        if runs is not None:
            own = own.join(runs.select("key").hint("merge"), "key", "left_anti")
        levels[0].append(_run(own, 0))
        level = 0
        while len(levels[level]) >= fanout:
            merged = levels[level][0]
            for run in levels[level][1:]:
                merged = merged.unionByName(run)
            levels[level] = []
            if level + 1 == len(levels):
                levels.append([])
            level += 1
            levels[level].append(_run(merged, level))
    return all_runs()


def _run(rows: DataFrame, level: int) -> DataFrame:
    return stored(rows.repartitionByRange("key").sortWithinPartitions("key"), f"line-run-{level}")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (),
                min_chars: int = 40, min_docs: int = 5, n_batches: int = 4, fanout: int = 2) -> DataFrame:
    """Per row of ``docs``: ``{id_col}, {carry...}, n_lines, n_dropped, text``.

    A line's key is the line without white space at both ends, A-Z lowered.  Keys
    of at least ``min_chars`` code points found in at least ``min_docs`` documents
    lose all their lines except in the document with the largest id holding them
    (which keeps all of its own).  The other lines stay, joined by newlines.

    A null or empty text is one empty line.  Rows with the same id are one
    document to the count, and each loses or keeps its lines like the other.
    Rows without id take no part: they are not counted and lose nothing.  Other
    columns than ``carry`` are dropped, whatever their names; ``carry`` may not
    name one of the result's own columns.  An empty table gives no rows.
    """
    bound_batches(docs)
    base = docs.select(F.col(id_col).alias("id"), *[F.col(c) for c in carry],
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    id_type = base.schema["id"].dataType.simpleString()
    lines = base.select("id", "text").where("id IS NOT NULL").mapInArrow(
        _long_lines(min_chars), f"id {id_type}, key binary")
    lines = stored(lines.distinct(), "lines")  # a document counts once, also if its row is there twice
    # a table of its own, so that the join below shuffles it by itself and a hot key can be split
    frequent = stored(lines.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs)
                      .select("key"), "frequent-lines")
    repeated = stored(lines.join(frequent, "key"), "repeated-lines")
    holders = line_holders(repeated, n_batches, fanout)
    drops = (repeated.join(holders, "key").where(F.col("id") < F.col("holder"))
             .groupBy("id").agg(F.collect_list("key").alias("drop")))  # as many as a document has lines
    kept_fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.drop("text").schema)
    out = base.join(drops, "id", "left").select("id", *carry, "text", "drop").mapInArrow(
        _without(min_chars), f"{kept_fields}, n_lines long, n_dropped long, text binary")
    return out.withColumn("text", F.col("text").cast("string")).withColumnRenamed("id", id_col)
