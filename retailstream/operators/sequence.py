"""Previous / next row of the same key, without putting a whole key in one task.

``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one task; a
key holding a third of all rows would then be a third of the job in one task.
Here each key is cut into ordered *buckets* (``bucket`` is a column that is
monotone in the order, e.g. ``ts div 1h``):

1. ``lag``/``lead`` inside ``(key, bucket)`` windows — bounded groups; the wide
   rows are shuffled for this, once;
2. one edge row per ``(key, bucket)``, its first or last row, by a partial
   aggregation over the key, order and carried columns alone (a second, narrow
   read of the input; a task sends one row per key and bucket);
3. ``lag``/``lead`` over the edges of a key (one row per bucket, small),
   giving each bucket the neighbouring bucket's edge row;
4. rows at a bucket edge take their neighbour from there: an equi-join on
   ``(key, bucket)``, by which the windowed rows are partitioned already.

The result equals the plain per-key window exactly; only the partitioning differs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_neighbor(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column,
                  cols: Sequence[str], direction: str = "prev", prefix: str | None = None) -> DataFrame:
    """Add ``{prefix}{c}`` = value of ``c`` in the previous (``direction='prev'``) or
    next (``'next'``) row of the same ``keys`` in ``order``; null at the ends.

    ``order`` must be a unique ordering within a key, and ``bucket`` must be
    non-decreasing along it.  Rows with a null key belong to no one: they have no
    neighbours and are not in the result (split them off first to keep them).
    """
    if direction not in ("prev", "next"):
        raise ValueError("direction must be 'prev' or 'next'")
    prefix = prefix if prefix is not None else f"{direction}_"
    keys, order, cols = list(keys), list(order), list(cols)
    shift = F.lag if direction == "prev" else F.lead

    rows = df.withColumn("_bkt", bucket)
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    group = [*keys, "_bkt"]
    w = Window.partitionBy(*group).orderBy(*order)
    inner = rows.select("*", shift(F.lit(True)).over(w).alias("_has_nb"),
                        *[shift(F.col(c)).over(w).alias(f"{prefix}{c}") for c in cols])
    # what the neighbouring bucket needs: this one's last row for 'prev', first for 'next'
    pick = F.max_by if direction == "prev" else F.min_by
    edges = rows.groupBy(*group).agg(pick(F.struct(*cols), F.struct(*order)).alias("_edge"))
    along = Window.partitionBy(*keys).orderBy("_bkt")
    edges = edges.select(*group, shift("_edge").over(along).alias("_nb")).where("_nb IS NOT NULL")

    fixed = {f"{prefix}{c}": F.when(F.col("_has_nb").isNull(), F.col(f"_nb.{c}"))
             .otherwise(F.col(f"{prefix}{c}")) for c in cols}
    return inner.join(edges, group, "left").withColumns(fixed).drop("_bkt", "_has_nb", "_nb")
