"""A bounded sample of labelled documents for training on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    max_docs: int, max_chars: int, ones: float = 0.5) -> tuple[list[str], list[int]]:
    """Texts and 0/1 labels of at most ``max_docs`` documents, in a fixed order.

    Ids are drawn by hash, a share ``ones`` of label 1; a label with fewer leaves
    the rest to the other.  Only the drawn ids (a bounded number) are broadcast to the
    scan of ``docs``; texts longer than ``max_chars`` are left out, so that what
    reaches the driver is bounded in bytes too.  Repeated label rows count once,
    with the larger label; of several rows with a drawn id the least text is taken.
    """
    given = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label")))
    drawn = [given.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(max_docs) for k in (0, 1)]
    ids = [[r["id"] for r in d.collect()] for d in drawn]
    n_ones = min(len(ids[1]), max(round(max_docs * ones), max_docs - len(ids[0])))
    n = (min(len(ids[0]), max_docs - n_ones), n_ones)
    chosen = [(i, k) for k in (0, 1) for i in ids[k][:n[k]]]
    if not chosen:
        return [], []
    kind = labels.schema[id_col].dataType.simpleString()
    wanted = docs.sparkSession.createDataFrame(chosen, f"id {kind}, label int")
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
            .join(F.broadcast(wanted), "id").groupBy("id", "label").agg(F.min("text").alias("text")).collect())
    rows.sort(key=lambda r: (r["id"], r["text"]))
    return [r["text"] for r in rows], [r["label"] for r in rows]
