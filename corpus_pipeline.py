"""The corpus pipeline: documents in, packed token sequences out.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor
kept and is written as a table before the next one reads it.  All stages but the
last return the columns of ``documents``; other columns are dropped, whatever
their names.  Rows without ``doc_id`` go through every stage but take no part in
the line counts and are not grouped by SimHash.  Empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailstream.llm.common import bound_batches, read_table, stored
from retailstream.llm.line_dedup import dedup_lines
from retailstream.llm.mixing import mix
from retailstream.llm.packing import pack
from retailstream.llm.simhash import group_firsts
from retailstream.llm.toxicity import fit, probability

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic, by their whole texts.

    Trained on the labels of ``sf_dir`` that the operator's query trains on too.
    """
    labels = read_table(spark, sf_dir, "labels").where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0)
    model = fit(docs, labels)
    bound_batches(docs)
    return docs.select(*COLUMNS).where(probability(model, F.col("text")) < 0.5)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share; ``n_chars`` follows the text."""
    kept = dedup_lines(docs, carry=("lang", "source"))
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*COLUMNS)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicate rows the one with the least id, once.

    The rows to keep are settled on ids, digests and fingerprints; the texts go
    through one shuffle, to those keys.  Only where several rows have one id and
    fingerprint are they compared, to keep the least.
    """
    first = stored(group_firsts(docs, shingle=3, max_bits=2), "group-firsts")
    rest = [c for c in COLUMNS if c != "text"]
    digest = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    rows = docs.select(*COLUMNS, F.col("doc_id").alias("id"), digest.alias("digest"))
    kept = rows.join(first, ["id", "digest"])
    several = kept.where("NOT alone").groupBy("id", "fp").agg(F.min(F.struct("text", *rest)).alias("row"))
    return (kept.where("alone").select(*COLUMNS).unionByName(several.select(*[f"row.{c}" for c in COLUMNS]))
            .unionByName(docs.select(*COLUMNS).where("doc_id IS NULL")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow the target shares of sources, languages and topics.

    Documents of rare values are repeated where the targets need more than there is.
    """
    return (mix(docs, repeats=True).where("sampled")
            .select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens in sequences of at most 2048, the ids themselves included."""
    return pack(docs, with_ids=True)


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup), ("SimHash near-dedup", simhash_dedup),
          ("mixing sources to target weights", mixing), ("best-fit packing", packing)]

# a trained classifier and a public tokenizer are no SQL: tested against a plain version instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
