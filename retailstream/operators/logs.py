"""DWD click-log jobs: parse with a dirty side output (PRJ-1/2), start/page
routing (PRJ-4) and display explosion (PRJ-5).  Batch and streaming alike —
these are row-local projections, so they stay in one whole-stage-codegen span.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from retailstream.schemas import RAW_LOG

CORRUPT = "_corrupt_record"


def parse_json(raw: DataFrame, schema: StructType = RAW_LOG, value: str = "value", into: str = "log",
               mode: str = "PERMISSIVE") -> DataFrame:
    """PRJ-1 / PRJ-2: the record's fields into ``into``.

    PERMISSIVE: a line is clean iff its whole text is one JSON object, whatever
    the types of its fields (a value that does not fit a field's type leaves that
    field null); the text of any other line is kept in ``{into}._corrupt_record``.
    ``{into}.start_text`` is the text of ``start``.  FAILFAST raises on the first
    malformed line.
    """
    rest = [c for c in raw.columns if c != into]
    if mode == "FAILFAST":
        parsed = F.from_json(value, schema, {"mode": "FAILFAST"})
        return raw.select(*rest, F.explode(F.array(parsed)).alias(into))
    # in brackets, so that text after the object makes the line invalid; by a
    # one-element generator, so that each line is parsed once: filters on the
    # result cannot be pushed below it
    lines = raw.select(*rest, F.explode(F.array(F.try_parse_json(F.concat(F.lit("["), F.col(value), F.lit("]")))))
                       .alias("_v"))
    clean = (F.col("_v").isNotNull() & F.col(value).rlike(r"^\s*\{")
             & F.try_variant_get("_v", "$[1]", "variant").isNull())
    fields = [F.try_variant_get("_v", f"$[0].{f.name}", f.dataType.simpleString()).alias(f.name) for f in schema]
    log = F.struct(*fields, F.try_variant_get("_v", "$[0].start", "string").alias("start_text"),
                   F.when(clean, F.lit(None)).otherwise(F.coalesce(F.col(value), F.lit(""))).alias(CORRUPT))
    return lines.select(*rest, log.alias(into))


def split_dirty(parsed: DataFrame, into: str = "log") -> tuple[DataFrame, DataFrame]:
    """(clean, dirty): dirty rows keep their original text unchanged."""
    bad = F.col(f"{into}.{CORRUPT}").isNotNull() | F.col(into).isNull()
    clean = parsed.where(~bad).withColumn(into, F.col(into).dropFields(CORRUPT))
    return clean, parsed.where(bad).drop(into)


def flatten(clean: DataFrame, into: str = "log", keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Lift the parsed record's fields to top-level columns."""
    return clean.select(*[c for c in keep if c in clean.columns], f"{into}.*")


def route_start_page(log: DataFrame) -> DataFrame:
    """PRJ-4: ``route`` = 'start' when the record's ``start`` is present and
    non-empty text (an empty JSON object ``{}`` still counts, as in the
    reference's string test), else 'page'."""
    start = F.coalesce(F.col("start_text"), F.to_json("start")) if "start_text" in log.columns else F.to_json("start")
    return log.withColumn("route", F.when(F.length(start) > 0, "start").otherwise("page"))


def explode_displays(pages: DataFrame) -> DataFrame:
    """PRJ-5: one row per element of ``displays`` with the page id and ``ts``.
    The page id comes from ``common.page_id`` when present, else ``page.page_id``
    (D1).  Null and empty ``displays`` give no rows."""
    page_id = F.coalesce(F.col("common.page_id"), F.col("page.page_id"))
    d = pages.select(*[c for c in ("seq",) if c in pages.columns], F.col("common"), page_id.alias("page_id"),
                     F.explode("displays").alias("display"), "ts")
    return d.select(*[c for c in ("seq",) if c in d.columns], "common", "page_id", "display.*", "ts")
