"""Keyword tokenizer (UDT-1) and keyword-source weights (AG-12).

The reference segments search text with a dictionary-based segmenter.  Here the
tokenize step is a JVM-side regular expression, so it stays inside whole-stage
codegen: lower-case, then every maximal run of Han characters, and every maximal
run of other letters/digits, is one keyword.  Whole texts are tokenized.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's report SQL): keyword source weights.
KEYWORD_WEIGHTS = {"SEARCH": 10, "ORDER": 3, "CART": 2, "CLICK": 1}
KEYWORD_SEARCH = "SEARCH"

# Java regex: a Han run, or a run of letters/digits that are not Han.
TOKEN_PATTERN = r"\p{IsHan}+|[\p{L}\p{N}&&[^\p{IsHan}]]+"


def tokenize(text) -> Column:
    """ARRAY<STRING> of keywords of ``text`` (empty array for null/empty text)."""
    t = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_extract_all(F.lower(t), F.lit(TOKEN_PATTERN), F.lit(0)),
                      F.array().cast("array<string>"))


def keyword_weight(source) -> Column:
    """CASE source WHEN 'SEARCH' THEN 10 ... ELSE 0 END."""
    s = F.col(source) if isinstance(source, str) else source
    expr = F.lit(0)
    for name, w in reversed(list(KEYWORD_WEIGHTS.items())):
        expr = F.when(s == name, F.lit(w)).otherwise(expr)
    return expr


def register_split_keyword(spark, name: str = "split_keyword") -> None:
    """Register ``name(text) -> TABLE(word STRING)`` for SQL ``LATERAL`` use, as
    the reference registers its splitter for its SQL jobs: a SQL table function
    over the expression of ``tokenize``, so it runs in the JVM too."""
    pattern = TOKEN_PATTERN.replace("\\", "\\\\")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(txt STRING) RETURNS TABLE(word STRING) "
              f"RETURN SELECT explode(regexp_extract_all(lower(txt), '{pattern}', 0))")
