"""Mixing sources to target weights [native]: iterative proportional fitting, then sampling.

Documents fall in cells (source, language, topic) of known token counts.  The
weights of the cells are raked: scaled to the target shares of the sources, then
of the languages, then of the topics, and again, until the three marginals hold
together.  A document is then drawn with a probability in proportion to its
cell's weight per token, calibrated so that the expected tokens are the budget.
Without repeats a probability ends at 1, so rare values fall short of their
targets; with repeats the expected copies of a document may exceed 1, and the
expected shares are the raked ones.  Both draws can be had beside each other.

Cells are a table, not a driver structure: there may be as many sources as
hosts.  A raking step is a partial sum by one key and a join back on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailstream.llm.common import SPACE, stored

MARGINALS = ("source", "lang", "topic")
NONE = "(none)"   # stands for a null source or language in the cells


def n_words(text: Column) -> Column:
    """Words of the whole text, as its token weight; 0 for null."""
    return F.coalesce(F.size(F.array_remove(F.split(text, SPACE + "+"), "")), F.lit(0)).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic by form, from the whole text: table, notice, list or prose."""
    lines = F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1
    bars = F.length(text) - F.length(F.replace(text, F.lit("|")))
    return (F.when(text.isNull() | (text == ""), "empty").when(bars >= 3 * lines, "table")
            .when(F.lower(text).contains("licen"), "notice").when(F.length(text) < 80 * lines, "list")
            .otherwise("prose"))


def cells_of(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns of its cell and its tokens, named ``_source, _lang, _topic, _tokens``."""
    text = F.col(text_col)
    return docs.withColumns({
        "_source": F.coalesce(F.col("source").cast("string"), F.lit(NONE)),
        "_lang": F.coalesce(F.col("lang").cast("string"), F.lit(NONE)),
        "_topic": topic_of(text), "_tokens": n_words(text)})


def tempered_targets(cells: DataFrame, key: str, power: float) -> DataFrame:
    """Target shares of a marginal: its token shares to ``power``, scaled to 1 (the
    usual flattening of a skewed mix; power 1 keeps the corpus' own shares)."""
    sums = cells.groupBy(key).agg(F.sum("tokens").cast("double").alias("t"))
    total = float(sums.agg(F.sum(F.pow("t", F.lit(power)))).first()[0] or 1)
    return sums.select(key, (F.pow("t", F.lit(power)) / F.lit(total)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int) -> DataFrame:
    """``cells`` (keys, tokens) with ``weight``: token shares after ``rounds`` of fitting.

    Each target table (key, share) has one row per value.  Every step is a table
    of its own, so plans stay short and a lost executor repeats one step at most.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    now = cells.withColumn("weight", F.col("tokens") / F.lit(total))
    for _ in range(rounds):
        for key, share in targets.items():
            scale = (now.groupBy(key).agg(F.sum("weight").alias("have")).join(share, key)
                     .select(key, (F.col("share") / F.col("have")).alias("scale")))
            now = stored(now.join(scale, key).withColumn("weight", F.col("weight") * F.col("scale")).drop("scale"),
                         f"raked-{key}")
    return now


def inclusion(cells: DataFrame, budget: float) -> DataFrame:
    """``cells`` (tokens, weight) with ``p``: least of 1 and a multiple of weight per token.

    The multiple makes the expected tokens ``budget`` times all tokens.  Cells
    that would exceed 1 are kept whole and the rest is scaled up, until no more
    cells do; every step but the last keeps at least one more cell whole.
    """
    per_token = F.col("weight") / F.col("tokens")
    goal = budget * (cells.agg(F.sum("tokens")).first()[0] or 0)
    factor, n_whole = None, -1
    while True:
        whole = F.lit(False) if factor is None else F.lit(factor) * per_token >= 1
        row = cells.agg(F.sum(F.when(whole, F.col("tokens")).otherwise(0)).alias("kept"),
                        F.sum(F.when(whole, 0.0).otherwise(F.col("weight"))).alias("free"),
                        F.count_if(whole).alias("n_whole")).first()
        if not row["free"] or row["n_whole"] <= n_whole:
            break
        factor, n_whole = (goal - row["kept"]) / row["free"], row["n_whole"]
    return cells.withColumn("p", F.least(F.lit(1.0), F.lit(factor or 0.0) * per_token))


def expected_copies(cells: DataFrame, budget: float) -> DataFrame:
    """``cells`` (tokens, weight) with ``p``: copies of each token, in proportion to weight
    per token and without a cap, so that ``tokens * p`` has the marginals of the weights."""
    row = cells.agg(F.sum("tokens").alias("tokens"), F.sum("weight").alias("weight")).first()
    factor = budget * (row["tokens"] or 0) / (row["weight"] or 1)
    return cells.withColumn("p", F.lit(float(factor)) * F.col("weight") / F.col("tokens"))


def drawn(doc_id: Column, p: Column, seed: int) -> Column:
    """A fixed draw by id: the first 32 bits of the id's and seed's MD5 as a fraction, below ``p``."""
    bits = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), doc_id.cast("string"))), 1, 8), 16, 10)
    return bits.cast("double") / F.lit(2.0 ** 32) < p


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: float = 0.6,
        power: float = 0.7, rounds: int = 6, seed: int = 1,
        targets: dict[str, DataFrame] | None = None, repeats: bool = False, once: bool = False) -> DataFrame:
    """``docs`` with ``topic, tokens, p, sampled``: the raked sampling probability and the draw.

    ``docs`` needs ``source`` and ``lang``; ``targets`` gives target shares by
    ``source``, ``lang`` and ``topic`` (key, share) and defaults to the corpus'
    own token shares to ``power``.  Expected tokens are ``budget`` of all.

    ``p`` ends at 1, and cells cut there miss their targets.  With ``repeats``, ``p`` is
    the expected number of copies and may exceed 1, the expected shares are the raked
    ones, and a column ``copies`` (int) has the number drawn: the whole part of ``p``,
    and one more with the rest as probability.  ``sampled`` then says ``copies > 0``.
    With ``once``, the columns ``p_once, sampled_once`` have the draw without repeats too.

    Null sources and languages are a value of their own, ``(none)``.  Null and
    empty texts have topic ``empty``, no tokens and p = 0: they add nothing to a
    mix and are never drawn.  Values without a target are not drawn either.  Rows with
    the same id are drawn together; null ids too, as one.  Columns of ``docs`` that
    have one of the result's names are replaced.  An empty table gives no rows.
    """
    own = ["topic", "tokens", "p", "sampled"] + ["copies"] * repeats + ["p_once", "sampled_once"] * once
    base = cells_of(docs.drop(*own, "_source", "_lang", "_topic", "_tokens"), text_col)
    return mix_cells(base, id_col, budget, power, rounds, seed, targets, repeats, once)


def mix_cells(base: DataFrame, id_col: str = "doc_id", budget: float = 0.6, power: float = 0.7, rounds: int = 6,
              seed: int = 1, targets: dict[str, DataFrame] | None = None, repeats: bool = False,
              once: bool = False) -> DataFrame:
    """``mix`` of rows that have the columns of their cell already (``cells_of``); their text is not needed."""
    keys = {f"_{k}": k for k in MARGINALS}
    cells = stored(base.groupBy(*keys).agg(F.sum("_tokens").alias("tokens")).where("tokens > 0")
                   .withColumnsRenamed(keys), "mix-cells")
    shares = targets or {k: tempered_targets(cells, k, power) for k in MARGINALS}
    shares = {k: stored(v, f"mix-target-{k}") for k, v in shares.items()}
    raked = rake(cells, shares, rounds)
    if once:
        raked = inclusion(raked, budget).withColumnRenamed("p", "p_once")
    p = (expected_copies if repeats else inclusion)(raked, budget)
    chances = ["p"] + ["p_once"] * once
    p = stored(p.select(*[F.col(k).alias(f"_{k}") for k in MARGINALS], *chances), "mix-probabilities")
    out = base.join(p, list(keys), "left").withColumns(
        {c: F.when(F.col("_tokens") > 0, F.coalesce(c, F.lit(0.0))).otherwise(0.0) for c in chances})
    by_id = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    if repeats:
        out = out.withColumn("copies", (F.floor("p") + drawn(by_id, F.col("p") - F.floor("p"), seed).cast("int")).cast("int"))
    out = out.withColumn("sampled", F.col("copies") > 0 if repeats else drawn(by_id, F.col("p"), seed))
    if once:
        out = out.withColumn("sampled_once", drawn(by_id, F.col("p_once"), seed))
    return out.withColumnsRenamed({"_topic": "topic", "_tokens": "tokens"}).drop("_source", "_lang")
