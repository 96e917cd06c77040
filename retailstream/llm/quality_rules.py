"""Quality rules [native]: per-document rules, judged by host with a beta prior.

Documents are measured with built-in expressions only.  Each rule's failures
are counted by host (the document's ``source``), and the host's failure rate is
shrunk towards the mean of all hosts with a beta prior fitted to the hosts by
the method of moments, so small hosts need more evidence than large ones.  The
host verdicts are joined back and decide with the document's own failures:

* junk rules (too short, repeats itself): a failing document goes anyway; a host
  whose shrunk rate is over a quarter and three times the usual is refused whole;
* style rules (symbols, repeated lines): a failing document goes, unless the
  shrunk rate says that over half of its host's documents are like that.  The
  form is then the host's own (tables, code, verse) and says nothing about quality.

Counts are partial sums, so a host with a third of all rows is one row per task
in the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailstream.llm.common import SPACE, stored

JUNK = ("fail_short", "fail_repeats")
STYLE = ("fail_symbols", "fail_lines")
RULES = JUNK + STYLE
MAX_JUNK_RATE, TIMES_USUAL = 0.25, 3.0   # a host over both is refused: the rate, and the prior mean this often
STYLE_RATE = 0.5                         # a host over it has the form as its style


def _n_repeat_words(words: Column) -> Column:
    """Words that lie in a 3-word window found at least twice, the first one included.

    Windows are compared by 64-bit hash, sorted with their positions so that
    equal ones are neighbours: n log n in the words, whatever their number.
    """
    n = F.size(words)
    hashes = F.transform(F.slice(words, F.lit(1), F.greatest(n - 2, F.lit(0))), lambda w, i: F.xxhash64(
        w, F.get(words, i + 1), F.get(words, i + 2)))

    def positions(p: Column) -> Column:
        twice = F.filter(p, lambda x, i: (F.get(p, i - 1)["h"] == x["h"]) | (F.get(p, i + 1)["h"] == x["h"]))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        # a window covers 3 words, or as many as up to the next repeated window
        steps = F.transform(at, lambda a, i: F.least(F.coalesce(F.get(at, i + 1) - a, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)

    # most texts repeat no window: those skip the sort
    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
                .otherwise(_let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
                                lambda p: _let(positions(p), covered))))


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            host_col: str = "source") -> DataFrame:
    """Per document: id, host and n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines,
    n_repeat_words (long)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), text.alias("text"))
    split = base.select("id", "host", "text",
                        F.array_remove(F.split("text", SPACE + "+"), "").alias("words"),
                        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    return split.select(
        "id", "host", F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", SPACE + "+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _n_repeat_words(F.col("words")).alias("n_repeat_words"))


def rule_failures(m: DataFrame) -> DataFrame:
    """Add the boolean failures of each rule and ``base_failed``."""
    m = m.withColumns({
        "fail_short": F.col("n_words") < 50,
        "fail_repeats": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
        "fail_symbols": 10 * F.col("n_symbols") > F.col("word_chars"),
        "fail_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_lines"),
    })
    return m.withColumn("base_failed", F.col("fail_short") | F.col("fail_repeats"))


def host_rates(failures: DataFrame) -> DataFrame:
    """Per host: documents ``n``, for each rule the shrunk failure rate, and for each junk rule
    ``{rule}_limit``, the rate that refuses a host.

    Over hosts with rates r: mean m and variance v give the beta prior
    a + b = m (1 - m) / v - 1 (at least 1; so much that the rate becomes m where
    hosts do not differ), and a host's rate is (failures + m (a + b)) / (n + a + b).
    """
    counts = failures.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES])
    counts = stored(counts, "host-counts")
    moments = counts.agg(*[f(F.col(r) / F.col("n")).alias(f"{r}_{k}") for r in RULES
                           for k, f in (("m", F.avg), ("v", F.var_pop))]).first()
    rates, limits = {}, {}
    for r in RULES:
        m, v = moments[f"{r}_m"] or 0.0, moments[f"{r}_v"] or 0.0
        strength = max(m * (1 - m) / v - 1, 1.0) if v > 0 else 1e9
        rates[r] = (F.col(r) + m * strength) / (F.col("n") + strength)
        if r in JUNK:
            limits[f"{r}_limit"] = F.lit(max(MAX_JUNK_RATE, TIMES_USUAL * m))
    return counts.select("host", "n", *[rate.alias(r) for r, rate in rates.items()],
                         *[limit.alias(r) for r, limit in limits.items()])


def judge_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    host_col: str = "source") -> DataFrame:
    """Per row of ``docs``: ``{id_col}, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, host_ok, style_failed, kept``.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated
    3-word windows.  ``host_ok``: the host is not refused.  ``style_failed``: a tenth
    of the characters are symbols, or three tenths of the lines repeat earlier ones,
    and that is not the host's style.  ``kept``: ``host_ok`` and neither failed.

    A null text is empty.  Null hosts form one host.  Repeated rows count and are
    judged each.  Other columns are ignored.  An empty table gives no rows.
    """
    measured = stored(measure(docs, id_col, text_col, host_col), "quality-measures")
    failures = rule_failures(measured)
    rates = host_rates(failures)
    refused = F.lit(False)
    for r in JUNK:
        refused = refused | (F.col(r) > F.col(f"{r}_limit"))
    hosts = rates.select(F.col("host").alias("h"), (~refused).alias("host_ok"),
                         *[(F.col(r) > STYLE_RATE).alias(f"style_{r}") for r in STYLE])
    out = failures.join(hosts, F.col("host").eqNullSafe(F.col("h")))
    style_failed = F.lit(False)
    for r in STYLE:
        style_failed = style_failed | (F.col(r) & ~F.col(f"style_{r}"))
    return out.withColumn("style_failed", style_failed).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "host_ok", "style_failed", (F.col("host_ok") & ~F.col("base_failed") & ~F.col("style_failed")).alias("kept"))
