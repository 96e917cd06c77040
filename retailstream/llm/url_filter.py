"""URL filters [native]: longest matching host and path rule by a range join.

Canonical keys.  A rule ``(host, path)`` becomes its host's labels in reverse
order, ``#`` (which no host can hold) and the path, e.g. ``org.example#/es/``.
A rule fits a URL exactly if the rule's key is a prefix of the URL's key *at the
depth of the rule's host*: a URL of host ``www.example.org`` has one key for each
of its domains ``org``, ``org.example``, ``org.example.www``, as far as rules go
that deep.

Sweep.  A prefix is the interval of keys that start with it, and two such
intervals are disjoint or nested.  Rules and URL keys are put in one sorted
order (range partitioning, so a frequent host or key is spread over many
tasks); each key's nearest rule at or before it brings the stack of rules that
were open there (the rule and all its own prefixes), and the deepest entry of
that stack which still covers the key is the answer.  Each partition starts
from the last rule of the partitions before it.  Only the rules' own prefix
chains are joined by equality, to build the stacks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailstream.llm.common import stored

RULE_SCHEMA = "host string, path string, verdict string"


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.array_join(labels, "."), F.lit("#"), path)


def _rule_stacks(rules: DataFrame) -> DataFrame:
    """Per distinct rule key: its stack, the rules whose keys are prefixes of it
    (itself included), as an array of (len, key, rule, verdict), deepest last.

    Of two rules with the same key and different verdicts, block wins.
    """
    r = (rules.where(F.col("host").isNotNull() & F.col("path").isNotNull() & ~F.col("host").rlike("[/?#]"))
         .select(ascii_lower(F.col("host")).alias("host"), "path", "verdict")
         .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))   # 'block' > 'allow'
         .select(_key(F.reverse(F.split("host", r"\.")), F.col("path")).alias("rkey"),
                 F.concat("host", "path").alias("rule"), "verdict"))
    r = r.select("rkey", F.struct(F.length("rkey").alias("len"), "rkey", "rule", "verdict").alias("entry"))
    # a key's prefixes: all cuts after its host, compared with the rules' own keys
    cuts = F.sequence(F.instr("rkey", "#"), F.length("rkey"))
    chain = r.select("rkey", F.explode(F.transform(cuts, lambda n: F.substring(F.col("rkey"), F.lit(1), n)))
                     .alias("prefix"))
    return (chain.join(r.select(F.col("rkey").alias("prefix"), "entry"), "prefix")
            .groupBy("rkey").agg(F.sort_array(F.collect_list("entry")).alias("stack")))


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """Judge every row of ``pages``: ``{id_col}, host, path, rule, verdict``.

    ``rules``: ``host, path, verdict`` (``allow`` or ``block``).  A rule fits its
    host and all its subdomains when the URL's path starts with the rule's path;
    the longest rule (host and path together) wins, then the longer host; of the
    same rule twice, block wins.  ``rule`` is host and path of the winner, null
    if none fits, and the verdict then is ``default``.

    Null or unparsable URLs have empty host and path.  An empty path starts only
    with an empty one.  Repeated rows and ids are judged row by row; other columns
    of ``pages`` are ignored.  Rules with a null host or path, or with ``/``, ``?``
    or ``#`` in the host, never fit.  An empty ``pages`` gives an empty result, an
    empty ``rules`` gives ``default`` throughout.
    """
    judged = pages.select(F.col(id_col).alias(id_col), host_of(F.col(url_col)).alias("host"),
                          path_of(F.col(url_col)).alias("path"))
    # one row for each rule, with its stack: read by two branches, so written once
    stacks = stored(_rule_stacks(rules), "url-rules")
    deepest = stacks.agg(F.max(F.size(F.split(F.substring_index("rkey", "#", 1), r"\.")))).first()[0] or 1

    # distinct URLs before the sweep; one key for each domain a rule could name
    labels = F.reverse(F.split("host", r"\."))
    levels = F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest)))
    urls = (judged.select("host", "path").distinct()
            .select("host", "path", F.explode(F.transform(
                levels, lambda n: _key(F.slice(labels, F.lit(1), n), F.col("path")))).alias("key")))
    # the sweep: rules before URLs at equal keys; host and path split equal keys over tasks
    empty_stack = F.lit(None).cast(stacks.schema["stack"].dataType)
    events = urls.select("key", F.lit(1).alias("kind"), "host", "path", empty_stack.alias("stack")).unionByName(
        stacks.select(F.col("rkey").alias("key"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("host"),
                      F.lit(None).cast("string").alias("path"), "stack"))
    swept = stored(events.repartitionByRange("key", "kind", "host", "path")
                   .withColumn("part", F.spark_partition_id()), "url-sweep")
    # the rule still open at the start of a partition: the last rule of any earlier one
    last = (swept.where("kind = 0").groupBy("part").agg(F.max_by("stack", "key").alias("stack")))
    starts = (swept.groupBy("part").agg(F.lit(1).alias("one")).join(last, "part", "left")
              .select("part", F.last("stack", ignorenulls=True).over(
                  Window.partitionBy("one").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
                  .alias("carried")))
    order = Window.partitionBy("part").orderBy("key", "kind")
    open_stack = swept.select("part", "key", "kind", "host", "path", F.last("stack", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, 0)).alias("opened")).where("kind = 1")
    # the stack's entries that still cover the key; the last one is the longest
    deepest_open = F.try_element_at(F.filter("stack", lambda e: F.col("key").startswith(e["rkey"])), F.lit(-1))
    best = (open_stack.join(starts, "part", "left")
            .select("host", "path", "key", F.coalesce("opened", "carried").alias("stack"))
            .select("host", "path", deepest_open.alias("hit"))
            .where(F.col("hit").isNotNull())
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.col("hit.len").alias("len"),
                                F.length(F.substring_index("hit.rkey", "#", 1)).alias("host_len"),
                                F.col("hit.rule").alias("rule"), F.col("hit.verdict").alias("verdict"))).alias("b")))
    return (judged.join(best, ["host", "path"], "left")
            .select(id_col, "host", "path", F.col("b.rule").alias("rule"),
                    F.coalesce("b.verdict", F.lit(default)).alias("verdict")))
