"""Registered queries against their SQL, on the smallest tables and on awkward rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from retailstream.llm import queries as Q
from tests.conftest import SF_SMALL
from tools.compare import canon

TABLES = ("documents", "pages", "embeddings", "labels", "conversations", "benchmark")

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, id int, fp long"
LINE = "a line that is long enough to be counted among the frequent ones"
LONG = " ".join(f"w{i % 700}" for i in range(60_000))
DOCS = [
    (1, None, "en", "s0", None), (2, "", "en", "s0", 0), (3, "   \t\n \x0b", None, None, 7),
    (4, LINE, "en", "s0", 1), (5, "  " + LINE.upper() + "\t", "en", "s0", 1), (6, f"x\n{LINE}\n{LINE}\ny", "de", "s1", 1),
    (7, LINE + "\r", "en", "s0", 1), (8, LINE + "\nend", "en", None, 1), (9, LINE, "en", "s0", 1), (9, LINE, "en", "s0", 1),
    (10, LONG, "fr", "s2", 1), (11, "a b c a b c a b c", "en", "s0", 1), (12, "é ü ß ## $$ | <x>\n\n\n", "de", "s2", 1),
    (13, "t | a | b | c\nu | d | e | f", "en", "s0", 1), (14, "word " * 60, "en", "s3", 1),
    (15, "This work is licensed under terms", "en", "s3", 1), (-5, "Ünï 中文 😀 " * 30, "es", "s1", 1),
]
URLS = [None, "", "no scheme", "http://", "http://a.org", "HTTP://WWW.Example.ORG/es/x?y#z", "http://example.org/es",
        "http://example.org/en/123", "x://y://z.org/es/", "http://a.com/fr/", "http://b.a.com/de/#q", "http://com/de/",
        "http://xcom/de/", "http://.org/", "http://org./x", "http://u@h.example.org:80/es/", "http://example.org/en/1?",
        "http://a..example.org/en/1", "http://notexample.org/es/1", "http://example.org//es/"]
NAN, INF = float("nan"), float("inf")
# ties, copies, equal ids, unusable components, vectors of another length
VECTORS = [(*r, 1, "v", 2) for r in [
    (50, [0.5, 0.5, 0.1], 1), (50, [0.5, 0.5, 0.1], 1), (100, [0.3, -0.2, 0.0], 2), (1, [0.5, 0.4, 0.1], 1),
    (2, [0.5, 0.4, 0.1], 1), (3, [0.25, 0.25, 0.3], 2), (4, [0.25, 0.25, 0.3], 2), (5, [0.25, 0.25, 0.3], 3),
    (7, [0.3, 0.4, 0.3], 9), (14, [0.3, 0.4, 0.3], 0), (21, None, 1), (22, [None, 0.5, 0.1], 1), (23, [NAN, 0.5, 0.1], 1),
    (24, [INF, 0.5, 0.1], 1), (25, [1e9, 0.5, 0.1], 1), (26, [0.5, 0.5, 0.1], None), (None, [0.5, 0.5, 0.1], 1),
    (150, [0.5, 0.5], 1), (151, [0.5, 0.4], 1), (152, [0.3, 0.3], 2), (2, [0.1, 0.4, 0.1], 2), (200, [-0.5, -0.5, 0.0], 4),
    (201, [0.4, 0.4, 0.0], 4), (250, [0.0, 0.0, 0.0], 5), (251, [0.0, 0.0, 0.0], 5), (300, [NAN, 0.0, 0.0], 6)]]


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    """Tables of nulls, empty and long texts, repeats and columns with clashing names."""
    d = str(tmp_path_factory.mktemp("odd"))
    docs = spark.createDataFrame([(*r, "k", 1, 2) for r in DOCS], DOC_SCHEMA)
    docs.coalesce(1).write.parquet(f"{d}/documents.parquet")
    pages = [(i % 15, u, "<html>", "h", "p", "r") for i, u in enumerate(URLS * 2)]
    (spark.createDataFrame(pages, "page_id long, url string, html string, host string, path string, rule string")
     .coalesce(1).write.parquet(f"{d}/pages.parquet"))
    (spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>, label int, row long, v string, score int")
     .coalesce(1).write.parquet(f"{d}/embeddings.parquet"))
    items = [(1, "This work is w1 w2 w3", 1), (1, "This work is w1 w2 w3", 1), (None, None, 2), (2, "", 3), (3, "Ünï a b", 4)]
    (spark.createDataFrame(items, "item_id long, text string, bucket int")
     .coalesce(1).write.parquet(f"{d}/benchmark.parquet"))
    return d


def connect(folder):
    con = duckdb.connect()
    for t in TABLES:
        try:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
        except duckdb.IOException:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')"
                        if t in ("documents", "pages", "embeddings", "benchmark") else f"CREATE VIEW {t} AS SELECT 1 AS x")
    return con


def same(spark, name, folder):
    df = Q.QUERIES[name](spark, folder)
    cur = connect(folder).execute(Q.ORACLES[name])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon([c[0] for c in cur.description], cur.fetchall())


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_small_tables(spark, name):
    same(spark, name, SF_SMALL)


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_awkward_rows(spark, odd_dir, name):
    same(spark, name, odd_dir)


@pytest.mark.parametrize("name", ["op2_quality_rules", "op4_line_dedup", "op5_mixing", "op7_best_fit_packing",
                                  "op3_simhash_dedup", "op11_license_scan", "op12_importance"])
def test_empty_documents(spark, tmp_path, name):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], DOC_SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert Q.QUERIES[name](spark, str(tmp_path)).count() == 0


def test_empty_pages_and_rules(spark, tmp_path):
    from retailstream.llm.url_filter import RULE_SCHEMA, filter_urls
    none = spark.createDataFrame([], "page_id long, url string")
    some = spark.createDataFrame([(1, "http://a.org/x"), (None, None)], "page_id long, url string")
    rules = spark.createDataFrame([("org", "", "block"), ("org", "", "allow"), ("a.org", "/x", "allow"),
                                   (None, "/", "block"), ("a/b", "/", "block")], RULE_SCHEMA)
    assert filter_urls(none, rules).count() == 0
    assert {(r.page_id, r.rule, r.verdict) for r in filter_urls(some, rules.limit(0)).collect()} == {
        (1, None, "allow"), (None, None, "allow")}
    assert {(r.page_id, r.rule, r.verdict) for r in filter_urls(some, rules).collect()} == {
        (1, "a.org/x", "allow"), (None, None, "allow")}
    # the same rule twice: block wins
    assert filter_urls(some.limit(1), rules.limit(2)).first().verdict == "block"


def test_many_nested_rules_match_brute_force(spark):
    import random

    from retailstream.llm.url_filter import RULE_SCHEMA, filter_urls
    rng = random.Random(3)
    hosts = ["a", "b.a", "c.b.a", "ab", "b", "a.b"]
    paths = ["", "/", "/x", "/x/", "/x/y", "/xy", "/z"]
    rules = [(h, p, rng.choice(["allow", "block"])) for h in hosts for p in paths if rng.random() < 0.5]
    urls = [(i, f"http://{rng.choice(['', 'w.', 'c.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', 'y', '/q'])}")
            for i in range(300)]

    def judge(url):
        host, _, rest = url[7:].partition("/")
        path = "/" + rest if "/" in url[7:] else ""
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (max(fits)[2:] if fits else (None, "allow"))

    got = {r.page_id: (r.rule, r.verdict) for r in filter_urls(
        spark.createDataFrame(urls, "page_id long, url string"), spark.createDataFrame(rules, RULE_SCHEMA)).collect()}
    assert got == {i: judge(u) for i, u in urls}


def test_native_plans_run_no_python(spark, odd_dir):
    for name in ("op2_quality_rules", "op5_mixing", "op10_url_filter", "op11_license_scan"):
        plan = Q.QUERIES[name](spark, odd_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow")), name


def test_raking_reaches_the_targets(spark):
    from retailstream.llm.mixing import rake
    cells = spark.createDataFrame([(s, l, t, 10 + 7 * i % 23) for i, (s, l, t) in enumerate(
        (s, l, t) for s in "abc" for l in "xy" for t in "pq")], "source string, lang string, topic string, tokens long")
    want = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"x": 0.6, "y": 0.4}, "topic": {"p": 0.25, "q": 0.75}}
    raked = rake(cells, {k: spark.createDataFrame(list(v.items()), f"{k} string, share double") for k, v in want.items()},
                 rounds=6)
    for key, shares in want.items():
        got = {r[0]: r[1] for r in raked.groupBy(key).agg(F.sum("weight")).collect()}
        assert got == pytest.approx(shares, abs=1e-4)


def test_sample_meets_its_budget(spark):
    out = Q.QUERIES["op5_mixing"](spark, SF_SMALL.replace("0.001", "0.01"))
    row = out.agg(F.sum(F.col("tokens") * F.col("p")).alias("e"), F.sum("tokens").alias("t"),
                  F.sum(F.when(F.col("sampled"), F.col("tokens"))).alias("s")).first()
    assert row.e / row.t == pytest.approx(0.6, abs=1e-3)
    assert row.s / row.t == pytest.approx(0.6, abs=0.1)


def test_mix_with_repeats_meets_its_targets(spark):
    """The marginals of tokens * copies, expected and drawn, with the defaults' targets."""
    from retailstream.llm.mixing import MARGINALS, cells_of, mix, tempered_targets
    docs = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet")
    cells = cells_of(docs).select(*[F.col(f"_{k}").alias(k) for k in MARGINALS], F.col("_tokens").alias("tokens"))
    out = mix(docs, repeats=True).withColumn("source", F.coalesce("source", F.lit("(none)"))).withColumn(
        "lang", F.coalesce("lang", F.lit("(none)"))).cache()
    total = out.agg(F.sum("tokens")).first()[0]
    for key in MARGINALS:
        want = {r[0]: r[1] for r in tempered_targets(cells, key, 0.7).collect()}
        rows = out.groupBy(key).agg(F.sum(F.col("tokens") * F.col("p")), F.sum(F.col("tokens") * F.col("copies"))).collect()
        assert {r[0]: r[1] / total / 0.6 for r in rows if r[1]} == pytest.approx(want, rel=0.02), key
        if key == "topic":
            assert {r[0]: r[2] / total / 0.6 for r in rows if r[1]} == pytest.approx(want, rel=0.25)
    assert out.where("p > 1").count() and out.where("abs(copies - p) >= 1 OR sampled != (copies > 0)").count() == 0
    out.unpersist()


def test_hosts_decide_on_their_documents(spark):
    """A junk host is refused, a small one of the same rate spared; symbols are pardoned where they are the style."""
    from retailstream.llm.quality_rules import judge_documents
    good, symbols = " ".join(f"w{i}" for i in range(80)), " ".join(f"#{i} | $x" for i in range(80))
    verse = "\n".join(["the same refrain again and again"] * 4 + [" ".join(f"v{i}x{j}" for j in range(20)) for i in range(4)])
    rows = []
    for h in range(40):
        rows += [(f"h{h}", "good", good)] * 38 + [(f"h{h}", "short", "a few words")] * 1 + [(f"h{h}", "symbols", symbols)]
    rows += [("junk", "short", "spam"), ("junk", "good", good)] * 100     # half of it junk
    rows += [("tiny", "short", "spam"), ("tiny", "good", good)]            # half of two: no evidence
    rows += [("tables", "symbols", symbols)] * 90 + [("tables", "good", good)] * 10
    rows += [("songs", "verse", verse)] * 80 + [("h1", "verse", verse)]
    docs = spark.createDataFrame([(i, t, h, k) for i, (h, k, t) in enumerate(rows)],
                                 "doc_id long, text string, source string, kind string")
    out = judge_documents(docs).join(docs.select("doc_id", "source", "kind"), "doc_id")
    kept = {(r.source, r.kind): (r.n, r.kept) for r in out.groupBy("source", "kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("kept").cast("int")).alias("kept")).collect()}
    assert kept["junk", "good"] == (100, 0) and kept["tiny", "good"] == (1, 1)
    assert kept["h3", "good"] == (38, 38) and kept["h3", "short"] == (1, 0) and kept["h3", "symbols"] == (1, 0)
    assert kept["tables", "symbols"] == (90, 90) and kept["tables", "good"] == (10, 10)
    assert kept["songs", "verse"] == (80, 80) and kept["h1", "verse"] == (1, 0)


def test_host_verdicts_change_results_on_the_tables(spark):
    """On the supplied tables documents of bad form go and labelled good ones stay."""
    folder = SF_SMALL.replace("0.001", "0.01")
    out = Q.QUERIES["op2_quality_rules"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    good = out.where("quality = 1 AND NOT base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    bad = out.where("style_failed").agg(F.avg("quality"), F.count(F.lit(1))).first()
    assert good > 0.97 and bad[0] < 0.1 and bad[1] > 10


def test_mix_query_meets_its_targets(spark):
    from retailstream.llm.mixing import tempered_targets
    out = Q.QUERIES["op5_mixing"](spark, SF_SMALL.replace("0.001", "0.01")).where("tokens > 0").cache()
    total = out.agg(F.sum("tokens")).first()[0]
    want = {r[0]: r[1] for r in tempered_targets(out.groupBy("topic").agg(F.sum("tokens").alias("tokens")), "topic", 0.7).collect()}
    got = {r[0]: r[1] / total / 0.6 for r in out.groupBy("topic").agg(F.sum(F.col("tokens") * F.col("p"))).collect()}
    assert got == pytest.approx(want, rel=0.02)
    out.unpersist()


def test_inclusion_meets_its_budget_in_any_number_of_steps(spark):
    """Thirty cells of which each step keeps one more whole: the budget is met, as by halving."""
    from retailstream.llm.mixing import inclusion
    rows = [(f"s{i}", 2 ** (30 - i), 0.2 ** i) for i in range(30)]
    goal = sum(t for _, t, _ in rows) - 2
    got = {r.source: r.p for r in inclusion(spark.createDataFrame(rows, "source string, tokens long, weight double"),
                                            goal / (goal + 2)).collect()}
    assert sum(got[s] * t for s, t, _ in rows) == pytest.approx(goal, abs=1e-3)
    low, high = 0.0, 1e40
    for _ in range(300):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(min(t, mid * w) for _, t, w in rows) < goal else (low, mid)
    assert [got[s] for s, _, _ in rows] == pytest.approx([min(1.0, low * w / t) for _, t, w in rows], rel=1e-3)


def test_mix_query_draws_without_repeats_too(spark):
    """``p_once`` meets the budget with no document twice; cells not kept whole have one multiple of ``p``."""
    out = Q.QUERIES["op5_mixing"](spark, SF_SMALL.replace("0.001", "0.01")).cache()
    row = out.agg(F.sum(F.col("tokens") * F.col("p_once")).alias("e"), F.sum("tokens").alias("t"), F.max("p_once").alias("most"),
                  F.sum(F.when(F.col("sampled_once"), F.col("tokens"))).alias("s")).first()
    assert row.e / row.t == pytest.approx(0.6, abs=1e-4) and row.most == 1.0
    assert row.s / row.t == pytest.approx(0.6, abs=0.1)
    part = out.where("p_once > 0.01 AND p_once < 1").agg(F.min(F.col("p_once") / F.col("p")), F.max(F.col("p_once") / F.col("p"))).first()
    assert part[0] == pytest.approx(part[1], rel=1e-3) and part[0] > 1
    assert out.where("p > 1 AND NOT sampled_once").count() == 0 and out.where("sampled AND NOT sampled_once").count() == 0
    assert out.where("sampled_once AND NOT sampled").count() > 0
    out.unpersist()
