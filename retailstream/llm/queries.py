"""One query per operator over the supplied tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailstream.llm.common import read_table

# fixed values of the URL contract: host, path, verdict
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from retailstream.llm.url_filter import RULE_SCHEMA, filter_urls
    return filter_urls(read_table(spark, sf_dir, "pages"), spark.createDataFrame(URL_RULES, RULE_SCHEMA))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from retailstream.llm.quality_rules import judge_documents
    return judge_documents(read_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from retailstream.llm.line_dedup import dedup_lines
    return dedup_lines(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from retailstream.llm.simhash import near_duplicates
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def transcripts(conversations: DataFrame) -> DataFrame:
    """``conv, pos, role, text``: the turns as rows of raw transcripts.

    Markers are written in four styles, by conversation; of every eighth turn or so
    the marker is missing and only a blank line tells that someone else speaks.
    """
    role, text = F.col("role"), F.col("text")
    # fixed values: how the styles name the roles
    names = [{"system": "System: ", "user": "User: ", "assistant": "Assistant: "},
             {"system": "### System\n", "user": "### Human\n", "assistant": "### Assistant\n"},
             {"system": "[system] ", "user": "Q: ", "assistant": "A: "},
             {"system": "<system> ", "user": "<user> ", "assistant": "<bot> "}]
    style = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(4))
    marker = F.lit("")
    for i, by_role in enumerate(names):
        for r, mark in by_role.items():
            marker = F.when((style == i) & (role == r), mark).otherwise(marker)
    unmarked = F.pmod(F.crc32(F.concat_ws(":", "conv_id", "turn")), F.lit(8)) == 0
    return conversations.select(
        F.col("conv_id").alias("conv"), F.col("turn").alias("pos"), role,
        F.concat(F.when(unmarked, F.lit("\n")).otherwise(marker), text).alias("text"))


def transcript_lines(rows: DataFrame) -> DataFrame:
    """``conv, pos, text``: each line of the transcripts as a row; nothing says where a turn begins."""
    return rows.select("conv", "pos", F.posexplode(F.split("text", "\n")).alias("line", "text")).select(
        "conv", (F.shiftleft(F.col("pos").cast("long"), 32) + F.col("line")).alias("pos"), "text")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from retailstream.llm.chat_format import fit, format_turns
    rows = transcripts(read_table(spark, sf_dir, "conversations"))
    learn = rows.where(F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(5)) != 0)   # the others are held out
    return format_turns(transcript_lines(rows), fit(learn)).select(
        F.col("conv").alias("conv_id"), "turn", "role", "begins", "n_lines", "rendered")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from retailstream.llm.packing import pack
    return pack(read_table(spark, sf_dir, "documents"))


def _part(n: int):
    """crc32 of the id as text, modulo n: which rows are held out."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n)), F.lit(-1))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from retailstream.llm.toxicity import fit, score_documents
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels").where(_part(5) != 0))
    return score_documents(docs, model).select("doc_id", (_part(5) == 0).alias("held_out"), "score", "predicted")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from retailstream.llm.byte_cnn import fit, score_documents
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels").where(_part(4) != 2))
    return score_documents(docs, model).select("doc_id", (_part(4) == 2).alias("held_out"), "score", "predicted")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from retailstream.llm.embedding_dedup import near_duplicates
    return near_duplicates(read_table(spark, sf_dir, "embeddings"), least=0.9)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from retailstream.llm.common import stored
    from retailstream.llm.mixing import cells_of, mix_cells
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    rows = stored(cells_of(docs).drop("text"), "mix-documents")   # the texts' words are counted once
    return mix_cells(rows, repeats=True, once=True).select(
        "doc_id", "topic", "tokens", F.round("p", 6).alias("p"), "copies", "sampled",
        F.round("p_once", 6).alias("p_once"), "sampled_once")


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from retailstream.llm.license_scan import scan_licenses
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from retailstream.llm.importance import resample
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from retailstream.llm.hard_negatives import hard_negatives
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(read_table(spark, sf_dir, "embeddings"), label=label, is_anchor=F.col("vec_id") % 50 == 0)


QUERIES = {
    "op1_toxicity": op1_toxicity, "op2_quality_rules": op2_quality_rules, "op3_simhash_dedup": op3_simhash_dedup,
    "op4_line_dedup": op4_line_dedup, "op5_mixing": op5_mixing, "op6_embedding_dedup": op6_embedding_dedup,
    "op7_best_fit_packing": op7_best_fit_packing, "op8_chat_format": op8_chat_format,
    "op9_quality_classifier": op9_quality_classifier, "op10_url_filter": op10_url_filter,
    "op11_license_scan": op11_license_scan, "op12_importance": op12_importance,
    "op13_hard_negatives": op13_hard_negatives,
}

OP10_SQL = """
WITH p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(h, pre, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
hit AS (
  SELECT DISTINCT host, path, arg_max(h || pre, length(h || pre)) OVER w AS rule,
         arg_max(verdict, length(h || pre)) OVER w AS verdict
  FROM (SELECT DISTINCT host, path FROM p)
  JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre)
  WINDOW w AS (PARTITION BY host, path))
SELECT page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN hit ON p.host = hit.host AND p.path = hit.path
"""

OP2_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
m AS (
  SELECT rid, doc_id, source, text,
         regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
w AS (SELECT rid, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM m),
g AS (SELECT rid, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY rid ORDER BY i)),
r AS (SELECT rid, i, c IS NOT NULL AND count(*) OVER (PARTITION BY rid, a, b, c) > 1 AS twice FROM g),
cov AS (
  SELECT rid, count(*) FILTER (WHERE covered) AS n_repeat_words
  FROM (SELECT rid, bool_or(twice) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS covered
        FROM r)
  GROUP BY rid),
f AS (
  SELECT m.rid, doc_id, source, len(words)::BIGINT AS n_words,
         coalesce(length(array_to_string(words, '')), 0)::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         len(lines) AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM m LEFT JOIN cov USING (rid)),
x AS (
  SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2,
         10 * n_symbols > word_chars AS f3, 10 * n_dup_lines > 3 * n_lines AS f4
  FROM f),
h AS (
  SELECT source, count(*)::DOUBLE AS n, sum(f1::INT)::DOUBLE AS c1, sum(f2::INT)::DOUBLE AS c2,
         sum(f3::INT)::DOUBLE AS c3, sum(f4::INT)::DOUBLE AS c4
  FROM x GROUP BY source),
mo AS (
  SELECT avg(c1/n) AS m1, var_pop(c1/n) AS v1, avg(c2/n) AS m2, var_pop(c2/n) AS v2,
         avg(c3/n) AS m3, var_pop(c3/n) AS v3, avg(c4/n) AS m4, var_pop(c4/n) AS v4 FROM h),
st AS (
  SELECT *, CASE WHEN v1 > 0 THEN greatest(m1*(1-m1)/v1 - 1, 1) ELSE 1e9 END AS s1,
            CASE WHEN v2 > 0 THEN greatest(m2*(1-m2)/v2 - 1, 1) ELSE 1e9 END AS s2,
            CASE WHEN v3 > 0 THEN greatest(m3*(1-m3)/v3 - 1, 1) ELSE 1e9 END AS s3,
            CASE WHEN v4 > 0 THEN greatest(m4*(1-m4)/v4 - 1, 1) ELSE 1e9 END AS s4 FROM mo),
ok AS (
  SELECT source, NOT ((c1+m1*s1)/(n+s1) > greatest(0.25, 3.0*m1) OR (c2+m2*s2)/(n+s2) > greatest(0.25, 3.0*m2)) AS host_ok,
         (c3+m3*s3)/(n+s3) > 0.5 AS style3, (c4+m4*s4)/(n+s4) > 0.5 AS style4
  FROM h, st)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed, host_ok,
       (f3 AND NOT style3) OR (f4 AND NOT style4) AS style_failed,
       host_ok AND NOT (f1 OR f2) AND NOT ((f3 AND NOT style3) OR (f4 AND NOT style4)) AS kept
FROM x JOIN ok ON x.source IS NOT DISTINCT FROM ok.source
"""

OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM d),
k AS (SELECT rid, doc_id, i, line,
             translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM l),
f AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT rid, k.doc_id, i, line, coalesce(k.doc_id < holder, false) AS gone FROM k LEFT JOIN f USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY rid
"""

# the parameters of mix(): share of tokens drawn, flattening power, raking rounds
BUDGET, POWER, ROUNDS = 0.6, 0.7, 6


def _op5_sql() -> str:
    """Raking by window sums, one step of one marginal at a time.

    The factor of the draw without repeats is the largest that any number of whole cells
    gives, in the order of weight per token: it has no number of steps.
    """
    steps, last = [], "c"
    for i in range(ROUNDS):
        for key in ("source", "lang", "topic"):
            steps.append(f"r{i}{key} AS (SELECT c.* REPLACE (weight * share / sum(weight) OVER (PARTITION BY {key}) "
                         f"AS weight) FROM {last} c JOIN t_{key} USING ({key}))")
            last = f"r{i}{key}"
    targets = ", ".join(
        f"t_{k} AS (SELECT {k}, pow(t, {POWER}) / sum(pow(t, {POWER})) OVER () AS share FROM "
        f"(SELECT {k}, sum(tokens)::DOUBLE AS t FROM c GROUP BY 1))" for k in ("source", "lang", "topic"))
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, text,
         len(string_split(text, chr(10))) AS n_lines,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS tokens
  FROM documents),
e AS (
  SELECT *, CASE WHEN text IS NULL OR text = '' THEN 'empty'
                 WHEN length(text) - length(replace(text, '|', '')) >= 3 * n_lines THEN 'table'
                 WHEN contains(lower(text), 'licen') THEN 'notice'
                 WHEN length(text) < 80 * n_lines THEN 'list' ELSE 'prose' END AS topic
  FROM d),
c AS MATERIALIZED (
  SELECT source, lang, topic, sum(tokens) AS tokens, sum(tokens)::DOUBLE / (SELECT sum(tokens) FROM e) AS weight
  FROM e WHERE tokens > 0 GROUP BY ALL),
{targets},
{", ".join(s.replace(" AS (", " AS MATERIALIZED (", 1) for s in steps)},
f AS (SELECT {BUDGET} * sum(tokens) / sum(weight) AS f FROM {last}),
w AS (
  SELECT tokens, coalesce(sum(tokens) OVER before, 0) AS kept, sum(weight) OVER rest AS free FROM {last}
  WINDOW before AS (ORDER BY weight / tokens DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest AS (ORDER BY weight / tokens DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
o AS (SELECT max(({BUDGET} * (SELECT sum(tokens) FROM w) - kept) / free) AS o FROM w),
p AS (SELECT source, lang, topic, f * weight / tokens AS p, least(1.0, o * weight / tokens) AS p_once FROM {last}, f, o),
x AS (
  SELECT doc_id, e.topic, e.tokens, CASE WHEN e.tokens > 0 THEN coalesce(p, 0) ELSE 0 END AS p,
         CASE WHEN e.tokens > 0 THEN coalesce(p_once, 0) ELSE 0 END AS p_once,
         ('0x' || substr(md5('1:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 AS draw
  FROM e LEFT JOIN p USING (source, lang, topic))
SELECT doc_id, topic, tokens, round(p, 6) AS p, (floor(p) + (draw < p - floor(p))::INT)::INT AS copies,
       floor(p) + (draw < p - floor(p))::INT > 0 AS sampled, round(p_once, 6) AS p_once, draw < p_once AS sampled_once
FROM x
"""


def _op11_sql() -> str:
    """Votes for diagonals, merged and verified, from the same templates."""
    from retailstream.llm.license_scan import GRAM, MAX_SHIFT, MIN_COVER, TEMPLATES
    quoted = ", ".join("({}, '{}', '{}', {}, '{}')".format(i, label, kind, GRAM[kind], text.replace("'", "''"))
                       for i, (label, kind, text) in enumerate(TEMPLATES))
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    grams = ("unnest(list_transform(range(len(words) - k + 1), lambda i: list_aggregate(words[i + 1:i + k], "
             "'string_agg', ' ')))")
    return rf"""
WITH t0(tpl, label, kind, k, text) AS (VALUES {quoted}),
t AS (SELECT tpl, label, kind, k, {words.format(lower.format("text"))} AS words FROM t0),
tg AS (SELECT tpl, label, kind, k, len(words) AS n, {grams} AS gram, unnest(range(len(words) - k + 1)) AS tat FROM t),
d AS (SELECT row_number() OVER () AS rid, doc_id, {words.format(lower.format("coalesce(text, '')"))} AS words
      FROM documents),
dg AS (SELECT rid, k, {grams} AS gram, unnest(range(len(words) - k + 1)) AS pos
       FROM d, (SELECT DISTINCT k FROM t) WHERE len(words) >= k),
v AS (SELECT rid, tpl, label, kind, k, n, pos - tat AS diag, list(DISTINCT tat) AS votes
      FROM dg JOIN tg USING (k, gram) GROUP BY ALL),
ph AS (SELECT rid, label, diag AS place FROM v WHERE kind = 'phrase' AND len(votes) = n - k + 1),
i0 AS (SELECT *, coalesce(diag - lag(diag) OVER (PARTITION BY rid, tpl ORDER BY diag) > {MAX_SHIFT}, true)::INT AS apart
       FROM v WHERE kind = 'notice'),
i1 AS (SELECT *, sum(apart) OVER (PARTITION BY rid, tpl ORDER BY diag) AS island FROM i0),
i2 AS (SELECT rid, tpl, label, k, n, island, list_sort(list_distinct(flatten(list(votes)))) AS votes
       FROM i1 GROUP BY ALL),
no AS (SELECT rid, label, round(list_sum(list_transform(votes, lambda x, j: least(coalesce(votes[j + 1] - x, k), k)))
                                / n::DOUBLE, 6) AS cover FROM i2),
f AS (SELECT rid, label, place, 1.0::DOUBLE AS cover, true AS ok FROM ph
      UNION ALL SELECT rid, label, NULL, cover, cover >= {MIN_COVER} FROM no),
r AS (SELECT rid, count(place) AS n_base, min(place) AS first_word, max(place) AS last_word,
             list_sort(list(DISTINCT label) FILTER (WHERE place IS NOT NULL)) AS base_labels,
             list_sort(list(DISTINCT label) FILTER (WHERE ok)) AS labels, max(cover) AS score FROM f GROUP BY rid)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(array_to_string(base_labels, ','), '') AS base_labels,
       coalesce(array_to_string(labels, ','), '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN r USING (rid)
"""


OP12_SQL = r"""
WITH RECURSIVE
tbl AS MATERIALIZED (
  SELECT list(list_reduce([b] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY b) AS crcs FROM range(256) r(b)),
t AS (
  SELECT 'd' AS side, row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, coalesce(text, '') FROM benchmark),
w AS MATERIALIZED (
  SELECT side, rid, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM t),
f AS MATERIALIZED (
  SELECT side, rid, unnest(words || list_transform(range(len(words) - 1), lambda i: words[i + 1] || ' ' || words[i + 2]))
         AS feature FROM w),
b AS MATERIALIZED (
  SELECT feature, xor(list_reduce([4294967295::BIGINT] || list_transform(
           range(octet_length(encode(feature))), lambda i: ('0x' || hex(encode(feature))[2 * i + 1:2 * i + 2])::BIGINT),
           lambda c, x: xor(c >> 8, crcs[(xor(c, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM f), tbl),
n AS (SELECT bucket, count(*) FILTER (WHERE side = 'd') AS s, count(*) FILTER (WHERE side = 'b') AS t
      FROM f JOIN b USING (feature) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (SELECT coalesce(sum(s), 0) + 10000 FROM n)::DOUBLE)
                                     / ((s + 1)::DOUBLE * (SELECT coalesce(sum(t), 0) + 10000 FROM n)::DOUBLE))) AS gain
      FROM n),
m AS (SELECT rid, count(*) AS n_features, floor(sum(gain) / count(*))::BIGINT AS weight
      FROM f JOIN b USING (feature) JOIN g USING (bucket) WHERE side = 'd' GROUP BY rid),
x AS (
  SELECT doc_id, len(words) >= 20 AS able, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT
                                                     + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN m USING (rid) WHERE side = 'd'),
r AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
             25 * count(*) OVER (PARTITION BY able) // 100 AS draws FROM x)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= draws THEN place END AS rank FROM r
"""

OP13_SQL = """
WITH e AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, * FROM (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT coalesce(isfinite(x) AND abs(256 * x::DOUBLE) <= 16777216,
                                                                         false))) = 0)),
s AS MATERIALIZED (
  SELECT a.rid AS a, a.vec_id AS anchor_id, b.rid AS b, b.vec_id AS id, a.label = b.label AS same,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.rid <> b.rid AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT a, anchor_id, b, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id, b) <= 5)
SELECT p.anchor_id, positive_id,
       (row_number() OVER (PARTITION BY a, p.b ORDER BY s.score DESC, s.id, s.b))::INT AS rank,
       s.id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (a)
WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY a, p.b ORDER BY s.score DESC, s.id, s.b) <= 3
"""


ORACLES = {"op2_quality_rules": OP2_SQL, "op4_line_dedup": OP4_SQL, "op5_mixing": _op5_sql(),
           "op10_url_filter": OP10_SQL, "op11_license_scan": _op11_sql(), "op12_importance": OP12_SQL,
           "op13_hard_negatives": OP13_SQL}
