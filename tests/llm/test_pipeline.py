"""The pipeline against a plain version of each stage on its own input."""

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from retailstream.llm.common import read_table
from retailstream.llm.queries import OP4_SQL
from tests.conftest import SF_SMALL
from tests.llm.test_packing import check_sequences, plain_pieces
from tests.llm.test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output, as written tables."""
    out, docs = {}, read_table(spark, SF_SMALL, "documents")
    for i, (name, stage) in enumerate(P.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, SF_SMALL).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs, after)
        docs = after
    return out


def test_stage_names_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["toxicity", "line dedup", "SimHash near-dedup",
                                        "mixing sources to target weights", "best-fit packing"]
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.schema.names == list(P.COLUMNS) and after.dtypes == before.select(*P.COLUMNS).dtypes, name


def test_toxicity_stage_only_drops_toxic(stages, spark):
    from retailstream.llm.toxicity import fit, probability
    before, after = stages["toxicity"]
    labels = read_table(spark, SF_SMALL, "labels").where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0)
    kept = before.where(probability(fit(before, labels), F.col("text")) < 0.5)
    assert sorted(kept.collect()) == sorted(after.collect())
    assert 0 < after.count() <= before.count()


def test_line_stage(stages):
    before, after = stages["line dedup"]
    con = duckdb.connect()
    con.register("documents", before.toPandas())
    want = {r[0]: r[3] for r in con.execute(OP4_SQL).fetchall()}
    got = after.select("doc_id", F.sha2("text", 256).alias("h"), "n_chars", F.length("text").alias("n")).collect()
    assert {r.doc_id: r.h for r in got} == want
    assert all(r.n_chars == r.n for r in got)


def test_simhash_stage(stages):
    before, after = stages["SimHash near-dedup"]
    rows = before.collect()
    comp = plain_components({r.doc_id: plain_fingerprint(r.text) for r in rows})
    assert sorted(after.collect()) == sorted(r for r in rows if comp[r.doc_id] == r.doc_id)


def test_mixing_stage_keeps_whole_rows(stages):
    before, after = stages["mixing sources to target weights"]
    assert set(after.collect()) <= set(before.collect())
    assert 0.3 < after.count() / before.count() < 0.95


def test_packing_stage(stages):
    before, after = stages["best-fit packing"]
    rows = after.collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == plain_pieces(
        {r.doc_id: r.text for r in before.collect()})
    check_sequences(rows)


def test_stages_take_awkward_and_empty_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, drop string, id int, p double, u int"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "a b c d", "en", "s", 7), (3, "a b c d", "en", "s", 7),
            (None, "a b c d", "en", "s", 7), (4, "word " * 30_000, "en", None, 1), (5, "a b c d", None, "t", 7)]
    docs = spark.createDataFrame([(*r, "d", 1, 0.5, 2) for r in rows], schema)
    for name, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0, name
        out = stage(spark, docs, SF_SMALL)
        n = out.count()
        if name in ("toxicity", "line dedup"):
            assert n == len(rows), name
        if name == "SimHash near-dedup":   # 1 and 2 have no words; 3, 3, 5 are equal; the row without id stays
            assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 1, 3, 4]


def test_mixing_stage_repeats_rare_values(spark):
    """The drawn share of a rare topic is near its target, which needs each of its documents more than once."""
    rows = [(i, "w " * 400 + str(i), "en", "s", 1) for i in range(300)]
    rows += [(1000 + i, f"| a | b | c {i}", "en", "s", 1) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = P.mixing(spark, docs, SF_SMALL).groupBy((F.col("doc_id") >= 1000).alias("rare")).agg(
        F.sum(F.size(F.split("text", " "))).alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    n, count = ({r.rare: r[c] for r in got} for c in ("n", "rows"))
    tokens = {False: 300 * 401, True: 200 * 7}
    want = tokens[True] ** 0.7 / sum(t ** 0.7 for t in tokens.values())
    assert n[True] / sum(n.values()) == pytest.approx(want, rel=0.2) and count[True] > 200


def test_simhash_stage_keeps_one_row_of_each_group(spark):
    """Ids with rows of different texts: a near-copy goes, another group's first stays."""
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, a), (2, b), (2, a), (3, "C D E"), (3, "c d e"), (4, b), (5, "x y z"), (5, "p q r"), (None, "n n n")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r.doc_id or 0, r.text) for r in P.simhash_dedup(spark, docs, SF_SMALL).collect())
    assert got == sorted([(1, a), (2, b), (3, "C D E"), (5, "x y z"), (5, "p q r"), (0, "n n n")])


def test_packing_stage_writes_the_tokens(spark):
    docs = spark.createDataFrame([(1, "some words " * 3000), (2, "a b c"), (2, None)], "doc_id long, text string")
    rows = P.packing(spark, docs, SF_SMALL).collect()
    assert all(len(r.ids) == r.length and zlib.crc32(np.array(r.ids, np.int32).tobytes()) == r.ids_crc32 for r in rows)
    check_sequences(rows)
