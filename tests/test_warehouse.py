from pyspark.sql import functions as F

from retailstream.operators import reports
from retailstream.plans import queries as Q
from retailstream.plans.warehouse import build_warehouse
from retailstream.sources.tables import read_stats
from tests.conftest import SF_SMALL


def test_layered_build_equals_registered_queries(spark, tmp_dir):
    paths = build_warehouse(spark, SF_SMALL, tmp_dir)
    vs = read_stats(spark, paths["visitor_stats"])
    cols = ["stt", "vc", "ch", "ar", "is_new", "uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum", "ts"]
    assert sorted(vs.select(cols).collect()) == sorted(Q.q_visitor_stats(spark, SF_SMALL).select(cols).collect())
    ps = read_stats(spark, paths["product_stats"])
    assert sorted(reports.gmv(ps).collect()) == sorted(Q.q_gmv(spark, SF_SMALL).collect())
    day = ps.agg(F.min("dt")).first()[0]
    one = reports.trademark_top_n(read_stats(spark, paths["product_stats"], day), 10, day).collect()
    every = Q.q_brand_topn(spark, SF_SMALL).where(F.col("dt") == day).drop("dt").collect()
    assert [tuple(r) for r in one] == sorted([tuple(r) for r in every], key=lambda r: (-r[2], r[0]))
    kw = read_stats(spark, paths["keyword_stats"])
    assert kw.count() == Q.q_keyword_stats(spark, SF_SMALL).count()
    pr = read_stats(spark, paths["province_stats"])
    assert sorted(reports.province_amounts(pr).collect()) == sorted(Q.q_province_totals(spark, SF_SMALL).collect())
