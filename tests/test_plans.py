"""Plan properties that matter at scale, pinned on the small tables."""

import contextlib
import io

from retailstream.plans import queries as Q
from tests.conftest import SF_SMALL


def _plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_filters_and_columns_reach_the_scan(spark):
    p = _plan(Q.q_payment_wide(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,F)" in p
    # lineitem is read with the used columns only, never all of them
    for line in p.splitlines():
        if line.startswith("ReadSchema:") and "l_orderkey" in line:
            assert "l_returnflag" not in line


def test_neighbour_shuffles_wide_rows_once(spark):
    """The windowed rows are joined to the bucket edges where they are."""
    p = _plan(Q.q_bounce_detect(spark, SF_SMALL), "simple").split("Initial Plan")[-1]
    exchanges = [ln for ln in p.splitlines() if "Exchange hashpartitioning" in ln]
    assert sum("_bkt" in ln for ln in exchanges) <= 3 and len(exchanges) <= 4


def test_plans_are_built_without_running_jobs(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "building plans")
    try:
        for name in ("product_stats", "gmv", "order_wide", "keyword_score", "cdc_route"):
            Q.QUERIES[name](spark, SF_SMALL)
        jobs = tracker.getJobIdsForGroup("plan-only")
        # at most the footers of each table read for its schema
        assert len(jobs) <= 5 * 14
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_gmv_scans_and_joins_no_more_than_it_needs(spark):
    p = _plan(Q.q_gmv(spark, SF_SMALL), "simple")
    assert p.count("FileScan") <= 14
    assert sum("Join" in ln for ln in p.splitlines()) <= 6   # no lookup of names, provinces or users


def test_new_visitor_repair_shuffles_candidates_only(spark):
    p = _plan(Q.q_new_visitor_repair(spark, SF_SMALL), "simple")
    assert "Union" in p


def test_one_day_report_reads_one_day(spark):
    p = _plan(Q.q_visitor_day(spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(dt" in p and Q.REPORT_DAY in p


def test_per_day_top_n_limits_before_the_shuffle(spark):
    p = _plan(Q.q_brand_topn(spark, SF_SMALL))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_latest_per_key_is_a_partial_aggregation(spark):
    p = _plan(Q.q_changelog_state(spark, SF_SMALL))
    assert "partial_max_by" in p
    assert "row_number" not in p


def test_each_line_is_parsed_once(spark):
    """Inside a generator, with the clean/dirty filter above it; the repair and
    the split read the parsed table."""
    physical = _plan(Q.q_dirty_split(spark, SF_SMALL), "extended").split("== Physical Plan ==")[1].splitlines()
    assert sum("Generate" in ln and "parseJson" in ln for ln in physical) == 1
    assert not any("Filter" in ln and "parseJson" in ln for ln in physical)
    assert "parseJson" not in _plan(Q.q_start_page_split(spark, SF_SMALL), "extended")
