from pyspark.sql import functions as F

from retailstream.operators import logs

LINES = [
    (1, '{"common":{"mid":"a","is_new":"1"},"page":{"page_id":"home","during_time":5},'
        '"displays":[{"item":"7","item_type":"sku_id"},{"item":"x","item_type":"activity"}],"ts":1000}'),
    (2, '{"common":{"mid":"a","is_new":"1"},"start":{"entry":"icon"},"ts":2000}'),
    (3, '{"common":{"mid":"b","is_new":"0"},"page":{"page_id":"cart"},"displays":[],"ts":3000}'),
    (4, '{"common":{"mid":"b","is_new":"0"},"page":{"page_id":"cart"},"displays":null,"ts":4000}'),
    (5, '{"common":{"mid":"b"},"page":{"page_id":"x"'),           # dirty: cut short
    (6, "not json at all"),                                     # dirty
    (7, '{"common":{"mid":"c"},"start":{},"ts":7000}'),          # empty start object still counts as start
    (8, '{"common":{"mid":"d"},"page":{"page_id":"p","during_time":"12"},"ts":8000.0}'),   # types do not matter
    (9, '{"common":{"mid":"d"},"start":"x","ts":9000}'),         # nor that of start
    (10, '{"common":{"mid":"d"},"ts":1} garbage'),               # dirty: text after the record
    (11, '{} {}'), (12, '5'), (13, ''), (14, None),              # dirty
]


def _parsed(spark):
    raw = spark.createDataFrame(LINES, "seq long, value string")
    return logs.split_dirty(logs.parse_json(raw))


def test_dirty_side_output_keeps_text(spark):
    clean, dirty = _parsed(spark)
    assert sorted((tuple(r) for r in dirty.collect())) == [LINES[i] for i in (4, 5, 9, 10, 11, 12, 13)]
    assert clean.count() == 7
    row = clean.where("seq = 8").select("log.page.during_time", "log.ts").first()
    assert tuple(row) == (12, 8000)


def test_start_page_route(spark):
    clean, _ = _parsed(spark)
    r = logs.route_start_page(logs.flatten(clean, keep=("seq",)))
    got = {x["seq"]: x["route"] for x in r.select("seq", "route").collect()}
    assert got == {1: "page", 2: "start", 3: "page", 4: "page", 7: "start", 8: "page", 9: "start"}


def test_display_explode_full_empty_null(spark):
    clean, _ = _parsed(spark)
    pages = logs.route_start_page(logs.flatten(clean, keep=("seq",))).where(F.col("route") == "page")
    d = logs.explode_displays(pages).select("seq", "page_id", "item", "item_type").collect()
    assert sorted(tuple(x) for x in d) == [(1, "home", "7", "sku_id"), (1, "home", "x", "activity")]


def test_failfast_mode_raises(spark):
    import pytest
    raw = spark.createDataFrame([LINES[5]], "seq long, value string")
    with pytest.raises(Exception):
        logs.parse_json(raw, mode="FAILFAST").collect()
