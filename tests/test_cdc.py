
from retailstream.operators import cdc
from retailstream.sources import sinks

ENV = [
    ("srv.shop.users", "r", None, {"id": "1", "name": "a", "x": "1"}, 1),
    ("srv.shop.users", "u", {"id": "1", "name": "a"}, {"id": "1", "name": "b", "x": "2"}, 2),
    ("srv.shop.users", "c", None, {"id": "2", "name": "c"}, 3),
    ("srv.shop.users", "d", {"id": "2", "name": "c"}, None, 4),
    ("srv.shop.orders", "c", None, {"id": "9", "st": "1001"}, 5),
    ("srv.shop.carts", "c", None, {"id": "7"}, 6),
]
SCHEMA = "topic string, op string, before map<string,string>, after map<string,string>, seq long"


def test_flatten(spark):
    f = cdc.flatten_changes(spark.createDataFrame(ENV, SCHEMA)).orderBy("seq").collect()
    assert [r["type"] for r in f] == ["insert", "update", "insert", "delete", "insert", "insert"]
    assert f[0]["database"] == "shop" and f[0]["tableName"] == "users" and f[0]["before"] == {}
    assert f[3]["data"] == {}


def test_route_config_override_unknown_sink_and_no_config(spark):
    ch = cdc.drop_deletes(cdc.flatten_changes(spark.createDataFrame(ENV, SCHEMA)))
    cfg = cdc.table_process(spark, [
        ("users", "insert", "hbase", "dim_users", "id,name,x", "id", None, 1),
        ("users", "insert", "hbase", "dim_users", "id,name", "id", None, 2),   # later seq wins
        ("users", "update", "hbase", "dim_users", "id,name", "id", None, 1),
        ("orders", "insert", "es", "x", "id", "id", None, 1),                   # unknown sink type
    ])
    r = {x["seq"]: (x["route"], x["data"]) for x in cdc.route_changes(ch, cfg).collect()}
    assert r[1] == ("dim", {"id": "1", "name": "a"})
    assert r[2] == ("dim", {"id": "1", "name": "b"})
    assert r[5][0] == "unknown_sink" and r[6][0] == "no_config"
    assert 4 not in r  # delete dropped


def test_whitelist_exact_names(spark):
    df = spark.createDataFrame([({"id": "1", " name": "x", "name": "y"}, "id,name")], "d map<string,string>, c string")
    assert df.select(cdc.whitelist("d", "c")).first()[0] == {"id": "1", "name": "y"}


def test_changelog_state_drops_deleted_keys(spark):
    st = cdc.changelog_state(cdc.flatten_changes(spark.createDataFrame(ENV, SCHEMA)))
    got = {(r["tableName"], r["data"].get("id")): r["data"].get("name") for r in st.collect()}
    assert got == {("users", "1"): "b", ("orders", "9"): None, ("carts", "7"): None}


def test_dim_schema_defaults_pk():
    s = cdc.dim_schema("name,x", None)
    assert s.fieldNames() == ["id", "name", "x"]


def test_versioned_dimension_upsert_is_idempotent(spark, tmp_dir):
    path = f"{tmp_dir}/dim_users"
    sinks.ensure_dim_table(spark, path, cdc.dim_schema("id,name"))
    ch = spark.createDataFrame([("1", "a", 1, "insert"), ("2", "b", 2, "insert"), ("1", "c", 3, "update")],
                               "id string, name string, seq long, type string")
    v = sinks.upsert_dimension_table(spark, ch, path, token="q:0")
    assert sinks.upsert_dimension_table(spark, ch, path, token="q:0") == v   # replay of the same batch
    dele = spark.createDataFrame([("2", None, 4, "delete")], "id string, name string, seq long, type string")
    sinks.upsert_dimension_table(spark, dele, path, token="q:1")
    cur = {r["id"]: r["name"] for r in sinks.read_dimension(spark, path).collect()}
    assert v == 1 and cur == {"1": "c"}
    # a new checkpoint starts its batches again from 0: its changes are seen
    more = spark.createDataFrame([("3", "x", 5, "insert")], "id string, name string, seq long, type string")
    assert sinks.upsert_dimension_table(spark, more, path, token="other:0") == 3
    assert {r["id"] for r in sinks.read_dimension(spark, path).collect()} == {"1", "3"}


def test_partial_changes_keep_the_other_columns(spark, tmp_dir):
    path = f"{tmp_dir}/dim_users"
    sinks.ensure_dim_table(spark, path, cdc.dim_schema("id,name"))
    schema = "id string, name string, nation string, seq long, type string, _present array<string>"
    ch = spark.createDataFrame([
        ("1", "a", "n", 1, "insert", ["id", "name", "nation"]), ("1", "b", None, 2, "update", ["id", "name"]),
        ("2", "c", None, 3, "insert", ["id", "name"]), ("3", "d", "m", 4, "insert", ["id", "name", "nation"]),
        ("3", None, None, 5, "delete", []), ("3", "e", None, 6, "insert", ["id", "name"]),
        ("4", None, None, 7, "update", ["id", "name"])], schema)
    sinks.upsert_dimension_table(spark, ch, path)
    late = spark.createDataFrame([("2", "old", "p", 2, "update", ["id", "name", "nation"])], schema)
    sinks.upsert_dimension_table(spark, late, path)   # out of order: only what was not set later
    got = {r["id"]: (r["name"], r["nation"]) for r in sinks.read_dimension(spark, path).collect()}
    assert got["1"] == ("b", "n")       # the update carries no nation: it stays
    assert got["3"] == ("e", None)      # nothing from before the delete
    assert got["4"] == (None, None) and got["2"][0] == "c"


def test_a_new_catalog_sees_new_files(spark, tmp_dir):
    from retailstream.sources.tables import Catalog
    spark.createDataFrame([(1,)], "x long").write.parquet(f"{tmp_dir}/t.parquet")
    assert Catalog(spark, tmp_dir).table("t").count() == 1
    spark.createDataFrame([(2,)], "x long").write.mode("append").parquet(f"{tmp_dir}/t.parquet")
    assert Catalog(spark, tmp_dir).table("t").count() == 2


def test_sink_replay_of_a_batch_does_not_duplicate(spark, tmp_dir):
    from retailstream.sources.tables import read_stats
    df = spark.createDataFrame([("2024-01-01 00:00:00", "x", 1), ("2024-01-02 00:00:00", "y", 2)],
                               "stt string, keyword string, ct long")
    for _ in range(2):   # the same micro-batch delivered twice (retry after a lost executor)
        sinks.write_stats(df, f"{tmp_dir}/stats", ["stt", "keyword", "ct"], batch_id=7)
        sinks.write_topic(df, f"{tmp_dir}/topic", batch_id=7)
    assert read_stats(spark, f"{tmp_dir}/stats").count() == 2
    assert read_stats(spark, f"{tmp_dir}/stats", "2024-01-02").select("keyword").first()[0] == "y"
    assert spark.read.parquet(f"{tmp_dir}/topic").count() == 2


def test_routing_config_follows_its_change_feed(spark):
    cols = ["sourceTable", "operateType", "sinkType", "sinkTable", "sinkColumns", "sinkPk", "sinkExtend"]
    snap = cdc.table_process(spark, [("users", "insert", "hbase", "dim_users", "id,name", "id", None),
                                     ("orders", "insert", "kafka", "dwd_orders", "id", "id", None)]).select(*cols)
    row = {"sourceTable": "users", "operateType": "insert", "sinkType": "hbase", "sinkTable": "dim_users",
           "sinkColumns": "id,name,nation", "sinkPk": "id"}
    gone = {"sourceTable": "orders", "operateType": "insert"}
    feed = cdc.flatten_changes(spark.createDataFrame(
        [("s.cfg.table_process", "u", None, row, 1), ("s.cfg.table_process", "d", gone, None, 2),
         ("s.shop.users", "c", None, {"id": "1"}, 3)], SCHEMA))
    got = cdc.routing_config(snap, feed).collect()
    assert [(r["sourceTable"], r["sinkColumns"]) for r in got] == [("users", "id,name,nation")]
    routed = cdc.route_changes(feed.where("tableName = 'users'"), cdc.routing_config(snap, feed)).collect()
    assert [r["route"] for r in routed] == ["dim"]
