import random

from pyspark.sql import functions as F

from retailstream.operators import visits
from retailstream.operators.sequence import with_neighbor
from tests.conftest import page_rows

DAY = 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01 00:00:00


def test_new_visitor_repair_sequence(spark):
    log = page_rows(spark, [(1, T0, "m", "1", None), (2, T0 + 1, "m", "1", "home"), (3, T0 + 2, "m", "0", "home"),
                            (4, T0 + 3, "m", "1", "home"), (5, T0, "n", "0", None), (6, T0 + 5, "n", "1", None)])
    r = {x["seq"]: x["is_new"] for x in visits.repair_new_visitor(log).select("seq", "common.is_new").collect()}
    assert r == {1: "1", 2: "0", 3: "0", 4: "0", 5: "0", 6: "1"}


def test_daily_unique_visit_midnight_and_late_row(spark):
    log = page_rows(spark, [
        (1, T0 - 1, "m", "1", None),            # 2023-12-31 23:59:59.999
        (2, T0, "m", "0", None),                # 2024-01-01 00:00:00 -> new day
        (3, T0 + 5, "m", "0", None),            # same day: dropped
        (4, T0 + 6, "m", "0", "home"),          # not an entry
        (5, T0 - 10, "m", "0", None),           # late row of the previous day: re-emitted (D2)
        (6, T0 + 7, "m", "0", None),            # back to today: emitted again
    ])
    got = sorted(x[0] for x in visits.daily_unique_visit(log).select("seq").collect())
    assert got == [1, 2, 5, 6]


def test_bounce_boundaries(spark):
    w = 10_000
    log = page_rows(spark, [
        (1, T0, "a", "0", None), (2, T0 + 9_999, "a", "0", "home"),       # stays: not a bounce
        (3, T0, "b", "0", None), (4, T0 + 10_000, "b", "0", "home"),      # exactly 10 s: timeout -> bounce
        (5, T0, "c", "0", None), (6, T0 + 10_001, "c", "0", "home"),      # bounce
        (7, T0, "d", "0", None),                                          # no successor: bounce
        (8, T0, "e", "0", None), (9, T0 + 3, "e", "0", None),             # entry then entry: both bounce
        (10, T0, "f", "0", None), (11, T0, "f", "0", "home"),             # same ms, seq order: stays
    ])
    got = sorted(x[0] for x in visits.bounce_detect(log, within_ms=w).select("seq").collect())
    assert got == [3, 5, 7, 8, 9]


def _brute_neighbors(rows, direction):
    by = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        by.setdefault(r[0], []).append(r)
    out = {}
    for k, rs in by.items():
        for i, r in enumerate(rs):
            j = i - 1 if direction == "prev" else i + 1
            out[(r[0], r[2])] = rs[j][3] if 0 <= j < len(rs) else None
    return out


def test_bucketed_neighbor_matches_plain_window_with_hot_key(spark):
    rnd = random.Random(7)
    rows = []
    for seq in range(3000):
        key = "hot" if rnd.random() < 0.4 else f"k{rnd.randrange(40)}"   # one key holds ~40% of rows
        rows.append((key, rnd.randrange(0, 50 * DAY), seq, rnd.randrange(1000)))
    df = spark.createDataFrame(rows, "k string, t long, s long, v long")
    for direction in ("prev", "next"):
        # small buckets: the hot key is cut into many buckets, many of them empty
        n = with_neighbor(df, ["k"], ["t", "s"], F.floor(F.col("t") / DAY), ["v"], direction, "nb_")
        got = {(r["k"], r["s"]): r["nb_v"] for r in n.collect()}
        assert got == _brute_neighbors(rows, direction)
