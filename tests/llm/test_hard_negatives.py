"""Trees and searches against brute force; boxes that cannot matter are not read."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retailstream.llm import hard_negatives as H


def plain_search(ids, rows, v, q, low, high, k, skip):
    score = v.astype(np.int64) @ q.astype(np.int64)
    return [sorted([(int(s), int(i), int(r)) for s, i, r in zip(score, ids, rows, strict=True) if a <= s <= b and r != skip],
                   key=lambda x: (-x[0], x[1], x[2]))[:k] for a, b in zip(low, high, strict=True)]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 600), st.integers(1, 5), st.integers(1, 40), st.integers(0, 2 ** 31))
def test_search_is_brute_force(n, dim, spread, seed):
    rng = np.random.default_rng(seed)
    v = rng.integers(-spread, spread + 1, (n, dim)).astype(np.int32)   # few values: many ties
    ids, rows = rng.integers(0, n, n), np.arange(n)
    tree = H.RTree(ids, rows, v).ready()
    q = rng.integers(-spread, spread + 1, dim).astype(np.int32)
    low = np.array([-H.CLOSED, 0, spread, 5])
    high = np.array([H.CLOSED, 2 * spread, spread, -5])   # all, some, one score, none
    got, _ = tree.search(q, low, high, 3, skip=int(rows[0]))
    assert got == plain_search(ids, rows, v, q, low, high, 3, rows[0])


def test_nodes_box_their_rows():
    rng = np.random.default_rng(1)
    v = rng.integers(-50, 50, (5000, 3)).astype(np.int32)
    tree = H.RTree(np.arange(5000), np.arange(5000), v)
    assert sorted(tree.rows.tolist()) == list(range(5000))
    assert all(b - a <= H.LEAF for a, b in zip(tree.first[:tree.n_leaves], tree.last[:tree.n_leaves], strict=True))

    def below(node):
        a, b = tree.first[node], tree.last[node]
        return list(range(a, b)) if node < tree.n_leaves else [r for c in range(a, b) for r in below(c)]
    for node in range(len(tree.first)):
        rows = tree.v[below(node)]
        assert (rows.min(axis=0) == tree.lo[node]).all() and (rows.max(axis=0) == tree.hi[node]).all()
    assert sorted(below(len(tree.first) - 1)) == list(range(5000))


def test_boxes_outside_the_windows_are_not_read():
    rng = np.random.default_rng(2)
    v = rng.integers(-1000, 1000, (20_000, 2)).astype(np.int32)
    tree = H.RTree(np.arange(20_000), np.arange(20_000), v).ready()
    q = np.array([300, 200])
    _, read = tree.search(q, np.array([-H.CLOSED]), np.array([H.CLOSED]), 5)
    _, window = tree.search(q, np.array([100_000]), np.array([101_000]), 3)
    _, none = tree.search(q, np.array([10]), np.array([5]), 3)
    assert read < tree.n_leaves / 10 and window < tree.n_leaves / 2 and none == 0


def test_large_components_stay_exact():
    v = np.array([[H.LARGEST, H.LARGEST], [H.LARGEST, H.LARGEST - 1], [-H.LARGEST, 1]], np.int32)
    tree = H.RTree(np.arange(3), np.arange(3), v).ready()
    low, high = np.array([-H.CLOSED]), np.array([H.CLOSED])
    assert tree.search(v[1], low, high, 2)[0] == plain_search(np.arange(3), np.arange(3), v, v[1], low, high, 2, -1)


def plain_mining(rows, anchors):
    out = set()
    whole = [(i, lab, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, v, lab in rows]
    for i, lab, v in whole:
        if i not in anchors:
            continue
        scored = sorted((-int(v @ w), j, other) for j, other, w in whole if j != i)
        for ps, j, _ in [x for x in scored if x[2] == lab][:5]:
            fits = [x for x in scored if x[2] != lab and 50 * -ps <= 100 * -x[0] <= 95 * -ps][:3]
            out |= {(i, j, k + 1, x[1], -ps, -x[0]) for k, x in enumerate(fits)}
    return out


@pytest.mark.parametrize("small", [False, True])
def test_mining_against_brute_force(spark, monkeypatch, small):
    """One label holds most rows; with small trees and chunks many of them meet, on several salts."""
    if small:
        for name, value in (("TREE_ROWS", 40), ("CHUNK", 4), ("CHUNKS_A_SALT", 2), ("LEAF", 8)):
            monkeypatch.setattr(H, name, value)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 6))
    rows = [(i, [float(x) for x in np.round(base[i % 40] * (1 + 0.1 * (i % 3)), 3)], 0 if i % 3 else i % 5) for i in range(400)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, dim string")
    out = H.hard_negatives(df, is_anchor=F.col("vec_id") % 10 == 0)
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) and set(got) == plain_mining(rows, set(range(0, 400, 10)))


def test_empty_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert H.hard_negatives(spark.createDataFrame([], schema)).count() == 0
    some = spark.createDataFrame([(1, [0.5], 1), (2, [], 1), (3, [], 2), (4, None, None)], schema)
    assert H.hard_negatives(some, is_anchor=F.lit(False)).count() == 0
    assert [tuple(r)[:4] for r in H.hard_negatives(some).collect()] == []
