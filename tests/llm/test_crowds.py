"""Crowded buckets of the embedding near-dedup."""

import numpy as np
import pytest

from retailstream.llm import embedding_dedup as E


def crowd(n, dim, noise, seed=0):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=dim) + rng.normal(size=(n, dim)) * noise).astype(np.float32)


def links(v, least=0.9):
    v = v.astype(np.float64)
    cos = (v @ v.T) / np.outer(*[np.linalg.norm(v, axis=1)] * 2)
    return (cos >= least).sum(1) - 1


@pytest.mark.parametrize("same", [True, False])
def test_matrix_products_find_the_pairs_that_pair_by_pair_finds(same):
    n = 300
    rng = np.random.default_rng(1)
    vec = crowd(n, 32, 0.3).astype(np.float64)
    vec[:40] = vec[40:80] * rng.uniform(0.5, 2, (40, 1))   # cosine 1 but for rounding
    g = {"vec": vec, "norm": np.linalg.norm(vec, axis=1), "home": rng.random(n) < 0.4,
         "block": rng.integers(0, 1 if same else 2, n), "left": np.zeros(n, int), "right": np.full(n, 0 if same else 1)}
    for least in (0.9, 1.0, float(E.np.median(vec[5] @ vec.T / g["norm"][5] / g["norm"]))):
        got = {tuple(sorted(p)) for i, j in E._near_in_crowd(g, 0, n, least) for p in zip(i.tolist(), j.tolist(), strict=True)}
        want = set()
        for i, j in E._pairs_of([(0, n)], g):
            near = E._near(g, i, j, least)
            want |= set(zip(i[near].tolist(), j[near].tolist(), strict=True))
        assert got == want and (least == 1.0 or want)


def test_first_meeting_is_counted_once_over_all_tables():
    s = E.Hashing()
    v = crowd(60, 64, 0.4, 3).astype(np.float64)
    codes = E.bucket_codes(v / np.linalg.norm(v, axis=1, keepdims=True), s).astype(np.int32)   # as they travel
    for a in range(0, 60, 7):
        for b in range(a + 1, 60):
            meetings = [(t, c) for t in range(s.tables) for c in set(codes[a, t].tolist()) & set(codes[b, t].tolist())
                        if c in (codes[a, t, 0], codes[b, t, 0])]
            i, j = np.full(len(meetings), a), np.full(len(meetings), b)
            table, bucket = (np.array([m[k] for m in meetings], np.int64) for k in (0, 1))
            first = E._first_meeting(codes, i, j, table, bucket) if meetings else np.zeros(0, bool)
            assert first.sum() == bool(meetings)


def test_crowded_group_over_several_blocks(spark):
    n = E.BLOCK + 300
    v = crowd(n, 64, 0.2, 5)          # cosines about 0.96
    rng = np.random.default_rng(6)
    far = rng.normal(size=(500, 64)).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate([*v, *far])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r[0]: (r[1], r[2]) for r in E.near_duplicates(df).collect()}
    unit = v.astype(np.float64) / np.linalg.norm(v.astype(np.float64), axis=1, keepdims=True)
    codes, meet = E.bucket_codes(unit, E.Hashing()), np.zeros((n, n), bool)
    for t in range(codes.shape[1]):
        at_home = (codes[:, t, None, :1] == codes[None, :, t]).any(2)
        meet |= at_home | at_home.T
    want = (meet & (unit @ unit.T >= 0.9)).sum(1) - 1   # each pair that meets in some bucket, once
    assert [got[i] for i in range(n)] == [(k, 0) for k in want.tolist()]
    assert want.sum() >= 0.95 * links(v).sum()
    assert all(got[n + i] == (0, n + i) for i in range(500))


@pytest.mark.parametrize("dim", [3, 20, 64, 384])
@pytest.mark.parametrize("kind", ["dense", "few", "shifted"])
def test_sketches_leave_linked_pairs_candidates(dim, kind):
    rng = np.random.default_rng(dim)
    n, s = 800, E.Hashing()
    a = rng.normal(size=(n, dim)) + (5 if kind == "shifted" else 0)
    if kind == "few":   # two components of all
        a[:] = 0
        a[np.arange(n), rng.integers(dim, size=n)] = 1
        a[np.arange(n), rng.integers(dim, size=n)] += 0.5
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    off = rng.normal(size=(n, dim))
    off -= np.einsum("ij,ij->i", off, a)[:, None] * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * off / np.linalg.norm(off, axis=1, keepdims=True)   # the least similar that link
    x, y = (E.codes_and_sketch(v, s)[1].view(np.uint64) for v in (a, b))
    apart = np.bitwise_count(x ^ y).sum(axis=1)
    assert (apart <= E.most_bits(dim, 0.9, s)).all()
    if dim >= E.NARROW and kind == "dense":   # and others are told apart
        others = np.bitwise_count(x ^ x[rng.permutation(n)]).sum(axis=1)
        assert (others <= E.most_bits(dim, 0.9, s)).mean() < 0.01
