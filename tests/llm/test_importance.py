"""Buckets against zlib feature by feature, and the draw against a plain computation."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from retailstream.llm import importance as I


def plain_features(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=40), max_size=50))
def test_matrix_checksums_are_zlibs(features):
    assert I.crc32_all(features).tolist() == [zlib.crc32(f) for f in features]


def test_long_features_and_single_ones():
    features = [b"x" * n for n in (0, 1, I.MAX_COLUMNS, I.MAX_COLUMNS + 1, 200_000)]
    assert I.crc32_all(features).tolist() == [zlib.crc32(f) for f in features]
    assert I.crc32_all([]).tolist() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abA é.9\n", max_size=40), max_size=8))
def test_buckets_of_texts(texts):
    n, found = I.feature_buckets([t.encode() for t in texts], 97)
    for t, k, got in zip(texts, n.tolist(), found, strict=True):
        words, features = plain_features(t)
        assert k == len(words)
        assert Counter(got.tolist()) == Counter(zlib.crc32(f.encode()) % 97 for f in features)


def plain_draw(docs, target, buckets, percent, least):
    own = [Counter(zlib.crc32(f.encode()) % buckets for f in plain_features(t)[1]) for _, t in docs]
    goal = Counter(zlib.crc32(f.encode()) % buckets for _, t in target for f in plain_features(t)[1])
    s = sum(own, Counter())
    gain = [math.floor(1000 * math.log((goal[b] + 1) * (sum(s.values()) + buckets)
                                       / ((s[b] + 1) * (sum(goal.values()) + buckets)))) for b in range(buckets)]
    rows = []
    for (i, t), c in zip(docs, own, strict=True):
        n = sum(c.values())
        weight = math.floor(sum(gain[b] * k for b, k in c.items()) / n) if n else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((len(plain_features(t)[0]) >= least, i, n, weight, score))
    able = sorted((r for r in rows if r[0]), key=lambda r: (-r[4], r[1] is None, r[1], r[2]))
    draws = percent * len(able) // 100
    ranked = [(*r[1:], k + 1 if k < draws else None) for k, r in enumerate(able)]
    return Counter(ranked + [(*r[1:], None) for r in rows if not r[0]])


def test_draw_against_a_plain_one(spark):
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ünï", "X" * 5000, "a-b", "9"]
    docs = [(int(i) if i else None, " ".join(rng.choice(vocabulary, rng.integers(0, 60)))) for i in range(300)]
    docs += [(7, "same text " * 20)] * 40 + [(8, None), (8, "")]
    target = [(1, " ".join(rng.choice(vocabulary[:20], 200))), (None, None)]
    out = I.resample(spark.createDataFrame([(*d, "x", 3) for d in docs], "doc_id long, text string, rank string, part int"),
                     spark.createDataFrame(target, "item_id long, text string"), buckets=500, percent=30, least_words=10)
    got = Counter((r.doc_id, r.n_features, r.weight, r["score"], r["rank"]) for r in out.collect())
    assert got == plain_draw(docs, target, 500, 30, 10)


def test_empty_target_and_wide_buckets(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    out = I.resample(docs, none, buckets=100_000, percent=50, least_words=1)
    assert sorted((r.doc_id, r.n_features, r["rank"]) for r in out.collect() if r["rank"]) == [
        (r.doc_id, r.n_features, 1) for r in out.orderBy("score", ascending=False).limit(1).collect()]


def test_a_task_hashes_long_texts_in_slices(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(I, "SLICE_BYTES", 10)
    texts = ["a b c d e f g h", "i", "", "j k", "l " * 30]
    b = pa.record_batch([pa.array(range(5), pa.int64()), pa.array([t.encode() for t in texts])], ["id", "t"])
    parts = list(I._hashed(97)(iter([b])))
    assert len(parts) > 1 and [i for p in parts for i in p.column("id").to_pylist()] == list(range(5))
    assert [n for p in parts for n in p.column("n_features").to_pylist()] == [len(plain_features(t)[1]) for t in texts]
