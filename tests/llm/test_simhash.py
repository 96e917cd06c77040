"""Fingerprints, links and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from retailstream.llm import simhash
from retailstream.llm.graph import components
from retailstream.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    words = re.findall("[^\x20\x09-\x0D]+", text)
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """{id: fingerprint} to {id: least id reachable over at most 2 differing bits}."""
    ids = sorted(prints)
    value = np.array([prints[i] for i in ids], np.uint64)
    comp = list(range(len(ids)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(value[i] ^ value[i + 1:]) <= 2):
            a, b = sorted((root(i), root(i + 1 + int(j))))
            comp[b] = a
    return {ids[i]: ids[root(i)] for i in range(len(ids))}


def test_query_on_small_tables(spark):
    import os
    texts = {r.doc_id: r.text for r in spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet")).collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    comp = plain_components(prints)
    got = QUERIES["op3_simhash_dedup"](spark, SF_SMALL).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
        i: (f"{prints[i]:016x}", comp[i]) for i in texts}


@pytest.mark.parametrize("text", [None, "", " \n", "one", "one two", "A b C", "x " * 70_000, "é\x0bÜ\x0cz", "a\x1cb c d"])
def test_fingerprints_of_odd_texts(text):
    got = simhash.fingerprint((text or "").encode(), 3)
    assert got % (1 << 64) == plain_fingerprint(text)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_in_crowded_buckets(spark, monkeypatch):
    """Thousands of fingerprints that share most bits: all links, by ever finer keys."""
    rng = random.Random(1)
    base = rng.getrandbits(64)
    prints = {base}
    while len(prints) < 700:   # in 14 neighbouring bits of the base, so that quarters are shared by all
        prints.add(base ^ rng.getrandbits(14))
    while len(prints) < 900:
        prints.add(rng.getrandbits(64))
    monkeypatch.setattr(simhash, "MAX_BUCKET", 8)
    values = np.array(sorted(prints), np.uint64)
    want = {tuple(sorted((signed(int(a)), signed(int(values[i + 1 + j])))))
            for i, a in enumerate(values) for j in np.flatnonzero(np.bitwise_count(a ^ values[i + 1:]) <= 2)}
    fps = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    got = [(r.u, r.v) for r in simhash.links(fps).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_more_bits_than_certain_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([], "fp long"), 3)


def test_components_of_chains_stars_and_nothing(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(
        chain + star + [(7, 7), (3, 2)], "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{1000 + i: 1000 for i in range(200)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_odd_rows(spark):
    rows = [(None, "a b c", 1), (5, "a b c", 1), (2, None, 1), (9, "", 1), (9, "", 1), (7, "unlike the others here", 1)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp int"))
    assert sorted(((r.doc_id or -1), r.component_id) for r in got.collect()) == [
        (-1, 5), (2, 2), (5, 5), (7, 7), (9, 2), (9, 2)]
