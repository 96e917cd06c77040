"""Pieces against the plain tokenizer, the plan against plain best-fit decreasing."""

import bisect
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from retailstream.llm import packing
from retailstream.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def plain_pieces(texts, seq_len=2048):
    t, out = tokenizer(), {}
    for i, text in texts.items():
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), seq_len)):
            part = ids[at:at + seq_len]
            out[i, k] = (at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))
    return out


def check_sequences(rows, seq_len=2048):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= seq_len
    return len(held)


def plain_best_fit(lengths, seq_len):
    room, made = [], 0
    for x in sorted(lengths, reverse=True):
        i = bisect.bisect_left(room, x)
        if i == len(room):
            made, left = made + 1, seq_len - x
        else:
            left = room.pop(i) - x
        if left:
            bisect.insort(room, left)
    return made


def test_query_on_small_tables(spark):
    import os
    rows = QUERIES["op7_best_fit_packing"](spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet")).collect()}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows} == plain_pieces(texts)
    assert check_sequences(rows) == plain_best_fit([r.length for r in rows], 2048)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_plan_equals_piece_by_piece(lengths):
    runs, made = packing.plan_best_fit(dict(Counter(lengths)), 50)
    assert made == plain_best_fit(lengths, 50)
    table = pa.record_batch({"length": pa.array([x for x, n in Counter(lengths).items() for _ in range(n)], pa.int64()),
                             "rank": pa.array([i for n in Counter(lengths).values() for i in range(n)], pa.int64())})
    if lengths:
        class Row:
            def __init__(self, d):
                self.__dict__.update(d)
        placed = [Row(r) for b in packing._placed(runs)([table]) for r in b.to_pylist()]
        assert check_sequences(placed, 50) == made


ODD = ["a\x1cb c\xa0d \u2003 é <|endoftext|> x<|startoftext|>y don't 'S I'LL ﬁ İ Σς ΑΣ z\r\n\t q 12ab３", "", " ", "\n",
       "日本語 text 🤷🏽‍♂️ ok A. b', c'. D., e.f. x1. ÀÉ. <|STARTOFTEXT|>. Ⅷ. ª. 1. a1, kK. e\u0301 \u0301a A\u030a",
       "Größe, ÇA va. naïve.. ,x, .,", "x" * 5000, "ß ẞ ŉ ǰ Ĳ ĳ ŀ ǅ"]


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=60))
def test_word_encoding_is_the_tokenizers(text):
    import public_tokenizers
    encoder = packing._encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [text, *ODD]
    ids, bounds = encoder.texts(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == tokenizer_ids(t), t


_PLAIN = None


def tokenizer_ids(text):
    global _PLAIN
    _PLAIN = _PLAIN or tokenizer()
    return _PLAIN.encode(text, add_special_tokens=False).ids


def test_odd_rows_and_ids(spark):
    rows = [(1, None, 5), (1, "", 5), (None, "a b", 5), (2, "word " * 5000, 5), (2, "word " * 5000, 5)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, length int"), with_ids=True).collect()
    check_sequences(out)
    assert Counter((r.doc_id, r.piece, r.length) for r in out) == Counter(
        [(1, 0, 1)] * 2 + [(None, 0, 3)] + [(2, 0, 2048), (2, 1, 2048), (2, 2, 905)] * 2)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in out)


@pytest.mark.parametrize("least", range(0, 9))
def test_capacity_tree(least):
    tree = packing.CapacityTree(8)
    for c in (1, 4, 7):
        tree.mark(c, True)
    tree.mark(4, False)
    tree.mark(5, True)
    assert tree.tightest(least) == min((c for c in (1, 5, 7) if c >= least), default=None)


HOSTILE = """
import resource, sys
import numpy as np
import pyarrow as pa
import public_tokenizers
from retailstream.llm.packing import CACHE_BYTES, _encoder
encoder = _encoder(public_tokenizers.path("word_bpe_49k.json"))
def peak():
    return resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024
before = peak()
for turn in range(4):   # distinct words of letters and digits, 4 MB of them in one text
    rng = np.random.default_rng(turn)
    words = [f"{a:x}q{b}" for a, b in rng.integers(0, 1 << 30, (260_000, 2)).tolist()]
    ids, bounds = encoder.texts(pa.array([" ".join(words)]))
    assert encoder.cached <= CACHE_BYTES and bounds[-1] == len(ids) > len(words)
print(before, peak())
"""


def test_a_worker_stays_small_on_hostile_texts():
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    out = subprocess.run([sys.executable, "-c", HOSTILE], capture_output=True, text=True, check=True,
                         env={**os.environ, "PYTHONPATH": root}).stdout
    before, peak = map(float, out.split())
    assert peak - before < 350, (before, peak)


def test_small_calls_and_a_forgetful_cache_change_no_id(monkeypatch):
    import public_tokenizers
    for name, value in (("CALL_WORDS", 3), ("CALL_CHARS", 20), ("CACHE_BYTES", 2000)):
        monkeypatch.setattr(packing, name, value)
    encoder = packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [*ODD, " ".join(f"a{i}b, word{i}. {'z' * (i % 40)}é" for i in range(300))] * 2
    ids, bounds = encoder.texts(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == tokenizer_ids(t), t
    assert encoder.cached <= 2000
