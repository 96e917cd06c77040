"""License spans against a plain scan of the words, with words put in, left out and changed."""

import random
import re

import pytest
from pyspark.sql import functions as F

from retailstream.llm import license_scan as L

NOTICE = dict((label, text) for label, kind, text in L.NOTICES)["bsd"]
WORDS = NOTICE.lower().replace(",", "").split()


def plain_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def scan(spark, texts, **kw):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in L.scan_licenses(docs, **kw).collect()}


def test_phrases_match_a_plain_scan(spark):
    rng = random.Random(5)
    vocabulary = ["mit", "license", "apache", "general", "public", "MIT", "License", "x", "é", "the", "General,"]
    texts = [rng.choice([" ", "\n", "-", " . "]).join(rng.choices(vocabulary, k=rng.randrange(60))) for _ in range(200)]
    got = scan(spark, texts)
    for i, text in enumerate(texts):
        words, places, labels = plain_words(text), [], set()
        for label, _, phrase in L.PHRASES:
            own = phrase.split()
            at = [j for j in range(len(words)) if words[j:j + len(own)] == own]
            places += at
            labels |= {label} if at else set()
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (
            len(words), len(places), min(places, default=None), max(places, default=None)), text
        assert r.base_labels == ",".join(sorted(labels)) and labels <= set(r.labels.split(","))
        assert not labels or r.score == 1.0


def test_long_texts_are_scanned_to_their_end(spark):
    long_text = " ".join(["w"] * 50_000 + ["mit", "license"] + ["v"] * 150_000 + ["general", "public", "license"])
    notice = " ".join(["w"] * 99_999 + WORDS)
    got = scan(spark, [long_text, notice])
    assert (got[0].n_base, got[0].first_word, got[0].last_word) == (2, 50_000, 200_002)
    assert got[1].labels == "bsd" and got[1].score == 1.0


@pytest.mark.parametrize("change", ["put in", "left out", "changed"])
def test_neighbouring_diagonals_are_merged(spark, change):
    """One word changed in the middle shifts or breaks the diagonal; the span is still found whole."""
    words, mid = list(WORDS), len(WORDS) // 2
    words[mid:mid + (change != "put in")] = [] if change == "left out" else ["new"]
    texts = spark.createDataFrame([(1, " ".join(["a"] * 7 + words + ["b"] * 9))], "key long, text string")
    found = L.spans(texts).where("label = 'bsd'").collect()
    assert len(found) == 1
    r = found[0]
    assert (r.start, r.end, r.verified) == (7, 7 + len(words), True)
    covered = len(WORDS) - (change != "put in")
    assert r.cover == pytest.approx(covered / len(WORDS), abs=1e-6)


def test_parts_and_shuffled_words_are_refused(spark):
    rng = random.Random(2)
    part, mixed = " ".join(WORDS[:len(WORDS) // 2]), list(WORDS)
    rng.shuffle(mixed)
    far = " x ".join([" ".join(WORDS[:6]), " ".join(["y"] * 50), " ".join(WORDS[6:12]), " ".join(["z"] * 50), " ".join(WORDS[12:])])
    got = scan(spark, [part, " ".join(mixed), far, NOTICE.upper()])
    assert [got[i].labels for i in range(4)] == ["", "", "", "bsd"]
    assert 0 < got[0].score < L.MIN_COVER and got[1].score < L.MIN_COVER


def test_rows_are_judged_each(spark):
    rows = [(1, None, 9), (1, "", 9), (None, "mit license", 9), (2, "MIT\tLicense mit license", 9)] + [
        (3, "the apache license", 9)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int")
    out = L.scan_licenses(docs)
    assert out.count() == len(rows)
    assert out.where("doc_id = 3").select("n_base", "labels").distinct().collect() == [(1, "apache")]
    assert out.where("doc_id IS NULL").first().n_base == 1 and out.where("doc_id = 2").first().n_base == 2
    assert out.where(F.col("doc_id") == 1).select("n_words", "labels", "score").distinct().collect() == [(0, "", 0.0)]


def test_templates_need_their_words(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    with pytest.raises(ValueError, match="fewer than 4 words"):
        L.scan_licenses(docs, templates=[("x", "notice", "a b c")])
    assert L.scan_licenses(docs, templates=[("x", "phrase", "b c")]).first().first_word == 1
