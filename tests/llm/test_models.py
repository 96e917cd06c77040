"""Classifiers: held-out accuracy, gradients, odd texts; chats and vectors against brute force."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from retailstream.llm import byte_cnn, chat_format, embedding_dedup, toxicity
from retailstream.llm.queries import QUERIES, transcripts
from tests.conftest import SF_SMALL

SYLLABLES = ["an", "the", "er", "tion", "re", "st", "ou", "ing", "ha", "ly", "en", "at"]
BAD = ["trasher", "moronic", "veju", "scumly"]


def prose(rng, n):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n))


def labelled(n, seed):
    """Texts of invented words; label 1 has a bad word, often misspelt, every 40 words or so."""
    rng, out = random.Random(seed), []
    for i in range(n):
        words, label = prose(rng, rng.randint(30, 300)).split(), int(i % 4 == 0)
        for _ in range(label * max(len(words) // 40, 1)):
            bad = rng.choice(BAD)
            words.insert(rng.randrange(len(words)), rng.choice([bad, bad + rng.choice(SYLLABLES)]))
        out.append((i, " ".join(words), label))
    return out


def test_toxicity_generalises_to_unseen_forms():
    learn, held = labelled(500, 1), labelled(200, 2)
    model = toxicity.train([t for _, t, _ in learn], [y for *_, y in learn], toxicity.Settings())
    p = toxicity.Scorer(model).texts([t for _, t, _ in held])
    right = [(x >= 0.5) == y for x, (*_, y) in zip(p, held, strict=True)]
    assert np.mean(right) > 0.95
    # forms that training never saw, in a long clean text
    clean = prose(random.Random(9), 2000)
    low, high = toxicity.Scorer(model).texts([clean, clean + " moronicness trashers " + clean])
    assert low < 0.5 < high


def test_scores_do_not_depend_on_batches_or_cache(monkeypatch):
    learn = labelled(120, 3)
    model = toxicity.train([t for _, t, _ in learn], [y for *_, y in learn], toxicity.Settings(epochs=3))
    texts = [t for _, t, _ in labelled(30, 4)] + ["", "123 !!", "ÄÖ ß é", "word " * 5000]
    whole = toxicity.Scorer(model).texts(texts)
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 3)
    one = toxicity.Scorer(model)
    assert [one.texts([t])[0] for t in texts] == pytest.approx(whole)
    assert all(0 <= p <= 1 for p in whole)


@pytest.mark.parametrize("module", [toxicity, byte_cnn])
def test_no_or_one_sided_labels(spark, module):
    docs = spark.createDataFrame([(1, "a b", 0.5), (1, None, 0.5), (None, "", 0.5), (4, "x " * 50_000, 0.5)],
                                 "doc_id long, text string, score double")
    for rows in ([], [(1, 1), (1, 0), (None, 1), (4, None)]):
        labels = spark.createDataFrame(rows, "doc_id long, y int")
        out = module.score_documents(docs, module.fit(docs, labels, label_col="y")).collect()
        assert len(out) == 4 and all(0 <= r.score <= 1 for r in out)
    empty = module.score_documents(docs.limit(0), module.fit(docs.limit(0), labels, label_col="y"))
    assert empty.count() == 0


def test_labelled_sample_is_bounded_and_even(spark):
    from retailstream.llm.training import labelled_sample
    docs = spark.createDataFrame([(i, "t" * (i % 50)) for i in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(400)], "doc_id long, y int")
    texts, given = labelled_sample(docs, labels, "doc_id", "text", "y", 100, 1000)
    assert Counter(given) == {0: 60, 1: 40}
    assert labelled_sample(docs, labels, "doc_id", "text", "y", 100, 1000) == (texts, given)
    assert Counter(labelled_sample(docs, labels, "doc_id", "text", "y", 90, 1000, 1 / 3)[1]) == {0: 60, 1: 30}
    texts, _ = labelled_sample(docs, labels, "doc_id", "text", "y", 100, 10)
    assert max(map(len, texts)) <= 10


def test_labelled_sample_takes_repeated_ids_once(spark):
    from retailstream.llm.training import labelled_sample
    docs = spark.createDataFrame([(i % 4 if i < 300 else i, f"t{i:03}") for i in range(320)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in [0, 1, 2, 3, 300, 301]], "doc_id long, y int")
    texts, given = labelled_sample(docs, labels, "doc_id", "text", "y", 6, 1000)
    assert texts == ["t000", "t001", "t002", "t003", "t300", "t301"] and given == [0, 1, 0, 1, 0, 1]


@pytest.mark.parametrize("name, label, cut", [("op1_toxicity", "toxic", 0.5), ("op9_quality_classifier", "quality", 0.7)])
def test_scoring_queries(spark, name, label, cut):
    d = SF_SMALL.replace("0.001", "0.01")
    out = QUERIES[name](spark, d).toPandas()
    docs = spark.read.parquet(f"{d}/documents.parquet")
    assert len(out) == docs.count() and not out.score.isna().any() and out.score.between(0, 1).all()
    assert (out.predicted == (out.score >= cut)).all()
    n, rest = (5, 0) if label == "toxic" else (4, 2)
    assert (out.held_out == out.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % n == rest)).all()
    both = out.merge(spark.read.parquet(f"{d}/labels.parquet").toPandas(), on="doc_id")
    seen, held = both[~both.held_out], both[both.held_out]
    assert (seen.predicted == seen[label]).mean() > 0.9   # few labels at this size
    assert (held.predicted == held[label]).mean() > 0.75


def test_cnn_gradients():
    """Backpropagation against differences, for every weight table."""
    s = byte_cnn.Settings(dim=3, filters=5, hidden=4)
    model = byte_cnn.Model.start(s)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    model.weights["mix"][:] = (0.7, 0.4)
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(60, 120, n, dtype=np.uint8)) for n in (10, 2600, 1500)]
    d_out = np.array([0.5, -1.0, 2.0])

    def loss():
        logit, owner, _ = byte_cnn.chunk_logits(model, texts)
        return float(d_out @ byte_cnn.document_logits(model, logit, owner)[0])

    logit, owner, layers = byte_cnn.chunk_logits(model, texts)
    _, combined = byte_cnn.document_logits(model, logit, owner)
    grads = byte_cnn.backward(model, logit, owner, layers, combined, d_out)
    for name, w in model.weights.items():
        flat = w.reshape(-1)
        for i in np.argsort(-np.abs(grads[name].ravel()))[:3]:
            keep, eps = flat[i], 1e-5
            flat[i] = keep + eps
            up = loss()
            flat[i] = keep - eps
            down = loss()
            flat[i] = keep
            assert grads[name].ravel()[i] == pytest.approx((up - down) / (2 * eps), rel=2e-2, abs=1e-4), name


def test_cnn_long_texts_in_stretches(monkeypatch):
    model = byte_cnn.Model.start(byte_cnn.Settings())
    model.weights["mix"][:] = (1.0, 0.5)
    rng = np.random.default_rng(0)
    texts = [bytes(rng.integers(32, 120, n, dtype=np.uint8)) for n in (0, 1, 4, 8, 1023, 1025, 1541, 5000, 70000, 262141)]
    whole = byte_cnn.score_texts(model, texts)
    monkeypatch.setattr(byte_cnn, "SEGMENT", 7)
    monkeypatch.setattr(byte_cnn, "SLICE_BYTES", 5000)
    assert byte_cnn.score_texts(model, texts) == pytest.approx(whole, abs=1e-5)


def test_chat_roles_are_recovered(spark):
    d = SF_SMALL.replace("0.001", "0.01")
    gold = {(r.conv_id, r.turn): r for r in spark.read.parquet(f"{d}/conversations.parquet").collect()}
    got = QUERIES["op8_chat_format"](spark, d).collect()
    assert len(got) == len(gold) and all(r.begins for r in got)
    held = [r for r in got if zlib.crc32(str(r.conv_id).encode()) % 5 == 0]
    assert np.mean([gold[r.conv_id, r.turn].role == r.role for r in held]) > 0.97
    # a round trip: the turn without its marker, in the canonical form
    assert all(r.rendered == f"<|im_start|>{r.role}\n{gold[r.conv_id, r.turn].text}<|im_end|>" for r in got
               if "\n\n" not in gold[r.conv_id, r.turn].text)


def test_long_chat_equals_one_viterbi(spark, monkeypatch):
    """Blocks and scans find the same path as one pass over the whole transcript."""
    monkeypatch.setattr(chat_format, "BLOCK", 2)
    monkeypatch.setattr(chat_format, "FAN", 3)
    rng = random.Random(5)
    rows = spark.createDataFrame(
        [(c, t, rng.choice(chat_format.ROLES), prose(rng, rng.randint(1, 60))) for c in range(3) for t in range(45)],
        "conv_id long, turn long, role string, text string")
    lines = transcripts(rows)
    model = chat_format.fit(lines)
    got = chat_format.format_chats(lines, model).orderBy("conv", "pos").collect()
    held = lines.orderBy("conv", "pos").collect()
    for c in range(3):
        features = [f for r in held if r.conv == c for f, _ in chat_format.read_lines(r.text)]
        n = len(chat_format.STATES)
        path = chat_format.viterbi(model, features, np.tile(model.start, (n, 1)), np.zeros(n))
        want, at = [], iter(path)
        for r in (r for r in held if r.conv == c):
            for k, _ in enumerate(chat_format.read_lines(r.text)):
                role, begins = chat_format.STATES[next(at)]
                if begins or k == 0:
                    want.append((r.pos, chat_format.ROLES[role], begins))
        assert sorted((r.pos, r.role, r.begins) for r in got if r.conv == c) == sorted(want)


def test_chat_odd_rows(spark):
    rows = [(1, 0, "user", "User: hi\n\nAssistant: yes?\nmore"), (1, 1, None, None), (None, 0, "user", "x"),
            (2, None, "user", "x"), (2, 5, "robot", " \n\t"), (3, 7, "user", "**Human:** a" + " b" * 100_000)]
    df = spark.createDataFrame([(*r, "c", 1) for r in rows],
                               "conv long, pos long, role string, text string, content string, block int")
    model = chat_format.fit(df.limit(0))   # markers mean something before anything is learnt
    got = sorted(chat_format.format_chats(df, model).collect())
    assert [(r.conv, r.pos, r.role, r.n_lines) for r in got] == [
        (1, 0, "assistant", 2), (1, 0, "user", 1), (3, 7, "user", 1)]
    assert chat_format.format_chats(df.limit(0), chat_format.fit(df)).count() == 0


# names inside a message are the speaker's own role or one who never speaks: a line alone cannot tell the other's from a turn
ODD_TURNS = {"assistant": ["Well.\nAnswer: 42 it is", "use\n\n  model: resnet\n\n\nend", "plain", "a\n \nb\nc"],
             "user": ["so\nuser: admin\nContext: x", "plain", "a\n\n  b\n\n\nc"]}


def odd_talk(rng, n_convs, n_turns):
    return [(c, t, role, rng.choice(ODD_TURNS[role]) + f" {c} {t}") for c in range(n_convs)
            for t in range(n_turns) for role in [("user", "assistant")[t % 2]]]


def test_turns_are_put_together_from_lines(spark, monkeypatch):
    """Over rows, blocks and spans of blocks; names and blank lines inside a message stay."""
    from retailstream.llm.queries import transcript_lines
    monkeypatch.setattr(chat_format, "BLOCK", 2)
    monkeypatch.setattr(chat_format, "FAN", 3)
    gold = odd_talk(random.Random(1), 5, 40)
    rows = spark.createDataFrame(gold, "conv long, pos long, role string, text string")
    marked = rows.withColumn("text", F.concat(F.when(F.col("role") == "user", "User: ").otherwise("Assistant: "), "text"))
    got = chat_format.format_turns(transcript_lines(marked), chat_format.fit(marked)).collect()
    assert sorted((r.conv, r.turn, r.role, r.content) for r in got) == sorted(gold)
    assert all(r.rendered == f"<|im_start|>{r.role}\n{r.content}<|im_end|>" and r.begins for r in got)


def test_stretches_hold_several_or_partial_turns(spark):
    gold = odd_talk(random.Random(2), 3, 30)
    known = spark.createDataFrame([(c, t, r, f"{r.title()}: {x}") for c, t, r, x in gold],
                                  "conv long, pos long, role string, text string")
    rng, rows = random.Random(3), []
    for c in range(3):
        lines, pos = "\n".join(f"{r.title()}: {x}" for k, _, r, x in gold if k == c).split("\n"), 100
        while lines:
            n, pos = rng.randint(1, 7), pos + rng.randint(1, 90)
            rows.append((c, pos, "\n".join(lines[:n])))
            lines = lines[n:]
    rows += [(7, i, "") for i in range(70)] + [(7, 80, "User: hi"), (7, 81, ""), (8, 0, "  ")]   # blank rows first, and only
    got = chat_format.format_turns(spark.createDataFrame(rows, "conv long, pos long, text string"), chat_format.fit(known))
    assert sorted((r.conv, r.turn, r.role, r.content) for r in got.collect()) == sorted([*gold, (7, 0, "user", "hi")])


def test_rows_at_one_position_are_cut_in_blocks(spark):
    """A conversation whose rows all have the same position, half of them equal, is many blocks, in the order of the texts."""
    rows = spark.createDataFrame([(1, 5, f"l{i:04}" if i % 2 else "same") for i in range(1000)], "conv long, pos long, text string")
    blocks = chat_format._blocks(rows.repartition(4)).collect()
    assert max(len(b.texts) for b in blocks) <= chat_format.BLOCK
    assert sorted(b.block for b in blocks) == list(range(len(blocks)))
    texts = [t.text for b in sorted(blocks, key=lambda b: b.block) for t in b.texts]
    assert texts == sorted(r.text for r in rows.collect())


@pytest.mark.parametrize("line, role", [("User: x", "user"), ("### Assistant", "assistant"), ("Q: why", "user"),
                                        ("<|system|> x", "system"), ("**Human:** x", "user"), ("The user: x", None),
                                        ("[AI] x", "assistant"), ("plain", None), ("note: x", None)])
def test_markers(line, role):
    assert chat_format.marker_of(line)[0] == role


def plain_links(rows, least=0.9):
    def usable(v):
        return v is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v, float) != 0)

    fine = [(i, np.array(v, float)) for i, v in rows if usable(v)]
    n, comp = Counter(), list(range(len(fine)))
    for a, (_, x) in enumerate(fine):
        for b in range(a):
            y = fine[b][1]
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                n[a] += 1
                n[b] += 1
                old, new = comp[a], comp[b]
                comp = [new if c == old else c for c in comp]
    out = []
    for k, (i, _) in enumerate(fine):
        out.append((i, n[k], min(fine[j][0] for j in range(len(fine)) if comp[j] == comp[k])))
    return out + [(i, 0, i) for i, v in rows if not usable(v)]


def test_vectors_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)   # the crowded group is compared block by block
    rng = np.random.default_rng(4)
    base = rng.normal(size=48)
    rows = [(i, (base + rng.normal(size=48) * 0.12).tolist()) for i in range(60)]
    rows += [(100 + i, rng.normal(size=48).tolist()) for i in range(40)]
    rows += [(200 + i, rows[3][1]) for i in range(5)] + [(300, [1.0, 2.0]), (301, [2.0, 4.1]), (302, [0.0, 0.0])]
    rows += [(400, None), (401, []), (402, [1.0, None]), (403, [float("nan"), 1.0]), (404, [float("inf"), 1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, n_links int")
    got = sorted(tuple(r)[:3] for r in embedding_dedup.near_duplicates(df).collect())
    want = sorted(plain_links(rows))
    assert [g[::2] for g in got] == [w[::2] for w in want]   # ids and components
    assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_vector_recall(spark):
    """Random pairs at the threshold itself: at least 0.97 of them meet in some table."""
    rng = np.random.default_rng(1)
    a = rng.normal(size=(2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(2000, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(0.19) * b / np.linalg.norm(b, axis=1, keepdims=True)
    x, y = (embedding_dedup.bucket_codes(v, embedding_dedup.Hashing()) for v in (a, b))
    assert ((x[:, :, :1] == y).any(2) | (x == y[:, :, :1]).any(2)).any(1).mean() > 0.97


def test_vector_query(spark):
    got = QUERIES["op6_embedding_dedup"](spark, SF_SMALL)
    assert got.dtypes == [("vec_id", "bigint"), ("n_links", "bigint"), ("component_id", "bigint"), ("kept", "boolean")]
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert sorted(tuple(r)[:3] for r in got.collect()) == sorted(plain_links(rows))


def test_hadamard_keeps_lengths():
    x = np.random.default_rng(0).normal(size=(5, 32))
    y = embedding_dedup.hadamard(x)
    assert np.allclose((y ** 2).sum(1), 32 * (x ** 2).sum(1))
    assert np.allclose(embedding_dedup.hadamard(y), 32 * x)

