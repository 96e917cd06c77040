"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are embedded, filters of two blocks of ``BLOCK`` bytes slide over them
block by block, and each chunk of the text keeps every filter's maximum.  Chunks
overlap by half and cover the whole document; a small layer turns a chunk's
maxima and size (a short chunk lights up few filters too) into its logit, and the document's logit is the mean over its chunks and
the lowest of them, weighed by trained weights.  Text that repeats itself or is
made of a few symbols lights up few filters, which the layer over the maxima sees.

All training is backpropagation written out below, with Adam, on a bounded
sample of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailstream.llm.common import bound_batches
from retailstream.llm.training import labelled_sample

BLOCK = 4            # bytes the filters step by; a filter sees two blocks
CHUNK = 256          # blocks of a chunk: 1024 bytes, overlapping by half
SEGMENT = 512        # chunks of a long text worked on at a time
SLICE_BYTES = 1 << 20   # of short texts worked on at a time


@dataclass(frozen=True)
class Settings:
    """Fixed before training; the same at every size of the corpus."""

    dim: int = 6              # numbers a byte is embedded in
    filters: int = 48
    hidden: int = 24
    epochs: int = 16
    crops: float = 0.3        # share of training texts of which only a stretch is shown
    least_crop: int = 24      # bytes
    batch: int = 32           # documents
    rate: float = 5e-3
    max_docs: int = 4000      # labelled documents trained on, half of each label where there are enough
    max_chars: int = 6_000    # longer labelled documents are not trained on
    seed: int = 11


@dataclass
class Model:
    settings: Settings
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def start(s: Settings) -> Model:
        rng = np.random.default_rng(s.seed)

        def normal(rows: int, cols: int) -> np.ndarray:
            return rng.normal(0, rows ** -0.5, (rows, cols)).astype(np.float32)

        embed = rng.normal(0, 1, (256, s.dim)).astype(np.float32)
        return Model(s, {
            "embed": embed, "first": normal(2 * BLOCK * s.dim, s.filters)[:BLOCK * s.dim],
            "second": normal(2 * BLOCK * s.dim, s.filters)[:BLOCK * s.dim],
            "shift": np.zeros(s.filters, np.float32), "deep": normal(s.filters, s.hidden),
            "deep_shift": np.zeros(s.hidden, np.float32),
            "size": normal(1, s.hidden), "out": normal(s.hidden, 1),
            "bias": np.zeros(1, np.float32), "mix": np.array([1.0, 0.0], np.float32)})


def blocks_of(text: bytes) -> np.ndarray:
    """The text's bytes in blocks, zero bytes at the end: at least two blocks."""
    n = max(-(-len(text) // BLOCK), 2) * BLOCK
    return np.frombuffer(text.ljust(n, b"\0"), np.uint8).reshape(-1, BLOCK)


def chunk_bounds(n_positions: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) filter positions of the chunks that cover a text."""
    starts = np.arange(0, max(n_positions - CHUNK // 2, 1), CHUNK // 2)
    return starts, np.minimum(starts + CHUNK, n_positions)


def _layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts' blocks in one array, and each chunk's bounds in it and its text."""
    parts, first, last, owner, at = [], [], [], [], 0
    for i, text in enumerate(texts):
        blocks = blocks_of(text)
        lo, hi = chunk_bounds(len(blocks) - 1)   # a position is a block and the next one
        parts.append(blocks)
        first.append(lo + at)
        last.append(hi + at)
        owner.append(np.full(len(lo), i))
        at += len(blocks)
    return np.concatenate(parts), np.concatenate(first), np.concatenate(last), np.concatenate(owner)


def _half_maxima(conv: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Maxima of ``conv`` over [first, last): chunks overlap, so bounds are interleaved."""
    if last[-1] == len(conv):   # reduceat takes starts below the length only
        conv = np.concatenate([conv, conv[-1:]])
    bounds = np.stack([first, last], 1).ravel()
    return np.maximum.reduceat(conv, bounds, axis=0)[::2]


def chunk_logits(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Logits of all chunks of ``texts``, the text each belongs to, and what led to them."""
    w = model.weights
    blocks, first, last, owner = _layout(texts)
    x = w["embed"][blocks].reshape(len(blocks), -1)
    conv = x[:-1] @ w["first"] + x[1:] @ w["second"]
    top = _half_maxima(conv, first, last) + w["shift"]
    pooled = np.maximum(top, 0)
    size = np.log2(last - first).astype(np.float32)[:, None] / 8
    inner = pooled @ w["deep"] + size @ w["size"] + w["deep_shift"]
    act = np.maximum(inner, 0)
    logit = (act @ w["out"] + w["bias"])[:, 0]
    return logit, owner, (blocks, first, last, x, conv, top, pooled, size, inner, act)


def document_logits(model: Model, logit: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Mean and lowest chunk of each text, weighed; ``owner`` rises from 0 without gaps."""
    n = np.bincount(owner)
    starts = np.cumsum(n) - n
    mean, low = np.add.reduceat(logit, starts) / n, np.minimum.reduceat(logit, starts)
    mix = model.weights["mix"]
    return mix[0] * mean + mix[1] * low, (n, starts, mean, low)


def backward(model: Model, logit: np.ndarray, owner: np.ndarray, layers: tuple, combined: tuple,
             d_out: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of all weights, given those of the documents' logits."""
    w = model.weights
    blocks, first, last, x, conv, top, pooled, size, inner, act = layers
    n, starts, mean, low = combined
    grads = {"mix": np.array([(d_out * mean).sum(), (d_out * low).sum()], np.float32)}
    d_logit = (d_out * w["mix"][0] / n)[owner]
    lowest = np.array([lo + int(np.argmin(logit[lo:lo + k])) for lo, k in zip(starts, n, strict=True)])
    d_logit[lowest] += d_out * w["mix"][1]
    d_logit = d_logit[:, None].astype(np.float32)
    grads["out"], grads["bias"] = act.T @ d_logit, d_logit.sum(0)
    d_inner = (d_logit @ w["out"].T) * (inner > 0)
    grads["deep"], grads["deep_shift"] = pooled.T @ d_inner, d_inner.sum(0)
    grads["size"] = size.T @ d_inner
    d_top = (d_inner @ w["deep"].T) * (top > 0)
    grads["shift"] = d_top.sum(0)
    # each maximum's gradient goes to the position that holds it
    d_conv = np.zeros_like(conv)
    cols = np.arange(conv.shape[1])
    for lo, hi, d in zip(first, last, d_top, strict=True):
        if d.any():
            d_conv[lo + conv[lo:hi].argmax(0), cols] += d
    hit = np.flatnonzero(d_conv.any(1))
    d = d_conv[hit]
    grads["first"], grads["second"] = x[hit].T @ d, x[hit + 1].T @ d
    d_embed = np.zeros_like(w["embed"])
    np.add.at(d_embed, blocks[hit].ravel(), (d @ w["first"].T).reshape(-1, w["embed"].shape[1]))
    np.add.at(d_embed, blocks[hit + 1].ravel(), (d @ w["second"].T).reshape(-1, w["embed"].shape[1]))
    grads["embed"] = d_embed
    return grads


def _crop(text: bytes, rng: np.random.Generator, s: Settings) -> bytes:
    """Now and then a stretch of the text instead of all of it: labelled texts are seldom short."""
    if rng.random() >= s.crops or len(text) < 2 * s.least_crop:
        return text
    size = int(np.exp(rng.uniform(np.log(s.least_crop), np.log(len(text)))))
    at = int(rng.integers(len(text) - size + 1))
    return text[at:at + size]


def train(texts: list[str], labels: list[int], s: Settings) -> Model:
    """Adam on the mean log loss, both labels weighing the same."""
    model = Model.start(s)
    if len(set(labels)) < 2:   # nothing to tell apart: the share of good documents
        share = min(max((sum(labels) + 0.5) / (len(labels) + 1), 1e-3), 1 - 1e-3)
        model.weights["out"][:] = 0
        model.weights["bias"][:] = np.log(share / (1 - share))
        return model
    rng = np.random.default_rng(s.seed)
    data = [t.encode() for t in texts]
    y = np.array(labels, np.float64)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    m = {k: np.zeros_like(v) for k, v in model.weights.items()}
    v = {k: np.zeros_like(x) for k, x in model.weights.items()}
    step, steps = 0, s.epochs * -(-len(data) // s.batch)
    for _ in range(s.epochs):
        for batch in np.array_split(rng.permutation(len(data)), -(-len(data) // s.batch)):
            logit, owner, layers = chunk_logits(model, [_crop(data[i], rng, s) for i in batch])
            out, combined = document_logits(model, logit, owner)
            prob = 1 / (1 + np.exp(-np.clip(out, -30, 30)))
            grads = backward(model, logit, owner, layers, combined, (prob - y[batch]) * weight[batch] / len(batch))
            step += 1
            rate = s.rate * (1 - step / (steps + 1))
            for k, g in grads.items():
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                model.weights[k] -= (rate * (m[k] / (1 - 0.9 ** step))
                                     / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return model


def segments(text: bytes) -> Iterator[bytes]:
    """The text in stretches of ``SEGMENT`` chunks each that share no chunk: their
    chunks, one after the other, are the text's own."""
    step, n = CHUNK // 2, len(blocks_of(text)) - 1
    for a in range(0, max(-(-(n - step) // step), 1), SEGMENT):
        upto = (a + SEGMENT - 1) * step + CHUNK + 1
        yield text[a * step * BLOCK:upto * BLOCK]


def score_texts(model: Model, texts: list[bytes]) -> list[float]:
    """Probabilities of whole texts; long ones are worked on a stretch at a time."""
    logits, owners = [], []
    batch: list[bytes] = []
    batch_of: list[int] = []

    def flush() -> None:
        if batch:
            logit, owner, _ = chunk_logits(model, batch)
            logits.append(logit)
            owners.append(np.array(batch_of)[owner])
            batch.clear()
            batch_of.clear()

    held = 0
    for i, text in enumerate(texts):
        for part in segments(text):
            batch.append(part)
            batch_of.append(i)
            held += len(part) + 2 * BLOCK
            if held > SLICE_BYTES:
                flush()
                held = 0
    flush()
    if not logits:
        return []
    out, _ = document_logits(model, np.concatenate(logits), np.concatenate(owners))
    return (1 / (1 + np.exp(-np.clip(out, -30, 30)))).tolist()


def probability(model: Model, text: Column) -> Column:
    """The quality of each whole text, 0 to 1; of a null text as of an empty one."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(score_texts(model, [t.encode("utf-8", "replace") for t in texts]), dtype="float64")

    return score(F.coalesce(text, F.lit("")))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", settings: Settings = Settings()) -> Model:
    """Train on at most ``settings.max_docs`` labelled documents (see ``labelled_sample``).

    Labels and texts that are null are not used.  With no label or only one kind,
    the model gives all texts the share of good ones seen.
    """
    texts, given = labelled_sample(docs, labels, id_col, text_col, label_col, settings.max_docs, settings.max_chars)
    return train(texts, given, settings)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = 0.7) -> DataFrame:
    """Per row of ``docs``: ``{id_col}, score, predicted`` (1 from ``threshold`` on).

    Null and empty texts are two blocks of zero bytes to the network.  Repeated
    rows and null ids are scored row by row.  Other columns are ignored.
    """
    bound_batches(docs)
    scored = docs.select(F.col(id_col), probability(model, F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
