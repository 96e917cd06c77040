"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained in numpy.

A word is the bag of its character n-grams (with word ends) and of itself; the
n-grams hash into a table of embeddings, a word is the mean of its n-grams'
vectors, a window of words the mean of its words' vectors, and a linear softmax
gives the two classes.  Embeddings and softmax are trained together, so a
misspelt or inflected form never seen shares most of its vectors with the forms
that were.

A text is scored whole, in overlapping windows of a fixed number of words; its
score is the highest window's, so a long text's few toxic words are not
averaged away.  A word that comes again within a window counts once there, or a
line of one word over and over would carry that word's noise many times.
Training follows the same rule: of a toxic document the window that scores
highest carries the label (after a first third of training with all of them).

Because everything up to the softmax is linear, a trained word is one number:
scoring looks words up in the worker's cache and adds up runs of them.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailstream.llm.common import bound_batches
from retailstream.llm.training import labelled_sample

WORDS = re.compile(r"[^\W\d_]+")
CACHE_WORDS = 200_000   # words a worker remembers the scores of; more are worked out each time
SLICE_WORDS = 10_000    # words whose n-grams are held at a time
SLICE_CHARS = 1 << 20   # text scored at a time in a task


@dataclass(frozen=True)
class Settings:
    """Fixed before training; the same at every size of the corpus."""

    buckets: int = 1 << 16     # rows of the embedding table
    dim: int = 8
    shortest: int = 3          # n-gram lengths
    longest: int = 6
    window: int = 16           # words averaged at a time; windows overlap by half
    least_docs: int = 3        # words of fewer training documents are left out of training
    epochs: int = 24
    steps: int = 16            # per epoch
    rate: float = 0.3
    floor: float = 1e-12
    max_docs: int = 3600       # labelled documents trained on
    toxic_share: float = 1 / 3   # of them, where there are enough: more clean ones, fewer false alarms
    max_chars: int = 8_000     # longer labelled documents are not trained on
    seed: int = 7


def word_grams(words: list[str], s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(bucket ids of all words' n-grams, the word each belongs to): hashes over code points, vectorised."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    marked = [f"<{w}>" for w in words]
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(marked)), lengths)
    place = np.arange(len(points)) - starts[owner]
    room = lengths[owner] - place    # code points from here to the word's end
    ids, owners = [], []
    value, at = np.zeros(len(points), np.uint64), np.arange(len(points))
    with np.errstate(over="ignore"):
        for n in range(1, s.longest + 1):
            more = room[at] >= n
            at, value = at[more], value[more]
            value = (value ^ points[at + n - 1]) * np.uint64(0x100000001B3) + np.uint64(n)
            if n >= s.shortest:
                ids.append(_bucket(value, s.buckets))
                owners.append(owner[at])
        # the whole word, by the sum of its mixed positions
        mixed = (points + np.uint64(0x9E3779B97F4A7C15)) * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1))
        mixed ^= mixed >> np.uint64(29)
        ids.append(_bucket(np.add.reduceat(mixed * np.uint64(0xBF58476D1CE4E5B9), starts), s.buckets))
        owners.append(np.arange(len(marked)))
    return np.concatenate(ids), np.concatenate(owners)


def _bucket(value: np.ndarray, buckets: int) -> np.ndarray:
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return ((value >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def first_of(codes: np.ndarray, window: int) -> np.ndarray:
    """Whether each word is not among the ``window`` words before it."""
    order = np.argsort(codes, kind="stable")
    again = (codes[order[1:]] == codes[order[:-1]]) & (np.diff(order) < window)
    out = np.ones(len(codes), bool)
    out[order[1:][again]] = False
    return out


def window_means(values: np.ndarray, window: int) -> np.ndarray:
    """Means over windows of ``window`` values, overlapping by half; fewer values are one window."""
    if len(values) <= window:
        return values.mean(keepdims=True) if len(values) else np.zeros(1)
    sums = np.concatenate([[0.0], np.cumsum(values)])
    starts = np.append(np.arange(0, len(values) - window, window // 2), len(values) - window)
    return (sums[starts + window] - sums[starts]) / window


@dataclass
class Model:
    settings: Settings
    scalars: np.ndarray   # per bucket: embedding times softmax weights, toxic minus clean
    bias: float

    def word_scores(self, words: list[str]) -> np.ndarray:
        out = [np.zeros(0)]
        for at in range(0, len(words), SLICE_WORDS):
            part = words[at:at + SLICE_WORDS]
            ids, owner = word_grams(part, self.settings)
            out.append(np.bincount(owner, self.scalars[ids], len(part)) / np.bincount(owner, minlength=len(part)))
        return np.concatenate(out)

    def probability(self, codes: np.ndarray, values: np.ndarray) -> float:
        """Of a text: its words' codes (equal words, equal codes) and scores."""
        window = self.settings.window
        best = window_means(np.where(first_of(codes, window), values, 0.0), window).max() if len(codes) else 0.0
        return 1.0 / (1.0 + float(np.exp(-np.clip(best + self.bias, -30, 30))))


def train(texts: list[str], labels: list[int], s: Settings) -> Model:
    """Embeddings and softmax, jointly, by gradient descent on the mean log loss of windows.

    Adagrad by rows, from a floor that keeps rows of few windows near their start.
    """
    rng = np.random.default_rng(s.seed)
    held = [words_of(t) for t in texts]
    seen = Counter(w for words in held for w in set(words))
    index = {w: i for i, w in enumerate(sorted(w for w, n in seen.items() if n >= s.least_docs))}
    docs, parts, divide = [], [], []
    for d, words in enumerate(held):
        codes = np.array([index.get(w, -1) for w in words], np.int64)
        counted = first_of(codes, s.window) & (codes >= 0)
        for at in range(0, max(len(codes) - s.window, 0) + 1, max(s.window // 2, 1)):
            part = codes[at:at + s.window][counted[at:at + s.window]]
            if len(part):
                parts.append(part)
                divide.append(min(len(codes), s.window))
                docs.append(d)
    if not parts or len(set(labels)) < 2:   # nothing to tell apart: the share of toxic documents
        share = min(max((sum(labels) + 0.5) / (len(labels) + 1), 1e-3), 1 - 1e-3)
        return Model(s, np.zeros(s.buckets), float(np.log(share / (1 - share))))
    grams, owner = word_grams(list(index), s)
    grams = grams[np.argsort(owner, kind="stable")]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(index)))])
    divide = np.array(divide, np.float32)
    docs, label = np.array(docs), np.array(labels)[docs]
    sizes = np.array([len(p) for p in parts])
    ends = np.cumsum(sizes)
    tokens = np.concatenate(parts)
    embed = rng.normal(0, 0.1, (s.buckets, s.dim)).astype(np.float32)
    out = rng.normal(0, 0.1, (s.dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    squares = [np.full((s.dim, 1), s.floor, np.float32), np.full(1, s.floor, np.float32),
               np.full((s.buckets, 1), s.floor, np.float32)]
    chosen = np.arange(len(parts))
    for epoch in range(s.epochs):
        if epoch >= s.epochs // 3:
            # of each toxic document only the window that looks most toxic keeps its label
            scalars = embed @ (out[:, 1] - out[:, 0])
            word_now = np.add.reduceat(scalars[grams], bounds[:-1]) / np.diff(bounds)
            score = np.add.reduceat(word_now[tokens], ends - sizes) / divide
            best = np.full(len(texts), -np.inf)
            np.maximum.at(best, docs, score)
            chosen = np.flatnonzero((label == 0) | (score == best[docs]))
        toxic = (label[chosen] == 1).sum()   # both classes weigh the same
        weight = np.where(label == 1, len(chosen) / 2 / max(toxic, 1), len(chosen) / 2 / max(len(chosen) - toxic, 1))
        for batch in np.array_split(rng.permutation(chosen), s.steps):
            at, own = _ranges(ends[batch] - sizes[batch], sizes[batch])
            words, word_at = np.unique(tokens[at], return_inverse=True)
            g_at, g_word = _ranges(bounds[words], bounds[words + 1] - bounds[words])
            g_size = (bounds[words + 1] - bounds[words])[:, None]
            ids = grams[g_at]
            vecs = _sums(g_word, embed[ids], len(words)) / g_size
            hidden = _sums(own, vecs[word_at], len(batch)) / divide[batch][:, None]
            logit = hidden @ out + bias
            error = np.exp(logit - logit.max(1, keepdims=True))
            error /= error.sum(1, keepdims=True)
            error[np.arange(len(batch)), label[batch]] -= 1
            error *= (weight[batch] / len(batch))[:, None]
            d_hidden = error @ out.T / divide[batch][:, None]
            d_word = _sums(word_at, d_hidden[own], len(words)) / g_size
            grads = (hidden.T @ error, error.sum(0), _sums(ids, d_word[g_word], s.buckets))
            for value, grad, square in zip((out, bias, embed), grads, squares, strict=True):
                square += (grad * grad).mean(-1, keepdims=True)
                value -= s.rate * grad / np.sqrt(square)
    return Model(s, (embed @ (out[:, 1] - out[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The indexes of all ranges one after the other, and the range each belongs to."""
    owner = np.repeat(np.arange(len(starts)), lengths)
    return np.arange(len(owner)) - (np.cumsum(lengths) - lengths)[owner] + starts[owner], owner


def _sums(owner: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Row sums by owner."""
    return np.stack([np.bincount(owner, rows[:, j], n) for j in range(rows.shape[1])], 1).astype(np.float32)


class Scorer:
    """Scores texts with a model, remembering words' scores."""

    def __init__(self, model: Model):
        self.model = model
        self.cache: dict[str, float] = {}

    def texts(self, texts: list[str]) -> list[float]:
        held = [words_of(t) for t in texts]
        codes = {w: i for i, w in enumerate(set().union(*held))}
        distinct = list(codes)
        known = np.array([self.cache.get(w, np.nan) for w in distinct], np.float64)
        new = np.flatnonzero(np.isnan(known))
        if len(new):
            known[new] = self.model.word_scores([distinct[i] for i in new])
            room = max(CACHE_WORDS - len(self.cache), 0)
            self.cache.update((distinct[i], known[i]) for i in new[:room].tolist())
        out = []
        for words in held:
            at = np.fromiter(map(codes.__getitem__, words), np.int64, len(words))
            out.append(self.model.probability(at, known[at]))
        return out


_SCORERS: dict[str, Scorer] = {}


def _slices(texts: list[str]) -> Iterator[list[str]]:
    part, held = [], 0
    for t in texts:
        if part and held + len(t) > SLICE_CHARS:
            yield part
            part, held = [], 0
        part.append(t)
        held += len(t)
    if part:
        yield part


def probability(model: Model, text: Column) -> Column:
    """The toxicity of each whole text, 0 to 1; of a null text as of an empty one."""
    key = uuid.uuid4().hex

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if key not in _SCORERS:   # one for a worker process, over all its tasks
            _SCORERS.clear()
            _SCORERS[key] = Scorer(model)
        for texts in batches:
            yield pd.Series([p for part in _slices(texts.tolist()) for p in _SCORERS[key].texts(part)],
                            dtype="float64")

    return score(F.coalesce(text, F.lit("")))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", settings: Settings = Settings()) -> Model:
    """Train on at most ``settings.max_docs`` labelled documents (see ``labelled_sample``).

    Labels and texts that are null are not used.  With no label or only one kind,
    the model gives all texts the share of toxic ones seen.
    """
    texts, given = labelled_sample(docs, labels, id_col, text_col, label_col, settings.max_docs, settings.max_chars,
                                   settings.toxic_share)
    return train(texts, given, settings)


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``{id_col}, score, predicted`` (1 from 0.5 on).

    Null and empty texts are scored as texts without words.  Repeated rows and
    null ids are scored row by row.  Other columns are ignored.
    """
    bound_batches(docs)
    scored = docs.select(F.col(id_col), probability(model, F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
