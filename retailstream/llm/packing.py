"""Best-fit packing: token pieces into sequences, best-fit decreasing over the whole corpus.

Best-fit decreasing takes the longest piece first and puts it into the open
sequence with the least room that still holds it, found by a segment tree over
the remaining capacities.  It only looks at lengths, and there are at most
``seq_len`` of them, so the plan is made from the histogram of lengths: pieces
of one length are placed in runs ("the next 5,000 pieces of 700 tokens go two
each into sequences 81 to 2580, from token 600 on").  The plan is the one that
piece-by-piece best-fit decreasing makes; its size depends on ``seq_len``, not
on the corpus, and it is all the driver holds.

Pieces then find their place by their rank among the pieces of their length.
Ranks are counted within (length, salt) groups and shifted by the sizes of the
groups before, so one length that a third of all pieces share is spread out.
"""

from __future__ import annotations

import os
import sys
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailstream.llm.common import bound_batches, stored

SLICE_BYTES = 4 << 20   # text encoded at a time in a task; a longer text is a slice of its own
MAX_SALTS = 512         # groups that the pieces of one length are ranked in
CACHE_BYTES = 48 << 20  # words and ids of a generation; a worker remembers the last two
CALL_WORDS = 2048       # words that the full tokenizer gets at a time: its answers are large objects
CALL_CHARS = 1 << 16    # and characters, or one word


class WordEncoder:
    """Ids of whole texts, encoded word by word with a cache.

    Exact for tokenizers that drop white space and never join across it.  Words
    of Latin letters, with or without a final run of ``.`` and ``,``, are one
    pre-token (and one more): they go straight to the model; everything else
    goes through the full tokenizer.
    """

    def __init__(self, path: str):
        # a task has one core; threads of the tokenizer would keep memory of their own
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.cache: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}   # the generation before; its words move on when they are met
        self.cached = 0   # bytes in ``cache``, about
        # the byte-level alphabet: printable Latin-1 stands for itself, other bytes for 256, 257, ...
        printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        others = (b for b in range(256) if b not in printable)
        self.alphabet = {b: 256 + i for i, b in enumerate(others)}

    def _by_tokenizer(self, words: list[str]) -> Iterator[bytes]:
        first, chars = 0, 0
        for i, word in enumerate(words):
            if i > first and (i - first == CALL_WORDS or chars + len(word) > CALL_CHARS):
                yield from self._call(words[first:i])
                first, chars = i, 0
            chars += len(word)
        if first < len(words):
            yield from self._call(words[first:])

    def _call(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.full.encode_batch_fast(words, add_special_tokens=False)]

    def _remember(self, word: str, ids: bytes) -> None:
        size = sys.getsizeof(word) + sys.getsizeof(ids) + 128   # and a place in the table
        if self.cached + size > CACHE_BYTES:
            self.cache, self.before, self.cached = {}, self.cache, 0
        if size <= CACHE_BYTES:
            self.cache[word] = ids
            self.cached += size

    def _letters(self, word: str) -> bytes | None:
        """Ids of a word of Latin letters; None for any other."""
        if not word.isalpha():
            return None
        if word.isascii():
            word = word.lower()
        else:
            if max(word) >= "ɐ":
                return None
            word = unicodedata.normalize("NFC", word).lower()
            if not word.isalpha():
                return None
            word = word.encode().decode("latin-1").translate(self.alphabet)
        return np.array([t.id for t in self.model.tokenize(word)], dtype="<u4").tobytes()

    def words(self, words: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each of ``words`` (distinct)."""
        out = list(map(self.cache.get, words))
        rest, ends = [], {}
        for i, known in enumerate(out):
            if known is None:
                word = words[i]
                known = self.before.get(word)
                if known is not None:
                    out[i] = known
                    self._remember(word, known)
                    continue
                letters = word.rstrip(".,")
                ids = self._letters(letters)
                if ids is None:
                    rest.append(i)
                    continue
                end = word[len(letters):]
                if end:
                    if end not in ends:
                        ends[end] = self._call([end])[0]
                    ids += ends[end]
                out[i] = ids
                self._remember(word, ids)
        for i, ids in zip(rest, self._by_tokenizer([words[i] for i in rest]), strict=True):
            out[i] = ids
            self._remember(words[i], ids)
        return out

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds): text i has ids[bounds[i]:bounds[i + 1]]."""
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        ids = self.words(coded.dictionary.to_pylist())
        lengths = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
        flat = np.frombuffer(b"".join(ids), "<u4")
        starts = np.concatenate([[0], np.cumsum(lengths)])
        which = coded.indices.to_numpy()
        n = lengths[which]
        ends = np.concatenate([[0], np.cumsum(n)])
        out = flat[np.repeat(starts[which] - ends[:-1], n) + np.arange(ends[-1])]
        return out, ends[split.offsets.to_numpy() - split.offsets[0].as_py()]


_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    """One encoder for each worker process and tokenizer."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield first, i
            first, held = i, 0
        held += size + 1
    if first < len(sizes):
        yield first, len(sizes)


def _pieces(tokenizer: str | None, seq_len: int, end_id: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer
        if path is None:
            import public_tokenizers
            path = public_tokenizers.path("word_bpe_49k.json")
        encoder = _encoder(path)
        end = np.array([end_id], dtype="<u4")
        for b in batches:
            for first, last in _slices(b.column(1), SLICE_BYTES):
                ids, bounds = encoder.texts(b.column(1).slice(first, last - first))
                rows: list[tuple] = []
                tokens = []
                for doc_id, lo, hi in zip(b.column(0).slice(first, last - first).to_pylist(), bounds[:-1].tolist(),
                                          bounds[1:].tolist(), strict=True):
                    own = np.concatenate([ids[lo:hi], end])
                    for piece, start in enumerate(range(0, len(own), seq_len)):
                        part = own[start:start + seq_len]
                        rows.append((doc_id, piece, start, len(part), zlib.crc32(part)))
                        tokens.append(part)
                cols = list(zip(*rows, strict=True))
                types = [b.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([t.astype(np.int32) for t in tokens], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)
    return cut


def cut_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seq_len: int = 2048,
               tokenizer: str | None = None, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """``id, piece, start, length, ids_crc32[, ids]``: every text's ids and ``end_id``, cut at ``seq_len``."""
    bound_batches(docs)
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"id {base.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return base.mapInArrow(_pieces(tokenizer, seq_len, end_id, with_ids),
                           schema + (", ids array<int>" if with_ids else ""))


class CapacityTree:
    """Which remaining capacities have open sequences; the least one of at least
    some size is found in logarithmic time."""

    def __init__(self, largest: int):
        self.width = 1
        while self.width <= largest:
            self.width *= 2
        self.some = [False] * (2 * self.width)

    def mark(self, capacity: int, present: bool) -> None:
        node = capacity + self.width
        self.some[node] = present
        while node > 1:
            node //= 2
            self.some[node] = self.some[2 * node] or self.some[2 * node + 1]

    def tightest(self, least: int) -> int | None:
        node = least + self.width
        if self.some[node]:
            return node - self.width
        while node > 1:
            if node % 2 == 0 and self.some[node + 1]:   # the subtree to the right
                node += 1
                while node < self.width:
                    node = 2 * node if self.some[2 * node] else 2 * node + 1
                return node - self.width
            node //= 2
        return None


def plan_best_fit(histogram: dict[int, int], seq_len: int) -> tuple[np.ndarray, int]:
    """Best-fit decreasing for ``histogram[length]`` pieces: (runs, number of sequences).

    A run (length, first rank, first sequence, per sequence, from) says: the
    pieces of that length from that rank on go, so many to each, into the
    sequences from the first one on, starting at token ``from``.
    """
    tree = CapacityTree(seq_len)
    open_at: list[list[tuple[int, int]]] = [[] for _ in range(seq_len + 1)]   # (first sequence, how many)
    runs, made = [], 0

    def put(capacity: int, first: int, n: int) -> None:
        if n and capacity:
            open_at[capacity].append((first, n))
            tree.mark(capacity, True)

    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room, first = seq_len, made
                n = -(-left // (seq_len // length))
                made += n
            else:
                first, n = open_at[room].pop()
                if not open_at[room]:
                    tree.mark(room, False)
            each = room // length   # a sequence stays the tightest until it is too full
            full = min(n, left // each)
            some = min(left - full * each, each) if full < n else 0
            runs.append((length, rank, first, each, seq_len - room))
            put(room - each * length, first, full)
            if some:
                put(room - some * length, first + full, 1)
            put(room, first + full + bool(some), n - full - bool(some))
            rank += full * each + some
            left -= full * each + some
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 5), made


def _placed(runs: np.ndarray):
    order = (runs[:, 0] << 48) + runs[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            run = runs[np.searchsorted(order, (length << 48) + rank, side="right") - 1]
            nth = rank - run[:, 1]
            out = b.select([n for n in b.schema.names if n != "rank"])
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(run[:, 2] + nth // run[:, 3]), pa.array(run[:, 4] + nth % run[:, 3] * length)],
                [*out.schema.names, "sequence_id", "offset"])
    return place


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seq_len: int = 2048,
         tokenizer: str | None = None, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Per piece: ``{id_col}, piece, start, length, ids_crc32[, ids], sequence_id, offset``.

    ``tokenizer``: path of a tokenizers file, readable on every executor (default:
    the installed public ``word_bpe_49k.json``).  A document is its text's ids and
    ``end_id``; only longer ones than ``seq_len`` are cut.  ``ids_crc32`` is the
    CRC-32 of the piece's ids as little-endian 32-bit words.  Offsets in a
    sequence are gapless from 0.

    Null and empty texts are the one id ``end_id``.  Repeated rows, repeated or
    null ids are packed row by row; equal pieces may swap places.  Other columns
    are ignored, whatever their names.  An empty table gives no rows.
    """
    pieces = stored(cut_pieces(docs, id_col, text_col, seq_len, tokenizer, end_id, with_ids), "pieces")
    n_salts = min(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), MAX_SALTS)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "piece"), F.lit(n_salts)))
    groups = stored(salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "piece-groups")
    histogram = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = plan_best_fit(histogram, seq_len)
    before = groups.select("length", "salt", (F.sum("n").over(
        Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
        .alias("before"))
    own = Window.partitionBy("length", "salt").orderBy("id", "piece", "start", "ids_crc32")
    ranked = (salted.withColumn("nth", F.row_number().over(own) - 1).join(before, ["length", "salt"])
              .select(*pieces.columns, (F.col("nth") + F.col("before")).alias("rank")))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    placed = ranked.mapInArrow(_placed(runs), f"{fields}, sequence_id long, offset long")
    return placed.withColumnRenamed("id", id_col)
