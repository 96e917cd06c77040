"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations.

A vector is rotated by three rounds of random signs and a fast Hadamard
transform; its hash is the nearest signed axis.  ``hashes`` such axes together
are a bucket, there are ``tables`` independent ones, and a vector also visits
the buckets that come closest to its own (multiprobe): the ones where one axis
is replaced by its second or third best.  Two vectors meet where one of them is
at home and the other at home or visiting, and every meeting is verified by
cosine in double precision.

Vectors do not travel to their buckets: some 250 signs of rotated coordinates, the
*sketch*, do.  A pair whose sketches differ in more bits than a linked pair's could
(five standard deviations above its mean) is no candidate, and only members with a
candidate partner in a bucket are sent there as vectors.

Equal vectors are one class before hashing.  A bucket is cut into blocks of
about ``BLOCK`` members by hash, and blocks are compared two by two, so that no
task holds more than two blocks however large a bucket is; crowded ones by matrix
products.  Linked pairs are not emitted: a block pair sends each member's number of links, with every pair
counted only at the first meeting of the two, and a spanning star of links for
the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailstream.llm.common import stored
from retailstream.llm.graph import components

BLOCK = 1024        # members of a bucket compared at a time, with as many others
PAIRS = 1 << 18     # pairs verified at a time
CROWD = 64          # rows of a group from which on matrix products compare it
ROUNDING = 1e-9     # of a cosine by matrix product
SKETCH = 256        # signs that go to the buckets ahead of the vectors, at most
WORDS = [f"s{i}" for i in range(SKETCH // 64)]
NARROW = 32         # rotations of fewer coordinates have too few directions for a sketch
BROADCAST = 500_000   # crowded buckets (three numbers each) up to which their list is broadcast


@dataclass(frozen=True)
class Hashing:
    tables: int = 10
    hashes: int = 2     # axes of one table's bucket; more for more vectors
    probes: int = 2     # other buckets visited in each table
    seed: int = 5


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, whose length is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2)
        h *= 2
    return x.reshape(n, d)


def bucket_codes(vectors: np.ndarray, s: Hashing) -> np.ndarray:
    """(n, tables, 1 + probes): each vector's own bucket first, then those it visits."""
    return codes_and_sketch(vectors, s)[0]


def most_bits(dim: int, least: float, s: Hashing) -> int:
    """Differing sketch bits up to which a pair is a candidate: a rotation's coordinate has another
    sign in two vectors with the probability of their angle over pi."""
    width = max(1 << (dim - 1).bit_length(), 4)
    if width < NARROW:
        return SKETCH
    n = _bits_each(width, s) * s.tables * s.hashes
    p = np.arccos(min(max(least, -1.0), 1.0)) / np.pi
    return min(int(np.ceil(n * p + 5 * np.sqrt(n * p * (1 - p)))) + 1, SKETCH)


def _bits_each(width: int, s: Hashing) -> int:
    """Signs that each rotation gives to the sketch."""
    return min(width, SKETCH // (s.tables * s.hashes))


def codes_and_sketch(vectors: np.ndarray, s: Hashing) -> tuple[np.ndarray, np.ndarray]:
    """``bucket_codes``, and (n, ``SKETCH`` / 64) longs of the signs of some rotated coordinates."""
    n, dim = vectors.shape
    width = max(1 << (dim - 1).bit_length(), 4)
    signs = np.random.default_rng([s.seed, width]).choice([-1.0, 1.0], (s.tables, s.hashes, 3, width))
    padded = np.zeros((n, width))
    padded[:, :dim] = vectors
    codes = np.empty((n, s.tables, 1 + s.probes), np.int64)
    signs_of = np.zeros((n, SKETCH), bool)
    bits = _bits_each(width, s)
    # a probe changes one axis to its second or third best
    changes = [(j, rank) for rank in (1, 2) for j in range(s.hashes)]
    for t in range(s.tables):
        axes = np.empty((n, s.hashes, 3), np.int64)
        loss = np.empty((n, len(changes)))
        for j in range(s.hashes):
            y = padded
            for r in range(3):
                y = hadamard(y * signs[t, j, r])
            at = (t * s.hashes + j) * bits
            signs_of[:, at:at + bits] = y[:, :bits] > 0
            size = np.abs(y)
            best = np.argsort(-size, axis=1, kind="stable")[:, :3]
            axes[:, j] = 2 * best + (np.take_along_axis(y, best, 1) > 0)
            top = np.take_along_axis(size, best, 1)
            for c, (changed, rank) in enumerate(changes):
                if changed == j:
                    loss[:, c] = top[:, 0] - top[:, rank]
        place = (2 * width) ** np.arange(s.hashes)
        own = axes[:, :, 0] @ place
        codes[:, t, 0] = own
        for p, c in enumerate(np.argsort(loss, axis=1, kind="stable")[:, :s.probes].T):
            changed, rank = np.array(changes)[c].T
            rows = np.arange(n)
            codes[:, t, 1 + p] = own + (axes[rows, changed, rank] - axes[rows, changed, 0]) * place[changed]
    # of long rows of axes; buckets that fall together are verified as one
    return codes % (2 ** 31 - 1), np.packbits(signs_of, axis=1).view(np.int64)


def _hashed(s: Hashing):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column("dim").to_numpy()
            vec = b.column("vec")
            codes = np.empty((len(dims), s.tables, 1 + s.probes), np.int64)
            sketch = np.empty((len(dims), len(WORDS)), np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                rows = vec.take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim).astype(np.float64)
                codes[at], sketch[at] = codes_and_sketch(rows / np.linalg.norm(rows, axis=1, keepdims=True), s)
            flat = pa.array(codes.reshape(-1).astype(np.int32))
            step = s.tables * (1 + s.probes)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(dims) + 1, dtype=np.int32) * step), flat)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, lists, *[pa.array(w.copy()) for w in sketch.T]], [*b.schema.names, "codes", *WORDS])
    return of


def _first_meeting(codes: np.ndarray, i: np.ndarray, j: np.ndarray, table: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Whether the pairs (i, j), found in (table, bucket), meet there first.

    They meet in a table's bucket where one is at home and the other at home or
    visiting; of several such buckets the least one is first.  A pair is looked at
    until it has met, or its own table is reached: in a crowd, after the first table.
    """
    first = np.zeros(len(i), bool)
    waiting = np.arange(len(i))
    never = np.int64(np.iinfo(np.int64).max)   # of a type: a plain number would take the type of 4-byte codes, and wrap
    for t in range(codes.shape[1]):
        a, b = codes[i[waiting], t], codes[j[waiting], t]
        at_a = np.where((b == a[:, :1]).any(1), a[:, 0], never)
        at_b = np.where((a == b[:, :1]).any(1), b[:, 0], never)
        where = np.minimum(at_a, at_b)
        met = where != never
        first[waiting] = met & (table[waiting] == t) & (bucket[waiting] == where)
        waiting = waiting[~met & (table[waiting] > t)]
        if not len(waiting):
            break
    return first


def _link(g: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, counts: np.ndarray, label: np.ndarray) -> None:
    """Linked pairs (i, j): those that meet here first add to ``counts`` and pull the labels together."""
    own = _first_meeting(g["codes"], i, j, g["table"][i], g["bucket"][i])
    i, j = i[own], j[own]
    if not len(i):
        return
    # sums of whole numbers, exact in doubles
    counts += (np.bincount(i, g["weight"][j], len(counts)) + np.bincount(j, g["weight"][i], len(counts))).astype(np.int64)
    while True:   # the larger root of each pair goes to the smaller one, until no pair has two
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != label[label]).any():
            label[:] = label[label]


def _near(g: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
    """Whether the cosine of the pairs (i, j) is at least ``least``."""
    return np.einsum("ij,ij->i", g["vec"][i], g["vec"][j]) / (g["norm"][i] * g["norm"][j]) >= least


def _near_in_crowd(g: dict[str, np.ndarray], lo: int, hi: int, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs of one large group of rows, by matrix products of its two blocks (or one
    with itself); cosines within rounding of ``least`` are computed again as for any pair."""
    rows = np.arange(lo, hi)
    same = g["left"][lo] == g["right"][lo]
    left, right = (rows, rows) if same else (rows[g["block"][lo:hi] == g["left"][lo]], rows[g["block"][lo:hi] == g["right"][lo]])
    if not len(left) or not len(right):
        return
    unit = (g["vec"][right] / g["norm"][right, None]).T
    step = max(PAIRS // len(right), 1)
    for at in range(0, len(left), step):
        some = left[at:at + step]
        cos = (g["vec"][some] / g["norm"][some, None]) @ unit
        ok = (cos >= least - ROUNDING) & (g["home"][some, None] | g["home"][right])
        if same:
            ok &= some[:, None] < right
        x, y = np.nonzero(ok)
        i, j = some[x], right[y]
        open_ = np.flatnonzero(cos[x, y] < least + ROUNDING)
        if len(open_):
            sure = np.ones(len(i), bool)
            sure[open_] = _near(g, i[open_], j[open_], least)
            i, j = i[sure], j[sure]
        yield i, j


def _pairs_of(groups: list[tuple[int, int]], g: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j to compare within small groups of rows, some groups at a time."""
    held_i, held_j, held = [], [], 0
    for lo, hi in groups:
        i = np.repeat(np.arange(lo, hi), hi - lo)
        j = np.tile(np.arange(lo, hi), hi - lo)
        # one of the two at home, and from the two blocks that this group compares
        ok = (i < j) & (g["home"][i] | g["home"][j]) & (
            (g["left"][i] == g["right"][i]) | (g["block"][i] != g["block"][j]))
        held_i.append(i[ok])
        held_j.append(j[ok])
        held += int(ok.sum())
        if held >= PAIRS:
            yield np.concatenate(held_i), np.concatenate(held_j)
            held_i, held_j, held = [], [], 0
    if held:
        yield np.concatenate(held_i), np.concatenate(held_j)


GROUP = ["dim", "table", "bucket", "left", "right"]


def _by_groups(work):
    """``work`` on tables of whole groups, of rows that come sorted by group in batches."""
    def ready(table: pa.Table) -> int:
        """Rows before the last group, which may go on in the next batch."""
        same = np.ones(table.num_rows, bool)
        for c in table.select(GROUP).columns:
            same &= c.to_numpy() == c[-1].as_py()
        return int(np.flatnonzero(~same)[-1]) + 1 if (~same).any() else 0

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            table = pa.Table.from_batches(held)
            n = ready(table)
            if n:
                yield from work(table.slice(0, n))
                held = table.slice(n).combine_chunks().to_batches()
        if held:
            yield from work(pa.Table.from_batches(held))
    return of


def _spans(g: dict[str, np.ndarray]) -> list[tuple[int, int]]:
    """First and last row of each group."""
    change = np.zeros(len(g["table"]), bool)
    for c in GROUP[1:]:
        change[1:] |= g[c][1:] != g[c][:-1]
    bounds = np.concatenate([[0], np.flatnonzero(change), [len(change)]])
    return list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))


def _apart(g: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Differing sketch bits of rows."""
    return sum(np.bitwise_count(g[w][i] ^ g[w][j]).astype(np.int16) for w in WORDS)


def _candidates(least: float, s: Hashing):
    """The rows that have a partner in their group by the sketches."""
    def crowd(g: dict[str, np.ndarray], lo: int, hi: int, most: int, found: np.ndarray) -> None:
        rows = np.arange(lo, hi)
        same = g["left"][lo] == g["right"][lo]
        left = rows if same else rows[g["block"][lo:hi] == g["left"][lo]]
        right = rows if same else rows[g["block"][lo:hi] == g["right"][lo]]
        if not len(left) or not len(right):
            return
        step = max(PAIRS // len(right), 1)
        for at in range(0, len(left), step):
            some = left[at:at + step]
            near = _apart(g, some[:, None], right) <= most
            near &= (g["home"][some, None] | g["home"][right]) & (some[:, None] != right)
            found[some] |= near.any(1)
            found[right] |= near.any(0)

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        dims = table.column("dim").to_numpy()
        for dim in np.unique(dims):
            t = table.filter(pa.array(dims == dim)).combine_chunks()
            g = {c: t.column(c).to_numpy() for c in ("table", "bucket", "block", "left", "right")}
            g |= {c: t.column(c).to_numpy().view(np.uint64) for c in WORDS}
            g["home"] = t.column("home").to_numpy(zero_copy_only=False).astype(bool)
            most, found, spans = most_bits(int(dim), least, s), np.zeros(t.num_rows, bool), _spans(g)
            for i, j in _pairs_of([x for x in spans if 1 < x[1] - x[0] < CROWD], g):
                near = _apart(g, i, j) <= most
                found[i[near]] = True
                found[j[near]] = True
            for lo, hi in (x for x in spans if x[1] - x[0] >= CROWD):
                crowd(g, lo, hi, most, found)
            yield from t.filter(pa.array(found)).drop_columns(WORDS).to_batches()
    return _by_groups(work)


def _verified(least: float, s: Hashing):
    shape = (s.tables, 1 + s.probes)

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        dims = table.column("dim").to_numpy()
        for dim in np.unique(dims):
            t = table.filter(pa.array(dims == dim)).combine_chunks()
            g = {c: t.column(c).to_numpy() for c in ("cid", "weight", "table", "bucket", "block", "left", "right")}
            g["home"] = t.column("home").to_numpy(zero_copy_only=False).astype(bool)
            g["vec"] = _flat(t.column("vec")).reshape(-1, dim).astype(np.float64)
            g["norm"] = np.linalg.norm(g["vec"], axis=1)
            g["codes"] = _flat(t.column("codes")).reshape(-1, *shape)
            counts, label = np.zeros(t.num_rows, np.int64), np.arange(t.num_rows)
            spans = _spans(g)
            for i, j in _pairs_of([x for x in spans if x[1] - x[0] < CROWD], g):
                near = _near(g, i, j, least)
                _link(g, i[near], j[near], counts, label)
            for lo, hi in (x for x in spans if x[1] - x[0] >= CROWD):
                for i, j in _near_in_crowd(g, lo, hi, least):
                    _link(g, i, j, counts, label)
            linked = np.flatnonzero((counts > 0) | (label != np.arange(len(label))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(g["cid"][linked]), pa.array(g["cid"][label[linked]]), pa.array(counts[linked])],
                ["u", "v", "n"])

    return _by_groups(work)


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy() for c in column.chunks]) if column.num_chunks else np.zeros(0)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", least: float = 0.9,
                    hashing: Hashing = Hashing()) -> DataFrame:
    """Per row of ``vectors``: ``{id_col}, n_links, component_id, kept``.

    Pairs found with cosine of at least ``least`` are linked, none below it.
    ``n_links``: other rows linked directly; ``component_id``: least id reachable,
    itself included; ``kept``: the row's id is its component's.

    Null and zero vectors, and those with null or non-finite components, link with
    nothing, not even each other; vectors of different lengths do not link.  Rows
    with the same id are rows of their own; rows with a null id link and count, and
    a component without any id has a null one and keeps nothing.  Other columns are
    ignored, whatever their names.  An empty table gives no rows.
    """
    kind = vectors.schema[vec_col].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    base = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast(kind).alias("vec"))
    fine = F.coalesce(F.forall("vec", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
                      & F.exists("vec", lambda x: x != 0), F.lit(False))
    # a nan is larger than anything, so it is not below infinity
    valid = base.where(fine)
    classes = stored(valid.groupBy("vec").agg(F.count(F.lit(1)).alias("weight"), F.min("id").alias("least"))
                     .select(F.monotonically_increasing_id().alias("cid"), F.size("vec").cast("long").alias("dim"),
                             "vec", "weight", "least"), "vector-classes")
    fields = f"cid long, dim long, vec {kind}, weight long"
    hashed = stored(classes.select("cid", "dim", "vec", "weight").mapInArrow(
        _hashed(hashing), f"{fields}, codes array<int>, " + ", ".join(f"{w} long" for w in WORDS)), "vector-codes")
    width = 1 + hashing.probes
    places = hashed.select("cid", "dim", *WORDS, F.posexplode("codes").alias("at", "bucket")).select(
        "cid", "dim", F.expr(f"at div {width}").alias("table"), F.col("bucket").cast("long").alias("bucket"),
        (F.col("at") % width == 0).alias("home"), *WORDS)
    # only buckets of more than a block are cut; their list is short, a thirtieth of the vectors at most
    key = GROUP[:3]
    crowded = stored(places.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
                     .select(*key, F.ceil(F.col("n") / BLOCK).alias("n_blocks")), "vector-crowds")
    if crowded.count() <= BROADCAST:
        crowded = F.broadcast(crowded)
    n_blocks = F.coalesce("n_blocks", F.lit(1).cast("long"))
    placed = places.join(crowded, key, "left").withColumn("n_blocks", n_blocks).withColumn(
        "block", F.pmod(F.xxhash64("cid"), F.col("n_blocks")))
    others = F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)
    paired = placed.withColumn("other", F.explode(others)).select(
        "cid", *key, "home", "block", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
        *WORDS)
    members = (paired.repartition(*GROUP).sortWithinPartitions(*GROUP)
               .mapInArrow(_candidates(least, hashing), paired.drop(*WORDS).schema))
    members = stored(members, "vector-candidates")
    found = (members.join(hashed.select("cid", "vec", "weight", "codes"), "cid")
             .repartition(*GROUP).sortWithinPartitions(*GROUP)
             .mapInArrow(_verified(least, hashing), "u long, v long, n long"))
    found = stored(found, "vector-links")
    reached = components(found.select("u", "v"))
    counts = found.groupBy("u").agg(F.sum("n").alias("n"))
    linked = stored(classes.join(reached.withColumnRenamed("node", "cid"), "cid", "left")
                    .join(counts.withColumnRenamed("u", "cid"), "cid", "left")
                    .select("vec", "weight", "least", F.coalesce("component", "cid").alias("component"),
                            F.coalesce("n", F.lit(0)).alias("n")), "vector-components")
    named = linked.join(linked.groupBy("component").agg(F.min("least").alias("component_id")), "component").select(
        F.xxhash64("vec").alias("h"), F.col("vec").alias("v"), (F.col("n") + F.col("weight") - 1).alias("n_links"),
        "component_id")
    named = stored(named, "vector-names")
    keyed = valid.withColumn("h", F.xxhash64("vec"))
    joined = (keyed.join(named.withColumnRenamed("h", "vh"),
                         (F.col("h") == F.col("vh")) & (F.col("vec") == F.col("v")))
              .select("id", "n_links", "component_id"))
    alone = base.where(~fine).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return joined.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
