"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

The states are a role that begins a turn and a role that goes on with one.  A
line is observed as its speaker marker (``User:``, ``### Assistant``, ``Q:``,
``<system>``, ...), whether a blank line comes before it, its length and whether
it asks.  Transition and feature probabilities are counted from transcripts
whose roles are known, on top of small prior counts; the roles of a new transcript are
its most likely path (Viterbi).  A marker is cut off only where the path begins a
turn of the marker's role; blank lines inside a turn stay.  Turns are numbered by
the beginnings before them, their lines joined over rows and blocks, and each turn
is rendered as ``<|im_start|>role\\n...<|im_end|>``.

Long transcripts are not one group.  The rows are range-sorted and cut in blocks of
so many rows, wherever their positions lie; a block is summed up by a matrix of best path scores from the state before it to
its last one, and these matrices combine by max-plus products.  Scanning them in
steps of ``FAN`` blocks (and those in steps again) tells each block how well each
state before it can be reached and how well each state after it can go on, with
which the block alone finds its part of the best path.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retailstream.llm.common import bound_batches, stored

ROLES = ("system", "user", "assistant")
STATES = tuple((r, begins) for r in range(len(ROLES)) for begins in (True, False))
# fixed values: names that speaker markers use for each role
NAMES = {"system": ("system", "instruction", "instructions", "context"),
         "user": ("user", "human", "q", "question", "customer", "prompter", "me"),
         "assistant": ("assistant", "ai", "bot", "a", "answer", "agent", "model", "gpt")}
ROLE_OF = {name: role for role, names in NAMES.items() for name in names}
# an opening sign and a name, closed by the sign, or a bare name and a colon
MARKER = re.compile(r"\s*(?:(#{1,6}\s*|\*\*|\[|<\|?)\s*(\w+)\s*(?:\*\*\s*:?|:?\s*\*\*|\]\s*:?|\|?>\s*:?|:|$)|(\w+)\s*:)"
                    r"[ \t]*")
BLOCK = 64    # transcript rows in a block, or less where they have so many characters
BLOCK_CHARS = 1 << 20
FAN = 256     # blocks summed up at a time
N_FEATURES = 4 * 2 * 4 * 2


def marker_of(line: str) -> tuple[str | None, str]:
    """(role the line's speaker marker names, the line without it)."""
    found = MARKER.match(line)
    if found:
        role = ROLE_OF.get((found[2] or found[3]).lower())
        if role:
            return role, line[found.end():]
    return None, line


def feature_of(role: str | None, blank_before: bool, line: str) -> int:
    """Number of the line's observation."""
    size = (len(line) >= 40) + (len(line) >= 120) + (len(line) >= 300)
    mark = 0 if role is None else 1 + ROLES.index(role)
    return ((mark * 2 + blank_before) * 4 + size) * 2 + line.rstrip().endswith("?")


def parse_lines(text: str, blank: bool = False) -> list[tuple[int | None, str]]:
    """(observation, whole line) of each line, None for a blank one; ``blank``: a blank line comes before.

    A line is measured without its marker, whether or not that turns out to be one."""
    out: list[tuple[int | None, str]] = []
    for line in text.split("\n"):
        if not line.strip():
            blank = True
            out.append((None, line))
            continue
        role, rest = marker_of(line)
        out.append((feature_of(role, blank, rest), line))
        blank = False
    return out


def read_lines(text: str) -> list[tuple[int, str]]:
    """(observation, whole line) of each line that is not blank."""
    return [(f, line) for f, line in parse_lines(text) if f is not None]


def _parsed(held: list[dict], blank: bool) -> list[tuple[int, int | None, str]]:
    """(pos, observation, line) of a block's rows, read as if line ends joined them."""
    out: list[tuple[int, int | None, str]] = []
    for t in held:
        lines = parse_lines(t["text"], blank)
        blank = lines[-1][0] is None
        out += [(t["pos"], f, line) for f, line in lines]
    return out


class Model:
    """Log probabilities: ``start`` (states), ``move`` (from, to), ``emit`` (state, feature)."""

    def __init__(self, moves: np.ndarray, emits: np.ndarray, starts: np.ndarray):
        self.move = np.log(_allowed(moves + 1.0))
        self.start = np.log(_normal(np.where([b for _, b in STATES], starts + 1.0, 1e-9)))
        self.emit = np.log(_normal(emits + _prior()))


def _prior() -> np.ndarray:
    """Pseudo-counts of features: what a marker says before anything is learnt."""
    mark = np.arange(N_FEATURES) // (N_FEATURES // (1 + len(ROLES)))
    prior = np.empty((len(STATES), N_FEATURES))
    for i, (role, begins) in enumerate(STATES):
        usual = (mark == 1 + role) if begins else (mark == 0)
        prior[i] = np.where(usual, 2.0, np.where(mark == 0, 0.2, 0.01))
    return prior


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(-1, keepdims=True)


def _allowed(x: np.ndarray) -> np.ndarray:
    """A turn goes on with its own role only."""
    for i, (role, _) in enumerate(STATES):
        for j, (other, begins) in enumerate(STATES):
            if not begins and other != role:
                x[i, j] = 1e-9
    return _normal(x)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of features by state, and of moves inside a row, for rows of known role."""
    index = {s: i for i, s in enumerate(STATES)}
    for b in batches:
        emits = np.zeros((len(STATES), N_FEATURES), np.int64)
        inside = np.zeros((len(STATES), len(STATES)), np.int64)
        for role, text in zip(b["role"], b["text"], strict=True):
            state = None
            for feature, _ in read_lines(text):
                now = index[ROLES.index(role), state is None]
                emits[now, feature] += 1
                if state is not None:
                    inside[state, now] += 1
                state = now
        rows = [("emit", s, f, emits[s, f]) for s, f in zip(*emits.nonzero(), strict=True)]
        rows += [("move", s, t, inside[s, t]) for s, t in zip(*inside.nonzero(), strict=True)]
        yield pd.DataFrame(rows, columns=["what", "i", "j", "n"])


def fit(rows: DataFrame) -> Model:
    """From transcript rows ``conv, pos, role, text`` of known roles, all of them.

    Rows of other roles, or null ones, teach nothing.  Moves between rows are
    counted by joining each row with the one at the next position, so no
    transcript has to be in one place.
    """
    known = rows.where(F.col("role").isin(*ROLES) & F.col("text").isNotNull())
    counts = (known.select("role", "text").mapInPandas(_counted, "what string, i int, j int, n long")
              .groupBy("what", "i", "j").agg(F.sum("n").alias("n")).collect())   # at most states x features
    emits, moves = np.zeros((len(STATES), N_FEATURES)), np.zeros((len(STATES), len(STATES)))
    for r in counts:
        (emits if r["what"] == "emit" else moves)[r["i"], r["j"]] += r["n"]
    # rows repeated at a position are counted first: their pairs are a product
    at = stored(known.groupBy("conv", "pos", "role", (F.instr("text", "\n") > 0).alias("long"))
                .agg(F.count(F.lit(1)).alias("n")), "chat-known")
    nxt = at.groupBy("conv", (F.col("pos") - 1).alias("pos"), F.col("role").alias("then")).agg(F.sum("n").alias("m"))
    follows = at.join(nxt, ["conv", "pos"]).groupBy("role", "then", "long").agg(
        F.sum(F.col("n") * F.col("m")).alias("pairs")).collect()
    index = {s: i for i, s in enumerate(STATES)}
    for r in follows:   # the row's last line is its first one, or goes on after it
        moves[index[ROLES.index(r["role"]), not r["long"]], index[ROLES.index(r["then"]), True]] += r["pairs"]
    starts = np.zeros(len(STATES))
    for r in known.where("pos = 0").groupBy("role").count().collect():
        starts[index[ROLES.index(r["role"]), True]] += r["count"]
    return Model(moves, emits, starts)


def _through(m: Model, features: np.ndarray) -> np.ndarray:
    """(states, states): best score from the state before the lines to that of the last one."""
    best = np.where(np.eye(len(STATES), dtype=bool), 0.0, -np.inf)
    for f in features:
        best = (best[:, :, None] + m.move[None]).max(1) + m.emit[:, f]
    return best


def viterbi(m: Model, features: list[int], before: np.ndarray, after: np.ndarray) -> list[int]:
    """Best path of the lines; ``before``: score of each state before the first line
    (moves included from there), ``after``: what each state of the last line is still worth."""
    back = []
    score = before
    for k, f in enumerate(features):
        reach = score[:, None] + m.move if k or before.ndim == 1 else score
        back.append(reach.argmax(0))
        score = reach.max(0) + m.emit[:, f]
    path = [int((score + after).argmax())]
    for b in back[:0:-1]:
        path.append(int(b[path[-1]]))
    return path[::-1]


def _matrix(values: list[float]) -> np.ndarray:
    return np.array(values, np.float64).reshape(len(STATES), len(STATES))


def _scan(blocks: DataFrame, most: int) -> DataFrame:
    """``conv, block, m`` (matrices) to ``conv, block, before, after``: best scores of
    the states before and after each block.  ``most``: largest block number."""
    n = len(STATES)

    def product(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        out = np.where(np.eye(n, dtype=bool), 0.0, -np.inf)
        for v in pdf["m"]:
            out = (out[:, :, None] + _matrix(v)[None]).max(1)
        return pd.DataFrame({"conv": pdf["conv"].iloc[:1].values, "block": pdf["part"].iloc[:1].values,
                             "m": [out.ravel().tolist()]})

    def ends(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        before, after = [np.array(pdf["before"].iloc[0])], [np.array(pdf["after"].iloc[0])]
        mats = [_matrix(v) for v in pdf["m"]]
        for m in mats[:-1]:
            before.append((before[-1][:, None] + m).max(0))
        for m in mats[:0:-1]:
            after.append((m + after[-1][None]).max(1))
        return pd.DataFrame({"conv": pdf["conv"].values, "block": pdf["block"].values,
                             "before": [x.tolist() for x in before], "after": [x.tolist() for x in after[::-1]]})

    kind = blocks.schema["conv"].dataType.simpleString()
    even = F.array_repeat(F.lit(0.0), n)
    counted = blocks.join(blocks.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), "conv")
    # most transcripts are one block: nothing comes before or after it
    alone = counted.where("n = 1").select("conv", "block", even.alias("before"), even.alias("after"))
    parts = counted.where("n > 1").drop("n").withColumn("part", F.expr(f"block div {FAN}"))
    if most < FAN:
        outer = parts.withColumns({"before": even, "after": even})
    else:
        whole = stored(parts.groupBy("conv", "part").applyInPandas(product, f"conv {kind}, block long, m array<double>"),
                       "chat-parts")
        known = _scan(whole, most // FAN).withColumnRenamed("block", "part")
        outer = parts.join(known, ["conv", "part"])
    return outer.groupBy("conv", "part").applyInPandas(
        ends, f"conv {kind}, block long, before array<double>, after array<double>").unionByName(alone)


def _sum_up(model: Model):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for texts, first, blank in zip(*(b.column(c).to_pylist() for c in ("texts", "block", "blank")), strict=True):
                lines = [f for _, f, _ in _parsed(texts, blank) if f is not None]
                m = _through(model, np.array(lines, np.int64))
                if first == 0 and lines:   # no state comes before: all rows hold the start
                    after = model.start + model.emit[:, lines[0]]
                    rest = _through(model, np.array(lines[1:], np.int64))
                    m = np.tile((after[:, None] + rest).max(0), (len(STATES), 1))
                out.append(np.maximum(m, -1e300).ravel().tolist())
            yield pa.RecordBatch.from_arrays(
                [b.column("conv"), b.column("block"), pa.array(out, pa.list_(pa.float64()))], ["conv", "block", "m"])
    return of


def _trimmed(lines: list[str]) -> list[str]:
    """Without the blank lines before and after."""
    solid = [i for i, line in enumerate(lines) if line.strip()]
    return lines[solid[0]:solid[-1] + 1] if solid else []


def _decoded(model: Model, by_row: bool):
    """Parts of turns: the lines of a block, or of its rows, up to the next beginning.  ``nth`` counts
    the block's beginnings; blank lines before its first other line have no role yet."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for conv, block, held, blank, before, after in zip(*(b.column(c).to_pylist() for c in (
                    "conv", "block", "texts", "blank", "before", "after")), strict=True):
                lines = _parsed(held, blank)
                seen = [f for _, f, _ in lines if f is not None]
                enter = np.array(before)
                if block == 0:
                    enter = np.tile(model.start, (len(STATES), 1))
                path = iter(viterbi(model, seen, enter, np.array(after)) if seen else [])
                nth, part = 0, None
                for pos, feature, line in lines:
                    role, begins = (None, False) if feature is None else STATES[next(path)]
                    if part is None or begins or by_row and part["pos"] != pos:
                        nth += begins
                        part = {"conv": conv, "block": block, "nth": nth, "pos": pos, "role": None,
                                "begins": begins, "lines": []}
                        out.append(part)
                    if feature is not None:
                        part["role"] = ROLES[role]
                    if begins:
                        named, rest = marker_of(line)
                        line = rest if named == ROLES[role] else line
                        if not line:   # the marker is a line by itself
                            continue
                    part["lines"].append(line)
            schema = pa.schema([("conv", b.schema.field("conv").type), ("block", pa.int64()), ("nth", pa.int64()),
                                ("pos", pa.int64()), ("role", pa.string()), ("begins", pa.bool_()),
                                ("lines", pa.list_(pa.string()))])
            yield pa.RecordBatch.from_pylist(out, schema)
    return of


def _content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The column ``parts``, lists of lines in order, as ``n_lines`` and ``content``."""
    for b in batches:
        texts = [_trimmed([line for part in parts for line in part]) for parts in b.column("parts").to_pylist()]
        names = [n for n in b.schema.names if n != "parts"]
        yield pa.RecordBatch.from_arrays(
            [*b.select(names).columns, pa.array([len(t) for t in texts], pa.int64()),
             pa.array(["\n".join(t) for t in texts], pa.string())], [*names, "n_lines", "content"])


def render(role: Column, content: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), content, F.lit("<|im_end|>"))


def _cut(rows_each: int, chars_each: int):
    """Blocks of sorted rows: ``part`` (task) and ``idx`` number them within a conversation, ``solid`` does from
    its first row on that is not blank; ``blank``, ``ends``: a blank line comes before, stands last."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, held, size = TaskContext.get().partitionId(), [], [], 0
        conv, idx, solid, blank, ends, waiting = None, 0, None, False, False, 0
        schema = None

        def close():
            nonlocal held, size, idx, solid, blank, waiting
            if solid is not None or any(t["text"].strip() for t in held):
                solid = 0 if solid is None else solid + 1
            out.append({"conv": conv, "part": task, "idx": idx, "solid": solid, "blank": blank, "ends": ends,
                        "texts": held})
            waiting += size
            held, size, idx, blank = [], 0, idx + 1, ends

        for b in batches:
            schema = schema or pa.schema([
                ("conv", b.schema.field("conv").type), ("part", pa.int64()), ("idx", pa.int64()), ("solid", pa.int64()),
                ("blank", pa.bool_()), ("ends", pa.bool_()),
                ("texts", pa.list_(pa.struct([("pos", pa.int64()), ("text", pa.string())])))])
            for c, pos, text in zip(*(b.column(n).to_pylist() for n in ("conv", "pos", "text")), strict=True):
                if held and (c != conv or len(held) == rows_each or size + len(text) > chars_each):
                    close()
                if c != conv:
                    conv, idx, solid, blank = c, 0, None, False
                held.append({"pos": pos, "text": text})
                size += len(text)
                ends = not text[text.rfind("\n") + 1:].strip()
                if len(out) >= 1000 or waiting > 4 * chars_each:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, waiting = [], 0
        if held:
            close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)
    return of


def _blocks(rows: DataFrame) -> DataFrame:
    """``conv, block, blank, texts``: each conversation's rows by position and text, cut by their number."""
    kind = rows.schema["conv"].dataType.simpleString()
    bound_batches(rows)
    # equal rows are spread too: the last key tells all rows apart
    order = ["conv", "pos", "text", "salt"]
    ordered = (rows.where("conv IS NOT NULL AND pos IS NOT NULL AND text IS NOT NULL")
               .select("conv", F.col("pos").cast("long").alias("pos"), "text", F.monotonically_increasing_id().alias("salt"))
               .repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "pos", "text"))
    cut = stored(ordered.mapInArrow(_cut(BLOCK, BLOCK_CHARS), (
        f"conv {kind}, part long, idx long, solid long, blank boolean, ends boolean, "
        "texts array<struct<pos:long,text:string>>")), "chat-blocks")
    # a conversation goes on from the tasks before: of each task that is its first one only
    before = Window.partitionBy("conv").orderBy("part")
    past = before.rowsBetween(Window.unboundedPreceding, -1)
    edges = (cut.groupBy("conv", "part").agg(F.max("idx").alias("idx"), F.max("solid").alias("solid"),
                                             F.max_by("ends", "idx").alias("ends"))
             .withColumn("seen", F.coalesce(F.max(F.col("solid").isNotNull()).over(past), F.lit(False)))
             .withColumn("n", F.coalesce(F.when(F.col("seen"), F.col("idx")).otherwise(F.col("solid")) + 1, F.lit(0)))
             .select("conv", "part", "seen", F.sum("n").over(past).alias("first"), F.lag("ends").over(before).alias("last"))
             .where("first IS NOT NULL"))
    edges = stored(edges, "chat-edges")   # a row for each task at most
    nth = F.when(F.col("seen"), F.col("idx")).otherwise(F.col("solid"))
    return (cut.join(F.broadcast(edges), ["conv", "part"], "left").select(
        "conv", (F.coalesce("first", F.lit(0)) + nth).alias("block"),
        (F.col("blank") | ((F.col("idx") == 0) & F.coalesce("last", F.lit(False)))).alias("blank"), "texts")
        .where("block IS NOT NULL"))   # blank blocks before all others


def _parts(rows: DataFrame, model: Model, by_row: bool) -> DataFrame:
    """``conv, block, nth, pos, role, begins, lines``."""
    kind = rows.schema["conv"].dataType.simpleString()
    blocks = _blocks(rows)
    mats = stored(blocks.mapInArrow(_sum_up(model), f"conv {kind}, block long, m array<double>"), "chat-matrices")
    most = mats.agg(F.max("block")).first()[0] or 0
    return blocks.join(_scan(mats, most), ["conv", "block"]).mapInArrow(_decoded(model, by_row), (
        f"conv {kind}, block long, nth long, pos long, role string, begins boolean, lines array<string>"))


def format_chats(rows: DataFrame, model: Model) -> DataFrame:
    """Transcript rows ``conv, pos, text`` to the parts of turns in each row: ``conv, pos, role, begins,
    n_lines, content``; ``format_turns`` has whole turns.

    ``pos`` orders the rows of a transcript (whole numbers, gaps allowed); a row may
    hold any number of lines, and a turn may run on over rows: then ``begins`` is false
    for the rows after its first.  ``content`` has the lines, without the marker that
    began the turn and without the blank lines before and after.

    Rows are read as if line ends joined them, so a blank row is a blank line.  Rows
    with a null ``conv``, ``pos`` or text are ignored.  Rows repeated at a position are
    read one after the other, in the order of their texts.  Other columns are
    ignored.  An empty table gives no rows.  Paths of equal score may be cut between
    two blocks.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    parts = _parts(rows, model, True).where("role IS NOT NULL").select(
        "conv", "pos", "role", "begins", F.array("lines").alias("parts"))
    return parts.mapInArrow(_content, f"conv {kind}, pos long, role string, begins boolean, n_lines long, content string")


def format_turns(rows: DataFrame, model: Model) -> DataFrame:
    """Transcript rows ``conv, pos, text`` to whole turns: ``conv, turn, pos, role, begins, n_lines, content, rendered``.

    Rows are read as ``format_chats`` does.  ``turn`` counts the turns of a conversation
    from 0, ``pos`` is the position of the turn's first row; blank lines inside a
    turn are part of its content.
    """
    kind = rows.schema["conv"].dataType.simpleString()
    parts = stored(_parts(rows, model, False), "chat-turn-parts")
    # beginnings before each block: summed by FAN blocks, then within those
    counts = parts.groupBy("conv", "block").agg(F.max("nth").alias("n")).withColumn("span", F.expr(f"block div {FAN}"))
    counts = stored(counts, "chat-turn-counts")

    def sum_before(*by: str, order: str) -> Column:
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(w), F.lit(0))

    spans = (counts.groupBy("conv", "span").agg(F.sum("n").alias("n"))
             .select("conv", "span", sum_before("conv", order="span").alias("base")).where("base > 0"))
    begun = (counts.select("conv", "block", "span", sum_before("conv", "span", order="block").alias("here"))
             .join(spans, ["conv", "span"], "left")
             .select("conv", "block", (F.col("here") + F.coalesce("base", F.lit(0))).alias("begun")).where("begun > 0"))
    numbered = parts.join(stored(begun, "chat-turns-begun"), ["conv", "block"], "left").withColumn(
        "turn", F.greatest(F.coalesce("begun", F.lit(0)) + F.col("nth") - 1, F.lit(0)))
    at = F.struct("block", "nth")
    whole = numbered.groupBy("conv", "turn").agg(
        F.min_by("pos", at).alias("pos"), F.min_by("role", F.when(F.col("role").isNotNull(), at)).alias("role"),
        F.max("begins").alias("begins"),
        F.transform(F.sort_array(F.collect_list(F.struct("block", "nth", "lines"))), lambda x: x["lines"]).alias("parts"))
    turns = whole.mapInArrow(_content, (
        f"conv {kind}, turn long, pos long, role string, begins boolean, n_lines long, content string"))
    return turns.withColumn("rendered", render(F.col("role"), F.col("content")))
