"""Roles in raw transcripts: a hidden Markov model over lines, then turns in one form.

States are the roles, each as the first line of a turn or a later one. A line's features are the
speaker marker it begins with, whether a blank line is in front of it, whether it ends like a question, and its length.
Viterbi's best path is computed exactly though a conversation may lie in many tasks: each stretch of
lines first gives a matrix of its best scores from any state to any other, the matrices of a
conversation are folded in order, which fixes the states at the stretches' ends, and each stretch is then
decoded between them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.components import stored

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)     # 2r: first line of a turn of role r; 2r + 1: a later line
# Names that transcripts give the speakers: fixed values.
ALIASES = {
    "system": ("system", "sys", "instruction", "instructions"),
    "user": ("user", "human", "you", "question", "q", "customer", "usuario", "utilisateur", "benutzer"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "agent", "model", "asistente", "gpt"),
}
_SPEAKER = {name: role for role, names in ALIASES.items() for name in names}
_MARKER = re.compile(
    r"^\s*(?:#{1,6}\s*(?P<h>\w+)\s*:?\s*$|\*\*(?P<s>\w+):?\*\*:?\s*|\[(?P<b>\w+)\]:?\s*|<\|?(?P<t>\w+)\|?>\s*|(?P<c>\w+)\s*[:>]\s+|(?P<e>\w+)\s*:\s*$)")
MARKERS = ("none", *ROLES, "other")
#: Values of the features: marker, blank line before, question, length.
SHAPE = (len(MARKERS), 2, 2, 4)


def marker(line: str) -> tuple[str, int]:
    """The speaker that a line's marker names, none or other, and where its text begins."""
    found = _MARKER.match(line)
    if not found:
        return "none", 0
    name = next(g for g in found.groupdict().values() if g is not None).lower()
    role = _SPEAKER.get(name)
    return (role, found.end()) if role else ("other", 0)


def features(line: str, blank: bool) -> tuple[int, int, int, int]:
    text = line.rstrip()
    size = len(text)
    return (MARKERS.index(marker(line)[0]), int(blank), int(text.endswith("?")),
            0 if size < 20 else 1 if size < 80 else 2 if size < 300 else 3)


class Model:
    """Log chances of first states, of transitions and of each feature's values in each state."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: list[np.ndarray]):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def from_counts(cls, start: dict, move: dict, emit: dict) -> Model:
        def logs(shape: tuple[int, ...], counts: dict, prior: float) -> np.ndarray:
            table = np.full(shape, prior)
            for key, n in counts.items():
                table[key] += n
            return np.log(table / table.sum(axis=-1, keepdims=True))

        allowed = np.zeros((STATES, STATES), dtype=bool)
        for s in range(STATES):
            allowed[s, 0::2] = True             # any role may begin a turn
            allowed[s, s | 1] = True            # or the turn goes on
        moves = np.where(allowed, logs((STATES, STATES), move, 0.5), -np.inf)
        first = np.where(np.arange(STATES) % 2 == 0, logs((STATES,), start, 0.5), -np.inf)
        return cls(first, moves, [logs((STATES, n), emit.get(k, {}), 0.5) for k, n in enumerate(SHAPE)])

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Log chance of each line's features in each state."""
        return sum(self.emit[k][:, rows[:, k]].T for k in range(len(SHAPE)))

    def matrix(self, emitted: np.ndarray) -> np.ndarray:
        """Best score of a stretch for each state before it and at its end."""
        best = np.where(np.eye(STATES, dtype=bool), 0.0, -np.inf)
        for line in emitted:
            best = (best[:, :, None] + self.move[None]).max(axis=1) + line
        return best

    def decode(self, emitted: np.ndarray, before: int, end: int) -> list[int]:
        """Best states of a stretch that ends in `end`, after state `before` (-1: it begins a conversation)."""
        score = (self.start if before < 0 else self.move[before]) + emitted[0]
        back = []
        for line in emitted[1:]:
            total = score[:, None] + self.move
            back.append(total.argmax(axis=0))
            score = total.max(axis=0) + line
        path = [end]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        return path[::-1]


def learn(turns: DataFrame) -> Model:
    """Counts over all lines of `turns(conv_id, turn, role, text)`, whose texts may begin with markers.

    Aggregates only reach the driver: a few rows per state and feature value, and two per task, for what goes on over the
    border of tasks. The model depends on the rows alone, not on how they are partitioned.
    """
    lines = number_lines(turns.filter(F.col("role").isin(*ROLES)), "conv_id", "turn", "text", "role")
    counted = stored(turns.sparkSession, lines.mapInArrow(_count, _COUNTS))
    counts: dict[tuple, int] = {}
    for r in counted.filter("part < 0").groupBy("kind", "k", "a", "b").agg(F.sum("n").alias("n")).collect():
        counts[r["kind"], r["k"], r["a"], r["b"]] = r["n"]
    _across(counts, counted.filter("part >= 0").collect())
    start, move, emit = {}, {}, {}
    for (kind, k, a, b), n in counts.items():
        if kind == "start":
            start[b] = n
        elif kind == "move":
            move[a, b] = n
        else:
            emit.setdefault(k, {})[a, b] = n
    return Model.from_counts(start, move, emit)


def number_lines(turns: DataFrame, conv: str, turn: str, text: str, role: str | None = None) -> DataFrame:
    """(conv, turn, line, blank, first, opens, role, text) of every line, in the order of conversation and turn.

    Rows are sorted over all partitions, so a long conversation may lie in several; lines without
    text are left out and noted as `blank` on the next. `first` is the first line of a row, `opens` that of a conversation's
    smallest turn.
    """
    rows = turns.select(F.col(conv).cast("string").alias("conv"), F.col(turn).cast("long").alias("turn"),
                        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
                        (F.col(role) if role else F.lit(None)).cast("string").alias("role"))
    rows = rows.select("conv", "turn", "role", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    key = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first()]
    rows = rows.withColumn("h", F.xxhash64("role", "text"))
    return rows.repartitionByRange(*key, F.col("line")).sortWithinPartitions(*key, "line", "h") \
        .select("conv", "turn", "line", "role", "text")


_COUNTS = "kind STRING, k INT, a INT, b INT, n BIGINT, part INT, conv STRING"


def _count(batches):
    """What a task's lines count (part -1), and its borders.

    The task's first conversation gives a row `first` with its first line's state (a; -1 if all are blank) and whether it has a blank
    line in front (b); its last conversation a row `last` with its last line's state (a; -1) and whether a blank line ends it (b). The first
    line counts neither as start nor by its blank feature: the tasks before decide.
    """
    from collections import Counter

    from pyspark import TaskContext

    context = TaskContext.get()
    part = context.partitionId() if context else 0
    counts: Counter = Counter()
    first: tuple | None = None      # conversation, state, blank in front
    conv, state, blank, begun = None, -1, False, False
    for batch in batches:
        for c, line, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv", "line", "role", "text")), strict=True):
            if not begun or c != conv:
                if begun and first is None:
                    first = (conv, -1, blank)
                conv, state, blank, begun = c, -1, False, True
            if not text.strip():
                blank = True
                continue
            now = 2 * ROLES.index(role) + (0 if line == 0 else 1)
            opens = first is None
            if opens:
                first = (c, now, blank)
            elif state < 0:
                counts["start", 0, 0, now - now % 2] += 1
            else:
                counts["move", 0, state, now] += 1
            for k, value in enumerate(features(text, blank)):
                if k != 1 or not opens:
                    counts["emit", k, now, value] += 1
            state, blank = now, False
    if begun:
        first = first or (conv, -1, blank)
        rows = [(*key, n, -1, None) for key, n in counts.items()]
        rows += [("first", 0, first[1], int(first[2]), 0, part, first[0]), ("last", 0, state, int(blank), 0, part, conv)]
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                                         ["kind", "k", "a", "b", "n", "part", "conv"])


def _across(counts: dict[tuple, int], borders: list) -> None:
    """Add what the first lines of tasks count, given the tasks before."""
    def add(*key: str | int) -> None:
        counts[key] = counts.get(key, 0) + 1

    parts: dict[int, dict] = {}
    for r in borders:
        parts.setdefault(r["part"], {})[r["kind"]] = r
    conv, state, blank, begun = None, -1, False, False      # where the tasks before end
    for part in sorted(parts):
        first, last = parts[part]["first"], parts[part]["last"]
        if not begun or first["conv"] != conv:
            state, blank = -1, False
        blank = blank or bool(first["b"])
        if first["a"] >= 0:
            if state < 0:
                add("start", 0, 0, first["a"] - first["a"] % 2)
            else:
                add("move", 0, state, first["a"])
            add("emit", 1, first["a"], int(blank))
        if first["a"] >= 0 or last["conv"] != first["conv"]:
            state, blank = last["a"], bool(last["b"])
        conv, begun = last["conv"], True


_LINES = "conv STRING, turn BIGINT, line BIGINT, text STRING, stretch BIGINT, place INT, marks ARRAY<INT>"
_STRETCH = 4096


def _stretches(batches):
    """Lines with the stretch they belong to: neighbours of one conversation in one task.

    A task's first row, of place -2, has its first conversation; its last, of place -1, its last
    conversation and whether that ends there in a blank line.
    """
    from pyspark import TaskContext

    context = TaskContext.get()
    stretch, place, conv, blank = (context.partitionId() << 33 if context else 0), 0, object(), False
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int32()))

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)],
            ["conv", "turn", "line", "text", "stretch", "place", "marks"])

    begun = False
    for batch in batches:
        out: list[tuple] = []
        for c, turn, line, text in zip(*(batch.column(n).to_pylist() for n in ("conv", "turn", "line", "text")), strict=True):
            if not begun:
                out.append((c, None, None, None, stretch, -2, None))
                begun = True
            if c != conv or place >= _STRETCH:
                blank = blank and c == conv
                conv, place, stretch = c, 0, stretch + 1
            if not text.strip():
                blank = True
                continue
            out.append((c, turn, line, text, stretch, place, list(features(text, blank))))
            place, blank = place + 1, False
        yield batch_of(out)
    if begun:
        yield batch_of([(conv, None, None, None, stretch, -1, [int(blank)])])


def _blank_between(lines: DataFrame) -> DataFrame:
    """The lines of `_stretches`; a blank line that ends a task counts for the conversation's first line in the next.

    Two rows a task reach the driver.
    """
    ends = sorted(lines.filter("place < 0").select("stretch", "place", "conv", F.col("marks")[0].alias("blank")).collect(),
                  key=lambda r: (r["stretch"] >> 33, r["place"]))
    after, last = [], None
    for r in ends:
        if r["place"] == -1:
            last = r
        elif last is not None and last["blank"] and last["conv"] == r["conv"]:
            after.append((r["stretch"] >> 33 << 33) + 1)
    marked = F.transform("marks", lambda x, k: F.when(k == 1, F.lit(1)).otherwise(x))
    return lines.filter("place >= 0").withColumn(
        "marks", F.when((F.col("place") == 0) & F.col("stretch").isin(after), marked).otherwise(F.col("marks")))


def _emitted(table: pa.Table, model: Model) -> np.ndarray:
    return model.scores(np.array(table.column("marks").to_pylist(), dtype=np.int64).reshape(-1, len(SHAPE)))


def _matrices(table: pa.Table, model: Model) -> pa.Table:
    table = table.sort_by("place")
    emitted = _emitted(table, model)
    first = (model.start + emitted[0])[None, :]     # as if the stretch began the conversation
    rest = model.matrix(emitted[1:])
    opening = (first[:, :, None] + rest[None]).max(axis=1).ravel()
    return pa.table({"conv": table.column("conv").slice(0, 1), "stretch": table.column("stretch").slice(0, 1),
                     "opening": pa.array([opening.tolist()], pa.list_(pa.float64())),
                     "through": pa.array([model.matrix(emitted).ravel().tolist()], pa.list_(pa.float64()))})


def _fold(table: pa.Table) -> pa.Table:
    """The states in front of and at the end of each stretch of a conversation."""
    table = table.sort_by("stretch")
    opening, through = table.column("opening").to_pylist(), table.column("through").to_pylist()
    score, back = np.array(opening[0]), []
    for values in through[1:]:
        total = score[:, None] + np.array(values).reshape(STATES, STATES)
        back.append(total.argmax(axis=0))
        score = total.max(axis=0)
    ends = [int(score.argmax())]
    for step in reversed(back):
        ends.append(int(step[ends[-1]]))
    ends.reverse()
    return pa.table({"stretch": table.column("stretch"), "before": pa.array([-1, *ends[:-1]], pa.int32()),
                     "end": pa.array(ends, pa.int32())})


def _decode(lines: pa.Table, states: pa.Table, model: Model) -> pa.Table:
    lines = lines.sort_by("place")
    path = model.decode(_emitted(lines, model), states.column("before")[0].as_py(), states.column("end")[0].as_py()) \
        if lines.num_rows else []
    return pa.table({"conv": lines.column("conv"), "turn": lines.column("turn"), "line": lines.column("line"),
                     "text": lines.column("text"), "stretch": lines.column("stretch"), "place": lines.column("place"),
                     "role": pa.array([ROLES[s // 2] for s in path], pa.string()),
                     "begins": pa.array([s % 2 == 0 for s in path], pa.bool_()),
                     "begun": pa.array(np.cumsum([s % 2 == 0 for s in path], dtype=np.int64), pa.int64())})


def parse_transcripts(transcripts: DataFrame, model: Model) -> DataFrame:
    """(conv, turn, line, text, stretch, place, role, begins, begun) of every line with text of `transcripts(conv_id, turn, text)`.

    Rows of a conversation go by turn, null first, rows of one turn by line. `role` is that of the
    best path, `begins` says that a turn begins here, `begun` how many have in the stretch so far; stretch and place give the order. Conversations
    without id are one; texts without words give no lines; other columns, a role among them, are not read.
    """
    spark = transcripts.sparkSession
    lines = number_lines(transcripts, "conv_id", "turn", "text").mapInArrow(_stretches, _LINES)
    lines = _blank_between(stored(spark, lines))

    def matrices_of(table):
        return _matrices(table, model)

    def decoded(left, right):
        return _decode(left, right, model)

    matrices = lines.groupBy("stretch").applyInArrow(
        matrices_of, "conv STRING, stretch BIGINT, opening ARRAY<DOUBLE>, through ARRAY<DOUBLE>")
    states = matrices.groupBy("conv").applyInArrow(_fold, "stretch BIGINT, before INT, end INT")
    return lines.groupBy("stretch").cogroup(states.groupBy("stretch")).applyInArrow(
        decoded, "conv STRING, turn BIGINT, line BIGINT, text STRING, stretch BIGINT, place INT, role STRING, begins BOOLEAN, "
                 "begun BIGINT")


def _strip(batches):
    for batch in batches:
        text = [t[marker(t)[1]:].strip() for t in batch.column("text").to_pylist()]
        yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(text, pa.string()))


def render_turns(parsed: DataFrame) -> DataFrame:
    """(conv, turn, role, text, rendered): each turn that was found in the canonical form.

    A turn goes from a line that begins one to the next such line of the conversation, whatever rows
    the lines came in; turns are numbered from 0. Markers are removed, the lines joined by
    line ends, and the turn put as <|role|>, its text and <|end|> on lines of their own.
    """
    lines = stored(parsed.sparkSession, parsed.mapInArrow(_strip, parsed.schema))
    counts = lines.groupBy("conv", "stretch").agg(F.max("begun").alias("n"))
    before = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("stretch", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = lines.join(counts, "stretch").withColumn("turn", F.col("before") + F.col("begun") - 1)
    line = F.struct("stretch", "place", "role", "text")
    turns = numbered.groupBy("conv", "turn").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    turns = turns.select("conv", "turn", F.col("lines")[0]["role"].alias("role"),
                         F.array_join(F.filter(F.transform("lines", lambda x: x["text"]), lambda t: t != ""), "\n").alias("text"))
    return turns.withColumn("rendered", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>")))


def held_out(conv: Column) -> Column:
    """Whether a conversation is kept out of learning: crc32 of its id as text is odd. One without id isn't."""
    return F.coalesce(F.crc32(conv.cast("string").cast("binary")) % 2 == 1, F.lit(False))


def raw_transcripts(turns: DataFrame) -> DataFrame:
    """Conversations as they are found: roles only as speaker markers, in one of several styles.

    A conversation's style depends on its id; in some the markers of some turns are missing. A blank
    line parts the turns.
    """
    def named(*names):
        return F.when(F.col("role") == "system", names[0]).when(F.col("role") == "user", names[1]).otherwise(names[2])

    style = F.pmod(F.xxhash64("conv_id", F.lit(1)), F.lit(6))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marked = F.when(style == 0, F.concat(named("System", "User", "Assistant"), F.lit(": "), text)) \
        .when(style == 1, F.concat(named("System", "Human", "AI"), F.lit(": "), text)) \
        .when(style == 2, F.concat(F.lit("### "), named("Instruction", "User", "Assistant"), F.lit("\n"), text)) \
        .when(style == 3, F.concat(F.lit("**"), named("System", "Q", "A"), F.lit("**: "), text)) \
        .when(style == 4, F.concat(F.lit("["), named("sys", "customer", "agent"), F.lit("] "), text)) \
        .otherwise(F.concat(F.lit("<|"), named("system", "user", "assistant"), F.lit("|>\n"), text))
    bare = F.pmod(F.xxhash64("conv_id", "turn", F.lit(2)), F.lit(10)) == 0
    return turns.select("conv_id", "turn", "role", F.concat(F.when(bare, text).otherwise(marked), F.lit("\n")).alias("text"))
