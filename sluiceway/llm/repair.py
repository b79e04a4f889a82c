"""Conversations brought back to turns that alternate, by the cheapest edits.

Edits of a conversation are paths through a lattice: a node is (rows read, what was said last); an edge keeps, reroles or deletes
the next row or inserts a turn. The cheapest path is found by Dijkstra's method from both ends: a forward
and a reverse heap are worked off until their heads together exceed the best crossing, so that every
path of equal cost crosses between settled nodes; the crossing with the least concatenated audit counts.
At one node audits of equal cost are never prefixes of each other (the longer would hold inserts the
other lacks, at a higher cost), so the least audit to and from each node is all that is needed.

No task needs a whole conversation's rows: rows are numbered by a range sort and cut into stretches of
`STRETCH` rows, each searched from every state it may be entered in to every state it may be left in, in parallel.
A fold over the stretches picks the path, without texts, and leads back to each stretch's edits.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.components import stored
from sluiceway.llm.spelling import crc32_sql
from sluiceway.operators.joins import measured_join
from sluiceway.operators.running import in_order

# White space of the contract, ends of a sentence, pairs of neighbours, costs.
WHITE = " \t\n\x0b\x0c\r"
PAIRS = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

STRETCH_BITS = 8        # 256 rows
#: States: nothing said, the system, the user, the assistant spoke last.
START, SYSTEM, USER, ASSISTANT = range(4)
_SAID = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
_NAMES = {"u": "user", "a": "assistant"}
#: Who speaks next if the turn is rerolled or inserted.
_NEXT = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
#: From any state the rest costs at most this much more than from any other.
SPREAD = 15

#: A row as the search sees it: (initial, must go, keeping it costs).
_CODES = {c: ("suao"[i // 2], False, TRUNCATED * (i % 2)) for i, c in enumerate("sSuUaAoO")} | {"x": ("o", True, 0)}


def _steps(code: str, state: int) -> Iterator[tuple[int, int, str]]:
    """(state, cost, letter) of the edits that read this row."""
    initial, gone, extra = _CODES[code]
    yield state, DELETE, "D"
    if gone:
        return
    for said, after in _SAID[state].items():
        if said == initial:
            yield after, extra, "K"
        elif said == _NEXT[state]:
            yield after, REROLE + extra, "R"


def _inserts(state: int) -> Iterator[tuple[int, int, str]]:
    yield _SAID[state][_NEXT[state]], INSERT, "I"


@lru_cache(maxsize=4096)
def _edges(code: str | None) -> tuple[tuple, tuple]:
    """Edges of one row (or the inserts, for None) from each state, and into each."""
    out = [tuple(_inserts(s) if code is None else _steps(code, s)) for s in range(4)]
    into = [tuple((s, cost, letter) for s in range(4) for t, cost, letter in out[s] if t == state) for state in range(4)]
    return tuple(out), tuple(into)


def search(codes: str, enter: int, leave: int) -> tuple[int, str] | None:
    """(cost, least audit) of the cheapest edits of these rows between two states, None if there are none."""
    last = len(codes)
    sides = ({}, {})            # settled: node -> (cost, audit)
    heaps = ([(0, 0, "", enter)], [(0, 0, "", leave)])
    best = float("inf")

    def onward(side: int, row: int, state: int):
        """(node, cost, letter) one edge further from this end."""
        for to, cost, letter in _edges(None)[side][state]:
            yield (row, to), cost, letter
        if side == 0 and row < last:
            for to, cost, letter in _edges(codes[row])[0][state]:
                yield (row + 1, to), cost, letter
        elif side == 1 and row:
            for to, cost, letter in _edges(codes[row - 1])[1][state]:
                yield (row - 1, to), cost, letter

    def settle(side: int) -> None:
        nonlocal best
        # Of equal costs fewer rows read come first: edges without cost read a row, so labels are complete.
        cost, read, audit, state = heapq.heappop(heaps[side])
        node = (last - read if side else read, state)
        if node in sides[side]:
            return
        sides[side][node] = cost, audit
        other = sides[1 - side]
        if node in other:
            best = min(best, cost + other[node][0])
        for (row, to), more, letter in onward(side, *node):
            if (row, to) in other:
                best = min(best, cost + more + other[row, to][0])
            if (row, to) not in sides[side]:
                heapq.heappush(heaps[side], (
                    cost + more, last - row if side else row, letter + audit if side else audit + letter, to))

    settle(0)
    settle(1)
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        settle(0 if heaps[0][0] <= heaps[1][0] else 1)
    if best == float("inf"):
        return None
    forward, reverse = sides
    audits = [audit + reverse[node][1] for node, (cost, audit) in forward.items()
              if node in reverse and cost + reverse[node][0] == best]
    for node, (cost, audit) in forward.items():
        audits += [audit + letter + reverse[to][1] for to, more, letter in onward(0, *node)
                   if to in reverse and cost + more + reverse[to][0] == best]
    return int(best), min(audits)


@lru_cache(maxsize=20_000)
def _stretch(codes: str) -> list[tuple[int, int, int, str]]:
    """(enter, leave, cost, audit) for all pairs of states with a path."""
    found = ((e, x, search(codes, e, x)) for e in range(4) for x in range(4))
    return [(e, x, *way) for e, x, way in found if way]


def initial_of(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else "o"


_STRETCHES = "conv_id BIGINT, stretch BIGINT, enter INT, leave INT, cost BIGINT, audit STRING, initials STRING, illegal BIGINT"
_PICKED = "conv_id BIGINT, stretch BIGINT, enter INT, audit STRING, cost BIGINT, illegal BIGINT"
_REPAIRED = "conv_id BIGINT, row BIGINT, place INT, role STRING, text STRING"


def _batches(rows: Iterable[tuple], ddl: str, size: int = 5000, weight: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches of bounded number and text."""
    kinds = {"BIGINT": pa.int64(), "INT": pa.int32(), "STRING": pa.string()}
    schema = pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])
    held, heavy = [], 0

    def out():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        heavy += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= size or heavy >= weight:
            yield out()
            held, heavy = [], 0
    if held:
        yield out()


def _rows(batches, *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(n).to_pylist() for n in names], strict=True)


def _search_stretches(batches):
    def rows():
        for (conv, stretch), group in groupby(_rows(batches, "conv_id", "stretch", "code", "initial"), key=lambda r: r[:2]):
            held = list(group)      # at most 2 ** STRETCH_BITS
            codes, initials = "".join(r[2] for r in held), "".join(r[3] for r in held)
            illegal = sum(a + b not in PAIRS for a, b in zip(initials, initials[1:]))
            for enter, leave, cost, audit in _stretch(codes):
                yield conv, stretch, enter, leave, cost, audit, initials[0] + initials[-1], illegal

    return _batches(rows(), _STRETCHES)


class _Way(NamedTuple):
    cost: int
    tail: tuple     # (stretch, enter, audit) not yet common to all ways

    def text(self) -> str:
        return "".join(t[2] for t in self.tail)


def _fold(batches):
    """The cheapest way through each conversation's stretches: an edit string per stretch, and a summary row."""
    def conversation(conv, rows):
        ways = {START: _Way(0, ())}
        done, illegal, said = [], 0, ""
        for stretch, group in groupby(rows, key=lambda r: r[1]):
            after: dict[int, list[_Way]] = {}
            initials, inside = "", 0
            for _, _, enter, leave, cost, audit, initials, inside in group:
                if enter in ways:
                    way = ways[enter]
                    after.setdefault(leave, []).append(_Way(way.cost + cost, (*way.tail, (stretch, enter, audit))))
            illegal += inside + (bool(said) and said + initials[0] not in PAIRS)
            said = initials[1]
            ways = {}
            for leave, many in after.items():
                least = min(w.cost for w in many)
                many = [w for w in many if w.cost == least]
                ways[leave] = many[0] if len(many) == 1 else min(many, key=_Way.text)
            least = min(w.cost for w in ways.values())
            ways = {s: w for s, w in ways.items() if w.cost <= least + SPREAD}
            # What all ways share is decided.
            shared = 0
            tails = [w.tail for w in ways.values()]
            while all(len(t) > shared and t[shared] == tails[0][shared] for t in tails):
                shared += 1
            done += tails[0][:shared]
            ways = {s: _Way(w.cost, w.tail[shared:]) for s, w in ways.items()}
        end = min((ways[s] for s in (START, ASSISTANT) if s in ways), key=lambda w: (w.cost, w.text()))
        done += end.tail
        for stretch, enter, audit in done:
            yield conv, stretch, enter, audit, None, None
        yield conv, None, None, "".join(d[2] for d in done), end.cost, illegal

    def rows():
        names = ("conv_id", "stretch", "enter", "leave", "cost", "audit", "initials", "illegal")
        for conv, group in groupby(_rows(batches, *names), key=lambda r: r[0]):
            yield from conversation(conv, group)

    return _batches(rows(), _PICKED)


def _apply(batches):
    """Rows behind their stretch's edits -> repaired rows.

    An inserted turn has the number of the row before it and a `place` over 0, at the start of a stretch
    the number of its first row and a place below 0; rows have place 0.
    """
    def rows():
        conv, edits, state, at, place = None, [], START, 0, 0

        def inserted() -> Iterator[tuple]:
            """Turns inserted before the next edit that reads a row."""
            nonlocal state, place
            while edits and edits[-1] == "I":
                letter = _NEXT[state]
                edits.pop()
                state, place = _SAID[state][letter], place + 1
                yield conv, at, place, _NAMES[letter], ""

        for key, wide, row, enter, audit, role, text in _rows(batches, "conv_id", "wide", "row", "enter", "audit", "role", "text"):
            yield from inserted()
            if not wide:
                # At most two inserts follow each other in a cheapest path.
                conv, edits, state, at, place = key, list(reversed(audit)), enter, row, -9
                continue
            edit = edits.pop()
            at, place = row, 0
            if edit != "D":
                letter = initial_of(role) if edit == "K" else _NEXT[state]
                state = _SAID[state][letter]
                yield conv, row, 0, role if edit == "K" else _NAMES[letter], text
        yield from inserted()

    return _batches(rows(), _REPAIRED)


class Repair(NamedTuple):
    rows: DataFrame         # conv_id, row, place, role, text: the repaired conversations, in order of (row, place)
    summary: DataFrame      # conv_id, cost, audit, illegal
    faults: DataFrame       # conv_id, row, turn, fault: of each row read


def repair_conversations(turns: DataFrame) -> Repair:
    """Repair `turns(conv_id, turn, role, text)`, a table of long conv_id and turn.

    Nulls of role and text count as one space, a null conv_id is a conversation of its own, null turns come first.
    Rows of one turn go by role, then text. The first fault of a row counts: blank (white space alone), duplicate
    (role and text seen earlier in the conversation), truncated (ends in none of `.!?`). Roles count by their
    initial. Conversations without rows don't occur in the result; other columns are ignored; texts and conversations may be of any length.
    """
    spark = turns.sparkSession
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))
    ordered = in_order(rows, ["conv_id", "turn", F.substring("role", 1, 32), F.substring("text", 1, 32)], ("role", "text"))

    tail = F.rtrim(F.col("text"), F.lit(WHITE))
    seen_key = F.unhex(F.sha2(F.to_json(F.struct("conv_id", "role", "text")), 256))
    initial = F.substring("role", 1, 1)
    read = stored(spark, ordered.select(
        "conv_id", "row", "turn", F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        (tail == "").alias("blank"), (~F.substring(tail, -1, 1).isin(".", "!", "?")).alias("cut"), seen_key.alias("seen")))
    repeated = read.groupBy("seen").agg(F.count("*").alias("times"), F.min("row").alias("first")).filter("times > 1").drop("times")
    fault = F.when(F.col("blank"), "blank").when(F.col("first") < F.col("row"), "duplicate").when(F.col("cut"), "truncated")
    faults = stored(spark, measured_join(read, repeated, ["seen"], "left", ["row"]).select("conv_id", "row", "turn", "initial", fault.alias("fault")))

    code = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper("initial")).otherwise(F.col("initial"))
    stretch = F.shiftright("row", STRETCH_BITS)
    coded = faults.select("conv_id", stretch.alias("stretch"), "row", code.alias("code"), "initial")
    searched = coded.repartition("conv_id", "stretch").sortWithinPartitions("conv_id", "stretch", "row").mapInArrow(_search_stretches, _STRETCHES)
    picked = stored(spark, searched.repartition("conv_id").sortWithinPartitions("conv_id", "stretch").mapInArrow(_fold, _PICKED))
    edits = picked.filter("stretch IS NOT NULL").select(
        "conv_id", "stretch", F.lit(0).alias("wide"), F.shiftleft("stretch", STRETCH_BITS).alias("row"), "enter", "audit")
    both = ordered.select("conv_id", stretch.alias("stretch"), F.lit(1).alias("wide"), "row", "role", "text").unionByName(edits, allowMissingColumns=True)
    repaired = both.repartition("conv_id", "stretch").sortWithinPartitions("conv_id", "stretch", "wide", "row").mapInArrow(_apply, _REPAIRED)
    return Repair(repaired, picked.filter("stretch IS NULL").select("conv_id", "cost", "audit", "illegal"), faults.drop("initial"))


def _digest(batches):
    def rows():
        for conv, group in groupby(_rows(batches, "conv_id", "role", "text"), key=lambda r: r[0]):
            told = hashlib.sha256()
            for k, (_, role, text) in enumerate(group):
                told.update(("\n" * bool(k) + f"{role}:{text}").encode())
            yield conv, told.hexdigest()

    return _batches(rows(), "conv_id BIGINT, sha256 STRING")


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, sha256) of each conversation's lines `role:text`, joined by newlines.

    SHA-256 reads its input in order, so one task reads a conversation, as a stream that it doesn't hold.
    """
    return repaired.repartition("conv_id").sortWithinPartitions("conv_id", "row", "place").mapInArrow(_digest, "conv_id BIGINT, sha256 STRING")


def damaged(turns: DataFrame) -> DataFrame:
    """Known faults in whole conversations, by the checksum of `conv_id:turn` modulo 20.

    0 drops a row, 1 empties its text, 2 removes `.!?`, 3 repeats it, 4 makes it the user's; nulls are one space.
    """
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def repair_table(turns: DataFrame) -> DataFrame:
    """Damage the conversations, repair them, and tell what was found and done, one row per conv_id."""
    repair = repair_conversations(damaged(turns))
    count = lambda what: F.sum((F.col("fault") == what).cast("long")).alias(what)
    found = repair.faults.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"), count("blank"), count("duplicate"), count("truncated"))
    parts = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    for more in (found, repair.summary, repaired_digests(repair.rows)):
        parts = parts.unionByName(more, allowMissingColumns=True)
    number = lambda name: F.coalesce(F.max(name), F.lit(0)).cast("long").alias(name)
    return parts.groupBy("conv_id").agg(
        *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


def _more(label: str, cost: str | int, letter: str) -> str:
    """SQL: a label (nine digits of cost, then the audit) one edit further."""
    return f"(lpad(CAST(CAST(left({label}, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0') || substr({label}, 10) || '{letter}')"


def _step_sql() -> str:
    """SQL: labels of the four states after one more row and the inserts behind it."""
    names = "nsua"
    into = {t: [(s, said) for s in range(4) for said, to in _SAID[s].items() if to == t] for t in range(4)}
    columns = []
    for t in range(4):
        ways = [_more(f"w.{names[t]}", DELETE, "D")]
        for s, said in into[t]:
            ways.append(f"CASE WHEN kept AND initial = '{said}' THEN {_more(f'w.{names[s]}', 'extra', 'K')} END")
            if said in _NAMES:
                ways.append(f"CASE WHEN kept THEN {_more(f'w.{names[s]}', f'extra + {REROLE}', 'R')} END")
        columns.append(f"least({', '.join(ways)}) AS {names[t]}")
    return ", ".join(columns)


_FAR = "'900000000'"
_USER_IN = f"least(u, {_more('n', INSERT, 'I')}, {_more('s', INSERT, 'I')}, {_more('a', INSERT, 'I')})"

REPAIR_SQL = rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
kinds AS (SELECT *, {crc32_sql("list_transform(string_split(k, ''), lambda c: unicode(c)::BIGINT)")} % 20 AS kind FROM keyed),
turns AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds WHERE kind <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS initial
  FROM turns),
faulted AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM numbered),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulted GROUP BY conv_id),
rows AS (
  SELECT conv_id, i, initial, fault NOT IN ('blank', 'duplicate') AS kept, CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END AS extra
  FROM faulted),
walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '000000000' AS n, {_FAR} AS s, lpad('{INSERT}', 9, '0') || 'I' AS u, lpad('{2 * INSERT}', 9, '0') || 'II' AS a
  FROM counted
  UNION ALL
  SELECT conv_id, i, n, s, u, least(a, {_more('u', INSERT, 'I')}) AS a FROM (
    SELECT conv_id, i, n, s, {_USER_IN} AS u, a FROM (
      SELECT w.conv_id, r.i, {_step_sql()}
      FROM walk w JOIN rows r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1))),
ends AS (
  SELECT w.conv_id, least(w.n, w.a) AS label FROM walk w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i),
letters AS (
  SELECT conv_id, label, unnest(range(10, length(label) + 1)) AS p FROM ends),
edits AS (
  SELECT conv_id, p, substr(label, p, 1) AS edit, length(regexp_replace(substr(label, 10, p - 9), 'I', '', 'g')) AS i,
    length(regexp_replace(substr(label, 10, p - 9), 'D', '', 'g')) AS said
  FROM letters),
told AS (
  SELECT e.*, f.role, f.text,
    coalesce(max(CASE WHEN said = 1 AND edit = 'K' AND f.initial = 's' THEN 1 END) OVER (PARTITION BY e.conv_id), 0) AS shift
  FROM edits e LEFT JOIN faulted f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i AND e.edit <> 'I' WHERE edit <> 'D'),
hashed AS (
  SELECT conv_id, sha256(string_agg(
    CASE WHEN edit = 'K' THEN role WHEN (said - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END,
    chr(10) ORDER BY p)) AS sha FROM told GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  CAST(coalesce(CAST(left(label, 9) AS INTEGER), 0) AS BIGINT) AS cost, coalesce(substr(label, 10), '') AS audit,
  coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN hashed h ON h.conv_id IS NOT DISTINCT FROM o.conv_id"""
