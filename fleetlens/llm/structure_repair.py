r"""Repair of a conversation's structure: the cheapest edits that make its roles `(system? (user assistant)+)?`.

A row is blank (no character but ASCII white space), a duplicate (role and text were seen before) or truncated (its last
character but white space is none of `.!?`); the first that holds counts.  Edits of a row: Keep (0), Rerole to user or
assistant (2), Delete (3, the only one for blank and duplicate rows); an empty user or assistant row can be Inserted anywhere
(2).  A truncated row that isn't deleted adds 1.

The lattice of a conversation of n rows has the nodes (rows read, state), with four states: nothing yet, after system, after
user, after assistant.  A bidirectional Dijkstra search runs on it: a forward heap from (0, nothing) and a reverse heap from
(n, nothing) and (n, after assistant).  It goes on until the two least open costs add up to more than the best meeting, so
that all crossings of equal cost are settled on one side at least.  From these, the least concatenated audit (the initials of
the edits) is read off: as an audit's letters fix its cost, no optimal audit is the beginning of another, and a letter leads
from a node to one node only, so the least letter that stays on an optimal path is right at each step.

Spark works in two passes.  The first one shuffles a digest, an initial and flags of each row, sorted by conversation, and
searches.  The second one shuffles the rows themselves, sorted likewise, each conversation led by what the search found; the
repaired rows leave as a stream.  So a conversation passes through one task, as its audit and hash are one sequence, but no
task holds its texts; the search keeps some integers per row.

Rows are ordered by turn (nulls first), then by the MD5 of role and text.  A null role or text is one space.  A null conv_id is
a conversation of its own.  Repeated rows are duplicates.  A conversation without rows has zeros and an empty audit.  Other
columns don't matter.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from math import inf

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.llm.common import Memo, ship

# Characters that are white space, marks that end a text, costs of the edits.
WHITE = " \t\n\x0b\f\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

#: States: nothing yet, after system, after user, after assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a kept row, by state and the role's initial.
_AFTER = {(EMPTY, "s"): SYSTEM, **{(q, "u"): USER for q in (EMPTY, SYSTEM, ASSISTANT)}, (USER, "a"): ASSISTANT}
#: The state after the only role out of user and assistant that may follow.
_NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: Conversations of up to so many rows share results with others of the same signs.
_SHARED_ROWS = 64


def row_edits(sign: str) -> list[tuple[int, str, int, int]]:
    """(state, letter, cost, next state) for a row: `-` must go, else its initial (x: no role), a capital if truncated."""
    edits = [(q, "D", DELETE, q) for q in range(4)]
    if sign != "-":
        more = TRUNCATED if sign.isupper() else 0
        edits += [(q, "K", KEEP + more, _AFTER[q, sign.lower()]) for q in range(4) if (q, sign.lower()) in _AFTER]
        edits += [(q, "R", REROLE + more, _NEXT[q]) for q in range(4)]
    return edits


_EDITS = {sign: row_edits(sign) for sign in "-suaxSUAX"}
#: By sign and state: (letter, cost, next state), least letter first; and (letter, cost, state before).
_ONWARD = {sign: [sorted(e[1:] for e in edits if e[0] == q) for q in range(4)] for sign, edits in _EDITS.items()}
_BACKWARD = {sign: [[(e[1], e[2], e[0]) for e in edits if e[3] == q] for q in range(4)] for sign, edits in _EDITS.items()}
_INSERTED = [[q for q in range(4) if _NEXT[q] == after] for after in range(4)]


def cheapest(signs: str) -> tuple[int, str]:
    """The least cost for rows of these signs, and the ASCII-least audit at that cost.  A node is 4 * rows read + state."""
    n = len(signs)

    def onward(node: int) -> Iterator[tuple[str, int, int]]:
        i, q = node >> 2, node & 3
        if i < n:
            for letter, cost, after in _ONWARD[signs[i]][q]:
                yield letter, cost, node - q + 4 + after
        yield "I", INSERT, node - q + _NEXT[q]

    def backward(node: int) -> Iterator[tuple[str, int, int]]:
        i, q = node >> 2, node & 3
        if i:
            for letter, cost, before in _BACKWARD[signs[i - 1]][q]:
                yield letter, cost, node - q - 4 + before
        for before in _INSERTED[q]:
            yield "I", INSERT, node - q + before

    goals = (4 * n + EMPTY, 4 * n + ASSISTANT)
    sides = [({EMPTY: 0}, {}, [(0, EMPTY)], onward), (dict.fromkeys(goals, 0), {}, [(0, goal) for goal in goals], backward)]
    best = 0 if n == 0 else None
    while sides[0][2] and sides[1][2] and (best is None or sides[0][2][0][0] + sides[1][2][0][0] <= best):
        side = 0 if sides[0][2][0][0] <= sides[1][2][0][0] else 1
        known, settled, heap, neighbours = sides[side]
        cost, node = heapq.heappop(heap)
        if node in settled:
            continue
        settled[node] = cost
        met = sides[1 - side][0].get(node)
        if met is not None and (best is None or cost + met < best):
            best = cost + met
        for _, more, other in neighbours(node):
            if other not in settled and known.get(other, cost + more + 1) > cost + more:
                known[other] = cost + more
                heapq.heappush(heap, (cost + more, other))
    return best, _least_audit(best, sides[0][1], sides[1][1], onward, backward, goals)


def _least_audit(best: int, reached: dict, left: dict, onward, backward, goals: tuple) -> str:
    """The least audit, from the costs settled by the forward side (`reached`) and by the reverse side (`left`).

    A node of an optimal path is settled on one side at least: its two costs add up to `best`, the open ones to more.
    """
    left = left | dict.fromkeys(goals, 0)
    # Settled forward nodes from which an optimal path crosses to the reverse side, or ends.
    crossing = [
        node for node, cost in reached.items()
        if left.get(node, inf) + cost == best or any(left.get(to, inf) + more + cost == best for _, more, to in onward(node))
    ]
    optimal = set(crossing)
    while crossing:
        node = crossing.pop()
        for _, more, before in backward(node):
            if before not in optimal and reached.get(before, inf) + more == reached[node]:
                optimal.add(before)
                crossing.append(before)
    node, cost, audit = EMPTY, 0, []
    while not (cost == best and node in goals):
        for letter, more, to in sorted(onward(node)):
            if (to in optimal and reached[to] == cost + more) or left.get(to, inf) + more + cost == best:
                node, cost = to, cost + more
                audit.append(letter)
                break
        else:
            raise AssertionError(f"no optimal edit after {''.join(audit)}")
    return "".join(audit)


def roles_of(audit: str) -> list[str | None]:
    """The role of every repaired row; None for the system row at the front, which is always a kept one."""
    n = len(audit) - audit.count("D")
    return [None] * (n % 2) + ["user", "assistant"] * (n // 2)


def damaged(turns: DataFrame) -> DataFrame:
    """`turns` (conv_id, turn, role, text) damaged by the CRC-32 of conv_id:turn modulo 20.

    0 drops a row, 1 empties its text, 2 takes out its .!?, 3 repeats it, 4 makes its role user.  A null is one space.
    """
    blank = F.lit(" ")
    name = F.concat(F.coalesce(turns["conv_id"].cast("string"), blank), F.lit(":"), F.coalesce(turns["turn"].cast("string"), blank))
    kind = F.crc32(name.cast("binary")) % 20
    role, text = F.coalesce(turns["role"], blank), F.coalesce(turns["text"], blank)
    rows = turns.select(
        turns["conv_id"].alias("conv_id"),
        turns["turn"].alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return rows.select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy")


def _digest(role: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def _sorted(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "leads", "turn", "digest")


def _searched(rows: DataFrame, ids: DataFrame | None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) per conversation of `rows`, or of `ids` too."""
    stripped = F.rtrim("text", F.lit(WHITE))
    light = rows.select(
        "conv_id", F.lit(1).alias("leads"), F.col("turn").cast("long").alias("turn"), "digest",
        F.substring("role", 1, 1).alias("initial"), (stripped == "").alias("blank"),
        (~F.right(stripped, F.lit(1)).isin(".", "!", "?")).alias("open"),
    )
    if ids is not None:
        names = ids.select("conv_id").distinct()
        empty = [F.lit(None).cast(light.schema[c].dataType).alias(c) for c in light.columns[2:]]
        light = light.union(names.select("conv_id", F.lit(0).alias("leads"), *empty))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(cheapest, 100_000)
        state, out = None, []
        for batch in batches:
            for conv_id, leads, turn, digest, initial, blank, is_open in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or state.conv_id != conv_id:
                    if state is not None:
                        out.append(state.result(memo))
                    state = _Signs(conv_id)
                if leads:
                    state.add(turn, digest, initial, blank, is_open)
            if len(out) >= 5000:
                yield _batch(out, _FOUND)
                out = []
        if state is not None:
            out.append(state.result(memo))
        yield _batch(out, _FOUND)

    return _sorted(light).mapInArrow(search, _ddl(_FOUND, light))


class _Signs:
    """What the search needs of one conversation's rows, in order."""

    def __init__(self, conv_id):
        self.conv_id, self.signs, self.seen = conv_id, [], set()
        self.first, self.last, self.turns = None, None, 0
        self.counts, self.before = [0, 0, 0, 0], None

    def add(self, turn, digest: bytes, initial: str, blank: bool, is_open: bool) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        fault = 0 if blank else 1 if digest in self.seen else 2 if is_open else None
        self.seen.add(digest)
        if fault is not None:
            self.counts[fault] += 1
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.counts[3] += 1
        self.before = initial
        sign = initial if initial and initial in "sua" else "x"
        self.signs.append("-" if fault in (0, 1) else sign.upper() if fault == 2 else sign)

    def result(self, memo: Memo) -> tuple:
        signs = "".join(self.signs)
        cost, audit = memo[signs] if len(signs) <= _SHARED_ROWS else cheapest(signs)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (self.conv_id, gaps, *self.counts, cost, audit)


_FOUND = [
    ("conv_id", None), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
]
_ROWS = [("conv_id", None), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())]
_NAMES = {pa.int64(): "long", pa.string(): "string"}


def _ddl(fields: list, rows: DataFrame) -> str:
    kind = rows.schema["conv_id"].dataType.simpleString()
    return ", ".join(f"{name} {_NAMES.get(of, kind)}" for name, of in fields)


def _batch(rows: list[tuple], fields: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in fields]
    ids = pa.array(columns[0], None if any(x is not None for x in columns[0]) else pa.int64())
    return pa.RecordBatch.from_arrays([ids, *[pa.array(c, of) for c, (_, of) in zip(columns[1:], fields[1:])]], [f[0] for f in fields])


def _led(turns: DataFrame, ids: DataFrame | None) -> DataFrame:
    """The rows in order, each conversation led by a row with what was found about it."""
    ship(turns.sparkSession)
    blank = F.lit(" ")
    rows = turns.select(
        turns["conv_id"].alias("conv_id"), turns["turn"].alias("turn"), F.coalesce(turns["role"], blank).alias("role"),
        F.coalesce(turns["text"], blank).alias("text"),
    )
    rows = rows.withColumn("digest", _digest(F.col("role"), F.col("text")))
    found = _searched(rows, ids)
    numbers = [name for name, of in _FOUND if of == pa.int64()]
    heads = found.select(
        "conv_id", F.lit(0).alias("leads"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"),
        F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"), F.array(*numbers).alias("numbers"),
    )
    body = rows.select(
        "conv_id", F.lit(1).alias("leads"), F.col("turn").cast("long").alias("turn"), "digest", "role", "text",
        F.lit(None).cast("array<long>").alias("numbers"),
    )
    return _sorted(heads.union(body)).select("conv_id", "leads", "role", "text", "numbers")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Per conversation (head, repaired rows as an iterator of (role, text)); the rows must be used up before the next one."""
    lines = (line for batch in batches for line in zip(*(c.to_pylist() for c in batch.columns)))

    def rows_of(audit: str) -> Iterator[tuple[str, str]]:
        roles = iter(roles_of(audit))
        for letter in audit:
            if letter == "I":
                yield next(roles), ""
                continue
            _, _, role, text, _ = next(lines)
            if letter != "D":
                given = next(roles)
                yield (role if letter == "K" else given), text

    for conv_id, _, _, audit, numbers in lines:
        yield (conv_id, *numbers, audit), rows_of(audit)


def repair(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """(conv_id, place, role, text): the repaired rows of `turns` (conv_id, turn, role, text), places from 0."""
    led = _led(turns, ids)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for head, rows in _edited(batches):
            for place, (role, text) in enumerate(rows):
                out.append((head[0], place, role, text))
                held += 100 + len(text)
                if held >= 4_000_000:
                    yield _batch(out, _ROWS)
                    out, held = [], 0
        yield _batch(out, _ROWS)

    return led.mapInArrow(write, _ddl(_ROWS, led))


def report(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Per conversation of `turns`, or of `ids` (conv_id) too: faults, cost, audit and the hash of the repaired rows."""
    led = _led(turns, ids)
    fields = [*_FOUND, ("repaired_sha256", pa.string())]

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for head, rows in _edited(batches):
            digest, between = hashlib.sha256(), b""
            for role, text in rows:
                digest.update(between + f"{role}:".encode())
                digest.update(text.encode())
                between = b"\n"
            out.append((*head, digest.hexdigest()))
            if len(out) >= 5000:
                yield _batch(out, fields)
                out = []
        yield _batch(out, fields)

    return led.mapInArrow(digested, _ddl(fields, led))
