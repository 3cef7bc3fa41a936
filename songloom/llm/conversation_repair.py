"""Repair of a conversation's structure at least cost, by a run-length min-plus dynamic programme.

A repaired conversation has role initials ``(s?(ua)+)?``: an optional system turn, then users and
assistants in turn, ended by an assistant. Four states say what has been written so far. A row is one
of nine symbols: dead (blank or a duplicate, so it has to be deleted), or its role initial with or
without a truncated text. A symbol's min-plus matrix gives the least cost from state to state, the
turns that may be inserted before it included.

Equal symbols in a row form a run; a run of n is crossed by the binary powers of its matrix, which are
kept, in log n steps. From the costs still to come at the end of a run its choices are unrolled half by
half, the letters in the order delete, insert, keep, rerole, so that of all cheapest repairs the one
whose audit is least in ASCII is found.

A conversation is cut into cells of at most ``CELL_ROWS`` rows that follow each other. Each cell gives
one matrix; costs are handed backwards and states forwards over the cells of a conversation, a few
numbers each, and the cells themselves are unrolled apart from each other. So one very long
conversation is shared by many tasks. Equal rows of one turn travel as one row and a count.

The order within a conversation is turn (null first), role, text by code point. Null roles and texts
count as one space, as do a null id and turn where they are written out; rows with a null id form one
conversation. Role initials are taken as they are written; any but ``s``, ``u`` and ``a`` can't be kept.
Empty tables give none. Columns other than the four named play no part.

``repair_digests`` streams the repaired turns of a conversation through one task, since SHA-256 is serial
and the audit one string; it holds the audit, not the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from songloom.llm.common import pick, same
from songloom.plans.staging import stage

CELL_BITS = 12
CELL_ROWS = 1 << CELL_BITS  # distinct rows of a cell at most
SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
ROLES = "sua"

START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
NEXT = {START: AFTER_USER, AFTER_SYSTEM: AFTER_USER, AFTER_USER: AFTER_ASSISTANT, AFTER_ASSISTANT: AFTER_USER}
WRITTEN = {AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}
KEEP = {"s": {START: AFTER_SYSTEM}, "u": {p: q for p, q in NEXT.items() if q == AFTER_USER}, "a": {AFTER_USER: AFTER_ASSISTANT}}
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 3, 2, 2, 1
FAR = 1 << 60
DEAD = 0  # symbols: 0 dead; 1 + 2 * role + truncated, where roles are s, u, a and any other


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product of a matrix with a matrix or with a vector."""
    return np.minimum((a[:, :, None] + b[None]).min(axis=1) if b.ndim == 2 else (a + b[None]).min(axis=1), FAR)


def _insertions() -> np.ndarray:
    """Least cost from state to state by inserting turns only."""
    out = np.full((4, 4), FAR)
    np.fill_diagonal(out, 0)
    for p, q in NEXT.items():
        out[p, q] = INSERT_COST
    return _times(out, out)


INSERTIONS = _insertions()
LAST = _times(INSERTIONS, np.array([0, FAR, FAR, 0]))  # costs to come once all rows are done


def moves(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """``(letter, cost, next state)`` of what can be done with a row, without insertions."""
    found = [("D", DELETE_COST, state)]
    if symbol != DEAD:
        role, truncated = divmod(symbol - 1, 2)
        kept = KEEP[ROLES[role]].get(state) if role < len(ROLES) else None
        if kept is not None:
            found.append(("K", truncated * TRUNCATED_COST, kept))
        found.append(("R", REROLE_COST + truncated * TRUNCATED_COST, NEXT[state]))
    return found


@lru_cache(maxsize=None)
def power(symbol: int, k: int) -> np.ndarray:
    """The matrix of ``2 ** k`` rows of one symbol; nine symbols and as many powers as a length has bits."""
    if k:
        return _times(power(symbol, k - 1), power(symbol, k - 1))
    row = np.full((4, 4), FAR)
    for p in range(4):
        for _, cost, q in moves(symbol, p):
            row[p, q] = min(row[p, q], cost)
    return _times(INSERTIONS, row)


def crossed(symbol: int, length: int, to_come: np.ndarray) -> np.ndarray:
    """Costs to come before a run, from a vector or matrix of those after it."""
    for k in range(length.bit_length()):
        if length >> k & 1:
            to_come = _times(power(symbol, k), to_come)
    return to_come


def _level(to_come: np.ndarray) -> tuple[int, ...]:
    """Choices depend on differences only, so equal ones share their unrolled blocks."""
    return tuple((to_come - to_come.min()).tolist())


@lru_cache(maxsize=50_000)
def _unrolled_block(symbol: int, k: int, state: int, to_come: tuple[int, ...]) -> tuple[str, int]:
    """Letters and the state reached for ``2 ** k`` rows of one symbol, from the costs after them."""
    after = np.array(to_come)
    if k:
        letters, state = _unrolled_block(symbol, k - 1, state, _level(_times(power(symbol, k - 1), after)))
        more, state = _unrolled_block(symbol, k - 1, state, to_come)
        return letters + more, state
    before, letters = _times(power(symbol, 0), after), ""
    while True:
        choices = [(letter, q, True) for letter, cost, q in moves(symbol, state) if cost + to_come[q] == before[state]]
        if INSERT_COST + before[NEXT[state]] == before[state]:
            choices.append(("I", NEXT[state], False))
        letter, state, done = min(choices)
        letters += letter
        if done:
            return letters, state


def unrolled(runs: list[tuple[int, int]], state: int, to_come: np.ndarray) -> tuple[str, int]:
    """Letters and the state reached for runs ``(symbol, length)``, from the costs after them."""
    steps, after = [], to_come
    for symbol, length in reversed(runs):
        for k in range(length.bit_length()):
            if length >> k & 1:
                steps.append((symbol, k, _level(after)))
                after = _times(power(symbol, k), after)
    letters = []
    for symbol, k, level in reversed(steps):
        found, state = _unrolled_block(symbol, k, state, level)
        letters.append(found)
    return "".join(letters), state


def closing(state: int) -> tuple[str, int]:
    """The insertions that end a conversation."""
    letters = ""
    while state not in (START, AFTER_ASSISTANT):
        letters, state = letters + "I", NEXT[state]
    return letters, state


# --- rows on Spark


def _or_space(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """Faults for a test: what happens to a row follows from a CRC of ``conv_id:turn`` alone."""
    kind = F.crc32(F.concat(_or_space(F.col("conv_id")), F.lit(":"), _or_space(F.col("turn"))).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(kind == 3, 2).otherwise(1)))
    kept = turns.withColumns({"role": _or_space(F.col("role")), "text": _or_space(F.col("text"))}).filter(kind != 0)
    return kept.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_")).drop("_")


def turns_of(
    conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    return pick(conversations, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)


def placed_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, n, fresh, blank, truncated, place, cell)``, written.

    Equal rows are one row with their number ``n``; ``fresh`` says that no earlier turn has the same role
    and text. ``place`` follows the order of conversations and turns; a cell is a range of places.
    """
    rows = turns.select("conv_id", "turn", _or_space(F.col("role")).alias("role"), _or_space(F.col("text")).alias("text"))
    items = stage(rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("n")))
    items = items.withColumn("said", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    # Written, so that the join has a shuffle of its own on this side and a text said very often can be split.
    firsts = stage(items.groupBy("conv_id", "role", "said").agg(F.min(turn).alias("first")))
    joined = items.alias("l").join(firsts.alias("r"), same("l", "r", ["conv_id", "role", "said"]))
    ended = F.rtrim(F.col("l.text"), F.lit(SPACE))
    marked = joined.select(
        *[F.col(f"l.{c}").alias(c) for c in ("conv_id", "turn", "role", "text", "n")],
        F.col("l.turn").eqNullSafe(F.col("r.first.turn")).alias("fresh"),
        (ended == "").alias("blank"), (~F.right(ended, F.lit(1)).isin(*ENDS)).alias("truncated"),
    )
    # The bounds of the ranges are drawn from samples of these keys, so of a text its beginning is enough.
    dealt = marked.repartitionByRange("conv_id", "turn", "role", F.left("text", F.lit(64)))
    dealt = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    dealt = stage(dealt.withColumn("place", F.monotonically_increasing_id()))
    return dealt.withColumn("cell", F.shiftright("place", CELL_BITS))


def _role_class() -> Column:
    """0, 1, 2 for the initials s, u, a; 3 for any other."""
    initial = F.left("role", F.lit(1))
    return F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)


def _symbol() -> Column:
    """The symbol of a row's first copy; all others are dead."""
    own = 1 + 2 * _role_class() + F.col("truncated").cast("int")
    return F.when(F.col("blank") | ~F.col("fresh"), DEAD).otherwise(own).cast("int")


LEGAL = {(0, 1), (1, 2), (2, 1)}  # role classes that may follow each other


def _cells(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[tuple, list[tuple]]]:
    """``((conv_id, cell), rows)`` of a stream that is sorted by them; a cell is all that is held."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*[batch[c].to_pylist() for c in ("conv_id", "cell", *names)]):
            if row[:2] != key:
                if rows:
                    yield key, rows
                key, rows = row[:2], []
            rows.append(row[2:])
    if rows:
        yield key, rows


def _runs(rows: list[tuple]) -> tuple[tuple[int, int], ...]:
    """``(symbol, length)`` of a cell's rows, equal neighbours made one: a row's first copy, then its others."""
    runs: list[tuple[int, int]] = []
    for symbol, n, _ in rows:
        for found, length in ((symbol, 1), (DEAD, n - 1)):
            if length and runs and runs[-1][0] == found:
                runs[-1] = (found, runs[-1][1] + length)
            elif length:
                runs.append((found, length))
    return tuple(runs)


SHORT = 32  # runs; what is worked out for so few is kept, since most conversations are short and much alike


def _kept_if_short(work: Callable) -> Callable:
    kept = lru_cache(maxsize=20_000)(work)
    return lambda runs, *more: (kept if len(runs) <= SHORT else work)(runs, *more)


@_kept_if_short
def _matrix(runs: tuple[tuple[int, int], ...]) -> list[int]:
    matrix = np.where(np.eye(4, dtype=bool), 0, FAR)
    for symbol, length in reversed(runs):
        matrix = crossed(symbol, length, matrix)
    return matrix.ravel().tolist()


@_kept_if_short
def _ways(runs: tuple[tuple[int, int], ...], to_come: tuple[int, ...], last: bool) -> tuple[list[str], list[int]]:
    """Letters and next states for each state that a cell may be entered in."""
    ways = [unrolled(list(runs), p, np.array(to_come)) for p in range(4)]
    if last:
        ends = [closing(state) for _, state in ways]
        ways = [(audit + more, state) for (audit, _), (more, state) in zip(ways, ends)]
    return [audit for audit, _ in ways], [state for _, state in ways]


def _types(rows: DataFrame, column: str) -> tuple[str, pa.DataType]:
    """A column's type for a schema, and for Arrow."""
    kind = rows.schema[column].dataType
    return kind.simpleString(), to_arrow_type(kind)


def _batch(rows: list[tuple], kinds: tuple, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


BATCH_ROWS = 8192
CELL_FIELDS = "cell long, symbols array<long>, lengths array<long>, matrix array<long>, first_role int, last_role int, illegal long"


def _cell_rows(kind: pa.DataType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    longs = pa.list_(pa.int64())
    kinds = (kind, pa.int64(), longs, longs, longs, pa.int32(), pa.int32(), pa.int64())
    names = ["conv_id", *[part.split()[0] for part in CELL_FIELDS.split(", ")]]
    out, held = [], 0
    for (conv, cell), rows in _cells(batches, ("symbol", "n", "role_class")):
        runs = _runs(rows)
        roles = [role for _, _, role in rows]
        illegal = sum(n - 1 for _, n, _ in rows) + sum(pair not in LEGAL for pair in zip(roles, roles[1:]))
        symbols, lengths = zip(*runs)
        out.append((conv, cell, symbols, lengths, _matrix(runs), roles[0], roles[-1], illegal))
        held += len(runs)
        if held >= BATCH_ROWS:
            yield _batch(out, kinds, names)
            out, held = [], 0
    if out:
        yield _batch(out, kinds, names)


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each cell, from the last one back, the costs to come after it and before it."""
    conv, to_come, begun = None, LAST, False
    for batch in batches:
        after, before, last = [], [], []
        for this, matrix in zip(batch["conv_id"].to_pylist(), batch["matrix"].to_pylist()):
            new = not begun or this != conv
            conv, begun = this, True
            to_come = LAST if new else to_come
            after.append(to_come.tolist())
            to_come = _times(np.array(matrix).reshape(4, 4), to_come)
            before.append(int(to_come[START]))
            last.append(new)
        lists = pa.array(after, pa.list_(pa.int64()))
        yield (
            batch.drop_columns(["matrix"]).append_column("to_come", lists)
            .append_column("cost", pa.array(before, pa.int64())).append_column("last", pa.array(last, pa.bool_()))
        )


def _unroll_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The letters of each cell and where they lead, for each state that it may be entered in."""
    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("symbols", "lengths", "to_come", "last")]
        # Choices depend on differences of costs only, so like cells are met again.
        found = [
            _ways(tuple(zip(symbols, lengths)), _level(np.array(to_come)), last) for symbols, lengths, to_come, last in zip(*columns)
        ]
        yield (
            batch.drop_columns(["symbols", "lengths", "to_come", "last"])
            .append_column("audits", pa.array([audits for audits, _ in found], pa.list_(pa.string())))
            .append_column("exits", pa.array([exits for _, exits in found], pa.list_(pa.int32())))
        )


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each cell, from the first one on, the letters for the state it is entered in."""
    conv, state, role, begun = None, START, 0, False
    names = ("conv_id", "audits", "exits", "first_role", "last_role", "illegal", "cost")
    for batch in batches:
        rows = []
        for this, audits, exits, first, last, illegal, cost in zip(*[batch[c].to_pylist() for c in names]):
            if not begun or this != conv:
                conv, state, begun = this, START, True
            else:
                illegal, cost = illegal + ((role, first) not in LEGAL), 0
            rows.append((state, audits[state], illegal, cost))
            state, role = exits[state], last
        entry, audit, illegal, cost = zip(*rows) if rows else ([], [], [], [])
        yield pa.RecordBatch.from_pydict({
            "conv_id": batch["conv_id"], "cell": batch["cell"], "entry": pa.array(entry, pa.int32()),
            "audit": pa.array(audit, pa.string()), "illegal": pa.array(illegal, pa.int64()), "cost": pa.array(cost, pa.int64()),
        })


def cell_choices(placed: DataFrame) -> DataFrame:
    """``(conv_id, cell, entry, audit, illegal, cost)``, written: the cheapest edits of every cell.

    ``entry`` is the state before the cell. A conversation's cost is with its first cell, else it is 0.
    """
    kind, arrow = _types(placed, "conv_id")
    narrow = placed.select("conv_id", "cell", "place", "n", _symbol().alias("symbol"), _role_class().alias("role_class"))
    # Cells are few bytes and much work: they are spread by number, which the planner leaves alone.
    parts = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = narrow.repartition(parts, "conv_id", "cell").sortWithinPartitions("conv_id", "cell", "place")
    cells = dealt.mapInArrow(partial(_cell_rows, arrow), f"conv_id {kind}, {CELL_FIELDS}")
    back = cells.repartition(parts, "conv_id").sortWithinPartitions("conv_id", F.desc("cell"))
    fields = f"conv_id {kind}, " + CELL_FIELDS.replace("matrix array<long>, ", "")
    costs = stage(back.mapInArrow(_backward, f"{fields}, to_come array<long>, cost long, last boolean"))
    fields = f"conv_id {kind}, cell long, first_role int, last_role int, illegal long, cost long"
    ways = costs.repartition(parts, "conv_id", "cell").mapInArrow(_unroll_cells, f"{fields}, audits array<string>, exits array<int>")
    ahead = ways.repartition(parts, "conv_id").sortWithinPartitions("conv_id", "cell")
    return stage(ahead.mapInArrow(_forward, f"conv_id {kind}, cell long, entry int, audit string, illegal long, cost long"))


def _edits_of(audit: str, at: int, copies: int) -> tuple[str, int]:
    """The letters from ``at`` on that use up ``copies`` rows, and where they end."""
    begin = at
    while copies:
        step = audit[at : at + copies]
        at += len(step)
        copies -= len(step) - step.count("I")
    return audit[begin:at], at


def _repaired_rows(kinds: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "cell", "place", "step", "turn", "edit", "times", "role", "text"]
    out, state, held = [], START, 0

    def write(conv, cell, place, turn, letters, role, text):
        nonlocal state, held
        step = 0
        while step < len(letters):
            letter = letters[step]
            times = len(letters) - step - len(letters[step:].lstrip("D")) if letter == "D" else 1
            said = role, text
            if letter != "D":
                state = KEEP.get(role[:1], {})[state] if letter == "K" else NEXT[state]
                said = (role if letter == "K" else WRITTEN[state], "" if letter == "I" else text)
            out.append((conv, cell, place, step, None if letter == "I" else turn, letter, times, *said))
            held += 100 + len(said[1])
            step += times

    for (conv, cell), rows in _cells(batches, ("place", "turn", "n", "role", "text", "entry", "audit")):
        _, _, _, _, _, state, audit = rows[0]  # the head comes first
        at, place = 0, 0
        for place, turn, n, role, text, _, _ in rows[1:]:
            edits, at = _edits_of(audit, at, n)
            write(conv, cell, place, turn, edits, role, text)
        write(conv, cell, place + 1, None, audit[at:], "", "")
        if held >= 100 * BATCH_ROWS:
            yield _batch(out, kinds, names)
            out.clear()
            held = 0
    if out:
        yield _batch(out, kinds, names)


def repaired_turns(placed: DataFrame, choices: DataFrame) -> DataFrame:
    """Each edit in order: ``(conv_id, cell, place, step, turn, edit, times, role, text)``.

    Order is ``cell, place, step``. ``edit`` is D, I, K or R; ``times`` counts equal rows deleted
    together; role and text are those of the repaired turn, or of the rows deleted.
    """
    heads = choices.select("conv_id", "cell", F.lit(-1).cast("long").alias("place"), "entry", "audit")
    rows = placed.select("conv_id", "cell", "place", "turn", "n", "role", "text").unionByName(heads, allowMissingColumns=True)
    dealt = rows.repartition("conv_id", "cell").sortWithinPartitions("conv_id", "cell", "place")
    (conv, conv_arrow), (turn, turn_arrow) = _types(placed, "conv_id"), _types(placed, "turn")
    kinds = (conv_arrow, pa.int64(), pa.int64(), pa.int32(), turn_arrow, pa.string(), pa.int64(), pa.string(), pa.string())
    schema = f"conv_id {conv}, cell long, place long, step int, turn {turn}, edit string, times long, role string, text string"
    return dealt.mapInArrow(partial(_repaired_rows, kinds), schema)


def _digest_rows(kind: pa.DataType, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def row(conv, letters, said):
        columns = [pa.array([conv], kind), pa.array(["".join(letters)], pa.string()), pa.array([said.hexdigest()], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "audit", "repaired_sha256"])

    begun, conv, letters, said, empty = False, None, [], hashlib.sha256(), True
    for batch in batches:
        for this, edit, times, role, text in zip(*[batch[c].to_pylist() for c in ("conv_id", "edit", "times", "role", "text")]):
            if not begun or this != conv:
                if begun:
                    yield row(conv, letters, said)
                begun, conv, letters, said, empty = True, this, [], hashlib.sha256(), True
            letters.append(edit * times)
            if edit != "D":
                said.update(f"{role}:{text}".encode() if empty else f"\n{role}:{text}".encode())
                empty = False
    if begun:
        yield row(conv, letters, said)


def repair_digests(repaired: DataFrame) -> DataFrame:
    """``(conv_id, audit, repaired_sha256)`` of ``repaired_turns``: ``role:text`` of what is left, by lines."""
    kind, arrow = _types(repaired, "conv_id")
    dealt = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "cell", "place", "step")
    return dealt.mapInArrow(partial(_digest_rows, arrow), f"conv_id {kind}, audit string, repaired_sha256 string")


NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
EMPTY_HASH = hashlib.sha256().hexdigest()


def conversation_repairs(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each id of ``conversations``: faults and cheapest repair of its rows in ``turns``.

    ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``, where a row's
    first fault counts. An id without rows has zeros, an empty audit and the digest of nothing.
    """
    placed = placed_turns(turns)
    choices = cell_choices(placed)
    n, blank, fresh = F.col("n"), F.col("blank"), F.col("fresh").cast("long")
    by_turn = placed.groupBy("conv_id", "turn").agg(
        F.sum(F.when(blank, n).otherwise(0)).alias("blank"),
        F.sum(F.when(blank, 0).otherwise(n - fresh)).alias("duplicate"),
        F.sum(F.when(blank | ~F.col("truncated"), 0).otherwise(fresh)).alias("truncated"),
    )
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    faults = by_turn.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    )
    costs = choices.groupBy("conv_id").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
    parts = [conversations.select("conv_id").distinct(), faults, costs, repair_digests(repaired_turns(placed, choices))]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in NUMBERS],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(EMPTY_HASH)).alias("repaired_sha256"),
    )
