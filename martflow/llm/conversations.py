"""Repair of conversations whose turns don't alternate, by cheapest edits.

A conversation's rows are taken by turn (nulls first; equal turns by role and a
digest of the text). A row is blank, a duplicate of an earlier one, truncated, or
sound. Edits make the roles' initials read ``(s?(ua)+)?``: keep, change the role,
delete, insert an empty turn. The cheapest edits are found by depth-first branch
and bound, and of equally cheap ones those whose initials come first in ASCII.

Only symbols of the rows are searched, one letter a row. They are sorted by range
of (conversation, turn), so a conversation may lie in many tasks, and cut into
segments; each segment is searched on its own, for every state that it may be
entered and left in where it doesn't hold a whole conversation. Segments are then
joined in order, and the edits applied to the rows in one pass that streams them.
One audit is held whole, texts never are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from martflow.llm.common import SPACES, parts, pieces, table
from martflow.session import settle

# What edits cost.
REROLE, DELETE, INSERT, CUT = 3, 4, 3, 3
SEGMENT = 4096  # rows of a segment, at most

START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)  # states in which a conversation may end
_FAR = float("inf")
_NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_TURN = (USER, USER, ASSISTANT, USER)  # the state after an inserted or renamed turn
_NAME = {USER: "user", ASSISTANT: "assistant"}


def _moves(symbol: str) -> list[list[tuple[str, int, int]]]:
    """By state: (edit, cost, state after it) of the edits that use up a row, in ASCII order of the edits."""
    extra = CUT if symbol.isupper() else 0
    found = []
    for state in range(4):
        own = [("D", DELETE, state)]
        if symbol != "x":
            if (kept := _NEXT.get(symbol.lower(), {}).get(state)) is not None:
                own.append(("K", extra, kept))
            own.append(("R", REROLE + extra, _TURN[state]))
        found.append(own)
    return found


# A row's symbol: the initial of its role (o: any other), upper case if it is truncated, x if it has to go.
MOVES = {symbol: _moves(symbol) for symbol in "suaoSUAOx"}


def _with_inserts(costs: list[float]) -> list[float]:
    for _ in range(2):  # more than two in a row never help
        costs = [min(cost, INSERT + costs[_TURN[state]]) for state, cost in enumerate(costs)]
    return costs


def bounds(symbols: str, goals: tuple[int, ...]) -> list[list[float]]:
    """By rows used up and state: no way from there to a goal costs less. Roles are counted as well as faults."""
    last = _with_inserts([0 if state in goals else _FAR for state in range(4)])
    found = [last]
    for symbol in reversed(symbols):
        last = _with_inserts([min(cost + last[to] for _, cost, to in own) for own in MOVES[symbol]])
        found.append(last)
    return found[::-1]


def search(symbols: str, entry: int = START, goals: tuple[int, ...] = ENDS) -> tuple[int, str, int] | None:
    """(cost, audit, state): the cheapest edits from ``entry`` to one of ``goals``, first in ASCII of equally cheap ones.

    None where no edits lead there.

    Depth first with a stack of open branches, edits in ASCII order. A branch is
    left if its cost and the bound of what follows reach the incumbent's cost
    (of equal cost the incumbent came first in ASCII), exceed the bound of the
    whole, or if the same node (rows used up, state) was reached as cheaply
    before, that is by an audit that comes first. When the stack is empty the
    incumbent is proved. As the bounds are exact, no branch dies late, and the
    time is linear in the number of rows.
    """
    least = bounds(symbols, goals)
    limit = least[0][entry]
    seen = [[_FAR] * 4 for _ in least]
    incumbent: tuple = (_FAR, "", entry)
    letters: list[str] = []
    stack = [(0, entry, 0, 0, "")]  # rows used up, state, cost, edits before the last one, the last one
    while stack:
        i, state, cost, depth, letter = stack.pop()
        total = cost + least[i][state]
        if total > limit or total >= incumbent[0] or cost >= seen[i][state]:
            continue
        seen[i][state] = cost
        del letters[depth:]
        letters += letter
        depth += len(letter)
        if i == len(symbols) and state in goals:
            incumbent = (cost, "".join(letters), state)
            continue
        ways = [(i + 1, to, cost + more, depth, edit) for edit, more, to in MOVES[symbols[i]][state]] if i < len(symbols) else []
        ways.append((i, _TURN[state], cost + INSERT, depth, "I"))
        stack += sorted(ways, key=lambda way: way[4], reverse=True)
    return None if incumbent[0] == _FAR else incumbent


_searched = lru_cache(1 << 14)(search)  # short conversations have few patterns


def ways(symbols: str, opens: bool, closes: bool) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, audit) of a segment. ``opens`` and ``closes``: it surely begins or ends a conversation."""
    solve = _searched if len(symbols) <= 64 else search
    if opens and closes:
        cost, audit, state = solve(symbols)
        return [(START, state, cost, audit)]
    entries, exits = (START,) if opens else range(4), ENDS if closes else range(4)
    found = []
    for entry in entries:
        for state in exits:
            if (way := solve(symbols, entry, (state,))) is not None:
                found.append((entry, state, way[0], way[1]))
    return found


# ---- rows --------------------------------------------------------------------------------------

def _ordered(rows: DataFrame) -> DataFrame:
    """The columns used, with what rows of a conversation are sorted by. Nulls read as one space, but in ids and turns."""
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    return rows.select(
        "conv_id", F.col("turn").isNotNull().alias("_known"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("_digest"), text.alias("text"),
    )


_ORDER = ["_known", "turn", "role", "_digest"]

_SEGMENT = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("seg", T.LongType()),
    *[T.StructField(c, T.LongType()) for c in ("blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn")],
    T.StructField("first", T.StringType()), T.StructField("last", T.StringType()),
    T.StructField("ways", T.ArrayType(T.StructType([
        T.StructField("entry", T.IntegerType()), T.StructField("exit", T.IntegerType()),
        T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType()),
    ]))),
])


def _illegal(pair: str) -> bool:
    return pair not in ("su", "ua", "au")


class _Segment:
    """What is known of a run of rows of one conversation."""

    def __init__(self) -> None:
        self.symbols: list[str] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None
        self.first = self.last = None

    def add(self, turn: int | None, initial: str, symbol: str, blank: bool) -> None:
        self.symbols.append(symbol)
        self.blank += blank
        self.duplicate += symbol == "x" and not blank
        self.truncated += symbol.isupper()
        if self.first is None:
            self.first = initial
        else:
            self.illegal += _illegal(self.last + initial)
        self.last = initial
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def row(self, conv, part: int, seg: int, opens: bool, closes: bool) -> dict:
        names = ("blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn", "first", "last")
        found = ways("".join(self.symbols), opens, closes)
        return {"conv_id": conv, "part": part, "seg": seg, **{n: getattr(self, n) for n in names},
                "ways": [dict(zip(("entry", "exit", "cost", "audit"), way)) for way in found]}


def _segments(schema: pa.Schema, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seg, now, conv, opens, out = TaskContext.get().partitionId(), 0, None, None, False, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "symbol", "blank", "n"))):
                own, turn, initial, symbol, blank, n = row
                if now is not None and own != conv:
                    out.append(now.row(conv, part, seg, opens, True))
                    now, opens = None, True
                conv = own
                for copy in range(n):
                    if now is None:
                        now = _Segment()
                    elif len(now.symbols) == most:
                        out.append(now.row(conv, part, seg, opens, False))
                        now, opens, seg = _Segment(), False, seg + 1
                    now.add(turn, initial, "x" if copy else symbol, blank)
                    if len(out) >= 256:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out = []
        if now is not None:
            out.append(now.row(conv, part, seg, opens, False))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def segments(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Segments of all conversations: counts of faults, turns and roles at their ends, and the cheapest ways through them."""
    ordered = _ordered(rows)
    bare = F.rtrim("text", F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    seen = ordered.select(
        "conv_id", *_ORDER, initial.alias("initial"), (bare == "").alias("blank"), F.right(bare, F.lit(1)).isin(".", "!", "?").alias("_whole"),
    ).groupBy("conv_id", *_ORDER, "initial", "blank", "_whole").agg(F.count("*").alias("n"))
    turn = F.struct("_known", "turn")
    firsts = seen.groupBy("conv_id", "role", "_digest").agg(F.min(turn).alias("_first")).select(
        F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("_digest").alias("_d"), "_first")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("_digest") == F.col("_d"))
    kind = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    symbol = F.when(F.col("blank") | ~turn.eqNullSafe(F.col("_first")), "x").when(F.col("_whole"), kind).otherwise(F.upper(kind))
    marked = seen.join(firsts, same).withColumn("symbol", symbol)
    key = ["conv_id", *_ORDER]
    sorted_rows = marked.repartitionByRange(parts(rows), *key).sortWithinPartitions(*key)
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), *_SEGMENT.fields])
    return sorted_rows.select("conv_id", "turn", "initial", "symbol", "blank", "n").mapInArrow(_segments(to_arrow_schema(schema), segment), schema)


# ---- conversations -----------------------------------------------------------------------------

class _Fold:
    """Joins segments in order. What all cheapest ways have in common is kept aside, so that only short ends are compared."""

    def __init__(self) -> None:
        self.done: list[str] = []
        self.best = {START: (0, "")}
        self.sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.first_turn = self.last_turn = self.last = None

    def add(self, row: dict) -> None:
        for name in self.sums:
            self.sums[name] += row[name]
        if self.last is not None:
            self.sums["illegal"] += _illegal(self.last + row["first"])
        self.last = row["last"]
        if row["first_turn"] is not None:
            self.sums["turns"] -= row["first_turn"] == self.last_turn
            self.first_turn = row["first_turn"] if self.first_turn is None else self.first_turn
            self.last_turn = row["last_turn"]
        after: dict[int, tuple[int, str]] = {}
        for way in row["ways"]:
            if (before := self.best.get(way["entry"])) is not None:
                found = (before[0] + way["cost"], before[1] + way["audit"])
                after[way["exit"]] = min(found, after.get(way["exit"], found))
        shared = commonprefix([audit for _, audit in after.values()])
        self.done.append(shared)
        self.best = {state: (cost, audit[len(shared):]) for state, (cost, audit) in after.items()}

    def row(self, conv) -> dict:
        cost, audit = min(self.best[state] for state in ENDS if state in self.best)
        gaps = 0 if self.last_turn is None else self.last_turn - self.first_turn + 1 - self.sums["turns"]
        return {"conv_id": conv, "gaps": gaps, **{k: v for k, v in self.sums.items() if k != "turns"}, "cost": cost, "audit": "".join(self.done) + audit}


def _folded(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv, out = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if now is not None and row["conv_id"] != conv:
                    out.append(now.row(conv))
                    now = None
                if now is None:
                    now, conv = _Fold(), row["conv_id"]
                now.add(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.row(conv)], schema)

    return run


def reports(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text): its faults, the cost of its repair, and the audit.

    ``gaps``: missing turns between the first and the last. ``blank``,
    ``duplicate``, ``truncated``: rows by their first fault. ``illegal``: pairs of
    neighbouring rows whose roles don't follow each other. ``audit``: the edits'
    initials, K R D or I, in order. Null ids are one conversation; a null role or
    text reads as one space; a role is recognised by its first character, and an
    empty one fits nowhere. Repeated rows are duplicates of each other. Other
    columns are not read. No rows give no reports.
    """
    kinds = {"conv_id": rows.schema["conv_id"].dataType}
    schema = T.StructType([
        T.StructField("conv_id", kinds["conv_id"]),
        *[T.StructField(c, T.LongType()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], T.StructField("audit", T.StringType()),
    ])
    grouped = segments(rows, segment).repartition(parts(rows), "conv_id").sortWithinPartitions("conv_id", "part", "seg")
    return grouped.mapInArrow(_folded(to_arrow_schema(schema)), schema)


def _applied(schema: pa.Schema, most: int = 4 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        size = at = pos = 0
        audit, conv, state = "", None, START

        def put(edit: str, turn, role: str, text: str) -> None:
            nonlocal pos, size
            out.append({"conv_id": conv, "pos": pos, "turn": turn, "edit": edit, "role": role, "text": text})
            pos, size = pos + 1, size + len(text) + 64

        def inserts() -> None:
            nonlocal at, state
            while audit[at:at + 1] == "I":
                state = _TURN[state]
                put("I", None, _NAME[state], "")
                at += 1

        for batch in pieces(batches, "text"):
            for own, found, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "turn", "role", "text"))):
                if found is not None:
                    inserts()
                    audit, conv, state, at, pos = found, own, START, 0, 0
                    continue
                inserts()
                edit = audit[at]
                at += 1
                if edit == "K":
                    state = _NEXT[role[0]][state]
                    put(edit, turn, role, text)
                elif edit == "R":
                    state = _TURN[state]
                    put(edit, turn, _NAME[state], text)
                if size >= most:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out.clear()
                    size = 0
        inserts()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, pos, turn, edit, role, text): the rows after the edits of ``found`` (``reports`` of the same rows).

    Rows of one conversation follow each other, by ``pos`` from 0, in one
    partition. Inserted rows have no turn and an empty text.
    """
    kind = rows.schema["conv_id"].dataType
    schema = T.StructType([
        T.StructField("conv_id", kind), T.StructField("pos", T.LongType()), T.StructField("turn", T.LongType()),
        T.StructField("edit", T.StringType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    ])
    heads = found.select("conv_id", "audit", F.lit(0).alias("_row"))
    both = _ordered(rows).withColumn("_row", F.lit(1)).unionByName(heads, allowMissingColumns=True)
    sorted_rows = both.repartition(parts(rows), "conv_id").sortWithinPartitions("conv_id", "_row", *_ORDER)
    return sorted_rows.select("conv_id", "audit", "turn", "role", "text").mapInArrow(_applied(to_arrow_schema(schema)), schema)


def _hashed(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, conv, out = None, None, []
        for batch in batches:
            for own, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if now is not None and own != conv:
                    out.append({"conv_id": conv, "repaired_sha256": now.hexdigest()})
                    now = None
                if now is None:
                    now, conv = hashlib.sha256(), own
                else:
                    now.update(b"\n")
                now.update(f"{role}:{text}".encode())
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if now is not None:
            yield pa.RecordBatch.from_pylist([{"conv_id": conv, "repaired_sha256": now.hexdigest()}], schema)

    return run


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``repaired`` rows, which are read in their order and moved no more."""
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("repaired_sha256", T.StringType())])
    return rows.select("conv_id", "role", "text").mapInArrow(_hashed(to_arrow_schema(schema)), schema)


# ---- the query ---------------------------------------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the query's faults, dealt by a checksum of id and turn: dropped, emptied, cut, repeated, or given the role user."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text"))
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    hurt = rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(said("role")).alias("role"), text.alias("text"), copies.alias("_copies"))
    return hurt.select("conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("_copies")))).drop("col")


def damaged_and_repaired(rows: DataFrame) -> DataFrame:
    """Reports of the rows after damage with digests of their repair, one for every conversation before it."""
    hurt = damaged(rows)
    found = settle(reports(hurt), "reports")
    done = digests(repaired(hurt, found)).withColumnRenamed("conv_id", "_d")
    named = found.withColumnRenamed("conv_id", "_c")
    whole = rows.select("conv_id").distinct().join(named, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    whole = whole.join(done, F.col("conv_id").eqNullSafe(F.col("_d")), "left")
    count = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty: Column = F.lit(hashlib.sha256(b"").hexdigest())
    return whole.select(
        "conv_id", *count, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return damaged_and_repaired(table(spark, sf_dir, "conversations"))
