"""Repair of conversation structure by generalised LR parsing with weighted edits.

A conversation's roles shall read ``(s?(ua)+)?``.  The grammar's LR(0) automaton is built from its rules, and all ways
to repair are parsed at once on a graph-structured stack: a row is kept, gets another role or is deleted, and empty
turns are inserted between rows, each at its price.  Tops of equal stacks merge by the smaller (cost, audit).  In this
grammar a state stands on one state only (checked when the table is built), so equal top states mean equal stacks and
nothing is lost.  No audit of one cost is the beginning of another one at the same row (a beginning has fewer inserts,
so it is cheaper), so a smaller audit stays smaller whatever follows, and merging early is exact.  Tops that cost more
than ``BEYOND`` over the cheapest are dropped: from any state every future of another one can be had for less.

A conversation's rows come to one task, since its digest is one sequence, but they stream: Spark's sorts bring them in
order and spill, faults are marked by a window over (conversation, role, text), and edits go out as soon as all tops
agree on them.  Only a stretch on which they never agree is held, such as a run of rows that all have one role.

Defined results: a null role or text is one space, null turns come first, rows of one turn are ordered by role and text;
a null conversation id is one conversation; conversations whose rows are all gone have a row too; rows of an empty table
give none; other columns are not looked at and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Prices of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Tops this much dearer than the cheapest cannot win: an insert to close a pair and a delete of a late system row.
BEYOND = INSERT + DELETE
#: The role grammar: terminals are role initials.
GRAMMAR = (("Chat", ()), ("Chat", ("Body",)), ("Body", ("Body", "u", "a")), ("Body", ("Head", "u", "a")), ("Head", ("s",)), ("Head", ()))
ROLE_OF = {"u": "user", "a": "assistant"}
NONE, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
#: Rows after which a conversation looks for edits that all tops agree on.
SETTLE = 64
#: Edits of a batch that a task hands out.
BATCH = 4000

EDITS = "step long, edit string, role string, text string, was string, turn long, fault int, cost long"


class Table:
    """The LR(0) automaton of a grammar: shifts, reductions and the state below each state."""

    def __init__(self, rules: tuple[tuple[str, tuple[str, ...]], ...], start: str):
        self.rules = rules
        names = {left for left, _ in rules}

        def closed(items: Iterable[tuple[int, int]]) -> frozenset[tuple[int, int]]:
            out, todo = set(), list(items)
            while todo:
                rule, dot = item = todo.pop()
                if item not in out:
                    out.add(item)
                    right = rules[rule][1]
                    if dot < len(right) and right[dot] in names:
                        todo += [(i, 0) for i, (left, _) in enumerate(rules) if left == right[dot]]
            return frozenset(out)

        first = closed((i, 0) for i, (left, _) in enumerate(rules) if left == start)
        states, self.go, self.below = [first], [], [None]
        for state in states:
            moves: dict[str, set[tuple[int, int]]] = {}
            for rule, dot in state:
                if dot < len(rules[rule][1]):
                    moves.setdefault(rules[rule][1][dot], set()).add((rule, dot + 1))
            row = {}
            for symbol, items in sorted(moves.items()):
                target = closed(items)
                if target not in states:
                    states.append(target)
                    self.below.append(len(self.go))
                row[symbol] = states.index(target)
                if self.below[row[symbol]] != len(self.go):
                    raise ValueError("a state of this grammar stands on several states")
            self.go.append(row)
        done = [[rule for rule, dot in state if dot == len(rules[rule][1])] for state in states]
        self.final = [any(rules[r][0] == start for r in x) for x in done]
        #: For every state the states that its reductions lead to.
        self.reduced = [[self._after(s, r) for r in x if rules[r][0] != start] for s, x in enumerate(done)]
        self.shifts = [{t: s for t, s in row.items() if t not in names} for row in self.go]

    def _after(self, state: int, rule: int) -> int:
        left, right = self.rules[rule]
        for _ in right:
            state = self.below[state]
        return self.go[state][left]


ROLES = Table(GRAMMAR, "Chat")

#: A top of the stack: (cost, audit since the last agreed edit, last edit).  An edit: (edit before, letter, role, row, price).
Top = tuple[int, str, tuple | None]


class Parse:
    """One conversation: rows go in, agreed edits come out."""

    def __init__(self, table: Table = ROLES):
        self.table, self.tops, self.seen, self.held = table, {0: (0, "", None)}, 0, SETTLE
        self._close()

    def _close(self) -> None:
        """Reductions and inserts, until no top gets better; then the tops that can win."""
        tops, table, todo = self.tops, self.table, list(self.tops)
        while todo:
            state = todo.pop()
            cost, audit, last = tops[state]
            for target in table.reduced[state]:
                if target not in tops or (cost, audit) < tops[target][:2]:
                    tops[target] = (cost, audit, last)
                    todo.append(target)
            for terminal, target in table.shifts[state].items():
                if terminal in ROLE_OF and (target not in tops or (cost + INSERT, audit + "I") < tops[target][:2]):
                    tops[target] = (cost + INSERT, audit + "I", (last, "I", ROLE_OF[terminal], None, INSERT))
                    todo.append(target)
        best = min(t[0] for t in tops.values()) + BEYOND
        if any(t[0] > best for t in tops.values()):
            self.tops = {s: t for s, t in tops.items() if t[0] <= best}

    def add(self, initial: str, role: str, fault: int, row: object) -> None:
        """One more row; ``row`` comes back with its edit."""
        out: dict[int, Top] = {}
        more = TRUNCATED if fault == CUT else 0
        for state, (cost, audit, last) in self.tops.items():
            found = [(state, cost + DELETE, "D", role, DELETE)]
            if fault not in (BLANK, DUPLICATE):
                for terminal, target in self.table.shifts[state].items():
                    if terminal == initial:
                        found.append((target, cost + more, "K", role, more))
                    if terminal in ROLE_OF:
                        found.append((target, cost + REROLE + more, "R", ROLE_OF[terminal], REROLE + more))
            for target, total, letter, new, price in found:
                if target not in out or (total, audit + letter) < out[target][:2]:
                    out[target] = (total, audit + letter, (last, letter, new, row, price))
        self.tops = out
        self._close()
        self.seen += 1

    def settled(self) -> list[tuple]:
        """The edits that all tops agree on; they are forgotten here."""
        if self.seen < self.held:
            return []
        chains = [_chain(t[2]) for t in self.tops.values()]
        n = 0
        for step in zip(*chains, strict=False):
            if any(x is not step[0] for x in step):
                break
            n += 1
        # Where little is agreed on, the next look waits, so looking stays linear.
        self.seen, self.held = 0, max(SETTLE, max(map(len, chains)) - n)
        if n == 0:
            return []
        root = chains[0][n - 1]
        fresh: dict[int, tuple | None] = {id(root): None}
        tops = {}
        for (state, (cost, audit, _)), chain in zip(self.tops.items(), chains, strict=True):
            last = None
            for x in chain[n:]:  # shared edits stay shared
                last = fresh.setdefault(id(x), (last, *x[1:]))
            tops[state] = (cost, audit[n:], last)
        self.tops = tops
        return chains[0][:n]

    def rest(self) -> list[tuple]:
        """The edits left at the end."""
        ends = [t for s, t in self.tops.items() if self.table.final[s]]
        return _chain(min(ends, key=lambda t: t[:2])[2])


def _chain(last: tuple | None) -> list[tuple]:
    out = []
    while last is not None:
        out.append(last)
        last = last[0]
    return out[::-1]


# ---- the operator ----------------------------------------------------------------


def marked(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: str | None = None) -> DataFrame:
    """(conv, gone, turn, role, text, fault) of every row, a conversation's rows in order in one partition.

    ``gone`` names a flag of rows that do not count but whose conversations do.
    """
    own = rows.select(
        F.col(conv).alias("conv"),
        (F.lit(False) if gone is None else F.coalesce(F.col(gone), F.lit(False))).alias("gone"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    solid = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    same = Window.partitionBy("conv", "gone", "role", "digest").orderBy("turn")
    fault = (
        F.when(solid == "", BLANK).when(F.col("again") > 1, DUPLICATE)
        .when(~F.right(solid, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(NONE)
    )
    # One shuffle: rows that lie by conversation also lie by (conversation, role, text).
    return (
        own.withColumn("digest", F.sha2("text", 256)).repartition("conv")
        .withColumn("again", F.row_number().over(same)).withColumn("fault", fault)
        .sortWithinPartitions("conv", "gone", "turn", "role", "text", "again").drop("digest", "again")
    )


def edits(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: str | None = None) -> DataFrame:
    """(conv, step, edit, role, text, was, turn, fault, cost): the cheapest repair, one row per edit, in order.

    ``edit`` is Keep, Rerole, Delete or Insert by its initial; ``role`` and ``text`` are those after it, ``was`` the role
    before it and ``cost`` its price.  Each conversation begins with a row of step 0 without an edit.  The rows with
    K, R and I are the repaired conversation.
    """
    ready = marked(rows, conv, turn, role, text, gone)
    kind = ready.schema["conv"].dataType
    schema = StructType().add("conv", kind)
    for field in StructType.fromDDL(EDITS):
        schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now, parse, step = None, None, 0
        types = None

        def put(found: list[tuple]) -> None:
            nonlocal step
            for _, letter, new, row, price in found:
                step += 1
                at, said, was, fault = row or (None, "", None, None)
                out.append((now, step, letter, new, said, was, at, fault, price))

        for batch in batches:
            types = types or batch.schema
            for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if parse is None or key != now:
                    if parse is not None:
                        put(parse.rest())
                    now, parse, step = key, Parse(), 0
                    out.append((now, 0, None, None, None, None, None, None, 0))
                absent, at, who, said, fault = row
                if not absent:
                    parse.add(who[:1], who, fault, (at, said, who, fault))
                    put(parse.settled())
                if len(out) >= BATCH:
                    yield _batch(out, types)
                    out = []
        if parse is not None:
            put(parse.rest())
        if out:
            yield _batch(out, types)

    return ready.mapInArrow(run, schema)


def _batch(rows: list[tuple], types: pa.Schema) -> pa.RecordBatch:
    kinds = [types.field(0).type, pa.int64(), *[pa.string()] * 4, pa.int64(), pa.int32(), pa.int64()]
    names = ["conv", *(field.split()[0] for field in EDITS.split(", "))]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


class _Report:
    """What is reported of one conversation, from its edits in order."""

    def __init__(self, conv: object):
        self.conv, self.count, self.illegal, self.cost = conv, [0, 0, 0, 0], 0, 0
        self.turns, self.low, self.high, self.before = 0, None, None, None
        self.audit, self.digest, self.written = [], hashlib.sha256(), False

    def add(self, edit: str, role: str, text: str, was: str | None, turn: int | None, fault: int | None, cost: int) -> None:
        self.audit.append(edit)
        self.cost += cost
        if edit != "I":
            self.count[fault] += 1
            if self.before is not None and self.before + was[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = was[:1]
            if turn is not None and turn != self.high:
                self.turns += 1
                self.low, self.high = turn if self.low is None else self.low, turn
        if edit != "D":
            self.digest.update((("\n" if self.written else "") + f"{role}:{text}").encode())
            self.written = True

    def row(self) -> tuple:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, *self.count[1:], self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest())


def report(edited: DataFrame) -> DataFrame:
    """One row per conversation from ``edits``: faults, cost, audit and digest of the repaired turns; no shuffle."""
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    schema = StructType().add("conv_id", edited.schema["conv"].dataType)
    for name in names[1:]:
        schema.add(name, "string" if name in ("audit", "repaired_sha256") else "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, kind = None, None

        def told(rows: list[tuple]) -> pa.RecordBatch:
            kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            kind, done = batch.schema.field(0).type, []
            for conv, _, edit, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if edit is None:
                    if one is not None:
                        done.append(one.row())
                    one = _Report(conv)
                else:
                    one.add(edit, *rest)
            if done:
                yield told(done)
        if one is not None:
            yield told([one.row()])

    return edited.mapInArrow(run, schema)


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with the faults of a stated rule, for tests of repair: (conv_id, turn, role, text, gone).

    The CRC-32 of ``conv:turn`` modulo 20 decides: 0 drops the row (it stays, marked as gone), 1 empties its text,
    2 takes its full stops, exclamation and question marks, 3 repeats it, 4 makes its role user.  Nulls are one space.
    """
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn, role, text)]
    what = F.crc32(F.concat_ws(":", filled[0], filled[1]).cast("binary")) % 20
    said = F.when(what == 1, "").when(what == 2, F.regexp_replace(filled[3], "[.!?]", "")).otherwise(filled[3])
    out = rows.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.when(what == 4, "user").otherwise(filled[2]).alias("role"),
        said.alias("text"),
        (what == 0).alias("gone"),
        F.when(what == 3, 2).otherwise(1).alias("times_"),
    )
    return out.select("*", F.explode(F.array_repeat(F.lit(0), F.col("times_")))).drop("times_", "col")
