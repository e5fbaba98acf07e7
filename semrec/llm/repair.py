"""Conversation structure repair: the cheapest edits that make a conversation well formed.

A conversation is well formed when its role initials read ``(s?(ua)+)?``.  Edits walk over its
rows in order: Keep (0), Rerole to user or assistant (3), Delete (4; blank and duplicate rows
must go), Insert an empty user or assistant row (3); a truncated row that stays adds 3.  The
edit lattice has a node per (rows consumed, pattern state); its cheapest paths are found by
bidirectional Dijkstra search (:func:`search`).

Conversations may be of any size:

1. rows get their place in the conversation (:mod:`.numbering`), and a one-letter code of role
   initial and faults; a duplicate is any row but the first of equal role and text;
2. every ``BLOCK`` codes are one block; the search runs per block, for every pair of states
   that the block may be entered and left in.  Inserts between two blocks belong to the second
   one, so audits of different ways through a block are never prefixes of each other;
3. one pass over a conversation's blocks from its end gives the cost to go in each state, one
   from its start the state each block is really entered in;
4. rows and audits meet in one sorted stream per conversation that writes the repaired rows
   and their digest; nothing but the current row is held.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frozen, python_ready
from .numbering import numbered

#: Rows of a conversation that are searched together.
BLOCK = 256
KEEP_TRUNCATED, REROLE, DELETE, INSERT = 3, 3, 4, 3
#: Pattern states: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
BLANKS = " \t\n\x0b\x0c\r"


def _next(state: int) -> int:
    """State after the one role that an edit can put there."""
    return ASSISTANT if state == USER else USER


def _kept(state: int, initial: int) -> int | None:
    """State after keeping a row with this initial (3: any other one), None when it may not stay."""
    if initial == 0:
        return SYSTEM if state == START else None
    return initial + 1 if initial < 3 and _next(state) == initial + 1 else None


class Lattice:
    """Edit lattice of a block; a node is ``(row, state)``.  A code is ``a`` plus the initial, plus
    4 if truncated, plus 8 if the row must go."""

    def __init__(self, codes: str, last: bool):
        self.rows = [(c & 3, bool(c & 4), bool(c & 8)) for c in (ord(x) - 97 for x in codes)]
        self.last = last

    def _into(self, row: int, state: int) -> Iterator[tuple[int, int, str]]:
        """``(state after, cost, edit)`` of the edits that consume ``row``."""
        initial, truncated, must_go = self.rows[row]
        yield state, DELETE, "D"
        if not must_go:
            extra = KEEP_TRUNCATED if truncated else 0
            kept = _kept(state, initial)
            if kept is not None:
                yield kept, extra, "K"
            yield _next(state), REROLE + extra, "R"

    def forward(self, node: tuple[int, int]) -> Iterator[tuple[tuple[int, int], int, str]]:
        row, state = node
        if row < len(self.rows):
            for after, cost, edit in self._into(row, state):
                yield (row + 1, after), cost, edit
        if row < len(self.rows) or self.last:
            yield (row, _next(state)), INSERT, "I"

    def backward(self, node: tuple[int, int]) -> Iterator[tuple[tuple[int, int], int, str]]:
        row, state = node
        for before in range(4):
            if row:
                for after, cost, edit in self._into(row - 1, before):
                    if after == state:
                        yield (row - 1, before), cost, edit
            if (row < len(self.rows) or self.last) and _next(before) == state:
                yield (row, before), INSERT, "I"


class _Side:
    """One of the two searches: settled nodes with cost and least audit, and the heap of open ones.

    Nodes come off the heap by cost, then along the rows, so each one is settled after
    every node on its cheapest paths, also over edits that cost nothing."""

    def __init__(self, sources: list[tuple[int, int]], edges, towards: int):
        self.edges, self.towards = edges, towards
        self.open = {s: (0, "") for s in sources}
        self.settled: dict[tuple[int, int], tuple[int, str]] = {}
        self.heap = [(0, towards * s[0], s) for s in sources]
        heapq.heapify(self.heap)

    def top(self) -> int | None:
        while self.heap and self.heap[0][2] in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else None

    def settle(self) -> tuple[int, int]:
        node = heapq.heappop(self.heap)[2]
        cost, audit = self.settled[node] = self.open[node]
        for other, step, edit in self.edges(node):
            if other in self.settled:
                continue
            label = (cost + step, audit + edit if self.towards > 0 else edit + audit)
            known = self.open.get(other)
            if known is None or label < known:
                self.open[other] = label
                if known is None or label[0] < known[0]:
                    heapq.heappush(self.heap, (label[0], self.towards * other[0], other))
        return node


def search(lattice: Lattice, source: tuple[int, int], targets: list[tuple[int, int]]) -> tuple[int, str] | None:
    """Least cost from ``source`` to any target, and the least audit (ASCII) of that cost.

    The side with the smaller heap top goes on until the two tops together exceed the best
    crossing, so every edge of a cheapest path that joins the two settled sets has been met
    by then; the least concatenated audit over those crossings is the answer.
    """
    ahead, back = _Side([source], lattice.forward, 1), _Side(targets, lattice.backward, -1)
    best, order = None, [ahead] + [back] * len(targets)  # both searches first settle where they start
    while True:
        a, b = ahead.top(), back.top()
        if order:
            side = order.pop()
        elif a is None or b is None or (best is not None and a + b > best):
            break
        else:
            side = ahead if a <= b else back
        node, other = side.settle(), back if side is ahead else ahead
        if node in other.open:
            met = side.settled[node][0] + other.open[node][0]
            best = met if best is None else min(best, met)
    if best is None:
        return None
    audits = [cost[1] + back.settled[n][1] for n, cost in ahead.settled.items()
              if n in back.settled and cost[0] + back.settled[n][0] == best]
    for node, (cost, audit) in ahead.settled.items():
        for other, step, edit in lattice.forward(node):
            if other in back.settled and cost + step + back.settled[other][0] == best:
                audits.append(audit + edit + back.settled[other][1])
    return best, min(audits)


@functools.lru_cache(maxsize=1 << 16)
def block_paths(codes: str, first: bool, last: bool) -> tuple[tuple[int | None, ...], tuple[str | None, ...]]:
    """Costs and audits by ``4 * entry state + exit state``; a last block ends in exit 0, where
    the pattern is complete.  None where there is no way."""
    lattice, end = Lattice(codes, last), len(codes)
    costs, audits = [None] * 16, [None] * 16
    for entry in (START,) if first else range(4):
        for leave in (0,) if last else range(4):
            goal = [(end, START), (end, ASSISTANT)] if last else [(end, leave)]
            got = search(lattice, (0, entry), goal)
            if got:
                costs[4 * entry + leave], audits[4 * entry + leave] = got
    return tuple(costs), tuple(audits)


# rows -----------------------------------------------------------------------

def _or_blank(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` rows after the damage that crc32 of ``conv_id:turn`` modulo 20 picks:
    0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes it a
    user's; nulls count as one space."""
    pick = F.crc32(F.concat(_or_blank("conv_id"), F.lit(":"), _or_blank("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", _or_blank("role").alias("role"), _or_blank("text").alias("text"),
                        pick.alias("pick"))
    text = (F.when(F.col("pick") == 1, F.lit("")).when(F.col("pick") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text")))
    role = F.when(F.col("pick") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(0), F.when(F.col("pick") == 3, 2).otherwise(1))
    return rows.where("pick <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"),
                                          F.explode(copies).alias("copy")).drop("copy")


def _key(name: str) -> Column:
    """The conversation's id as text that a null id shares with no other."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{name}`").cast("string")), F.lit("-"))


def coded(rows: DataFrame) -> DataFrame:
    """``(key, turn, role, text, pos, fault, code)`` of ``(conv_id, turn, role, text)`` rows, written once.

    Rows of one turn are ordered by role, then text.  ``fault``: blank, duplicate, truncated or null."""
    own = rows.select(_key("conv_id").alias("key"), "turn", _or_blank("role").alias("role"),
                      _or_blank("text").alias("text"))
    # the first characters and a digest order texts without carrying whole texts as sort keys
    own = own.withColumn("head", F.substring("text", 1, 256)).withColumn(
        "digest", F.sha2(F.col("text").cast("binary"), 256))
    rows = numbered(own, "key", ["turn", "role", "head", "digest"]).drop("head")
    bare = F.rtrim("text", F.lit(BLANKS))
    firsts = (rows.select("key", "role", "digest", "pos").groupBy("key", "role", "digest").agg(F.min("pos").alias("pos"))
              .select("key", "pos", F.lit(True).alias("first")))
    flagged = rows.drop("digest").join(firsts, ["key", "pos"], "left")
    fault = (F.when(F.length(bare) == 0, "blank").when(F.col("first").isNull(), "duplicate")
             .when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), "truncated"))
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    initial = F.when((F.length("role") > 0) & (initial > 0), initial - 1).otherwise(3)
    code = (F.lit(97) + initial + F.when(F.col("fault") == "truncated", 4).otherwise(0)
            + F.when(F.col("fault").isin("blank", "duplicate"), 8).otherwise(0))
    return frozen(flagged.withColumn("fault", fault).withColumn("code", F.char(code)).drop("first"))


def _runs(columns: list[pa.Array]) -> Iterator[tuple]:
    return zip(*(c.to_pylist() for c in columns))


def searched(rows: DataFrame, block: int) -> DataFrame:
    """``(key, block, codes, costs, audits)``: the ways through every block."""
    size = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    blocks = rows.groupBy("key", F.floor(F.col("pos") / block).alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda x: x["code"]), "")
        .alias("codes"))
    blocks = blocks.join(size, "key").select("key", "block", "codes",
                                             ((F.col("block") + 1) * block >= F.col("n")).alias("last"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [block_paths(codes, at == 0, last) for _, at, codes, last in _runs(b.columns)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([g[0] for g in got], pa.list_(pa.int64())),
                 pa.array([g[1] for g in got], pa.list_(pa.string()))],
                names=["key", "block", "codes", "costs", "audits"])

    return python_ready(blocks).mapInArrow(
        work, "key string, block bigint, codes string, costs array<bigint>, audits array<string>")


def _illegal(codes: str) -> int:
    pairs = {(0, 1), (1, 2), (2, 1)}  # su, ua, au
    initials = [(ord(c) - 97) & 3 for c in codes]
    return sum(p not in pairs for p in zip(initials, initials[1:]))


def _from_the_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block and entry state the exit state and audit that are on the cheapest way on."""
    at, togo, following = None, None, None
    for b in batches:
        out = []
        for key, block, codes, costs, audits in _runs(b.columns):
            leave, audit, cost = [], [], []
            for entry in range(4):
                ways = [(costs[4 * entry + q] + (togo[q] if key == at else 0), audits[4 * entry + q], q)
                        for q in range(4) if costs[4 * entry + q] is not None
                        and (key != at or togo[q] is not None)]
                best = min(ways, default=(None, None, None))
                cost.append(best[0])
                audit.append(best[1])
                leave.append(best[2])
            illegal = _illegal(codes + following if key == at else codes)
            out.append((key, block, leave, audit, cost[START], illegal))
            at, togo, following = key, cost, codes[0]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _WAY.types)],
                                         names=_WAY.names) if out else pa.RecordBatch.from_pylist([], _WAY)


_WAY = pa.schema([("key", pa.string()), ("block", pa.int64()), ("leave", pa.list_(pa.int32())),
                  ("audits", pa.list_(pa.string())), ("cost", pa.int64()), ("illegal", pa.int64())])
_WAY_SQL = "key string, block bigint, leave array<int>, audits array<string>, cost bigint, illegal bigint"


def _from_the_start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, state = None, START
    for b in batches:
        entries, chosen = [], []
        for key, leave, audits in _runs([b.column(0), b.column(2), b.column(3)]):
            state = state if key == at else START
            entries.append(state)
            chosen.append(audits[state])
            at, state = key, leave[state]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(entries, pa.int32()), pa.array(chosen, pa.string()),
             b.column(4), b.column(5)], names=["key", "block", "entry", "audit", "cost", "illegal"])


def audited(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(key, block, entry, audit, cost, illegal)`` of :func:`coded` rows, written once: every block's part of
    the audit and the state it starts in.  ``cost`` of block 0 is that of the conversation."""
    ways = (searched(rows, block).repartition("key").sortWithinPartitions("key", F.col("block").desc())
            .mapInArrow(_from_the_end, _WAY_SQL))
    # a partition holds whole conversations, so the second pass only sorts it the other way
    return frozen(ways.sortWithinPartitions("key", "block").mapInArrow(
        _from_the_start, "key string, block bigint, entry int, audit string, cost bigint, illegal bigint"))


_TURN = pa.schema([("key", pa.string()), ("at", pa.int64()), ("role", pa.string()), ("text", pa.string()),
                   ("sha256", pa.string())])


class _Writer:
    """Applies audits to the sorted stream of one task."""

    def __init__(self):
        self.key, self.out, self.size = None, [], 0

    def emit(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.at else "") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.out.append((self.key, self.at, role, text, None))
        self.at += 1
        self.size += len(text) + 64

    def put(self, text: str) -> None:
        """A row with the one role that an edit can put here."""
        self.state = _next(self.state)
        self.emit("user" if self.state == USER else "assistant", text)

    def inserts(self) -> None:
        while self.done < len(self.audit) and self.audit[self.done] == "I":
            self.put("")
            self.done += 1

    def open(self, key: str, entry: int, audit: str) -> None:
        if key != self.key:
            self.close()
            self.key, self.at, self.digest = key, 0, hashlib.sha256()
        else:
            self.inserts()
        self.state, self.audit, self.done = entry, audit, 0

    def row(self, role: str, text: str) -> None:
        self.inserts()
        edit = self.audit[self.done]
        self.done += 1
        if edit == "R":
            self.put(text)
        elif edit == "K":
            self.state = _kept(self.state, INITIALS.index(role[0]))
            self.emit(role, text)

    def close(self) -> None:
        if self.key is not None:
            self.inserts()
            self.out.append((self.key, None, None, None, self.digest.hexdigest()))

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.out)) or [()] * 5
        self.out, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TURN.types)], names=_TURN.names)


def rewritten(rows: DataFrame, audits: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(key, at, role, text, sha256)``: the repaired rows in order (``at`` 0, 1, ...), and per conversation a
    row without ``at`` that holds the digest of its newline-joined ``role:text``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = _Writer()
        for b in batches:
            for key, pos, entry, role, text in _runs(b.columns):
                if pos < 0:
                    w.open(key, entry, text)
                else:
                    w.row(role, text)
                if w.size > 1 << 23:
                    yield w.batch()
        w.close()
        yield w.batch()

    null = F.lit(None).cast("string")
    plan = audits.select("key", "block", F.lit(-1).cast("bigint").alias("pos"), "entry", null.alias("role"),
                         F.col("audit").alias("text"))
    stream = plan.unionByName(rows.select("key", F.floor(F.col("pos") / block).alias("block"), "pos",
                                          F.lit(None).cast("int").alias("entry"), "role", "text"))
    return (python_ready(stream).repartition("key").sortWithinPartitions("key", "block", "pos")
            .select("key", "pos", "entry", "role", "text")
            .mapInArrow(work, "key string, at bigint, role string, text string, sha256 string"))


def repair(conversations: DataFrame, ids: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """``(reports, turns)`` of conversation rows ``(conv_id, turn, role, text)``.

    ``reports`` has a row for every different ``conv_id`` of ``ids``: ``gaps`` (missing turn numbers), ``blank``,
    ``duplicate`` and ``truncated`` rows (first fault only), ``illegal`` neighbours, ``cost``, ``audit`` and
    ``repaired_sha256``.  ``turns`` holds the repaired rows ``(conv_id, at, role, text)``.

    Null roles and texts count as one space; a null ``conv_id`` is a conversation like any other; null turns
    come first; rows of one turn go by role, then text; an id without rows gets zeros, an empty audit and the
    digest of the empty string.  Other columns, whatever their names, are left out; empty tables give empty
    results.  Texts and conversations may be of any length; the digest of one conversation is computed in one
    task, row by row, as SHA-256 is sequential.
    """
    rows = coded(conversations.select("conv_id", "turn", "role", "text"))
    audits = audited(rows, block)
    written = rewritten(rows, audits, block)
    known = ids.select("conv_id").distinct().withColumn("key", _key("conv_id"))
    counts = rows.groupBy("key").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")])
    whole = audits.groupBy("key").agg(
        F.sum("illegal").alias("illegal"), F.max(F.when(F.col("block") == 0, F.col("cost"))).alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))),
                                 lambda x: x["audit"]), "").alias("audit"))
    digests = written.where("at is null").select("key", F.col("sha256").alias("repaired_sha256"))
    zero = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    reports = (known.join(counts, "key", "left").join(whole, "key", "left").join(digests, "key", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(z)).cast("bigint").alias(c) for c, z in zero.items()],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256")))
    turns = written.where("at is not null").join(known, "key").select("conv_id", "at", "role", "text")
    return reports, turns
