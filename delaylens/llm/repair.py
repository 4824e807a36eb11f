"""Conversation structure repair: the cheapest edits that make a conversation an
optional system turn and then user and assistant in turn.

The search runs over rows in order with four states (nothing kept, system kept,
user next to be answered, answered). A state's best edits so far are one node of
a tree of prefixes: a node names its edit and its parent, so prefixes are shared,
and carries a rolling hash and its ancestors at powers of two. Where two ways
cost the same, their longest common prefix is found by lifting both nodes over
equal hashes; the edit behind it decides. Equal hashes are verified on the nodes.
Two ways of equal cost are never prefixes of each other (the edits fix the roles,
so one more edit is one more cost), hence the choice at a state is final.

A conversation of ordinary size is repaired in the task that gets its rows. Of a
longer one each block of rows is searched on its own from all four states, in as
many tasks as there are blocks, and the blocks' results are joined in order:
prefix nodes again, now with a block's edits as one step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from delaylens.llm.common import lean, text_batches
from delaylens.session import stage

#: Rows, and characters, of a conversation from which on it is searched in blocks.
LONG_ROWS = 10_000
LONG_CHARS = 16_000_000
#: Ids of long conversations sent to every task; above it they are joined by a shuffle.
BROADCAST_LONG = 100_000

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
#: States: nothing kept, system kept, user kept last, assistant kept last.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
#: The state that a kept role's initial leads to.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: The state that a turn of our own making leads to, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
NEVER = 1 << 60

MODULUS, BASE = (1 << 61) - 1, 1_000_003
LEGAL = {"su", "ua", "au"}

REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def label_hash(label: str) -> int:
    return int.from_bytes(label.encode(), "big") % MODULUS


class Prefixes:
    """A persistent tree of edit prefixes; node 0 is the empty one."""

    def __init__(self, hashed: Callable[[str], int] = label_hash):
        self.hashed = hashed
        self.label = [""]
        self.depth = [0]
        self.hash = [0]
        self.up: list[list[int]] = [[]]

    def add(self, parent: int, label: str) -> int:
        above = [parent]
        k = 0
        while k < len(self.up[above[k]]):
            above.append(self.up[above[k]][k])
            k += 1
        self.up.append(above)
        self.label.append(label)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * BASE + self.hashed(label)) % MODULUS)
        return len(self.label) - 1

    def lift(self, node: int, depth: int) -> int:
        """The ancestor at a depth."""
        while (more := self.depth[node] - depth) > 0:
            node = self.up[node][more.bit_length() - 1]
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two nodes of equal depth spell the same; no hash is believed."""
        while a != b:
            if self.label[a] != self.label[b]:
                return False
            a, b = self.up[a][0], self.up[b][0]
        return True

    def spelled(self, node: int) -> list[str]:
        """The labels from the first on."""
        labels = []
        while node:
            labels.append(self.label[node])
            node = self.up[node][0]
        return labels[::-1]

    def less(self, a: int, b: int) -> bool:
        """Whether a's labels come before b's: the first that differ decide, or
        else the shorter is less."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.lift(a, depth), self.lift(b, depth)
        if self.hash[x] == self.hash[y] and self.same(x, y):
            return self.depth[a] < self.depth[b]
        if self.hash[x] == self.hash[y]:  # two texts with one hash
            return self.spelled(a) < self.spelled(b)
        for k in range(len(self.up[x]) - 1, -1, -1):
            if k < len(self.up[x]):
                p, q = self.up[x][k], self.up[y][k]
                if self.hash[p] != self.hash[q]:
                    x, y = p, q
        if not self.same(self.up[x][0], self.up[y][0]):  # two texts with one hash
            return self.spelled(a) < self.spelled(b)
        return self.label[x] < self.label[y]


class Search:
    """The cheapest edits of the rows so far, by state, from one start state."""

    def __init__(self, start: int, prefixes: Prefixes | None = None):
        self.tree = prefixes or Prefixes()
        self.cost = [NEVER] * 4
        self.node = [0] * 4
        self.cost[start] = 0

    def offer(self, cost: list[int], node: list[int], state: int, price: int, parent: int, label: str) -> None:
        if price > cost[state]:
            return
        new = self.tree.add(parent, label)
        if price < cost[state] or self.tree.less(new, node[state]):
            cost[state], node[state] = price, new

    def insert(self) -> None:
        """Turns of our own before the next row: at most two can pay."""
        for state in (START, SYSTEM, ASSISTANT, USER):
            if self.cost[state] < NEVER:
                self.offer(self.cost, self.node, NEXT[state], self.cost[state] + INSERT_COST, self.node[state], INSERT)

    def row(self, initial: str, must_go: bool, truncated: bool) -> None:
        self.insert()
        cost, node = [NEVER] * 4, [0] * 4
        extra = TRUNCATED_COST if truncated else 0
        for state in range(4):
            paid, at = self.cost[state], self.node[state]
            if paid == NEVER:
                continue
            self.offer(cost, node, state, paid + DELETE_COST, at, DELETE)
            if must_go:
                continue
            kept = KEPT.get((state, initial))
            if kept is not None:
                self.offer(cost, node, kept, paid + extra, at, KEEP)
            if kept != NEXT[state]:
                self.offer(cost, node, NEXT[state], paid + extra + REROLE_COST, at, REROLE)
        self.cost, self.node = cost, node

    def best(self) -> tuple[int, int]:
        """The cost and node of the best way that may end here."""
        self.insert()
        a, b = ACCEPTED
        if self.cost[a] != self.cost[b]:
            end = a if self.cost[a] < self.cost[b] else b
        else:
            end = a if self.tree.less(self.node[a], self.node[b]) else b
        return self.cost[end], self.node[end]

    def step(self, costs: list[list[int]], edits: list[list[str]]) -> None:
        """A whole block of rows: costs and edits by its start and end state."""
        cost, node = [NEVER] * 4, [0] * 4
        for state in range(4):
            if self.cost[state] < NEVER:
                for end in range(4):
                    if costs[state][end] < NEVER:
                        self.offer(cost, node, end, self.cost[state] + costs[state][end], self.node[state], edits[state][end])
        self.cost, self.node = cost, node


def replay(edits: Iterable[str], rows: Iterator[tuple[str, str]], state: int = START) -> Iterator[tuple[int, str | None, str, str]]:
    """(state, edit, role, text) of each repaired turn; rows are consumed as the
    edits say, deleted ones give no turn."""
    for edit in edits:
        if edit == INSERT:
            state = NEXT[state]
            yield state, edit, ROLE[state], ""
            continue
        role, text = next(rows)
        if edit == KEEP:
            state = KEPT[state, role[:1]]
            yield state, edit, role, text
        elif edit == REROLE:
            state = NEXT[state]
            yield state, edit, ROLE[state], text


#: White space as the faults count it.
SPACE = " \t\n\v\f\r"


def fault(text: str, seen: bool) -> str | None:
    shown = text.rstrip(SPACE)
    if not shown:
        return "blank"
    if seen:
        return "duplicate"
    return None if shown[-1] in ".!?" else "truncated"


class Faults:
    """Counts over a conversation's rows in order."""

    def __init__(self):
        self.count = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = 0
        self.last: str | None = None
        self.turns = 0
        self.low = self.high = None

    def add(self, turn: int | None, initial: str, found: str | None, copies: int = 1) -> None:
        """A row and its equal copies, all with its turn; found: the fault of the
        first. Copies of a blank row are blank, others duplicates."""
        if found:
            self.count[found] += 1
        self.count["blank" if found == "blank" else "duplicate"] += copies - 1
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        self.illegal += copies - 1  # no role may follow itself
        self.last = initial
        if turn is not None:
            if turn != self.high:  # rows come by turn
                self.turns += 1
            self.low, self.high = (turn if self.low is None else self.low), turn

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns

    def values(self) -> list[int]:
        return [self.gaps, self.count["blank"], self.count["duplicate"], self.count["truncated"], self.illegal]


Row = tuple[int | None, str, str]


def repair_rows(rows: list[Row]) -> tuple[Faults, int, str]:
    """The faults, cost and edits of a conversation given as (turn, role, text)
    in order."""
    faults, search, seen = Faults(), Search(START), set()
    for turn, role, text in rows:
        mark = (role, hashlib.sha256(text.encode()).digest())
        found = fault(text, mark in seen)
        seen.add(mark)
        faults.add(turn, role[:1], found)
        search.row(role[:1], found in ("blank", "duplicate"), found == "truncated")
    cost, node = search.best()
    return faults, cost, "".join(search.tree.spelled(node))


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[Row]]]:
    """(id, rows) from sorted batches of id, turn, role, text and whether the row
    is present; neighbours with one id are one conversation."""
    open_id, rows, started = None, [], False
    for batch in batches:
        for conv, turn, role, text, present in zip(*(c.to_pylist() for c in batch.columns)):
            if not started or conv != open_id:
                if started:
                    yield open_id, rows
                open_id, rows, started = conv, [], True
            if present:
                rows.append((turn, role, text))
    if started:
        yield open_id, rows


class Parted:
    """The rows of ordinary conversations, and those of long ones."""

    def __init__(self, df: DataFrame, conv: str, turn: str, role: str, text: str, present: Column | None, long_rows: int, long_chars: int):
        filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))]
        there = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
        rows = df.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), *filled, there.alias("present"))
        size = rows.groupBy("conv").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))
        long = stage(size.where((F.col("n") > long_rows) | (F.col("chars") > long_chars)).select("conv"), "long")
        count = long.count()
        self.key = T.StructField(conv, rows.schema["conv"].dataType)
        self.long = None
        if count:
            listed = F.broadcast(long) if count <= BROADCAST_LONG else long
            same = rows["conv"].eqNullSafe(listed["conv"])
            self.long = rows.join(listed, same, "left_semi")
            rows = rows.join(listed, same, "left_anti")
        order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
        self.short = text_batches(rows).repartition("conv").sortWithinPartitions(*order)


def short_report(rows: DataFrame, schema: T.StructType) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for conv, rows in conversations(batches):
            faults, cost, audit = repair_rows(rows)
            turns = replay(audit, iter((role, text) for _, role, text in rows))
            repaired = "\n".join(f"{role}:{text}" for _, _, role, text in turns)
            out.append((conv, *faults.values(), cost, audit, hashlib.sha256(repaired.encode()).hexdigest()))
            if len(out) == 1000:
                yield as_batch(out, schema)
                out = []
        if out:
            yield as_batch(out, schema)

    return rows.mapInArrow(lean(work), schema)


def as_batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    columns = zip(*rows) if rows else [[] for _ in arrow]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)


# Long conversations

BLOCK = "conv {key}, block long, costs array<long>, edits array<string>"


def numbered(rows: DataFrame, block_rows: int) -> DataFrame:
    """A long conversation's rows in order, equal ones as one with their number,
    each with its block and its place there, written once. Sorting deals rows by
    ranges of (conversation, turn, role, start of the text), so one conversation
    is spread over many tasks."""
    mark = F.sha2("text", 256).alias("mark")
    once = rows.where("present").groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    once = stage(once.withColumn("mark", mark), "long-rows")
    # nulls are least, as in the order of the rows
    again = once.groupBy("conv", "role", "mark").agg(
        F.min(F.struct(F.col("turn").isNotNull().alias("has"), F.coalesce("turn", F.lit(0)).alias("turn"))).alias("first"), F.count("*").alias("n")
    )
    again = again.where("n > 1").select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("mark").alias("m"), "first")
    here = F.struct(F.col("turn").isNotNull().alias("has"), F.coalesce("turn", F.lit(0)).alias("turn"))
    seen = F.coalesce(here > F.col("first"), F.lit(False))
    marked = once.join(again, once["conv"].eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("mark") == F.col("m")), "left")
    marked = marked.select("conv", "turn", "role", "text", "copies", seen.alias("seen"))
    turn = F.col("turn").asc_nulls_first()
    dealt = marked.repartitionByRange("conv", turn, "role", F.substring("text", 1, 64))
    ordered = dealt.sortWithinPartitions("conv", turn, "role", "text")
    schema = T.StructType(ordered.schema.fields + T.StructType.fromDDL("block long, place long").fields)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            place = range(at, at + batch.num_rows)
            at += batch.num_rows
            block = pa.array([(part << 32) + p // block_rows for p in place], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, block, pa.array(list(place), pa.int64())], names=schema.names)

    return stage(text_batches(ordered).mapInArrow(lean(number), schema), "long-numbered")


def light(rows: DataFrame) -> DataFrame:
    """What the search needs of a row."""
    shown = F.rtrim(F.col("text"), F.lit(SPACE))
    found = F.when(shown == "", "blank").when(F.col("seen"), "duplicate").when(~F.substring(shown, -1, 1).isin(".", "!", "?"), "truncated")
    return rows.select("conv", "block", "place", "turn", "copies", F.substring("role", 1, 1).alias("initial"), found.alias("found"))


def searched_blocks(rows: DataFrame) -> DataFrame:
    """Of each block: its faults, and costs and edits from every state to every
    other, in order of (from, to)."""
    import pandas as pd

    key = rows.schema["conv"]
    fields = "block long, costs array<long>, edits array<string>, counts array<long>, first string, last string, low long, high long"
    schema = T.StructType([key, *T.StructType.fromDDL(fields).fields])

    def work(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        faults, searches, first = Faults(), [Search(s) for s in range(4)], group["initial"].iloc[0]
        turns = [None if pd.isna(t) else int(t) for t in group["turn"]]
        for turn, initial, found, copies in zip(turns, group["initial"], group["found"], group["copies"]):
            found = found if isinstance(found, str) else None
            faults.add(turn, initial, found, int(copies))
            for search in searches:
                search.row(initial, found in ("blank", "duplicate"), found == "truncated")
                for _ in range(int(copies) - 1):
                    search.row(initial, True, False)
        row = {
            "conv": group["conv"].iloc[0],
            "block": group["block"].iloc[0],
            "costs": [c for s in searches for c in s.cost],
            "edits": ["".join(s.tree.spelled(n)) for s in searches for n in s.node],
            "counts": [*faults.values()[1:], faults.turns],
            "first": first,
            "last": faults.last,
            "low": faults.low,
            "high": faults.high,
        }
        return pd.DataFrame([row]).astype({"low": "Int64", "high": "Int64"})

    return light(rows).groupBy("conv", "block").applyInPandas(work, schema)


def joined_blocks(blocks: DataFrame) -> DataFrame:
    """One row per block with its edits within the whole's cheapest, its state at
    the start, and on the last one the conversation's counts, cost and audit."""
    import pandas as pd

    fields = "block long, state int, edits string, ending string, values array<long>, audit string"
    schema = T.StructType([blocks.schema["conv"], *T.StructType.fromDDL(fields).fields])

    def work(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        search = Search(START)
        total, turns, illegal = [0, 0, 0], 0, 0
        low = high = last = None
        for b in group.itertuples():
            costs = [list(map(int, b.costs[s * 4 : s * 4 + 4])) for s in range(4)]
            search.step(costs, [list(b.edits[s * 4 : s * 4 + 4]) for s in range(4)])
            counts = list(map(int, b.counts))
            total = [x + y for x, y in zip(total, counts)]
            illegal += counts[3] + (last is not None and last + b.first not in LEGAL)
            last = b.last
            if not pd.isna(b.high):
                turns += counts[4] - (int(b.low) == high)  # a turn over the border
                low, high = (int(b.low) if low is None else low), int(b.high)
        cost, node = search.best()
        pieces = search.tree.spelled(node)
        ending = "".join(pieces[len(group) :])
        state, starts = START, []
        for piece, b in zip(pieces, group.itertuples()):
            starts.append(state)
            state = next(e for e in range(4) if b.costs[state * 4 + e] < NEVER and b.edits[state * 4 + e] == piece)
        gaps = 0 if low is None else high - low + 1 - turns
        rows = [(b.conv, b.block, s, p, "", None, None) for b, s, p in zip(group.itertuples(), starts, pieces)]
        rows[-1] = (*rows[-1][:4], ending, [gaps, *total, illegal, cost], "".join(pieces))
        return pd.DataFrame(rows, columns=schema.names)

    return blocks.groupBy("conv").applyInPandas(work, schema)


def long_turns(rows: DataFrame, blocks: DataFrame, block_fields: list[str]) -> DataFrame:
    """The rows of each block as it is read, in order, with the block's results on
    its first row only."""
    cols = [F.when(F.col("first_here"), F.col(c)).alias(c) for c in block_fields]
    first = rows.groupBy("conv", "block").agg(F.min("place").alias("p")).withColumnsRenamed({"conv": "c", "block": "b"})
    marked = rows.join(first, rows["conv"].eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")), "left")
    marked = marked.withColumn("first_here", F.col("place") == F.col("p")).drop("c", "b", "p")
    results = blocks.select(F.col("conv").alias("c"), F.col("block").alias("b"), *block_fields)
    joined = marked.join(results, marked["conv"].eqNullSafe(F.col("c")) & (F.col("block") == F.col("b")), "left")
    chosen = joined.select("conv", "block", "place", "role", "text", "copies", "first_here", *cols)
    return text_batches(chosen).repartition("conv").sortWithinPartitions("conv", "block", "place")


BLOCK_FIELDS = ["state", "edits", "ending", "values", "audit"]


def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, tuple | None, tuple[str, str] | None]]:
    """(id, results, turn) of long conversations row by row: repaired turns, and
    on its last row a conversation's results. Only one block's edits are held."""
    edits, at, state, ending, final = "", 0, START, "", None
    left, owner = 0, None
    for batch in batches:
        names = batch.schema.names
        for values in zip(*(c.to_pylist() for c in batch.columns)):
            r = dict(zip(names, values))
            if r["first_here"]:
                state, edits, at, ending = r["state"], r["edits"], 0, r["ending"]
                final = (r["values"], r["audit"]) if r["values"] is not None else None
            owner, text = r["conv"], (r["role"], r["text"])
            for _ in range(r["copies"]):
                stop = at
                while edits[stop] == INSERT:
                    stop += 1
                for state, _, role, said in replay(edits[at : stop + 1], iter([text]), state):
                    yield owner, None, (role, said)
                at = stop + 1
            if at == len(edits) and final is not None:
                for state, _, role, said in replay(ending, iter(()), state):
                    yield owner, None, (role, said)
                yield owner, final, None
                final = None


def long_report(rows: DataFrame, blocks: DataFrame, schema: T.StructType) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, first = hashlib.sha256(), True
        for conv, final, turn in streamed(batches):
            if turn is not None:
                digest.update(("" if first else "\n").encode() + f"{turn[0]}:{turn[1]}".encode())
                first = False
            else:
                values, audit = final
                yield as_batch([(conv, *values, audit, digest.hexdigest())], schema)
                digest, first = hashlib.sha256(), True

    return long_turns(rows, blocks, BLOCK_FIELDS).mapInArrow(lean(work), schema)


def long_parts(parted: Parted, block_rows: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = numbered(parted.long, block_rows)
    blocks = stage(joined_blocks(stage(searched_blocks(rows), "blocks")), "joined")
    gone = parted.long.groupBy("conv").agg(F.max("present").alias("any")).where("not any").select("conv")
    return rows, blocks, gone


def report(
    df: DataFrame, conv: str, turn: str, role: str, text: str, present: Column | None = None, long_rows: int = LONG_ROWS, long_chars: int = LONG_CHARS
) -> DataFrame:
    """One row per conversation: `conv`, then gaps, blank, duplicate, truncated,
    illegal, cost, audit and the SHA-256 of the repaired turns (`role:text`, by
    newlines).

    Rows go by turn, nulls first, then role and text; equal rows are duplicates
    after the first. Null roles and texts count as one space, so such a role is
    never kept, nor is an empty one. Rows where `present` isn't true are left out,
    but their conversation stays: without rows it has zeros and an empty audit. A
    null id is a conversation of its own. Only the named columns are read. Texts
    of any length are read whole. A long conversation's results still make one
    row: its audit has one letter a row, and one task hashes its turns as they
    stream by.
    """
    parted = Parted(df, conv, turn, role, text, present, long_rows, long_chars)
    schema = T.StructType([parted.key, *T.StructType.fromDDL(REPORT).fields])
    if len(set(schema.names)) < len(schema.names):
        raise ValueError(f"{conv} has the name of a result")
    whole = short_report(parted.short, schema)
    if parted.long is not None:
        rows, blocks, gone = long_parts(parted, long_rows)
        empty = [F.lit(0).cast("long").alias(n) for n in schema.names[1:7]]
        nothing = gone.select(F.col("conv").alias(conv), *empty, F.lit("").alias("audit"), F.sha2(F.lit(""), 256).alias("repaired_sha256"))
        whole = whole.unionByName(long_report(rows, blocks, schema)).unionByName(nothing)
    return whole


def repaired(
    df: DataFrame, conv: str, turn: str, role: str, text: str, present: Column | None = None, long_rows: int = LONG_ROWS, long_chars: int = LONG_CHARS
) -> DataFrame:
    """The repaired turns themselves, one row each: `conv`, position (from 0),
    role and text. Nulls, ties and so on as in `report`; conversations that end
    up empty have no rows."""
    parted = Parted(df, conv, turn, role, text, present, long_rows, long_chars)
    if conv in ("position", "role", "text"):
        raise ValueError(f"{conv} has the name of a result")
    schema = T.StructType([parted.key, *T.StructType.fromDDL("position long, role string, text string").fields])

    def in_batches(turns: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        out = []
        for turn in turns:
            out.append(turn)
            if len(out) == 1000:
                yield as_batch(out, schema)
                out = []
        if out:
            yield as_batch(out, schema)

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns():
            for conv, rows in conversations(batches):
                said = replay(repair_rows(rows)[2], iter((role, text) for _, role, text in rows))
                yield from ((conv, i, role, text) for i, (_, _, role, text) in enumerate(said))

        return in_batches(turns())

    def long(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def turns():
            position = 0
            for conv, _, turn in streamed(batches):
                if turn is None:
                    position = 0
                else:
                    yield conv, position, *turn
                    position += 1

        return in_batches(turns())

    whole = parted.short.mapInArrow(lean(short), schema)
    if parted.long is not None:
        rows, blocks, _ = long_parts(parted, long_rows)
        whole = whole.unionByName(long_turns(rows, blocks, BLOCK_FIELDS).mapInArrow(lean(long), schema))
    return whole


def damaged(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """The columns conv, turn, role, text and `present`, damaged by the remainder
    of crc32 of `conv:turn` by 20: 0 drops the row, 1 empties its text, 2 takes
    out its sentence ends, 3 repeats it, 4 makes it a user's. Nulls count as one
    space."""
    space = F.lit(" ")
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in (conv, turn)))
    harm = F.crc32(name.cast("binary")) % 20
    said, who = F.coalesce(text, space), F.coalesce(role, space)
    return df.select(
        conv,
        turn,
        F.when(harm == 4, "user").otherwise(who).alias(role),
        F.when(harm == 1, "").when(harm == 2, F.translate(said, ".!?", "")).otherwise(said).alias(text),
        (harm != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(1), F.when(harm == 3, 2).otherwise(1).cast("int"))).alias("__copy"),
    ).drop("__copy")
