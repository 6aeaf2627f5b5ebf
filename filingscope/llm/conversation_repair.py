"""Conversations brought into the form of an optional system turn and alternating user and assistant turns.

The cheapest edits are found by a Viterbi search over four states (nothing yet, after a system, user or assistant turn).
All paths stand in one tree of backpointers. A node counts who refers to it, a path that lost gives its nodes back, and
once all surviving states descend from one node, the edits up to it are final, are emitted and leave the memory. Of
equally cheap paths the one with the least audit (the edits' initials in order) survives, for which their whole
unresolved parts are compared. A state that another one beats by more than the way between them costs can never
win and is given up, which is what lets the survivors meet again.

A conversation is one stream through one task, in which only its unresolved edits are held; Spark brings the rows there
by one exchange on ``conv_id`` and sorts them, on disk where they are many.

Rows are taken by ``turn`` (nulls first), rows of one turn by role and text, so ties and repeated rows have one order.
Null roles and texts count as one blank; rows with null ``conv_id`` are one conversation. Rows without a turn have no part
in the gaps. An empty table has no conversations. Columns beyond these four are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices

START, SYSTEM, USER, ASSISTANT = range(4)
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
NEXT = (USER, USER, ASSISTANT, USER)  # where an inserted or renamed turn leads
NAMES = {USER: "user", ASSISTANT: "assistant"}
ENDS = (START, ASSISTANT)
BLANK, DUPLICATE, TRUNCATED = "blank", "duplicate", "truncated"
LARGEST = 2**63 - 1


class Costs(NamedTuple):
    rerole: int = 2
    delete: int = 3
    insert: int = 2
    truncated: int = 1  # of a truncated turn that stays


class Turn(NamedTuple):
    turn: int | None
    role: str
    text: str
    fault: str | None


class Edit(NamedTuple):
    edit: str  # Keep, Rerole, Delete, Insert
    turn: Turn | None  # None: inserted
    role: str | None  # afterwards; None: deleted


class Node:
    """The last edit of a path. ``refs`` counts the nodes behind it and the survivors that end in it."""

    __slots__ = ("parent", "edit", "depth", "refs")

    def __init__(self, parent: Node | None, edit: Edit | None):
        self.parent, self.edit, self.refs = parent, edit, 0
        self.depth = 0
        if parent is not None:
            parent.refs += 1
            self.depth = parent.depth + 1


def given_back(node: Node) -> None:
    """One reference less; nodes that nobody refers to go, and take their reference to the node before with them."""
    node.refs -= 1
    while node.refs == 0 and node.parent is not None:
        node = node.parent
        node.refs -= 1


def earlier(a: Node, b: Node) -> bool:
    """Whether the audit of path ``a`` is less than that of ``b``: both are followed back to where they part."""
    left, right = [], []
    while a is not b:
        if a.depth >= b.depth:
            left.append(a.edit.edit[0])
            a = a.parent
        else:
            right.append(b.edit.edit[0])
            b = b.parent
    return left[::-1] < right[::-1]


class Repair:
    """The search over one conversation. ``push`` and ``finish`` return the edits that have become final."""

    def __init__(self, costs: Costs):
        self.costs = costs
        self.root = Node(None, None)
        self.root.refs = 1
        self.survivors: dict[int, tuple[int, Node]] = {START: (0, self.root)}
        self.cost = 0
        self.look = 16  # how deep the tree may be before the survivors' common ancestor is looked for
        insert, delete = costs.insert, costs.delete
        #: What it costs at most to go on from the first state as from the second.
        self.way = {
            (START, SYSTEM): 0, (START, USER): insert, (START, ASSISTANT): 0,
            (SYSTEM, START): 2 * insert + delete, (SYSTEM, USER): insert, (SYSTEM, ASSISTANT): 2 * insert,
            (USER, START): insert + delete, (USER, SYSTEM): insert, (USER, ASSISTANT): insert,
            (ASSISTANT, START): delete, (ASSISTANT, SYSTEM): 0, (ASSISTANT, USER): insert,
        }

    def offer(self, found: dict[int, tuple[int, Node]], state: int, cost: int, parent: Node, edit: Edit) -> None:
        """A path to ``state``, which stays if it is the cheapest one, of equal ones the first by its audit."""
        held = found.get(state)
        if held is not None and held[0] < cost:
            return
        node = Node(parent, edit)
        node.refs = 1
        if held is None or cost < held[0] or earlier(node, held[1]):
            found[state], node = (cost, node), held[1] if held else None
        if node is not None:
            given_back(node)

    def insert(self) -> None:
        """Paths that go on with turns put in here, the cheapest first."""
        open_states = set(self.survivors)
        while open_states:
            state = min(open_states, key=lambda s: self.survivors[s][0])
            open_states.remove(state)
            cost, node = self.survivors[state]
            to = NEXT[state]
            before = self.survivors.get(to)
            self.offer(self.survivors, to, cost + self.costs.insert, node, Edit("Insert", None, NAMES[to]))
            if self.survivors[to] is not before:
                open_states.add(to)

    def push(self, turn: Turn) -> list[Edit]:
        self.insert()
        found: dict[int, tuple[int, Node]] = {}
        must_go = turn.fault in (BLANK, DUPLICATE)
        extra = self.costs.truncated if turn.fault == TRUNCATED else 0
        for state, (cost, node) in self.survivors.items():
            self.offer(found, state, cost + self.costs.delete, node, Edit("Delete", turn, None))
            if must_go:
                continue
            to = KEPT.get((state, turn.role[:1]))
            if to is not None:
                self.offer(found, to, cost + extra, node, Edit("Keep", turn, turn.role))
            to = NEXT[state]
            self.offer(found, to, cost + extra + self.costs.rerole, node, Edit("Rerole", turn, NAMES[to]))
        for _, node in self.survivors.values():
            given_back(node)
        self.survivors = {}
        for state, (cost, node) in found.items():
            if any(c + self.way[other, state] < cost for other, (c, _) in found.items() if other != state):
                given_back(node)
            else:
                self.survivors[state] = (cost, node)
        return self.settled()

    def settled(self) -> list[Edit]:
        """Edits that all survivors share: those from the root to the first node that more than one refers to. They are
        looked for when the unresolved part has doubled, so looking costs a constant number of steps per row."""
        node = next(iter(self.survivors.values()))[1]
        if node.depth - self.root.depth < self.look:
            return []
        path = []
        while node is not self.root:
            path.append(node)
            node = node.parent
        final = []
        while path and self.root.refs == 1:
            self.root = path.pop()
            final.append(self.root.edit)
        self.root.parent = None
        self.look = max(16, 2 * len(path))
        return final

    def finish(self) -> list[Edit]:
        self.insert()
        best: tuple[int, Node] | None = None
        for state in ENDS:
            if state in self.survivors:
                cost, node = self.survivors[state]
                if best is None or cost < best[0] or cost == best[0] and earlier(node, best[1]):
                    best = cost, node
        self.cost, node = best
        final = []
        while node is not self.root:
            final.append(node.edit)
            node = node.parent
        return final[::-1]


class Counts:
    """What is told of a conversation besides its edits."""

    def __init__(self):
        self.lowest = self.highest = None
        self.distinct = self.illegal = 0
        self.last = None
        self.faults = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}

    def add(self, turn: Turn) -> None:
        if turn.turn is not None and turn.turn != self.highest:
            self.lowest = turn.turn if self.lowest is None else self.lowest
            self.highest = turn.turn
            self.distinct += 1
        initial = turn.role[:1]
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if turn.fault:
            self.faults[turn.fault] += 1

    def values(self, cost: int) -> tuple[int, ...]:
        gaps = 0 if self.lowest is None else min(self.highest - self.lowest + 1 - self.distinct, LARGEST)
        return (gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal, cost)


END = "End"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
EDITS = (
    "conv_id bigint, step bigint, edit string, turn bigint, role string, text string, fault string, "
    + ", ".join(f"{c} bigint" for c in COUNTS)
)
EDIT_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 3, *[pa.int64()] * len(COUNTS)]
EDIT_NAMES = ["conv_id", "step", "edit", "turn", "role", "text", "fault", *COUNTS]


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, kind) for column, kind in zip(zip(*rows), types, strict=True)], names
    )


def ordered_turns(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """Turns by conversation in order, each with its first fault. One exchange, on ``conv_id``, serves all of it."""
    some = r"[^\x20\x09-\x0D]"
    ended = r"[.!?][\x20\x09-\x0D]*\z"
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.lit(True) if present is None else present).alias("present"),
    ).repartition("conv_id")
    alike = Window.partitionBy("conv_id", "role", F.md5("text"), "present").orderBy(F.col("turn").asc_nulls_first())
    fault = (
        F.when(~F.col("text").rlike(some), BLANK)
        .when(F.row_number().over(alike) > 1, DUPLICATE)
        .when(~F.col("text").rlike(ended), TRUNCATED)
    )
    return rows.select("*", fault.alias("fault"), F.row_number().over(alike).alias("nth")).sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_first(), "role", "text", "nth"
    )


def edits(turns: DataFrame, present: Column | None = None, costs: Costs = Costs()) -> DataFrame:
    """The cheapest edits of each conversation, in order and conversation by conversation within a partition.

    A row per edit: ``step`` from 0, ``edit`` (Keep, Rerole, Delete, Insert), the turn it is about (null: inserted), its
    role afterwards (null: deleted), its text and first fault. The row ``End`` closes a conversation and counts its gaps,
    faults and illegal neighbours before the edits, and the cost. Rows that are not ``present`` only name a conversation.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        none = (None,) * len(COUNTS)
        repair, counts, step, open_id = None, None, 0, None

        def put(final: list[Edit]) -> None:
            nonlocal step
            for edit, turn, role in final:
                told = (turn.turn, role, turn.text, turn.fault) if turn else (None, role, "", None)
                rows.append((open_id, step, edit, *told, *none))
                step += 1

        def close() -> None:
            put(repair.finish())
            rows.append((open_id, None, END, None, None, None, None, *counts.values(repair.cost)))

        for batch in batches:
            for some in slices(batch, "text"):
                columns = [some.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "present")]
                for conv_id, turn, role, text, fault, here in zip(*columns, strict=True):
                    if repair is None or conv_id != open_id:
                        if repair is not None:
                            close()
                        repair, counts, step, open_id = Repair(costs), Counts(), 0, conv_id
                    if here:
                        row = Turn(turn, role, text, fault)
                        counts.add(row)
                        put(repair.push(row))
                if rows:
                    yield _batch(rows, EDIT_NAMES, EDIT_TYPES)
                    rows.clear()
        if repair is not None:
            close()
            yield _batch(rows, EDIT_NAMES, EDIT_TYPES)

    return ordered_turns(turns, present).mapInArrow(run, EDITS)


def repaired(found: DataFrame) -> DataFrame:
    """The turns after the edits, in order of ``step``."""
    return found.where(F.col("edit").isin("Keep", "Rerole", "Insert")).select("conv_id", "step", "role", "text")


def digests(found: DataFrame) -> DataFrame:
    """A row per conversation of :func:`edits`: the counts, the audit and the repaired turns' digest. The edits follow
    each other in the partitions, so no exchange is needed and no conversation is held."""
    names = ["conv_id", *COUNTS, "audit", "repaired_sha256"]
    types = [pa.int64(), *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, digest, first = [], hashlib.sha256(), True
        for batch in batches:
            rows = []
            at = {name: batch.column(name).to_pylist() for name in EDIT_NAMES}
            for i, edit in enumerate(at["edit"]):
                if edit != END:
                    audit.append(edit[0])
                    if edit != "Delete":
                        digest.update(f"{'' if first else '\n'}{at['role'][i]}:{at['text'][i]}".encode())
                        first = False
                else:
                    rows.append((at["conv_id"][i], *(at[c][i] for c in COUNTS), "".join(audit), digest.hexdigest()))
                    audit, digest, first = [], hashlib.sha256(), True
            if rows:
                yield _batch(rows, names, types)

    schema = "conv_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", audit string, repaired_sha256 string"
    return found.mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns with faults put in by a checksum of their key: dropped (``present`` is false), emptied, without final
    marks, repeated, or given to the user."""
    part = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(part[0], F.lit(":"), part[1]).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", "role", "text", kind.alias("kind"))
    text = F.coalesce("text", F.lit(" "))
    kind = F.col("kind")
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (kind != 0).alias("present"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )


def op13_survivor_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the damaged table, repaired."""
    rows = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return digests(edits(rows, F.col("present")))
