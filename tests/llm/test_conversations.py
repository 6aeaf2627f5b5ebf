"""Repair of conversations against plain searches."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from filingscope.llm import conversation_repair as cr
from filingscope.llm.conversation_repair import Costs, Repair, Turn

COLUMNS = "conv_id bigint, turn bigint, role string, text string, step string, edit string"
FORM = re.compile(r"(s?(ua)+)?")


def plain_costs(edits: str, turns: list[Turn], costs: Costs) -> int:
    total, at = 0, 0
    for e in edits:
        if e == "I":
            total += costs.insert
            continue
        total += {"K": 0, "R": costs.rerole, "D": costs.delete}[e]
        total += costs.truncated if turns[at].fault == "truncated" and e != "D" else 0
        at += 1
    return total


def outcomes(edits: str, turns: list[Turn]) -> list[list[tuple[str, str]]]:
    """Every row of turns that an audit can lead to."""
    results, at = [[]], 0
    for e in edits:
        turn = None if e == "I" else turns[at]
        at += e != "I"
        if e == "D":
            continue
        roles = [turn.role] if e == "K" else ["user", "assistant"]
        results = [[*r, (role, turn.text if turn else "")] for r in results for role in roles]
    return [r for r in results if FORM.fullmatch("".join(role[:1] or "-" for role, _ in r))]


def exhaustive(turns: list[Turn], costs: Costs = Costs()) -> tuple[int, str]:
    """All audits with up to two insertions in each place."""
    best = None
    choices = [["D"] if t.fault in ("blank", "duplicate") else ["K", "R", "D"] for t in turns]
    for letters in itertools.product(*choices):
        for put in itertools.product(range(3), repeat=len(turns) + 1):
            audit = "".join("I" * n + e for n, e in zip(put, [*letters, ""]))
            cost = plain_costs(audit, turns, costs)
            if (best is None or (cost, audit) < best) and outcomes(audit, turns):
                best = cost, audit
    return best


def dynamic(turns: list[Turn], costs: Costs = Costs()) -> tuple[int, str]:
    """The same by whole audits in each state, without a tree, cuts or coalescence."""

    def inserted(states):
        for _ in range(4):
            for s, (c, a) in list(states.items()):
                new = (c + costs.insert, a + "I")
                to = "u" if s != "u" else "a"
                states[to] = min(states.get(to, new), new)
        return states

    states = {"": (0, "")}
    for t in turns:
        found: dict[str, tuple[int, str]] = {}
        extra = costs.truncated if t.fault == "truncated" else 0

        def put(state, cost, audit, found=found):
            found[state] = min(found.get(state, (cost, audit)), (cost, audit))

        for s, (c, a) in inserted(states).items():
            put(s, c + costs.delete, a + "D")
            if t.fault in ("blank", "duplicate"):
                continue
            to = "u" if s != "u" else "a"
            if t.role[:1] == to:
                put(to, c + extra, a + "K")
            if t.role[:1] == "s" and s == "":
                put("s", c + extra, a + "K")
            put(to, c + extra + costs.rerole, a + "R")
        states = found
    return min(v for s, v in inserted(states).items() if s in ("", "a"))


def run(turns: list[Turn], costs: Costs = Costs()) -> tuple[int, str, list[tuple[str, str]], int]:
    repair, final, widest = Repair(costs), [], 0
    for t in turns:
        final += repair.push(t)
        widest = max(widest, max(n.depth for _, n in repair.survivors.values()) - repair.root.depth)
    final += repair.finish()
    kept = [(e.role, e.turn.text if e.turn else "") for e in final if e.edit != "Delete"]
    return repair.cost, "".join(e.edit[0] for e in final), kept, widest


def random_turns(rng: random.Random, n: int) -> list[Turn]:
    roles = ["system", "user", "user", "assistant", "assistant", "tool", ""]
    faults = [None] * 5 + ["blank", "duplicate", "truncated", "truncated"]
    return [Turn(i, rng.choice(roles), f"t{i}", rng.choice(faults)) for i in range(n)]


def test_cheapest_and_least_edits():
    rng = random.Random(3)
    for n in [0, *[1, 2, 3] * 40, *[4] * 8]:
        turns = random_turns(rng, n)
        cost, audit, kept, _ = run(turns)
        assert (cost, audit) == exhaustive(turns) == dynamic(turns)
        assert outcomes(audit, turns) == [kept]


@pytest.mark.parametrize("costs", [Costs(), Costs(1, 1, 1, 0), Costs(5, 2, 1, 3), Costs(1, 4, 2, 2), Costs(0, 1, 1, 1)])
def test_long_conversations(costs):
    rng = random.Random(5)
    for n in (20, 90, 400):
        for _ in range(12):
            turns = random_turns(rng, n)
            cost, audit, kept, _ = run(turns, costs)
            assert (cost, audit) == dynamic(turns, costs)
            assert FORM.fullmatch("".join(role[:1] for role, _ in kept))
            assert kept in outcomes(audit, turns) if n < 30 else True


def test_memory_follows_what_is_open_not_the_length():
    rng = random.Random(7)
    widest = [run(random_turns(rng, n))[3] for n in (2_000, 20_000)]
    assert max(widest) < 200


def test_nodes_are_given_back():
    rng = random.Random(9)
    repair = Repair(Costs())
    for t in random_turns(rng, 5_000):
        repair.push(t)
    nodes = set()
    for _, node in repair.survivors.values():
        while node is not None:
            nodes.add(node)
            node = node.parent
    assert len(nodes) < 300
    references = defaultdict(int)
    for node in nodes:
        references[node.parent] += 1
    for _, node in repair.survivors.values():
        references[node] += 1
    assert all(node.refs == references[node] for node in nodes)


def plain_query(rows: list[tuple]) -> dict:
    """The query's result by conversation, from Python lists."""
    after, named = defaultdict(list), set()
    for conv_id, turn, role, text in rows:
        named.add(conv_id)
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        after[conv_id] += [(turn, role, text)] * (2 if kind == 3 else 1)
    result = {}
    for conv_id in named:
        turns, seen = [], set()
        for turn, role, text in sorted(after[conv_id], key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())):
            visible = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else None
            fault = "truncated" if fault is None and visible[-1] not in ".!?" else fault
            seen.add((role, text))
            turns.append(Turn(turn, role, text, fault))
        cost, audit = dynamic(turns)
        (kept,) = outcomes(audit, turns)
        known = {t.turn for t in turns if t.turn is not None}
        pairs = ["".join((a.role[:1], b.role[:1])) for a, b in itertools.pairwise(turns)]
        result[conv_id] = (
            max(known) - min(known) + 1 - len(known) if known else 0,
            *(sum(t.fault == f for t in turns) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
        )
    return result


def query(rows) -> dict:
    found = cr.digests(cr.edits(cr.damaged(rows), F.col("present")))
    return {r[0]: tuple(r)[1:] for r in found.collect()}


def test_awkward_tables(spark):
    rows = [
        (None, None, None, None), (None, 3, "user", "a null id."), (None, None, "assistant", "no turn"),
        (1, 1, "system", "Be brief."), (1, 2, "user", "One?"), (1, 3, "assistant", "Two."), (1, 3, "assistant", "Two."),
        (2, 5, "user", ""), (2, 6, "user", " \t\n "), (2, 7, "User", "capital."), (2, 8, "", "no role."),
        (3, -(2**63), "user", "low."), (3, 2**63 - 1, "assistant", "high."),
        (4, 1, "user", "tie b."), (4, 1, "assistant", "tie a."), (4, 1, "user", "tie a."),
        (5, 1, "user", "x" * 200_000), (5, 2, "assistant", "y" * 200_000 + "."),
        (6, 1, "user", "what "), (6, 2, "assistant", "日本語 🙂!\x1f"), (6, 3, "user", "end.\r\n"),
        *[(7, i, "user" if i % 3 else "assistant", f"turn {i % 11}." if i % 5 else "cut") for i in range(300)],
        *[(100 + i, j, "user" if j % 2 else "assistant", f"text {j}.") for i in range(60) for j in range(1, 5)],
    ]
    got = query(spark.createDataFrame([(*r, "s", "e") for r in rows], COLUMNS).repartition(5))
    want = plain_query([r for r in rows if r[0] != 7])
    assert got.keys() == want.keys() | {7}
    assert {k: v for k, v in got.items() if k != 7} == {
        k: (min(v[0], 2**63 - 1), *v[1:]) for k, v in want.items()
    }
    assert query(spark.createDataFrame([], COLUMNS)) == {}


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in cr.op13_survivor_repair(spark, sf).collect()}
    assert got == plain_query(rows)


def test_repaired_turns(spark):
    rows = [(1, 1, "user", "One?"), (1, 2, "user", "Two."), (1, 3, "assistant", "Three."), (1, 4, "user", "")]
    found = cr.edits(spark.createDataFrame([(*r, "s", "e") for r in rows], COLUMNS))
    assert [(r.step, r.role, r.text) for r in cr.repaired(found).orderBy("step").collect()] == [
        (0, "user", "One?"), (1, "assistant", ""), (2, "user", "Two."), (3, "assistant", "Three.")
    ]
    assert [(r.edit, r.fault) for r in found.where("edit = 'Delete'").collect()] == [("Delete", "blank")]
