"""Codes of vectors against plain loops and SQL."""

from __future__ import annotations

import hashlib
import math
import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from filingscope.llm import vector_codes as vc

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, error string, `row` string"


def plain(rows: list[tuple]) -> tuple[list[tuple], str]:
    """The contract by nested loops over Python integers. All vectors have one length, a multiple of 16."""
    kept = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return [], hashlib.sha256(b"").hexdigest()
    w = len(kept[0][2]) // 16
    parts = [[v[p * w : (p + 1) * w] for p in range(16)] for _, _, v in kept]
    books = [[row[p] for row in parts[:64]] for p in range(16)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(books[p]))

    for _ in range(2):
        for p in range(16):
            members = defaultdict(list)
            for row in parts:
                members[nearest(p, row[p])[1]].append(row[p])
            books[p] = [
                [sum(x) // len(members[e]) for x in zip(*members[e])] if members[e] else entry
                for e, entry in enumerate(books[p])
            ]
    found = [[nearest(p, row[p]) for p in range(16)] for row in parts]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = defaultdict(int)
    for (_, label, _), error in zip(kept, errors):
        by_label[label] += error
    result = [
        (i, "".join(f"{e:02x}" for _, e in f), error, by_label[label])
        for (i, label, _), f, error in zip(kept, found, errors)
    ]
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    return result, hashlib.sha256(flat.encode()).hexdigest()


def codes(spark, rows) -> tuple[list[tuple], str]:
    frame = spark.createDataFrame([(*r, "c", "e", "x") for r in rows], SCHEMA).repartition(3)
    coded, books = vc.compress(frame)
    found = vc.with_label_error(coded)
    return [(r.vec_id, r.code, r.error, r.label_error) for r in found.collect()], vc.digest(books)


def numbers(rng, n, quarters=False):
    return [rng.choice([-0.25, 0.0, 0.25, 0.5]) if quarters else float(np.float32(rng.gauss(0, 0.4))) for _ in range(n)]


@pytest.mark.parametrize("rows,quarters", [(0, False), (1, False), (40, True), (300, False), (300, True)])
def test_plain_loops(spark, rows, quarters):
    rng = random.Random(rows)
    data = [(i // 2 if quarters else i, numbers(rng, 32, quarters), rng.choice([None, 1, 2])) for i in range(rows)]
    want, digest = plain(data)
    got, found = codes(spark, data)
    assert sorted(got) == sorted(want)
    assert found == digest


def test_awkward_rows(spark):
    rng = random.Random(4)
    good = [(i, numbers(rng, 32), 1 if i % 3 else None) for i in range(90)]
    good += [good[7], (None, numbers(rng, 32), None), (None, numbers(rng, 32), 5), (91, [30000.0] * 32, 2)]
    bad = [
        (-1, None, 1), (-2, [None] * 32, 1), (-3, [math.nan] + [0.0] * 31, 1), (-4, [0.0] * 31 + [math.inf], 1),
        (-5, [], 1), (-6, [0.5] * 16, 1), (-7, [0.5] * 33, 1),
    ]
    want, digest = plain(good)
    got, found = codes(spark, good + bad)
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert found == digest


def test_lengths_that_16_does_not_divide_and_huge_components(spark):
    rng = random.Random(6)
    rows = [(i, [*numbers(rng, 18), 3e38, -3e38], 0) for i in range(70)]
    filled = [(i, [*v[:18], float(2**16), -float(2**16), *[0.0] * 12], label) for i, v, label in rows]
    want, digest = plain(filled)
    got, found = codes(spark, rows)
    assert sorted(got) == sorted(want)
    assert found == digest


def test_vectors_without_components(spark):
    assert codes(spark, [(1, [], 3), (2, [], 3)])[0] == [(1, "00" * 16, 0, 0), (2, "00" * 16, 0, 0)]


def test_masks_hold_all_nearest_entries():
    rng = np.random.default_rng(8)
    for entries in (1, 3, 63, 64):
        for spread in (3, 1000):
            book = vc.Codebook(rng.integers(-spread, spread, (entries, 4)))
            parts = rng.integers(-2 * spread, 2 * spread, (500, 4))
            distance = ((parts[:, None] - book.entries[None]) ** 2).sum(axis=2)
            entry, least = book.nearest(parts)
            assert (least == distance.min(axis=1)).all()
            assert (entry == distance.argmin(axis=1)).all()
    assert np.mean([bin(m).count("1") for m in book.candidates(parts // 2).tolist()]) < 40  # fewer than all are compared


def test_hot_and_rare_labels(spark, monkeypatch):
    monkeypatch.setattr(vc, "HOT_LABELS", 2)
    rng = random.Random(2)
    data = [(i, numbers(rng, 16), None if i % 2 else i % 7) for i in range(200)]
    assert sorted(codes(spark, data)[0]) == sorted(plain(data)[0])


def test_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    got = vc.op11_mask_codes(spark, sf)
    want = con.sql(vc.ORACLE)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())
