"""Piece vocabularies: backtracking against the library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from filingscope.llm import piece_merges as pm
from filingscope.llm.common import documents
from filingscope.llm.packing import vocabulary_path

from .conftest import AWKWARD

PATH = vocabulary_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def coder():
    return pm.PieceMerges(PATH)


def agrees(coder, library, texts):
    ids = coder.encode(texts)
    want = library.encode(texts)
    for text, got, right in zip(texts, ids, want, strict=True):
        assert np.frombuffer(got, "<i4").tolist() == right, text[:200]
    assert coder.decode(ids) == [library.decode(w) for w in want]


def test_random_texts(coder, library):
    rng = random.Random(1)
    some = [
        *" \n\t.,!_{}()'0123456789abcdeinorstASé▁　\x00\x7f日本語ж🙂́ﬁ", "  ", "    ", "the", "ing",
        " th", "...", "<s>", "<0x0A>", "==", "http", "\r\n", "tion",
    ]
    agrees(coder, library, ["".join(rng.choices(some, k=rng.randint(0, 60))) for _ in range(4000)])
    points = [chr(rng.choice([rng.randint(1, 0x24F), rng.randint(0x400, 0x4FF), rng.randint(0x2500, 0xD7FF)])) for _ in range(4000)]
    agrees(coder, library, ["".join(points[i : i + 20]) for i in range(0, 4000, 20)])


def test_every_piece_and_pairs_of_pieces(coder, library):
    rng = random.Random(2)
    pieces = [p.replace(pm.SPACE, " ") for p in coder.ids]
    agrees(coder, library, pieces)
    agrees(coder, library, ["".join(rng.choices(pieces, k=rng.randint(2, 8))) for _ in range(5000)])


def test_long_texts_without_a_cut(coder, library):
    agrees(coder, library, ["a" * 5_000, " " * 4_001, "abab" * 3_000, "x" * 100_000, "=" * 999 + "-" * 999])


def test_going_back_a_token(coder):
    """Texts whose first longest token is not the first token exist, and are met."""
    first = [cut for cut in coder.known if cut and coder.longest([cut])[0][0] != coder.backtracked(coder.longest([cut])[0])[0]]
    assert first


def test_what_is_forgotten_comes_back_right(library, monkeypatch):
    monkeypatch.setattr(pm, "MEMORY", 200)
    monkeypatch.setattr(pm, "PAIRS", 50)
    small = pm.PieceMerges(PATH)
    rng = random.Random(3)
    for _ in range(40):
        agrees(small, library, ["".join(rng.choices("abcdefgh ", k=80)) for _ in range(5)])
        assert small.size == sum(map(len, small.known))


def test_bytes_that_are_no_text_are_replaced(coder):
    lone = np.array([coder.byte_ids[0xE6]], "<i4").tobytes()
    assert coder.decode([lone, b""]) == ["�", ""]


def test_awkward_rows(spark, docs, library):
    frame = docs(*AWKWARD).repartition(3)
    got = sorted((r.doc_id, r.ids, r.decoded) for r in pm.encode(frame, PATH).collect() if r.doc_id is not None)
    texts = [(i, t or "") for i, t, _ in AWKWARD if i is not None]
    assert got == sorted((i, library.encode(t), library.decode(library.encode(t))) for i, t in texts)
    assert pm.encode(frame, PATH).where("doc_id IS NULL").count() == 2
    assert pm.encode(docs().limit(0), PATH).collect() == []


def test_whole_table(spark, library):
    sf = "/root/testdata/sf0.001"
    want = set()
    for r in documents(spark, sf).select("doc_id", "text").collect():
        ids = library.encode(r.text or "")
        digest = [hashlib.sha256(s.encode()).hexdigest() for s in (",".join(map(str, ids)), library.decode(ids))]
        want.add((r.doc_id, len(ids), *digest))
    assert {tuple(r) for r in pm.op12_piece_backtracking(spark, sf).collect()} == want
