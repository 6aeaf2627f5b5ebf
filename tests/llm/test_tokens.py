"""Packing, ORC files and pair-index encoding against the tokenizers library."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from filingscope.llm import bpe_index, orc_tokens, packing
from filingscope.llm.public_ids import TokenIds
from filingscope.session import shared_dir

from .conftest import AWKWARD

BYTES = packing.vocabulary_path("byte_bpe_50k.json")
WORDS = packing.vocabulary_path("word_bpe_49k.json")
TEXTS = [t or "" for _, t, _ in AWKWARD] + [" a", "a ", "a  b", "a \n b\n\nc", "don't  'll x   y", "<|endoftext|>"]


def library(path, text):
    return Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("memory", [0, 10**6])
def test_remembered_ids_are_those_of_the_library(memory):
    coder = TokenIds(BYTES, memory)
    for text in TEXTS + TEXTS:
        assert coder.encode(text) == np.array(library(BYTES, text), "<u4").tobytes()


def test_pair_index_is_the_library(docs):
    rows = bpe_index.encode(docs(*TEXTS), WORDS).collect()
    coder = Tokenizer.from_file(WORDS)
    assert len(rows) == len(TEXTS)
    for r in rows:
        ids = library(WORDS, TEXTS[r["doc_id"]])
        assert bytes(r["ids"]) == np.array(ids, "<u4").tobytes()
        assert r["decoded"] == coder.decode(ids, skip_special_tokens=False)
    assert bpe_index.encode(docs(*AWKWARD).limit(0), WORDS).count() == 0


def test_merges_apply_lowest_rank_first_and_left_to_right():
    ranks = {(0, 0): (1, 2), (0, 1): (0, 3), (2, 3): (2, 4)}
    assert bpe_index.merge_words([[0, 0, 0, 1], [0, 0, 0], [1], [0, 0, 1, 0, 1]], ranks) == [[4], [2, 0], [1], [0, 3, 3]]


def test_histogram_packing_uses_every_piece_once():
    counts = {1024: 3, 1000: 5, 600: 4, 424: 2, 24: 9, 7: 100, 1: 3}
    patterns = packing.pack_histogram(counts)
    used = {}
    for pattern, n in patterns:
        assert sum(pattern) <= 1024
        for length in pattern:
            used[length] = used.get(length, 0) + n
    assert used == counts
    assert sum(n for _, n in patterns) == 12  # 12,239 tokens: no packing has fewer


def test_packed_pieces_hold_each_id_once(docs, spark):
    table = docs(*AWKWARD, (11, "many different words " * 3000, "en"))
    cut = packing.written(packing.pieces(table, BYTES, with_ids=True), "pieces")
    packed = packing.pack(cut)
    rows = packed.collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"], r["start"]), []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    ids = {i: np.array([*library(BYTES, t or ""), 0], "<u4").tobytes() for i, t, _ in AWKWARD if i is not None}
    for i, whole in ids.items():
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        copies = sum(1 for a, _, _ in AWKWARD if a == i)
        assert sum(r["length"] for r in own) == copies * len(whole) // 4
        if copies == 1:
            assert b"".join(r["ids"] for r in own) == whole
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    assert sum(len(x) for x in whole.values()) == 4 * sum(r["length"] for r in rows)
    assert packing.pack_documents(table.limit(0), BYTES).count() == 0


def test_orc_round_trip(docs, spark):
    table = docs(*AWKWARD)
    path = shared_dir(spark, "orc")
    orc_tokens.write_tokens(table, BYTES, path)
    rows = orc_tokens.with_starts(orc_tokens.stored(spark, path), spark, path).collect()
    assert len(rows) == len(AWKWARD)
    rows.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == sorted((i for i, _, _ in AWKWARD), key=lambda i: -1 if i is None else i)
    at = 0
    for r in rows:
        assert r["start"] == at and r["n_tokens"] == len(r["ids"])
        at += r["n_tokens"]
    texts = {i: t or "" for i, t, _ in AWKWARD if i is not None}
    assert all(r["ids"] == [*library(BYTES, texts[r["doc_id"]]), 0] for r in rows if r["doc_id"] is not None)
    found = orc_tokens.stored(spark, path).where(F.col("doc_id") == 4)
    assert "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,4)]" in found._jdf.queryExecution().toString()
    assert found.count() == 1
    empty = shared_dir(spark, "orc")
    orc_tokens.write_tokens(table.limit(0), BYTES, empty)
    assert orc_tokens.stored(spark, empty).count() == 0


def test_digest_query(spark):
    import os

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("test tables not present")
    texts = {r["doc_id"]: r["text"] or "" for r in packing.documents(spark, folder).collect()}
    start = 0
    found = {r["doc_id"]: r for r in orc_tokens.op10_orc_tokens(spark, folder).collect()}
    coded = {r["doc_id"]: r for r in bpe_index.op6_bpe_pair_index(spark, folder).collect()}
    for i in sorted(texts):
        ids = np.array([*library(BYTES, texts[i]), 0], "<u4").tobytes()
        assert tuple(found[i])[1:] == (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
        words = np.array(library(WORDS, texts[i]), "<u4").tobytes()
        assert coded[i]["ids_sha256"] == hashlib.sha256(words).hexdigest()
