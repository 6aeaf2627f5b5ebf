"""Byte-pair encoding through an index of pair occurrences, and decoding.

The distinct new words of a partition are laid out one after the other as a linked list of symbols. The index maps
every adjacent pair that a merge rule knows to all its positions; the active ranks wait in a heap. The lowest rank is
applied at all its positions from left to right, which takes the pairs beside each position out and puts new ones
into the index and, if need be, the heap. When the heap is empty, what is left are the tokens. Words and the cuts of
text between blanks are remembered, so each is worked out once per partition or less.

The vocabulary file also names the normalisation and the splitting into words. Cuts of plain Latin-1 characters are
normalised and split by one pattern, all others by the library's own functions, once for each distinct cut. No rule of the supported files reaches across a blank. Special tokens are found in the
raw text first.

Nulls: a null text is an empty document without tokens, decoded as an empty text; a null ``doc_id`` stays null.
Repeated rows give equal rows. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, slices, texts, uncollected
from .packing import vocabulary_path
from .public_ids import BYTE_CHARACTERS

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

BLOCK = 20_000  # words that are indexed at once: bounds the index, not the result
MEMORY = 6_000_000  # characters that are remembered


class Rules:
    """Merge rules: the rank and the new symbol of a pair of symbols."""

    def __init__(self, ranks: dict[tuple[int, int], tuple[int, int]]):
        """``ranks``: rank and new symbol of each pair."""
        self.base = 1 + max((max(*pair, new) for pair, (_, new) in ranks.items()), default=0)
        self.ranks = {left * self.base + right: rank for (left, right), (rank, _) in ranks.items()}
        self.merges = {rank: (*pair, new) for pair, (rank, new) in ranks.items()}
        self.pairs = np.array(sorted(self.ranks), np.int64)
        self.pair_ranks = np.array([self.ranks[pair] for pair in self.pairs.tolist()], np.int64)

    def index(self, symbols: np.ndarray, ends: np.ndarray) -> dict[int, list[int]]:
        """All positions, ascending, of every pair within a word that a rule knows, by the rule's rank."""
        if not len(self.pairs) or not len(symbols):
            return {}
        wide = symbols.astype(np.int64)
        pairs = np.where(np.maximum(wide[:-1], wide[1:]) < self.base, wide[:-1] * self.base + wide[1:], -1)
        found = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        there = self.pairs[found] == pairs
        there[ends[:-1]] = False
        at = np.nonzero(there)[0]
        ranks = self.pair_ranks[found[at]]
        order = np.argsort(ranks, kind="stable")
        ranks, at = ranks[order], at[order]
        starts = np.nonzero(np.diff(ranks, prepend=-1))[0]
        return {int(ranks[s]): part.tolist() for s, part in zip(starts, np.split(at, starts[1:]), strict=True)}


def merge_words(words: list[list[int]], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[list[int]]:
    """Applies the merge rules (pair of symbols: rank and new symbol) to each word (of one symbol or more)."""
    laid, lengths = np.array([s for w in words for s in w], np.int64), np.array([len(w) for w in words], np.int64)
    tokens, ends = merge_laid(laid, lengths, Rules(ranks))
    return [part.tolist() for part in np.split(tokens, ends)[:-1]]


def merge_laid(laid: np.ndarray, lengths: np.ndarray, rules: Rules) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of words laid out one after the other, and behind which token each word ends."""
    if not len(laid):
        return laid, lengths
    ends = np.cumsum(lengths) - 1
    following = np.arange(1, len(laid) + 1)
    following[ends] = -1
    preceding = np.arange(-1, len(laid) - 1)
    preceding[ends - lengths + 1] = -1
    symbols, after, before = laid.tolist(), following.tolist(), preceding.tolist()
    where = rules.index(laid, ends)
    known, base = rules.ranks.get, rules.base
    heap = list(where)
    heapq.heapify(heap)
    while heap:
        rank = heapq.heappop(heap)
        left, right, merged = rules.merges[rank]
        for at in sorted(where.pop(rank)):
            beside = after[at]
            if beside < 0 or symbols[at] != left or symbols[beside] != right:
                continue  # an earlier merge took one of the two
            symbols[at], symbols[beside] = merged, -1
            after[at] = beyond = after[beside]
            if beyond >= 0:
                before[beyond] = at
                new = known(merged * base + symbols[beyond])
                if new is not None:
                    if new in where:
                        where[new].append(at)
                    else:
                        where[new] = [at]
                        heapq.heappush(heap, new)
            ahead = before[at]
            if ahead >= 0:
                new = known(symbols[ahead] * base + merged)
                if new is not None:
                    if new in where:
                        where[new].append(ahead)
                    else:
                        where[new] = [ahead]
                        heapq.heappush(heap, new)
    left_over = np.array(symbols)
    stays = left_over >= 0
    return left_over[stays], np.cumsum(stays)[ends]


#: Without marks to combine, blanks or control characters: here the vocabulary's normaliser only writes small letters
#: and its splitter is the pattern below (letters of Latin-1, single digits, other characters).
PLAIN = re.compile(r"[!-~\xa1-\xff]*")
WORDS = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    r"|[^a-z0-9\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xdf-\xf6\xf8-\xff]+"
)
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class IndexedBpe:
    """Encoder and decoder of one vocabulary file. ``memory`` bounds what is remembered, in characters."""

    def __init__(self, path: str, memory: int = MEMORY):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.splitter = tokenizer.normalizer, tokenizer.pre_tokenizer
        steps, cutters = whole["normalizer"].get("normalizers", []), whole["pre_tokenizer"].get("pretokenizers", [])
        patterns = [c["pattern"].get("Regex") for c in cutters if c["type"] == "Split"]
        self.plain = [n["type"] for n in steps] == NORMALIZERS and patterns == [SPLIT]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.ending = model["end_of_word_suffix"] or ""
        number = self.vocabulary.__getitem__
        ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            ranks.setdefault((number(a), number(b)), (rank, number(a + b)))
        self.rules = Rules(ranks)
        letters = range(256 + len(BYTE_CHARACTERS))  # every byte is a character below, and a symbol
        self.inner = np.array([self.vocabulary.get(chr(c), -1) for c in letters], np.int64)
        self.last = np.array([self.vocabulary.get(chr(c) + self.ending, -1) for c in letters], np.int64)
        self.special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.shown = {i: t + " " for t, i in self.vocabulary.items()}
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.memory, self.size = memory, 0
        self.ids: dict[str, bytes] = {"": b""}  # of words and cuts, which are the same if a cut is one word
        self.decoded: dict[str, str] = {"": ""}  # with a blank behind each token
        self.words: dict[str, tuple[bytes, str]] = {}

    def _split(self, cuts: list[str]) -> dict[str, list[str]]:
        """The words of each cut, in the characters that stand for bytes in the vocabulary."""
        plain = [c for c in cuts if self.plain and PLAIN.fullmatch(c)]
        lowered = "\n".join(plain).lower().split("\n") if plain else []
        found = {
            cut: [w if w.isascii() else w.encode().decode("latin-1").translate(BYTE_CHARACTERS) for w in WORDS.findall(low)]
            for cut, low in zip(plain, lowered, strict=True)
        }
        for cut in cuts:
            if cut not in found:
                found[cut] = [w for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(cut))]
        return found

    def learn(self, cuts: list[str]) -> None:
        """Works out cuts that are not known yet, in blocks of words."""
        split = self._split(cuts)
        new = list({w for words in split.values() for w in words if w not in self.words})
        for at in range(0, len(new), BLOCK):
            block = new[at : at + BLOCK]
            lengths = np.array([len(w) for w in block], np.int64)
            characters = np.frombuffer("".join(block).encode("utf-32-le"), "<u4")
            symbols = self.inner[characters]
            symbols[np.cumsum(lengths) - 1] = self.last[characters[np.cumsum(lengths) - 1]]
            tokens, ends = merge_laid(symbols, lengths, self.rules)
            ids, names = tokens.astype("<u4").tobytes(), [self.shown[i] for i in tokens.tolist()]
            start = 0
            for word, end in zip(block, ends.tolist(), strict=True):
                self.words[word] = (ids[4 * start : 4 * end], "".join(names[start:end]))
                start = end
        for cut, words in split.items():
            known = [self.words[w] for w in words]
            self.ids[cut], self.decoded[cut] = (
                known[0] if len(known) == 1 else (b"".join([i for i, _ in known]), "".join([d for _, d in known]))
            )
            self.size += len(cut)

    def forget(self) -> None:
        """The older half of what is known goes (a dictionary keeps the order in which it was filled)."""
        for known, kept in ((self.ids, {"": b""}), (self.decoded, {"": ""}), (self.words, {})):
            later = list(known)[len(known) // 2 :]
            kept |= {k: known[k] for k in later}
            known.clear()
            known |= kept
        self.size = sum(map(len, self.ids))

    def cuts(self, text: str) -> list[str]:
        """Special tokens and what stands between blanks and line breaks. No word holds either of the two."""
        if self.at_special is None or not any(s in text for s in self.special):
            return text.replace("\n", " ").split(" ")
        parts = self.at_special.split(text)
        return [c for s in parts for c in ([s] if s in self.special else s.replace("\n", " ").split(" "))]

    @uncollected()
    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Ids (little-endian unsigned 32-bit) and decoded text of each."""
        if self.size > self.memory:
            self.forget()
        for token, i in self.special.items():
            self.ids[token], self.decoded[token] = np.array([i], "<u4").tobytes(), token + " "
        cuts = [self.cuts(t) for t in texts]
        self.learn([c for c in set().union(*cuts) if c not in self.ids])
        ids, decoded = self.ids.__getitem__, self.decoded.__getitem__
        return [(b"".join(map(ids, c)), "".join(map(decoded, c))[:-1]) for c in cuts]


_OPEN: dict[str, IndexedBpe] = {}


def _coder(path: str) -> IndexedBpe:
    if path not in _OPEN:
        _OPEN[path] = IndexedBpe(path)
    return _OPEN[path]


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id``, ``ids`` (binary, little-endian unsigned 32-bit) and ``decoded`` of each document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary)
        for batch in batches:
            for some in slices(batch, "text"):
                found = coder.encode(some.column(1).to_pylist())
                columns = [some.column(0), pa.array([i for i, _ in found], pa.binary()), pa.array([d for _, d in found], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    return texts(docs).mapInArrow(run, "doc_id bigint, ids binary, decoded string")


def op6_bpe_pair_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode(documents(spark, sf_dir), vocabulary_path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
