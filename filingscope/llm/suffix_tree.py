"""Language-model scores by a probabilistic suffix tree over words.

The tree's nodes are contexts of zero, one or two words. All training documents are counted as triples (a word and the two
before it, with a mark before the start of a text); nothing that is learned is bounded by a share of the corpus or held by
the driver: a pair or triple counts from ``LEAST_COUNT`` occurrences on, whatever the size of the corpus.

A token goes through one shuffle, as a few bytes: words are dealt by their pair, frequent ones under short codes, with the
row they stand in, and packed in columns; the texts are read ``TURNS`` times, for a part of the pairs each. What is
recorded is then known where the tokens are, so only recorded pairs and triples become rows, and of the tokens those of
recorded pairs are kept as packed places. Pairs of the most frequent words are spread over the parts. Sums are by part first,
and what a pair or triple adds to a score is sent to its places, not the other way round.

A context stays in the tree if its next words diverge from those of its shorter suffix: by the Kullback-Leibler
divergence (words that are not recorded count as one), and by that times the context's count. Next-word distributions
are smoothed by absolute discounting: what is taken off the recorded words goes to the suffix's distribution, and at
the root to one class of unknown words. Each token is scored from the longest suffix of its past that is in the tree;
no context reaches across documents.

``learn`` holds the same tree in one process, for corpora whose triples fit there; the tests compare the two.

Nulls: a null text is empty and consists of its end alone; a null ``doc_id`` is neither held out nor learned from.
Each row has its own result, repeated rows equal ones (and they count as often as they stand there). If there is
nothing to learn from, every token has probability one of the unknown class. An empty table gives an empty result.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, mixed, partitions, slices, texts, words_of, written

LEAST_COUNT = 2
DISCOUNT = 0.75
LEAST_DIVERGENCE = 0.02  # nats for each token after the context
LEAST_GAIN = 10.0  # nats for all tokens after the context
END = np.uint64(0x454E44)  # stands for the end of a text; no word's hash is set to it on purpose
START = np.uint64(0x5354415254)  # stands before the first word of a text; no context holds it
TURNS = 2  # the texts are read so often to count their triples: what is shuffled at once is a part of them
PARTS = 4  # of a turn, for each shuffle partition: what a worker holds at once
HELD = 1_000_000  # tokens in a worker before they are packed
CODED, TOP = 65_000, 256  # words with short codes; words whose pairs are spread over the parts
RARE = 65_535  # the code of all other words
LISTED = 250_000  # words whose values are sent to where the texts are read
SHARES = 2  # of a turn, in which the places meet their values
LEARNED, SCORED = 1, 2
SHORT = 64  # bytes of a word that is hashed with all others
SLOTS = 22  # bits of a hash that find a coded word

Batches = Iterable[pa.RecordBatch]


def _hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of words: eight bytes of all words at a time, long words one by one."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = words.buffers()[2]
    data = np.append(np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), np.zeros(8, np.uint8))
    eight = np.ndarray(len(data) - 7, "<u8", data, 0, (1,))
    start, size = offsets[:-1], np.diff(offsets)
    found = mixed(size.astype(np.uint64))
    some = np.arange(len(size))
    for at in range(0, SHORT, 8):
        left = size[some] - at
        bits = (np.minimum(left, 8) * 8).astype(np.uint64)
        chunk = eight[start[some] + at] & (np.uint64(2**64 - 1) >> (np.uint64(64) - bits))
        found[some] = mixed(found[some] + chunk)
        some = some[left > 8]
        if not len(some):
            break
    long = np.nonzero(size > SHORT)[0]
    found[long] = [xxhash.xxh3_64_intdigest(data[start[i] : start[i] + size[i]].tobytes()) for i in long]
    return found


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each token of a column of texts; each text ends with END."""
    words, rows = words_of(column)
    n = len(column)
    counts = np.bincount(rows, minlength=n)
    ends = np.cumsum(counts + 1) - 1
    hashes = np.full(len(words) + n, END, np.uint64)
    where = np.ones(len(hashes), bool)
    where[ends] = False
    hashes[where] = _hashes(words)
    return hashes, np.repeat(np.arange(n), counts + 1)


def _counted(keys: np.ndarray, weights: np.ndarray | None = None) -> pa.RecordBatch:
    if weights is None:
        keys, weights = np.unique(keys, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(weights.astype(np.int64))], ["key", "n"])


def _sums(train: DataFrame, count: Callable[[Batches], Iterator[pa.RecordBatch]]) -> DataFrame:
    return train.mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def word_counts(train: DataFrame) -> DataFrame:
    """``key`` (hash) and ``n`` of every token of the training texts, the end of a text included."""

    def count(batches: Batches) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for some in (part for batch in batches for part in slices(batch, 0)):
            held.append(_tokens(some.column(0))[0])
            if sum(map(len, held)) >= HELD:
                yield _counted(np.concatenate(held))
                held = []
        if held:
            yield _counted(np.concatenate(held))

    return _sums(train, count)


class Frequent:
    """Sorted keys with counts; ``find`` gives places (-1: not there)."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order].astype(np.float64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)


def _frequent(counts: DataFrame, least: float) -> Frequent:
    table = counts.where(F.col("n") >= least).select("key", "n").toArrow()
    return Frequent(table["key"].to_numpy().astype(np.int64).view(np.uint64), table["n"].to_numpy())


SHIFT = np.uint64(24)


class Tree:
    """The tree in one process: places of words, pairs and triples, and the distributions of the kept contexts.

    Pairs are keyed by two word places, triples by the place of their first pair and that of their last word.
    """

    def __init__(self, words: Frequent, total: float, distinct: float, discount: float):
        self.words, self.total, self.distinct, self.discount = words, total, distinct, discount
        self.pairs = self.triples = Frequent(np.empty(0, np.uint64), np.empty(0))
        self.root = np.maximum(words.counts - discount, 1e-9) / max(total, 1.0)
        self.unknown = max(discount * distinct / total, 1e-12) if total else 1.0

    def places(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word places of all tokens (-1: not frequent), their rows, their distinct index and the distinct hashes."""
        tokens, rows = _tokens(column)
        hashes, index = np.unique(tokens, return_inverse=True)
        return self.words.find(hashes)[index], rows, index, hashes

    def pair_keys(self, word: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the pair that ends at each token, and where there is one."""
        there = np.zeros(len(word), bool)
        there[1:] = (rows[1:] == rows[:-1]) & (word[1:] >= 0) & (word[:-1] >= 0)
        keys = np.zeros(len(word), np.uint64)
        keys[1:] = (np.maximum(word[:-1], 0).astype(np.uint64) << SHIFT) | np.maximum(word[1:], 0).astype(np.uint64)
        return keys, there

    def pair_places(self, word: np.ndarray, rows: np.ndarray) -> np.ndarray:
        keys, there = self.pair_keys(word, rows)
        found = np.full(len(word), -1)
        found[there] = self.pairs.find(keys[there])
        return found

    def triple_keys(self, word: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        there = np.zeros(len(word), bool)
        there[1:] = (pair[:-1] >= 0) & (pair[1:] >= 0)
        keys = np.zeros(len(word), np.uint64)
        keys[1:] = (np.maximum(pair[:-1], 0).astype(np.uint64) << SHIFT) | np.maximum(word[1:], 0).astype(np.uint64)
        return keys, there

    def grow(self) -> None:
        """Tests the contexts and makes the distributions: parts of recorded words, and what is left for the suffix."""
        first = (self.pairs.keys >> SHIFT).astype(np.int64)
        last = (self.pairs.keys & np.uint64((1 << 24) - 1)).astype(np.int64)
        n = len(self.words.keys)
        self.keep_one, self.part_one, self.rest_one = _distributions(first, n, self.words.counts, self.pairs.counts, self.root[last])
        before = (self.triples.keys >> SHIFT).astype(np.int64)
        word = (self.triples.keys & np.uint64((1 << 24) - 1)).astype(np.int64)
        middle = last[before] if len(before) else before
        inner = self.pairs.find((middle.astype(np.uint64) << SHIFT) | word.astype(np.uint64))
        shorter = np.where(inner >= 0, self.part_one[inner], 0.0) if len(inner) else np.zeros(0)
        kept = self.keep_one[middle] if len(middle) else np.zeros(0, bool)
        shorter = np.where(kept, shorter + self.rest_one[middle] * self.root[word], self.root[word]) if len(middle) else shorter
        self.keep_two, self.part_two, self.rest_two = _distributions(before, len(self.pairs.keys), self.pairs.counts, self.triples.counts, shorter)
        suffix = last[np.nonzero(self.keep_two)[0]]
        self.keep_one[suffix] = True  # a suffix of a context in the tree is in the tree

    def score(self, word: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 probability of each token, and the context's length. For a word that is not frequent, without the
        root's part."""
        pair = self.pair_places(word, rows)
        keys, there = self.triple_keys(word, pair)
        triple = np.full(len(word), -1)
        triple[there] = self.triples.find(keys[there])
        previous, past = np.full(len(word), -1), np.full(len(word), -1)
        same = rows[1:] == rows[:-1]
        previous[1:] = np.where(same, word[:-1], -1)
        past[1:] = np.where(same, pair[:-1], -1)
        known = word >= 0
        p = np.where(known, self.root[np.maximum(word, 0)], 1.0) if len(self.root) else np.ones(len(word))
        length = np.zeros(len(word), np.int64)
        if len(self.keep_one):
            one = (previous >= 0) & self.keep_one[np.maximum(previous, 0)]
            p = np.where(one, p * self.rest_one[np.maximum(previous, 0)], p)
            if len(self.part_one):
                p = np.where(one & (pair >= 0), p + self.part_one[np.maximum(pair, 0)], p)
            length[one] = 1
        if len(self.keep_two):
            two = (past >= 0) & self.keep_two[np.maximum(past, 0)]
            p = np.where(two, p * self.rest_two[np.maximum(past, 0)], p)
            if len(self.part_two):
                p = np.where(two & (triple >= 0), p + self.part_two[np.maximum(triple, 0)], p)
            length[two] = 2
        return np.log10(np.maximum(p, 1e-30)), length


def _distributions(
    context: np.ndarray, n: int, context_counts: np.ndarray, counts: np.ndarray, suffix: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts kept, the discounted share of each recorded next word, and the share left to the suffix.

    ``context`` and ``counts``: of each recorded (context, next word); ``suffix``: its probability by the suffix.
    """
    total = np.maximum(context_counts[context], 1.0) if len(context) else np.zeros(0)
    share = counts / total if len(context) else np.zeros(0)
    part = np.maximum(counts - DISCOUNT, 0.0) / total if len(context) else np.zeros(0)
    left = 1.0 - np.bincount(context, part, n)
    pooled, pooled_suffix = (np.clip(1.0 - np.bincount(context, x, n), 1e-9, 1.0) for x in (share, suffix))
    terms = share * np.log(np.maximum(share, 1e-30) / np.maximum(suffix, 1e-30))
    divergence = np.bincount(context, terms, n) + pooled * np.log(pooled / pooled_suffix)
    recorded = np.bincount(context, minlength=n) > 0
    keep = recorded & (divergence >= LEAST_DIVERGENCE) & (divergence * context_counts >= LEAST_GAIN)
    return keep, part, np.clip(left, 1e-9, 1.0)


class Root(NamedTuple):
    total: float
    distinct: int
    discount: float
    unknown: float

    def chance(self, count: Column) -> Column:
        """A word's probability by its count, or that of the unknown class."""
        seen = F.greatest(count - self.discount, F.lit(1e-9)) / max(self.total, 1.0)
        return F.when(count > 0, seen).otherwise(self.unknown)


def _root(counts: DataFrame) -> Root:
    s = counts.agg(
        F.sum("n").alias("total"),
        F.count("*").alias("distinct"),
        F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("once"),
        F.sum(F.when(F.col("n") == 2, 1).otherwise(0)).alias("twice"),
    ).first()
    total, once, twice = float(s["total"] or 0), s["once"] or 0, s["twice"] or 0
    discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    return Root(total, s["distinct"], discount, max(discount * s["distinct"] / total, 1e-12) if total else 1.0)


def learn(train: DataFrame, counts: DataFrame) -> Tree:
    """The tree of the training texts (one column) in one process; ``counts`` are their word counts, written."""
    root = _root(counts)
    tree = Tree(_frequent(counts, 1.0), root.total, float(root.distinct), root.discount)

    def each(keys_of: Callable) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
        shared = train.sparkSession.sparkContext.broadcast(tree)

        def count(batches: Batches) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for some in slices(batch, 0):
                    word, rows, _, _ = shared.value.places(some.column(0))
                    keys, there = keys_of(shared.value, word, rows)
                    yield _counted(keys[there])

        return count

    tree.pairs = _frequent(_sums(train, each(lambda t, w, r: t.pair_keys(w, r))), LEAST_COUNT)
    tree.triples = _frequent(_sums(train, each(lambda t, w, r: t.triple_keys(w, t.pair_places(w, r)))), LEAST_COUNT)
    tree.grow()
    return tree


class Codes(NamedTuple):
    """A bounded list of frequent words: hashes, the most frequent ones last, and which are the few most frequent of all."""

    hashes: np.ndarray
    top: np.ndarray

    def finder(self) -> Callable[[np.ndarray], np.ndarray]:
        """Gives places in the list; for other words its length, as for the rarer ones of those that share a slot."""
        mask = np.uint64((1 << SLOTS) - 1)
        slots = np.full(1 << SLOTS, len(self.hashes), np.uint32)
        slots[self.hashes & mask] = np.arange(len(self.hashes))
        hashes = np.append(self.hashes, np.uint64(0))

        def find(words: np.ndarray) -> np.ndarray:
            at = slots[words & mask]
            return np.where(hashes[at] == words, at, np.uint32(len(self.hashes)))

        return find


def _least(counts: DataFrame, most: int) -> int:
    """A count that at most ``most`` words reach. Some hundred rows reach the driver."""
    step = F.floor(F.log2("n") * 8)
    found = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("n")).collect()
    least, words = 1 << 62, 0
    for row in sorted(found, key=lambda r: -r["step"]):
        words += row["words"]
        if words > most:
            break
        least = row["n"]
    return least


def _codes(counts: DataFrame) -> Codes:
    often = _frequent(counts, _least(counts, CODED))
    order = np.argsort(often.counts, kind="stable")
    return Codes(often.keys[order], often.counts[order] >= _least(counts, TOP))


def _packed(*columns: np.ndarray) -> bytes:
    """Columns by planes of their bytes, compressed, their lengths in front."""
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns]
    data = np.array([len(c) for c in columns], np.uint32).tobytes() + b"".join(planes)
    return len(data).to_bytes(4, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(blob: bytes, *kinds: type) -> Iterator[np.ndarray]:
    data = pa.decompress(blob[4:], int.from_bytes(blob[:4], "little"), codec="zstd", asbytes=True)
    at = 4 * len(kinds)
    for kind, n in zip(kinds, np.frombuffer(data, np.uint32, len(kinds)).tolist(), strict=True):
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        yield np.ascontiguousarray(planes.T).view(kind).reshape(n)
        at += n * width


def _dealer(codes: Codes, parts: int, turn: int) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """Makes packets (``part``, ``packet``) of the tokens that have a word before them: words, row, count, and what
    the row is for. Only the parts of a turn are made."""

    def packets(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        part, words, coded, uid, use, keys = (np.concatenate(x, axis=-1) for x in zip(*held, strict=True))
        held.clear()
        _, first, n = np.unique(keys, return_index=True, return_counts=True)
        order = np.argsort(part[first], kind="stable")
        first, n = first[order], n[order]
        cuts = np.concatenate([[0], np.nonzero(np.diff(part[first]))[0] + 1, [len(first)]])
        base = int(uid.min()) if len(uid) else 0
        names, blobs = [], []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            here = first[a:b]
            short = coded[:, here]
            long = words[:, here][short == RARE]
            row = (uid[here] - base).astype(np.uint32)
            names.append(int(part[here[0]]))
            blobs.append(_packed(np.array([base]), *short, long, row, n[a:b].astype(np.uint32), use[here]))
            if len(blobs) == 256 or b == len(first):
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(blobs, pa.binary())], ["part", "packet"])
                names, blobs = [], []

    def deal(batches: Batches) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        code = codes.finder()
        tops = np.append(codes.top, False)
        for batch in (part for whole in batches for part in slices(whole, "text")):
            hashes, rows = _tokens(batch.column("text"))
            at = code(hashes)
            short, top = np.where(at < len(codes.hashes), at, RARE).astype(np.uint16), tops[at]
            there = np.nonzero(rows[1:] == rows[:-1])[0] + 1  # tokens with a word before them
            w, v = there, there - 1
            before = np.maximum(there - 2, 0)
            second = (there < 2) | (rows[before] != rows[there])  # with one word before them alone
            u = np.where(second, len(hashes), before)
            hashes, short = np.append(hashes, START), np.append(short, np.uint16(RARE))
            pair = mixed(mixed(hashes)[v] + hashes[w])
            triple = mixed(pair + hashes[u])
            part = (np.where(top[v] & top[w], triple, pair) % np.uint64(parts)).astype(np.int64)
            kept = np.nonzero(part % TURNS == turn)[0]
            grams = np.stack([u[kept], v[kept], w[kept]])
            uid = batch.column("uid").to_numpy()[rows[there[kept]]]
            use = batch.column("use").to_numpy()[rows[there[kept]]]
            key = mixed(mixed(triple[kept] + use.astype(np.uint64)) + uid.view(np.uint64))
            held.append((part[kept], hashes[grams], short[grams], uid, use, key))
            size += len(kept)
            if size >= HELD:
                yield from packets(held)
                size = 0
        if size:
            yield from packets(held)

    return deal


def _by_part(batches: Batches, columns: list[str]) -> Iterator[tuple[int, list[np.ndarray | list]]]:
    """Rows that are sorted by ``part``, one part at a time."""
    part, held = None, []
    for batch in batches:
        of = batch.column("part").to_numpy()
        cuts = np.concatenate([[0], np.nonzero(np.diff(of))[0] + 1, [len(of)]])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if b == a:
                continue
            if held and of[a] != part:
                yield part, held
                held = []
            part = int(of[a])
            held.append(batch.slice(a, b - a).select(columns))
    if held:
        yield part, held


RECORDED = "part bigint, idx bigint, of bigint, spread boolean, u bigint, v bigint, w bigint, n bigint, places binary"


def _recorder(codes: Codes) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """Of each part the recorded pairs (``u`` null) and triples, numbered (a triple also names its pair, ``of``), and one
    row with the places of both: for each token of a recorded pair in a scored row the row, the count and the numbers.

    Pairs of the most frequent words are ``spread`` over the parts, so they are all given, with the part's count."""

    names = [column.split(" ")[0] for column in RECORDED.split(", ")]
    kinds = [*[pa.int64()] * 3, pa.bool_(), *[pa.int64()] * 4, pa.binary()]

    def opened(blob: bytes) -> tuple[np.ndarray, ...]:
        base, u, v, w, long, row, n, use = _unpacked(blob, np.int64, *[np.uint16] * 3, np.uint64, np.uint32, np.uint32, np.uint8)
        short = np.stack([u, v, w])
        words = np.append(codes.hashes, START)[np.minimum(short, len(codes.hashes))]
        words[short == RARE] = long
        return words, row + base, n.astype(np.int64), use, short

    def record(batches: Batches) -> Iterator[pa.RecordBatch]:
        for part, held in _by_part(batches, ["packet"]):
            found = [opened(blob) for some in held for blob in some.column(0).to_pylist()]
            words, uid, n, use, short = (np.concatenate(x, axis=-1) for x in zip(*found, strict=True))
            pair = mixed(mixed(words[1]) + words[2])
            order = np.lexsort((words[0], pair))
            pair, words, uid, n, use, short = pair[order], words[:, order], uid[order], n[order], use[order], short[:, order]
            learned = np.where(use & LEARNED, n, 0)
            new_pair = np.append(True, pair[1:] != pair[:-1])
            new_triple = np.append(True, words[0, 1:] != words[0, :-1]) | new_pair
            pairs, triples = np.nonzero(new_pair)[0], np.nonzero(new_triple)[0]
            n_pair, n_triple = np.add.reduceat(learned, pairs), np.add.reduceat(learned, triples)
            top = np.append(codes.top, False)[np.minimum(short[1:, pairs], len(codes.top))].all(axis=0)
            keep_pair = (n_pair >= LEAST_COUNT) | top
            keep_triple = (n_triple >= LEAST_COUNT) & (words[0, triples] != START)
            of_pair, of_triple = np.cumsum(new_pair) - 1, np.cumsum(new_triple) - 1
            placed = np.nonzero(keep_pair[of_pair] & ((use & SCORED) > 0))[0]
            number = np.cumsum(keep_pair) - 1
            number_triple = np.where(keep_triple, np.cumsum(keep_triple), 0)
            count = int(keep_pair.sum())
            at_pair, at_triple = pairs[keep_pair], triples[keep_triple]
            yield _batch(part, np.arange(count), None, top[keep_pair], None, *words[1:, at_pair], n_pair[keep_pair], None)
            of = of_pair[at_triple]
            yield _batch(part, count + np.arange(len(of)), number[of], top[of], *words[:, at_triple], n_triple[keep_triple], None)
            at, at_triple = number[of_pair[placed]], number_triple[of_triple[placed]]
            seen = np.maximum.accumulate(at_triple) if len(at_triple) else at_triple
            steps = np.diff(at, prepend=0), np.diff(seen, prepend=0)
            blob = _packed(uid[placed], n[placed].astype(np.uint32), *[s.astype(np.uint32) for s in steps], at_triple > 0)
            yield _batch(part, np.array([count]), *[None] * 6, [blob])

    def _batch(part: int, idx: np.ndarray, *columns: np.ndarray | list | None) -> pa.RecordBatch:
        given = [np.full(len(idx), part), idx, *columns]
        arrays = [
            pa.nulls(len(idx), k) if x is None else pa.array(x.view(np.int64) if k == pa.int64() else x, k)
            for x, k in zip(given, kinds, strict=True)
        ]
        return pa.RecordBatch.from_arrays(arrays, names)

    return record


PLACED = "part bigint, idx bigint, of bigint, value double, p double, places binary"


def _summed(batches: Batches) -> Iterator[pa.RecordBatch]:
    """``uid`` and ``score``: the sums over the places of each part of what pairs (their ``value``) and triples add, the
    latter by their pair's probability ``p`` (``value``: the recorded part over what the context leaves)."""
    for _, held in _by_part(batches, ["idx", "of", "value", "p", "places"]):
        rows = pa.Table.from_batches(held)
        blob = rows.filter(pc.is_valid(rows["places"]))
        pairs, triples = (rows.filter(found(rows["of"])) for found in (pc.is_null, pc.is_valid))
        pairs = pairs.filter(pc.is_valid(pairs["value"]))
        steps = pairs.filter(pc.is_valid(pairs["p"]))
        if not len(pairs) or not len(blob):
            continue
        count = blob["idx"][0].as_py()
        uid, n, at, at_triple, has = _unpacked(blob["places"][0].as_py(), np.int64, *[np.uint32] * 3, np.bool_)
        at, at_triple = np.cumsum(at, dtype=np.int64), np.cumsum(at_triple, dtype=np.int64)
        idx, of = triples["idx"].to_numpy(), triples["of"].to_numpy()
        value, p = np.zeros(count + int(max(at_triple.max(initial=0), idx.max(initial=-1) - count + 1))), np.ones(count)
        value[:count] = np.bincount(pairs["idx"].to_numpy(), pairs["value"].to_numpy(), count)
        p[steps["idx"].to_numpy()] = steps["p"].to_numpy()
        value[idx] = np.log10(1 + triples["value"].to_numpy() / p[of])
        sums = n * (value[at] + np.where(has, value[np.maximum(count + at_triple - 1, 0)], 0.0))
        some = np.nonzero(sums)[0]
        docs, of_doc = np.unique(uid[some], return_inverse=True)
        yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(np.bincount(of_doc, sums[some], len(docs)))], ["uid", "score"])


def _divergent(recorded: DataFrame, context: list[str], totals: DataFrame) -> DataFrame:
    """The contexts of the recorded next words (``n``, and ``suffix``: the probability by the shorter context), with
    their ``total`` and other columns of ``totals``, the share ``rest`` that is left to the suffix, and ``keep``. See
    _distributions."""
    n, total = F.col("n"), F.col("total")
    sums = recorded.groupBy(*context).agg(
        F.sum(n * (F.log(n) - F.log(F.greatest("suffix", F.lit(1e-30))))).alias("_terms"),
        F.sum("n").alias("_n"),
        F.sum(n - DISCOUNT).alias("_part"),
        F.sum("suffix").alias("_suffix"),
    )
    clipped = lambda x: F.least(F.greatest(1 - x, F.lit(1e-9)), F.lit(1.0))
    pooled, pooled_suffix = clipped(F.col("_n") / total), clipped(F.col("_suffix"))
    divergence = (F.col("_terms") - F.col("_n") * F.log(total)) / total + pooled * F.log(pooled / pooled_suffix)
    keep = (divergence >= LEAST_DIVERGENCE) & (divergence * total >= LEAST_GAIN)
    return sums.join(totals, context).select(*totals.columns, clipped(F.col("_part") / total).alias("rest"), keep.alias("keep"))


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table; the files of the shuffles before it go, for which the driver must collect its garbage."""
    table = written(df, purpose)
    for _ in range(2):  # what goes at first may hold the rest
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
    return table


def _values(keys: DataFrame, counts: DataFrame, root: Root) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What each word (``w``, ``c``, ``value``, ``by_context``) and each recorded pair (``id``, ``value``; as a next word also
    its probability ``p``) adds to a score, and the contexts of two words (``before``: their hash).

    A token's probability is the root's, times what each of its contexts leaves to its suffix, as long as nothing recorded
    adds a part. So a word adds the log of its root's probability and, as a context, that of its rest, a pair as a
    context that of its rest, and a recorded pair or triple the quotient of the whole and the product."""
    at_pairs = keys.where("places IS NULL AND u IS NULL").select(_id("idx").alias("id"), "spread", "v", "w", "n")
    spread = at_pairs.where("spread").groupBy("id", "v", "w").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)
    pairs = at_pairs.where("NOT spread").drop("spread").unionByName(spread)
    pairs = pairs.join(counts.withColumnRenamed("n", "c"), "w").select("id", "v", "w", "n", root.chance(F.col("c")).alias("root"))
    pairs = _stored(pairs, "pairs")
    totals = counts.select(F.col("w").alias("v"), F.col("n").alias("total"))
    one = _stored(_divergent(pairs.select("v", "n", F.col("root").alias("suffix")), ["v"], totals), "contexts-1")

    part = (F.col("n") - DISCOUNT) / F.col("total")
    there, product = F.col("rest").isNotNull(), F.col("rest") * F.col("root")

    def steps(contexts: DataFrame) -> DataFrame:
        """Each recorded pair's probability by the contexts of one word that are in the tree, else by the root."""
        return pairs.join(contexts, "v", "left").withColumn("p", F.when(there, part + product).otherwise(F.col("root")))

    first = steps(one.where("keep").drop("keep")).select("id", F.col("p").alias("suffix"))
    triples = keys.where("u IS NOT NULL").select(_id("of").alias("id"), F.xxhash64("u", "v").alias("before"), "n")
    two = triples.join(first, "id").select("before", "n", "suffix").repartition("before")  # few are of one context
    before = pairs.select(F.xxhash64("v", "w").alias("before"), F.col("n").alias("total"), "id")
    two = _stored(_divergent(two, ["before"], before).where("keep").drop("keep"), "contexts-2")

    # A suffix of a context in the tree is in the tree.
    suffixes = pairs.select("id", F.col("w").alias("v")).join(two.select("id"), "id", "left_semi")
    suffixes = suffixes.select("v").distinct().withColumn("closed", F.lit(True))
    one = one.join(suffixes, "v", "left").where(F.col("keep") | F.col("closed")).drop("keep", "closed")
    one = _stored(one, "contexts")
    words = counts.join(one.select(F.col("v").alias("w"), "rest"), "w", "left").select(
        *("w", F.col("n").alias("c"), there.alias("by_context")),
        (F.log10(root.chance(F.col("n"))) + F.coalesce(F.log10("rest"), F.lit(0.0))).alias("value"),
    )
    steps = steps(one).where(there).select("id", F.log10(F.col("p") / product).alias("value"), "p")
    left = two.select("id", F.log10("rest").alias("value"), F.lit(None).cast("double").alias("p"))
    return _stored(words, "words"), _stored(steps, "steps").unionAll(left), two


def _id(idx: str) -> Column:
    """A recorded pair: by its part and number, or, if it is spread over the parts, by its words and below zero."""
    own = F.col("part") * (1 << 32) + F.col(idx)
    return F.when(F.col("spread"), -1 - F.pmod(F.xxhash64("v", "w"), F.lit((1 << 63) - 1))).otherwise(own)


def _placed(recorded: DataFrame, mine: Callable[[Column], Column], steps: DataFrame, two: DataFrame) -> DataFrame:
    """What the recorded pairs and triples of some parts add, beside the rows with their places."""
    recorded = recorded.where(mine(F.col("part")))
    held = recorded.where("places IS NOT NULL").select("part", "idx", "places")
    at = F.floor(F.col("id") / (1 << 32)).cast("bigint")
    pairs = steps.where((F.col("id") >= 0) & mine(at)).select(at.alias("part"), (F.col("id") % (1 << 32)).alias("idx"), "value", "p")
    spread = recorded.where("spread AND u IS NULL AND places IS NULL").withColumn("id", _id("idx"))
    spread = spread.join(steps.where("id < 0"), "id").select("part", "idx", "value", "p")
    triples = recorded.where("u IS NOT NULL").withColumn("before", F.xxhash64("u", "v")).join(two, "before")
    share = (F.col("n") - DISCOUNT) / F.col("total") / F.col("rest")
    triples = triples.select("part", "idx", "of", share.alias("value"))
    frames = [held, pairs, spread, triples]
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return whole.select(*[column.split(" ")[0] for column in PLACED.split(", ")])


PARTS_OF_DOCS = "uid bigint, w bigint, n bigint, doc struct<doc_id:bigint,held_out:boolean,n_tokens:bigint,known:bigint,base:double,score:double,by_context:bigint>"


def score(docs: DataFrame, train: DataFrame | None = None) -> DataFrame:
    """Scores of all ``docs`` (``doc_id``, ``text``, ``held_out``) by a tree learned from ``train`` (``text``), or else from
    those of ``docs`` that are ``learned``. Both are read several times, and have to give the same rows in the same order."""
    spark = docs.sparkSession
    learned = F.coalesce("learned", F.lit(False)) if train is None else F.lit(False)
    rows = docs.select("doc_id", "held_out", "text", learned.alias("learned")).withColumn("uid", F.monotonically_increasing_id())
    use = (F.lit(SCORED) + F.when(F.col("learned"), LEARNED).otherwise(0)).cast("byte")
    used = rows.select("uid", use.alias("use"), "text")
    if train is None:
        train = rows.where("learned").select("text")
    else:
        used = used.unionAll(train.select(F.lit(0).cast("bigint"), F.lit(LEARNED).cast("byte"), "text"))
    counts = _stored(word_counts(train).withColumnRenamed("key", "w"), "word-counts")
    root, codes = _root(counts), _codes(counts.withColumnRenamed("w", "key"))
    parts = partitions(spark) * PARTS * TURNS
    turns = []
    for turn in range(TURNS):
        dealt = used.mapInArrow(_dealer(codes, parts, turn), "part bigint, packet binary")
        dealt = dealt.repartition(partitions(spark), "part").sortWithinPartitions("part")
        turns.append(_stored(dealt.mapInArrow(_recorder(codes), RECORDED), f"recorded-{turn}"))
    words, steps, two = _values(reduce(DataFrame.unionAll, turns), counts, root)
    sums = []
    for share in range(TURNS * SHARES):
        mine = lambda part: part % (TURNS * SHARES) == share  # noqa: B023, E731
        placed = _placed(turns[share % TURNS], mine, steps, two).repartition(partitions(spark), "part")
        found = placed.sortWithinPartitions("part").mapInArrow(_summed, "uid bigint, score double")
        sums.append(_stored(found.groupBy("uid").agg(F.sum("score").alias("score")), f"sums-{share}"))

    often = words.where(F.col("c") >= _least(counts, LISTED)).toArrow().sort_by("c")
    known = [often[c].to_numpy() for c in ("c", "value", "by_context")]
    listed = Codes(often["w"].to_numpy().astype(np.int64).view(np.uint64), np.zeros(len(often), bool))
    unknown = float(np.log10(root.unknown))

    def of_words(batches: Batches) -> Iterator[pa.RecordBatch]:
        names = [f.split(":")[0] for f in PARTS_OF_DOCS.split("<")[1].removesuffix(">").split(",")]
        of = [np.append(x, 0.0) for x in (np.ones(len(known[0])), np.log10(known[0] + 0.1), *known[1:])]
        code = listed.finder()
        for batch in (part for whole in batches for part in slices(whole, "text")):
            n = batch.num_rows
            hashes, row = _tokens(batch.column("text"))
            at = code(hashes)
            sums = [np.bincount(row, x[at], n) for x in of]
            tokens = pa.array(np.bincount(row, minlength=n).astype(np.int64))
            of_docs = [batch.column("doc_id"), batch.column("held_out"), tokens, *[pa.array(s.astype(t)) for s, t in zip(sums, (np.int64, float, float, np.int64))]]
            kinds = pa.struct(list(zip(names, [pa.int64(), pa.bool_(), *[pa.int64()] * 2, *[pa.float64()] * 2, pa.int64()])))
            doc = pa.StructArray.from_arrays(of_docs, fields=list(kinds))
            uid = batch.column("uid")
            apart = pa.array(mixed(uid.to_numpy().view(np.uint64)).view(np.int64))  # so that these rows meet in no one task
            yield pa.RecordBatch.from_arrays([uid, apart, pa.nulls(n, pa.int64()), doc], ["uid", "w", "n", "doc"])
            other = np.nonzero(at == len(known[0]))[0]
            other = other[np.lexsort((hashes[other], row[other]))]
            new = np.nonzero(np.append(True, (np.diff(row[other]) != 0) | (np.diff(hashes[other]) != 0)))[0] if len(other) else other
            first = other[new]
            rare = [uid.to_numpy()[row[first]], hashes[first].view(np.int64), np.diff(new, append=len(other))]
            yield pa.RecordBatch.from_arrays([*[pa.array(x) for x in rare], pa.nulls(len(first), kinds)], ["uid", "w", "n", "doc"])

    # What the frequent words add is summed where the texts are read; the others meet their values by a join.
    of_docs = rows.select("uid", "doc_id", "held_out", "text").mapInArrow(of_words, PARTS_OF_DOCS)
    found = of_docs.join(words, "w", "left")
    n, c = F.col("n"), F.coalesce("c", F.lit(0))
    by_words = found.select(
        "uid",
        "doc",
        F.when(F.col("doc").isNotNull(), F.col("doc.known")).otherwise(F.when(c > 0, n).otherwise(0)).alias("known"),
        F.when(F.col("doc").isNotNull(), F.col("doc.base")).otherwise(n * F.log10(c + 0.1)).alias("base"),
        F.when(F.col("doc").isNotNull(), F.col("doc.score")).otherwise(n * F.coalesce("value", F.lit(unknown))).alias("score"),
        F.when(F.col("doc").isNotNull(), F.col("doc.by_context")).otherwise(F.when(F.col("by_context"), n).otherwise(0)).alias("by_context"),
    )
    nothing = [F.lit(None).cast(by_words.schema[x].dataType).alias(x) for x in ("doc", "known", "base")]
    by_keys = reduce(DataFrame.unionAll, sums).select("uid", *nothing, "score", F.lit(None).cast("bigint").alias("by_context"))
    whole = by_words.unionAll(by_keys).groupBy("uid").agg(
        F.max("doc").alias("doc"), *[F.sum(x).alias(x) for x in ("known", "base", "score", "by_context")]
    )
    norm = float(np.log10(root.total + 0.1 * (root.distinct + 1)))
    return whole.select(
        *("doc.doc_id", "doc.held_out", "doc.n_tokens"),
        F.col("known").alias("n_known"),
        F.lit(int(root.total)).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("doc.n_tokens") * norm).alias("base_score"),
        "score",
        F.col("by_context").alias("n_by_context"),
    )


def op1_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string")) % 10
    docs = texts(documents(spark, sf_dir)).withColumn("held_out", F.coalesce(remainder == 0, F.lit(False)))
    return score(docs.withColumn("learned", F.coalesce(remainder != 0, F.lit(False))))
