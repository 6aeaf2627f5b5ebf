"""Jaccard join on word shingles by T-occurrence search, and the groups that its links form.

1. Each document becomes a set of hashed shingles; equal sets are one class, known by a digest.
2. Map tasks send their sets' shingles to ranges of the hash space as compressed blocks. There the inverted lists are
   counted; only entries of lists with two documents or more return, with the list's length (on a log scale). A pair
   must share at least 80 percent of either set, so a document with fewer shared shingles has no partner and drops
   out; what is left is its shared shingles, ordered from the shortest list to the longest.
3. A document posts the shortest lists it is in: so many that a partner must be in one of them. In each list one
   member, of the largest group so far, is the query for all others that are not in its group yet; after two such
   rounds the pairs that are left in the lists across groups are searched one by one. The work in a list of near
   copies is thus in proportion to the list, and no link between groups is lost.
4. A search holds one query and a block of candidates: T is the overlap that a candidate of that size needs. DivideSkip
   sets the L longest lists of the query aside, merges the others with a heap, keeps candidates with T - L hits, and
   looks those up in the long lists by binary search.
5. Links become groups by repeated star contraction; every table lies in the shared folder, none on the driver.

Nulls: a document without words or text has an empty set and is linked with nothing; a null ``doc_id`` has no name to
give, so it takes the smallest other ``doc_id`` of its group, or null. A set that only such documents have is linked
like any other, under a hash of its digest. Documents with equal sets, repeated rows among
them, are linked. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MIX, documents, mixed, partitions, slices, texts, word_hashes, words_of, written

SHINGLE = 5
SHARE = 80  # percent
HUB_ROUNDS = 2
HUBS = 12  # members of a group that serve as queries in a round, so that they differ
FLUSH = 2_000_000  # postings that a map task gathers before it sends them
BUCKET = 1_000_000  # postings of a range of the hash space, about
BLOCK = 512  # candidates of a search; members of a list that meet in one step

Batches = Iterable[pa.RecordBatch]


def needed(one, other):
    """The overlap that makes two sets of these sizes a link."""
    return -(-SHARE * (one + other) // (100 + SHARE))


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, ascending within the row, and the row of each."""
    words, rows = words_of(column)
    if not len(words):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    index, hashes = word_hashes(words)
    word = mixed(hashes)[index]
    count = np.bincount(rows, minlength=len(column))
    n = max(0, len(word) - SHINGLE + 1)
    found = word[:n].copy()
    for k in range(1, SHINGLE):
        found = mixed(found * MIX + word[k : n + k])
    inside = rows[:n] == rows[SHINGLE - 1 :][:n]
    found, owner = found[inside], rows[:n][inside]
    first = np.cumsum(count) - count
    short = np.nonzero((count > 0) & (count < SHINGLE))[0]
    whole = [xxhash.xxh3_64_intdigest(word[first[r] : first[r] + count[r]].tobytes()) for r in short]
    found, owner = np.concatenate([found, np.array(whole, np.uint64)]), np.concatenate([owner, short])
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.append(True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])) if len(found) else np.empty(0, bool)
    return found[new], owner[new]


def _sets(column: pa.Array) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Row, digest and set of each text with a word."""
    found, owner = shingle_sets(column)
    bounds = np.searchsorted(owner, np.arange(len(column) + 1))
    for row in np.nonzero(np.diff(bounds))[0]:
        own = found[bounds[row] : bounds[row + 1]]
        yield int(row), xxhash.xxh3_128_digest(own.tobytes()), own


def members(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``th`` (hash of the text), ``n`` (set size) and ``sig`` (digest of the set, null if it is empty) of
    every row."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            n, sig = [0] * batch.num_rows, [None] * batch.num_rows
            for row, digest, own in _sets(batch.column(1)):
                n[row], sig[row] = len(own), digest
            columns = [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(sig, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "th", "n", "sig"])

    rows = texts(docs).withColumn("th", F.xxhash64("text"))
    return rows.mapInArrow(run, "doc_id bigint, th bigint, n bigint, sig binary")


# --- blocks of postings ------------------------------------------------------------------------------


def _packed(values: np.ndarray) -> bytes:
    """Byte planes of the numbers, compressed: the high bytes of small numbers cost next to nothing."""
    return zstandard.compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes(), 1)


def _unpacked(block: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(block), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


BLOCKS = "target bigint, source bigint, a binary, b binary, c binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    columns = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds]
    return pa.RecordBatch.from_arrays(columns, names)


def _postings(buckets: int):
    """Blocks of postings for each range of the hash space (``target``), and one block per source that lists its
    documents (``c`` is their sizes, ``a`` their digests). Sets that are equal within a source are posted once."""

    def send(source: int, digests: dict[bytes, int], sizes: list[int], found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        hashes = np.concatenate(found)
        owner = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
        order = np.argsort(hashes)
        hashes, owner = hashes[order], owner[order]
        bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cuts = np.append(np.nonzero(np.append(True, bucket[1:] != bucket[:-1]))[0], len(bucket))
        rows = []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            steps = np.diff(hashes[a:b], prepend=np.uint64(0))
            rows.append((int(bucket[a]), source, _packed(steps), _packed(owner[a:b]), None))
        home = (source * 0x9E3779B97F4A7C15 >> 20) % buckets
        rows.append((home, source, b"".join(digests), None, _packed(np.array(sizes, np.uint32))))
        yield _rows(rows)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        source, digests, sizes, found, held = TaskContext.get().partitionId() << 32, {}, [], [], 0
        for batch in batches:
            for some in slices(batch, 0):
                for _, digest, own in _sets(some.column(0)):
                    if digest not in digests:
                        digests[digest] = len(sizes)
                        sizes.append(len(own))
                        found.append(own)
                        held += len(own)
                if held >= FLUSH:
                    yield from send(source, digests, sizes, found)
                    source, digests, sizes, found, held = source + 1, {}, [], [], 0
        if held:
            yield from send(source, digests, sizes, found)

    return run


def _by(batches: Batches, key: str) -> Iterator[tuple[int, list[dict]]]:
    """Rows of each key; the rows come sorted by it."""

    def rows() -> Iterator[dict]:
        for batch in batches:
            yield from batch.to_pylist()

    for k, group in groupby(rows(), key=lambda r: r[key]):
        yield k, list(group)


def _count_lists(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Entries of lists with two members or more, back to their sources: owners, hashes, log length."""
    for _, rows in _by(batches, "target"):
        out = [(r["source"], r["source"], r["a"], None, r["c"]) for r in rows if r["c"] is not None]
        blocks = [(r["source"], np.cumsum(_unpacked(r["a"], np.uint64), dtype=np.uint64), _unpacked(r["b"], np.uint32)) for r in rows if r["c"] is None]
        if blocks:
            hashes = np.concatenate([h for _, h, _ in blocks])
            source = np.repeat(np.arange(len(blocks)), [len(h) for _, h, _ in blocks])
            owner = np.concatenate([o for _, _, o in blocks])
            order = np.argsort(hashes, kind="stable")
            hashes, source, owner = hashes[order], source[order], owner[order]
            cuts = np.append(np.nonzero(np.append(True, hashes[1:] != hashes[:-1]))[0], len(hashes))
            length = np.repeat(np.diff(cuts), np.diff(cuts))
            kept = length > 1
            hashes, source, owner, length = hashes[kept], source[kept], owner[kept], length[kept]
            scale = np.minimum(255, np.log2(np.maximum(length, 1)) * 6).astype(np.uint8)
            order = np.argsort(source, kind="stable")
            cuts = np.searchsorted(source[order], np.arange(len(blocks) + 1))
            for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if b > a:
                    these = order[a:b]
                    steps = np.diff(hashes[these], prepend=np.uint64(0))
                    data = owner[these].astype("<u4").tobytes() + scale[these].tobytes()
                    out.append((blocks[i][0], blocks[i][0], _packed(steps), zstandard.compress(data, 1), None))
        yield _rows(out)


SETS = "sig binary, n bigint, shared binary"


def _survivors(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Documents that share enough for a partner: digest, size, shared hashes from the shortest list to the longest."""
    for _, rows in _by(batches, "target"):
        listing = next(r for r in rows if r["c"] is not None)
        sizes = _unpacked(listing["c"], np.uint32).astype(np.int64)
        hashes, owners, scales = [], [], []
        for r in rows:
            if r["c"] is None:
                hashes.append(np.cumsum(_unpacked(r["a"], np.uint64), dtype=np.uint64))
                data, n = zstandard.decompress(r["b"]), len(hashes[-1])
                owners.append(np.frombuffer(data, "<u4", n))
                scales.append(np.frombuffer(data, np.uint8, n, 4 * n))
        if not hashes:
            continue
        h, owner, scale = np.concatenate(hashes), np.concatenate(owners), np.concatenate(scales)
        shared = np.bincount(owner, minlength=len(sizes))
        alive = shared >= -(-SHARE * sizes // 100)
        kept = alive[owner]
        h, owner, scale = h[kept], owner[kept], scale[kept]
        order = np.lexsort((h, scale, owner))
        h, owner = h[order], owner[order]
        bounds = np.searchsorted(owner, np.arange(len(sizes) + 1))
        these = np.nonzero(alive)[0]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([listing["a"][16 * i : 16 * i + 16] for i in these], pa.binary()),
                pa.array(sizes[these]),
                pa.array([h[bounds[i] : bounds[i + 1]].tobytes() for i in these], pa.binary()),
            ],
            ["sig", "n", "shared"],
        )


def candidate_sets(docs: DataFrame, total: int) -> DataFrame:
    """:data:`SETS` of all documents that share 80 percent of their shingles with others; equal sets may repeat.
    ``total``: shingles of all sets, which sets the number of ranges of the hash space."""
    n = partitions(docs.sparkSession)
    blocks = texts(docs).select("text").mapInArrow(_postings(max(4 * n, total // BUCKET)), BLOCKS)
    blocks = blocks.repartition(n, "target").sortWithinPartitions("target")
    back = blocks.mapInArrow(_count_lists, BLOCKS).repartition(n, "target").sortWithinPartitions("target")
    return back.mapInArrow(_survivors, SETS)


# --- lists, queries, links ---------------------------------------------------------------------------


def prefix_postings(sets: DataFrame) -> DataFrame:
    """``h``, ``v``, ``n``, ``pos``: the shortest lists of each document, one of which any partner is in."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            hs, vs, ns, ps = [], [], [], []
            for one, size, shared in zip(v, n, batch.column(2).to_pylist(), strict=True):
                own = np.frombuffer(shared, np.uint64)
                alone = int(size) - len(own)
                prefix = int(size) - -(-SHARE * int(size) // 100) + 1 - alone
                own = own[: max(0, prefix)]
                hs.append(own.view(np.int64))
                vs.append(np.full(len(own), one))
                ns.append(np.full(len(own), size))
                ps.append(alone + np.arange(len(own)))
            columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in (hs, vs, ns, ps)] if hs else [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays(columns, ["h", "v", "n", "pos"])

    return sets.mapInArrow(run, "h bigint, v bigint, n bigint, pos bigint")


def divide_skip(query: np.ndarray, size: int, candidates: list[tuple[int, int, np.ndarray]]) -> list[int]:
    """Ids of the candidates (id, size of the set, shared hashes) that overlap with the query as much as they need."""
    sizes = np.array([n for _, n, _ in candidates], np.int64)
    need = needed(sizes, size)
    order = np.argsort(query)
    owner = np.repeat(np.arange(len(candidates)), [len(s) for _, _, s in candidates])
    hashes = np.concatenate([s for _, _, s in candidates])
    at = np.minimum(np.searchsorted(query[order], hashes), len(query) - 1)
    hit = query[order][at] == hashes
    place, owner = order[at[hit]], owner[hit]
    by_list = np.argsort(place, kind="stable")
    cuts = np.searchsorted(place[by_list], np.arange(len(query) + 1))
    lists = sorted((owner[by_list[a:b]] for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a), key=len)
    least = int(need.min())
    if len(lists) < least:
        return []
    longest = len(lists[-1])
    aside = min(least - 1, int(least / (0.1 * math.log2(longest + 1) + 1)))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    found = []
    for one, hits in groupby(heapq.merge(*(x.tolist() for x in short))):
        count = sum(1 for _ in hits)
        if count >= need[one] - aside:
            for entries in long:
                k = np.searchsorted(entries, one)
                count += k < len(entries) and entries[k] == one
            if count >= need[one]:
                found.append(candidates[one][0])
    return found


def _search(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Rows come by query and block, the query's own row first."""
    for batch_rows in _groups(batches):
        head, rest = batch_rows[0], batch_rows[1:]
        query = np.frombuffer(head["shared"], np.uint64)
        found = divide_skip(query, head["n"], [(r["v"], r["n"], np.frombuffer(r["shared"], np.uint64)) for r in rest]) if rest else []
        yield pa.RecordBatch.from_arrays(
            [pa.array([head["v"]] * len(found), pa.int64()), pa.array(found, pa.int64())], ["a", "b"]
        )


def _groups(batches: Batches) -> Iterator[list[dict]]:
    def rows() -> Iterator[dict]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                yield from batch.slice(at, BLOCK).to_pylist()

    for _, group in groupby(rows(), key=lambda r: (r["a"], r["block"])):
        yield list(group)


def links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the distinct ``pairs`` (a: query, b: candidate) that are links. A query's candidates are searched in
    blocks of about :data:`BLOCK`."""
    n = partitions(pairs.sparkSession)
    counts = pairs.groupBy("a").agg(F.count("*").alias("of_a"))
    blocks = F.ceil(F.col("of_a") / BLOCK)
    cut = pairs.join(counts, "a").select("a", "b", F.pmod(F.xxhash64("b"), blocks).alias("block"))
    queries = cut.select("a", "block").distinct().join(sets, F.col("a") == F.col("v"))
    others = cut.join(sets, F.col("b") == F.col("v"))
    rows = queries.select("a", "block", F.lit(0).alias("role"), "v", "n", "shared").unionByName(
        others.select("a", "block", F.lit(1).alias("role"), "v", "n", "shared")
    )
    dealt = rows.repartition(n, "a", "block").sortWithinPartitions("a", "block", "role", "v")
    return dealt.mapInArrow(_search, "a bigint, b bigint")


def stars(edges: DataFrame) -> bool:
    """Whether each ``a`` has one ``b`` and no ``b`` is an ``a``: then a further step would change nothing."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up = down").isEmpty()


def groups(edges: DataFrame) -> DataFrame:
    """``v`` and ``c``: the smallest member of the group of each end of an edge (``a``, ``b``), by star contraction.

    Both halves of a step are written, and rows meet by sorting: as one plan with broadcasts, each step made the driver
    plan the first half's join three times and build a table for each of four joins."""
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not stars(edges):
        # every larger neighbour to the smallest of a's neighbours and a
        near = both(edges)
        smallest = near.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = near.where("b > a").join(smallest.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), "larger-links")
        # every smaller neighbour, and a, to the smallest of them
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest.hint("merge"), "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(small.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct(), "links")
    return edges.select(F.col("a").alias("v"), F.col("b").alias("c"))


def _named(postings: DataFrame, group: DataFrame | None) -> DataFrame:
    """Postings with ``c`` and ``size``: the group of ``v`` so far and its number of members."""
    if group is None:
        return postings.withColumn("c", F.col("v")).withColumn("size", F.lit(1).cast("long"))
    sizes = group.groupBy("c").agg((F.count("*") + 1).alias("size"))
    known = group.join(sizes, "c")
    known = known.select("v", "c", "size").unionByName(sizes.select(F.col("c").alias("v"), "c", "size"))
    joined = postings.join(known, "v", "left")
    return joined.withColumns({"c": F.coalesce("c", "v"), "size": F.coalesce("size", F.lit(1).cast("long"))})


def _possible(n1: str, pos1: str, n2: str, pos2: str):
    a, b = F.col(n1), F.col(n2)
    enough = F.least(a - F.col(pos1), b - F.col(pos2)) >= F.ceil(SHARE * (a + b) / (100 + SHARE))
    return (100 * F.least(a, b) >= SHARE * F.greatest(a, b)) & enough


def hub_pairs(named: DataFrame) -> DataFrame:
    """In every list: one member of its largest group as ``a``, and each member of other groups as ``b``."""
    turn = F.when(F.col("size") == 1, -F.col("n")).otherwise(F.xxhash64("v", F.pmod("h", F.lit(HUBS))))
    hub = F.max(F.struct("size", turn.alias("turn"), "v", "c", "n", "pos")).alias("hub")
    lists = named.groupBy("h").agg(hub, F.min("c").alias("c1"), F.max("c").alias("c2")).where("c1 <> c2")
    met = named.join(lists.select("h", "hub"), "h").where("c <> hub.c")
    met = met.select("n", "pos", F.col("hub.n").alias("n2"), F.col("hub.pos").alias("pos2"), F.col("hub.v").alias("a"), F.col("v").alias("b"))
    return met.where(_possible("n", "pos", "n2", "pos2")).select("a", "b").distinct()


SLOTS = 128
FULL = 2**16 - 1


def slot_counts(sets: DataFrame) -> DataFrame:
    """``v`` and ``slots``: how many shared hashes fall into each of :data:`SLOTS` parts. The sum of the smaller counts
    is never below the overlap of two sets."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                np.minimum(np.bincount(np.frombuffer(s, np.uint64) % np.uint64(SLOTS), minlength=SLOTS), FULL).astype("<u2").tobytes()
                for s in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["v", "slots"])

    return sets.select("v", "shared").mapInArrow(run, "v bigint, slots binary")


def rest_pairs(named: DataFrame, sets: DataFrame) -> DataFrame:
    """All possible pairs across groups that meet in a list. A long list is cut into blocks; every two of its blocks
    meet in one step. A pair whose slot counts rule a link out is left out."""
    lists = named.groupBy("h").agg(F.min("c").alias("c1"), F.max("c").alias("c2"), F.count("*").alias("k")).where("c1 <> c2")
    blocks = F.ceil(F.col("k") / (4 * BLOCK)).cast("int")
    rows = named.join(lists.select("h", blocks.alias("blocks")), "h")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, "own").alias("x"), F.greatest(x, "own").alias("y")))
    rows = rows.select("h", "v", "n", "pos", "c", "own", F.explode(every).alias("step"))
    rows = rows.select("h", "v", "n", "pos", "c", "own", "step.x", "step.y").join(slot_counts(sets), "v")
    rows = rows.select("h", "v", "n", "pos", "c", "own", "x", "y", "slots")

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            pairs = np.unique(np.concatenate(held), axis=0) if held else np.empty((0, 2), np.int64)
            held.clear()
            first = np.nonzero(np.append(True, pairs[1:, 0] != pairs[:-1, 0]))[0] if len(pairs) else np.empty(0, np.int64)
            offsets = pa.array(np.append(first, len(pairs)).astype(np.int32))
            partners = pa.ListArray.from_arrays(offsets, pa.array(pairs[:, 1])) if len(pairs) else pa.array([], pa.list_(pa.int64()))
            return pa.RecordBatch.from_arrays([pa.array(pairs[first, 0]), partners], ["a", "partners"])

        def stream() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        size = 0
        for (_, x, y), group in groupby(stream(), key=lambda r: (r[0], r[6], r[7])):
            members = list(group)
            t = np.array([r[1:6] for r in members], np.int64)
            slots = np.frombuffer(b"".join(r[8] for r in members), "<u2").reshape(len(members), SLOTS).astype(np.int32)
            slots[slots == FULL] = 1 << 24  # or more: as good as no bound
            here, there = (t[:, 4] == x, t[:, 4] == y)
            one, other, own_slots, other_slots = t[here], t[there], slots[here], slots[there]
            for (v, n, pos, c, _), own in zip(one, own_slots, strict=True):
                ok = other[:, 3] != c
                ok &= 100 * np.minimum(other[:, 1], n) >= SHARE * np.maximum(other[:, 1], n)
                ok &= np.minimum(other[:, 1] - other[:, 2], n - pos) >= needed(other[:, 1], n)
                if x == y:
                    ok &= other[:, 0] > v
                if ok.any():
                    bound = np.minimum(other_slots[ok], own).sum(axis=1)
                    w = other[ok, 0][bound >= needed(other[ok, 1], n)]
                    held.append(np.column_stack([np.minimum(w, v), np.maximum(w, v)]))
                    size += len(w)
            if size > 500_000:
                yield out()
                size = 0
        yield out()

    n = partitions(named.sparkSession)
    dealt = rows.repartition(n, "h", "x", "y").sortWithinPartitions("h", "x", "y")
    met = dealt.mapInArrow(run, "a bigint, partners array<bigint>")
    partners = met.groupBy("a").agg(F.array_distinct(F.flatten(F.collect_list("partners"))).alias("partners"))
    return partners.select("a", F.explode("partners").alias("b"))


def similar_groups(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` of every row, ``th`` (hash of its text), ``sig`` (of its set),
    ``linked`` (a name of its group that is never null, but for documents without words)."""
    rows = written(members(docs), "shingle-members")
    total = rows.agg(F.sum("n")).first()[0] or 0
    named = rows.where("sig IS NOT NULL").groupBy("sig").agg(F.min("doc_id").alias("least"))
    named = named.withColumn("v", F.coalesce("least", F.xxhash64("sig")))
    found = candidate_sets(docs, total).groupBy("sig").agg(F.first("n").alias("n"), F.first("shared").alias("shared"))
    sets = written(found.join(named.drop("least"), "sig").select("v", "n", "shared"), "shingle-sets")
    postings = written(prefix_postings(sets), "shingle-lists")
    group, tested = None, None
    for step in range(HUB_ROUNDS + 1):
        state = written(_named(postings, group), "shingle-groups")
        pairs = hub_pairs(state) if step < HUB_ROUNDS else rest_pairs(state, sets)
        pairs = pairs.select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y"), "a", "b")
        pairs = pairs.dropDuplicates(["x", "y"])
        pairs = written(pairs if tested is None else pairs.join(tested, ["x", "y"], "left_anti"), "shingle-pairs")
        tested = pairs.select("x", "y") if tested is None else tested.unionByName(pairs.select("x", "y"))
        new = written(links(pairs.select("a", "b"), sets), "shingle-links")
        group = groups(new if group is None else new.unionByName(group.select(F.col("v").alias("a"), F.col("c").alias("b"))))
    of_sets = named.join(group, "v", "left").select(F.col("sig").alias("key"), "least", F.coalesce("c", "v").alias("linked"))
    # A group's smallest name is its smallest doc_id, unless one of its sets has a hash for a name.
    unnamed = of_sets.groupBy("linked").agg(F.min("least").alias("smallest"), F.count("*").alias("k"), F.count("least").alias("ids"))
    unnamed = unnamed.where("ids < k").select("linked", "smallest", F.lit(True).alias("unnamed"))
    component = F.when(F.col("unnamed"), F.col("smallest")).otherwise(F.col("linked"))
    of_sets = of_sets.join(unnamed, "linked", "left").select("key", "linked", component.alias("component_id"))
    alone = F.concat(F.lit("no set "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")
    return rows.withColumn("key", F.coalesce("sig", alone)).join(of_sets, "key", "left").select(
        *("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")),
        *("th", "sig", "linked"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest ``doc_id``, with the input's columns.

    Rows with equal id and text are one document. Documents without words are in no group and stay.
    """
    found = similar_groups(docs)
    group = F.coalesce(F.concat(F.lit("set "), "linked"), F.col("doc_id").cast("string"), F.concat(F.lit("-"), "th"))
    did = F.coalesce("doc_id", F.lit(2**63 - 1))
    first = found.groupBy(group.alias("group"), F.when(F.col("sig").isNull(), F.col("th")).alias("empty"))
    first = first.agg(F.min(F.struct(did.alias("did"), "th")).alias("first")).select("first.*").distinct()
    rows = docs.select(F.struct("*").alias("row"), did.alias("did"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"))
    return rows.join(first, ["did", "th"], "left_semi").dropDuplicates(["did", "th"]).select("row.*")


def op5_shingle_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(documents(spark, sf_dir)).drop("th", "sig", "linked")
