"""Document fingerprints by locally consistent parsing.

A text is a sequence of symbols. Runs of one symbol become one symbol; then deterministic coin tossing compares each
symbol with its left neighbour (twice the place of the lowest differing bit, plus that bit), which four times over
leaves labels below six that still differ from their neighbours. Local maxima of the labels start the phrases. A
phrase's name is a hash of what it spells, and the names are the symbols of the next level. Where a phrase ends
depends only on a few neighbours, so equal stretches of text have equal phrases inside, wherever they stand.

The fingerprint is a bottom-k sketch of the phrase names from the second level up: the ``SKETCH`` smallest hashes.
The likeness of two fingerprints is the share of common hashes among the smallest of both, an estimate of the
Jaccard similarity of their phrases.

Nulls: a null text is empty, has an empty fingerprint, and two empty fingerprints are alike (1.0); a null ``doc_id``
is ordered before all others. Rows of one id follow each other by text. A single row is its own successor. An empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MIX, documents, mixed, partitions, texts

LEVELS = 6
FIRST_LEVEL = 2
SKETCH = 64
TOSSES = 4
CHUNK = 1_500_000  # characters that are parsed at once, many texts together

U1 = np.uint64(1)


def _place(differ: np.ndarray) -> np.ndarray:
    """The place of the lowest bit that is set."""
    return ((differ & (~differ + U1)).astype(np.float64).view(np.int64) >> 52) - 1023


#: Labels that were tossed once are below 128: the place of their lowest differing bit is looked up.
PLACES = np.append(0, _place(np.arange(1, 256).astype(np.uint64))).astype(np.uint8)


def _toss(labels: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Twice the place of the lowest bit that differs from the left neighbour, plus that bit."""
    one = labels.dtype.type(1)
    differ = np.empty_like(labels)
    np.bitwise_xor(labels[1:], labels[:-1], out=differ[1:])
    differ[first] = one  # no left neighbour: as if the lowest bit differed
    place = PLACES[differ] if labels.dtype == np.uint8 else _place(differ).astype(labels.dtype)
    tossed = labels >> place
    tossed &= one
    place <<= one
    place |= tossed
    return place.astype(np.uint8, copy=False)


def _level(names: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of the sequences that stand one after the other in ``names``, and whose they are."""
    change = np.empty(len(names), bool)
    change[0] = True
    np.not_equal(names[1:], names[:-1], out=change[1:])
    new_owner = np.empty(len(names), bool)
    new_owner[0] = True
    np.not_equal(owner[1:], owner[:-1], out=new_owner[1:])
    at = np.nonzero(change | new_owner)[0]
    runs = np.diff(np.append(at, len(names))).astype(np.uint64)
    names, owner, first = names[at], owner[at], np.nonzero(new_owner[at])[0]
    labels = names
    for _ in range(TOSSES):
        labels = _toss(labels, first)
    start = np.zeros(len(names), bool)
    start[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    last = np.append(first[1:], len(names)) - 1
    start[last] = False  # its right neighbour belongs to another text
    start[first] = True
    phrase = np.nonzero(start)[0]
    length = np.diff(np.append(phrase, len(names)))
    inside = (np.arange(len(names)) - np.repeat(phrase, length)).astype(np.uint64)
    spelled = mixed(mixed(names + runs * MIX) ^ (inside + U1) * MIX)
    return mixed(np.add.reduceat(spelled, phrase)), owner[phrase]


def parse(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Names and owners of all phrases, level by level."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    for _ in range(LEVELS):
        if not len(points):
            return
        points, owner = _level(points, owner)
        yield points, owner


def _by_owner(names: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """The order by owner, then name: by one key of the owner and the names' first bits if those tell names apart."""
    bits = np.uint64(max(owners - 1, 1).bit_length())
    order = np.argsort((owner.astype(np.uint64) << (np.uint64(64) - bits)) | (names >> bits))
    sorted_names, sorted_owner = names[order], owner[order]
    if np.any((sorted_names[1:] < sorted_names[:-1]) & (sorted_owner[1:] == sorted_owner[:-1])):
        return np.lexsort((names, owner))
    return order


def sketches(texts: list[str], size: int = SKETCH) -> list[np.ndarray]:
    """The smallest distinct phrase hashes of each text, ascending."""
    levels = list(parse(texts))[FIRST_LEVEL - 1 :]
    if not levels:
        return [np.empty(0, np.uint64) for _ in texts]
    names, owner = np.concatenate([n for n, _ in levels]), np.concatenate([o for _, o in levels])
    order = _by_owner(names, owner, len(texts))
    names, owner = names[order], owner[order]
    new = np.append(True, (names[1:] != names[:-1]) | (owner[1:] != owner[:-1]))
    names, owner = names[new], owner[new]
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [names[a : min(b, a + size)] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def likeness(one: np.ndarray, other: np.ndarray, size: int = SKETCH) -> float:
    if not len(one) and not len(other):
        return 1.0
    smallest = np.union1d(one, other)[:size]
    return float(np.isin(smallest, one).__and__(np.isin(smallest, other)).mean())


def _printed(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as many characters from the start of the following text."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of each document."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, some = batch.column(0), batch.column(1).to_pylist()
            for a, b in _chunks([len(t) for t in some]):
                found = [_printed(s) for s in sketches(some[a:b])]
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    return texts(docs).mapInArrow(run, "doc_id bigint, fingerprint string")


def _chunks(lengths: list[int]) -> Iterator[tuple[int, int]]:
    start = size = 0
    for at, n in enumerate(lengths):
        if size and size + n > CHUNK:
            yield start, at
            start, size = at, 0
        size += n
    if lengths:
        yield start, len(lengths)


def with_next(docs: DataFrame) -> DataFrame:
    """Documents dealt out by ranges of ``doc_id`` and sorted, each range closed by the first document of the next.

    The bounds of the ranges are quantiles, fixed before the rows are dealt, and there are a few for each partition.
    Rows: ``bucket``, ``closing`` (this row only closes the bucket), ``doc_id``, ``text``.
    """
    rows = texts(docs).withColumn("key", F.coalesce("doc_id", F.lit(-(2**63))))
    n = partitions(docs.sparkSession)
    bounds = np.unique(rows.approxQuantile("key", [i / (8 * n) for i in range(1, 8 * n)], 0.1 / n) if n > 1 else [])

    @F.pandas_udf("int")
    def bucket_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(np.float64), "right").astype(np.int32))

    firsts = rows.groupBy(bucket_of("key").alias("bucket")).agg(F.min("key").alias("key")).collect()  # one per range
    found = sorted((r["bucket"], r["key"]) for r in firsts)
    closes = {key: found[i - 1][0] for i, (_, key) in enumerate(found)}
    keys = np.array(sorted(closes), np.int64)
    before = np.array([closes[k] for k in keys.tolist()], np.int32)

    @F.pandas_udf("array<int>")
    def buckets(key: pd.Series) -> pd.Series:
        own = np.searchsorted(bounds, key.to_numpy(np.float64), "right").astype(np.int32)
        at = np.minimum(np.searchsorted(keys, key.to_numpy()), len(keys) - 1)
        return pd.Series([[o, before[a]] if keys[a] == k else [o] for o, a, k in zip(own, at, key, strict=True)])

    dealt = rows.select("doc_id", "key", "text", F.posexplode(buckets("key")).alias("closing", "bucket"))
    return dealt.repartition(n, "bucket").sortWithinPartitions("bucket", "closing", "key", "text")


RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_edited(docs: DataFrame) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document."""

    def results(rows: list[tuple]) -> pa.RecordBatch:
        first = [i for i, (x, y) in enumerate(zip(rows, rows[1:], strict=False)) if x[0] == y[0] and not x[1]]
        changed = [edited(rows[i][3], rows[i + 1][3]) for i in first]
        found = sketches([r[3] for r in rows] + changed)
        texts_, following = [found[i] for i in first], [found[i + 1] for i in first]
        altered, pairs = found[len(rows) :], [rows[i] for i in first]
        columns = [
            pa.array([x[2] for x in pairs], pa.int64()),
            pa.array([len(x[3]) for x in pairs], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array([_printed(s) for s in texts_], pa.string()),
            pa.array([_printed(s) for s in altered], pa.string()),
            pa.array([likeness(a, b) for a, b in zip(texts_, altered, strict=True)], pa.float64()),
            pa.array([likeness(a, b) for a, b in zip(texts_, following, strict=True)], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in RESULT.split(", ")])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*[batch.column(k).to_pylist() for k in ("bucket", "closing", "doc_id", "text")], strict=True):
                held.append(row)
                size += len(row[3])
                if size > CHUNK and len(held) > 1:
                    yield results(held)
                    held, size = held[-1:], len(row[3])
        yield results(held)

    return with_next(docs).select("bucket", "closing", "doc_id", "text").mapInArrow(run, RESULT)


def op7_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(documents(spark, sf_dir))
