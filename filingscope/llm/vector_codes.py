"""Short codes of vectors: each part of a vector is replaced by the number of the nearest entry of a small codebook.

The nearest entries are found by slice and intersect. A codebook keeps, for each dimension, its entries' coordinates in
order, and for each place in that order a mask of the entries before it. The distance to a nearby entry gives a radius;
in every dimension the coordinates within it are one range, whose entries are the difference of two prefix masks. The
masks of all dimensions ANDed give the entries within the box, among them all nearest ones; only these are compared.

Components are integers, floor(256 * x), so that sums and distances are exact in any order of the rows. Each round is one
pass over the vectors: tasks add up the parts of each entry, and one row per task, part, entry and position is shuffled.
The driver holds the codebooks alone, 64 vectors at any size of the table.

Rows whose vector is null, or holds a null or a component that is not finite, are left out, as are those whose length is
not the one that most other rows have (of equally frequent ones the longer). A length that 16 does not divide is filled up
with zeros. Components beyond 2**24 after scaling are taken as 2**24. Rows with a null ``vec_id`` are coded; they come
last in the order that gives the first entries, in which rows of one ``vec_id`` are in the order of their vectors. With
fewer than 64 rows there are as many entries as rows; an empty table has no codes. Columns beyond these three are
not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

PARTS = 16
ENTRIES = 64  # a mask is one unsigned 64-bit integer
ROUNDS = 2
SCALE = 256
LIMIT = 2**24
BLOCK = 4096  # rows that are compared at once
HOT_LABELS = 200  # labels whose sums go to every task instead of through the join

KEPT = "vec_id bigint, label int, length int, vector array<int>"


def integer_vectors(rows: DataFrame) -> DataFrame:
    """The usable rows with integer vectors, filled up to a length that ``PARTS`` divides."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(2)))
            lists = batch.column(2)
            values = lists.flatten()
            lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(lengths)), lengths)
            numbers = values.to_numpy(zero_copy_only=False).astype(np.float64)  # nulls become NaN
            good = np.bincount(row, ~np.isfinite(numbers), len(lengths)) == 0
            whole = np.floor(np.where(np.isfinite(numbers), numbers, 0) * SCALE)
            whole = np.clip(whole, -LIMIT, LIMIT).astype(np.int32)[good[row]]
            lengths = lengths[good]
            wide = -(-lengths // PARTS) * PARTS
            starts = np.concatenate([[0], np.cumsum(wide)])
            filled = np.zeros(starts[-1], np.int32)
            filled[np.arange(len(whole)) + np.repeat(starts[:-1] - np.cumsum(lengths) + lengths, lengths)] = whole
            kept = batch.filter(pa.array(good))
            vectors = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(filled))
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), kept.column(1), pa.array(wide.astype(np.int32)), vectors],
                ["vec_id", "label", "length", "vector"],
            )

    chosen = rows.select(
        F.col("vec_id").cast("bigint"), F.col("label").cast("int"), F.col("embedding").cast("array<double>")
    )
    return chosen.mapInArrow(run, KEPT)


class Codebook:
    """The entries of one part position, sliced by dimension."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries  # (entries, dimensions)
        count, self.width = entries.shape
        self.order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(entries, self.order, axis=0)
        bits = np.uint64(1) << self.order.astype(np.uint64)
        none = np.zeros((1, self.width), np.uint64)
        self.prefix = np.concatenate([none, np.bitwise_or.accumulate(bits, axis=0)]) if count else none

    def radius(self, parts: np.ndarray) -> np.ndarray:
        """A whole number that the distance to the nearest entry does not exceed: in each dimension the entry whose
        coordinate comes next is tried."""
        best = None
        for d in range(self.width):
            near = np.searchsorted(self.sorted[:, d], parts[:, d]).clip(max=len(self.entries) - 1)
            distance = ((parts - self.entries[self.order[near, d]]) ** 2).sum(axis=1)
            best = distance if best is None else np.minimum(best, distance)
        return np.ceil(np.sqrt(best.astype(np.float64))).astype(np.int64) + 1  # one more than rounding can miss

    def candidates(self, parts: np.ndarray) -> np.ndarray:
        """A mask of the entries in the box around each part."""
        radius = self.radius(parts)
        mask = np.full(len(parts), np.uint64(2**64 - 1))
        for d in range(self.width):
            low = np.searchsorted(self.sorted[:, d], parts[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], parts[:, d] + radius, "right")
            mask &= self.prefix[high, d] ^ self.prefix[low, d]
        return mask

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each part, of equally near ones the first, and the squared distance."""
        masks = self.candidates(parts).astype("<u8")
        bits = np.unpackbits(masks.view(np.uint8).reshape(len(parts), 8), axis=1, bitorder="little")
        row, entry = np.nonzero(bits)  # row by row, entries in ascending order
        distance = ((parts[row] - self.entries[entry]) ** 2).sum(axis=1)
        first = np.searchsorted(row, np.arange(len(parts)))
        least = np.minimum.reduceat(distance, first)
        hit = np.flatnonzero(distance == least[row])
        return entry[hit[np.searchsorted(row[hit], np.arange(len(parts)))]], least


Codebooks = np.ndarray  # (parts, entries, dimensions of a part), 64-bit integers


def _blocks(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            some = batch.slice(at, BLOCK)
            values = some.column(some.schema.get_field_index("vector")).flatten().to_numpy()
            yield some, values.reshape(some.num_rows, PARTS, width).astype(np.int64)


def improved(vectors: DataFrame, codebooks: Codebooks) -> Codebooks:
    """One round: every part goes to its nearest entry, every entry that has parts becomes their mean, rounded down."""
    count, width = codebooks.shape[1:]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(entries) for entries in codebooks]
        sums = np.zeros((PARTS, count, width), np.int64)
        counts = np.zeros((PARTS, count), np.int64)
        for _, parts in _blocks(batches, width):
            for p, book in enumerate(books):
                entry, _ = book.nearest(parts[:, p])
                np.add.at(sums[p], entry, parts[:, p])
                counts[p] += np.bincount(entry, minlength=count)
        used = np.argwhere(np.repeat(counts[:, :, None] > 0, width, axis=2))
        p, e, d = used.T
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x.astype(np.int32)) for x in (p, e, d)), pa.array(sums[p, e, d]), pa.array(counts[p, e])],
            ["part", "entry", "position", "total", "members"],
        )

    added = (
        vectors.select("vector")
        .mapInArrow(run, "part int, entry int, position int, total bigint, members bigint")
        .groupBy("part", "entry", "position")
        .agg(F.sum("total").alias("total"), F.sum("members").alias("members"))
    )
    result = codebooks.copy()
    for r in added.collect():  # 64 vectors' worth of rows at most
        result[r.part, r.entry, r.position] = r.total // r.members
    return result


def trained(vectors: DataFrame, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks for vectors of one length: first the parts of the first 64, then ``rounds`` times improved."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(ENTRIES).collect()
    codebooks = np.array([r.vector for r in first], np.int64).reshape(len(first), PARTS, -1).transpose(1, 0, 2)
    for _ in range(rounds):
        codebooks = improved(vectors, codebooks)
    return codebooks


def encoded(vectors: DataFrame, codebooks: Codebooks) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (two hexadecimal digits per part) and ``error``, the squared distance."""
    width = codebooks.shape[2]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = [Codebook(entries) for entries in codebooks]
        for some, parts in _blocks(batches, width):
            found = [book.nearest(parts[:, p]) for p, book in enumerate(books)]
            digits = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8).tobytes().hex()
            step = 2 * PARTS
            codes = [digits[i : i + step] for i in range(0, len(digits), step)]
            error = sum(distance for _, distance in found)
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(1), pa.array(codes, pa.string()), pa.array(error)],
                ["vec_id", "label", "code", "error"],
            )

    return vectors.select("vec_id", "label", "vector").mapInArrow(
        run, "vec_id bigint, label int, code string, error bigint"
    )


def compress(rows: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """Codes of the usable rows (see :func:`encoded`), and the codebooks they refer to."""
    every = written(integer_vectors(rows), "integer-vectors")
    lengths = every.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    length = lengths[0].length if lengths else 0
    vectors = every.where(F.col("length") == length)
    codebooks = trained(vectors, rounds) if length else np.zeros((PARTS, 0, 0), np.int64)
    return encoded(vectors, codebooks) if length else encoded_none(vectors), codebooks


def encoded_none(vectors: DataFrame) -> DataFrame:
    """Vectors without components are all the one entry there is."""
    return vectors.select("vec_id", "label", F.lit("00" * PARTS).alias("code"), F.lit(0).cast("bigint").alias("error"))


def with_label_error(coded: DataFrame) -> DataFrame:
    """Adds the error summed over the rows of equal label, nulls together.

    Sums are made before the shuffle. The most frequent labels' sums are sent to every task; the rows of these go past
    the join on the label, spread by their code.
    """
    label = (F.col("label").isNull().alias("no_label"), F.coalesce("label", F.lit(0)).alias("a_label"))
    sums = coded.groupBy(*label).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).alias("summed"), F.count("*").alias("rows")
    )
    sums = sums.select("no_label", "a_label", F.least("summed", F.lit(2**63 - 1)).cast("bigint").alias("summed"), "rows")
    hot = sums.orderBy(F.desc("rows"), "no_label", "a_label").limit(HOT_LABELS)
    keyed = coded.select("*", *label).join(
        F.broadcast(hot.select("no_label", "a_label", F.col("summed").alias("hot"))), ["no_label", "a_label"], "left"
    )
    spread = F.when(F.col("hot").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64("vec_id", "code"), F.lit(1_000_000)))
    rest = sums.select("no_label", "a_label", "summed", F.lit(0).cast("bigint").alias("spread"))
    found = keyed.withColumn("spread", spread).join(rest, ["no_label", "a_label", "spread"], "left")
    return found.withColumn("label_error", F.coalesce("hot", "summed")).drop("no_label", "a_label", "spread", "hot", "summed")


def digest(codebooks: Codebooks) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def op11_mask_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of every usable vector."""
    coded, codebooks = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    coded = written(coded, "codes")
    return with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256")
    )


def _nearest_sql(n: int) -> str:
    return f"""near{n} AS (
    SELECT nth, p, min({{'d': d, 'entry': entry}}) AS best FROM (
        SELECT nth, a.p, entry, CAST(list_sum(list_transform(list_zip(part, coordinates),
            lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
        FROM parts a JOIN book{n} b ON a.p = b.p) GROUP BY nth, p
)"""


def _round_sql(n: int) -> str:
    return f"""means{n} AS (
    SELECT p, entry, list(mean ORDER BY i) AS coordinates FROM (
        SELECT p, best.entry AS entry, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS mean
        FROM (SELECT p, best, unnest(part) AS x, unnest(range(1, len(part) + 1)) AS i FROM near{n - 1} JOIN parts USING (nth, p))
        GROUP BY p, best.entry, i) GROUP BY p, entry
),
book{n} AS (
    SELECT b.p, b.entry, coalesce(a.coordinates, b.coordinates) AS coordinates
    FROM book{n - 1} b LEFT JOIN means{n} a ON a.p = b.p AND a.entry = b.entry
),
{_nearest_sql(n)}"""


ORACLE = f"""
WITH usable AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
numbered AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, vector) AS nth FROM usable),
parts AS (
    SELECT nth, p, vector[p * len(vector) // 16 + 1 : (p + 1) * len(vector) // 16] AS part
    FROM numbered, (SELECT unnest(range(16)) AS p)
),
book0 AS (SELECT p, nth - 1 AS entry, part AS coordinates FROM parts WHERE nth <= 64),
{_nearest_sql(0)},
{_round_sql(1)},
{_round_sql(2)}
SELECT vec_id, code, error,
    CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
    (SELECT sha256(string_agg(array_to_string(coordinates, ','), ',' ORDER BY p, entry)) FROM book2) AS codebooks_sha256
FROM (
    SELECT vec_id, label, string_agg(format('{{:02x}}', best.entry), '' ORDER BY p) AS code,
        CAST(sum(best.d) AS BIGINT) AS error
    FROM near2 JOIN numbered USING (nth) GROUP BY nth, vec_id, label
)
"""
