"""Packing of documents into sequences by shortest-pack-first over the length histogram.

Every document is its token ids and an end id. It is cut into whole sequences and one shorter tail; the pieces are
counted by length, and only that histogram (``max_tokens`` numbers at most) is packed: lengths go in longest first,
always into the pack with the most room that they fit, and packs that look alike are one pattern with a count.
Pieces get a rank among those of their length, and the patterns say for each range of ranks which sequence and
offset it has. No step holds the pieces of one length in one task: ranks are counted within salted groups.

Nulls: a null text is an empty document, which is its end id alone; a null ``doc_id`` stays null in its pieces.
Repeated rows are packed as often as they stand there. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, partitions, slices, texts, written
from .public_ids import token_ids

MAX_TOKENS = 1024
END_ID = 0

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def pieces(docs: DataFrame, vocabulary: str, max_tokens: int = MAX_TOKENS, end_id: int = END_ID, with_ids: bool = False):
    """The pieces of each document; ``with_ids`` adds the ids themselves as little-endian 32-bit integers."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = token_ids(vocabulary)
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
        for batch in (part for whole in batches for part in slices(whole, 1)):
            rows: list[list] = [[] for _ in names]
            found = coder.encode_all(batch.column(1).to_pylist())
            for doc_id, ids in zip(batch.column(0).to_pylist(), found, strict=True):
                ids += end
                for at in range(0, len(ids), 4 * max_tokens):
                    piece = ids[at : at + 4 * max_tokens]
                    row = (doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, piece)
                    for column, value in zip(rows, row, strict=False):
                        column.append(value)
            kinds = [pa.int64()] * 5 + [pa.binary()] * with_ids
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], names)

    return texts(docs).mapInArrow(cut, PIECES + ", ids binary" * with_ids)


def pack_histogram(counts: dict[int, int], max_tokens: int = MAX_TOKENS) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in the order of their places) and how many sequences have each."""
    by_room: dict[int, list[list]] = {}  # room left: patterns with a count
    for length in sorted(counts, reverse=True):
        left = counts[length]
        grown: list[tuple[int, tuple[int, ...], int]] = []
        while left:
            room = max((r for r in by_room if r >= length), default=None)
            if room is None:
                per_pack = min(max_tokens // length, left)
                full, rest = divmod(left, per_pack)
                if length * per_pack <= max_tokens:
                    grown.append((max_tokens - length * per_pack, (length,) * per_pack, full))
                    if rest:
                        grown.append((max_tokens - length * rest, (length,) * rest, 1))
                left = 0
            else:
                pattern, count = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
                used = min(count, left)
                if used < count:
                    by_room.setdefault(room, []).append([pattern, count - used])
                left -= used
                by_room.setdefault(room - length, []).append([(*pattern, length), used])
        for room, pattern, count in grown:
            by_room.setdefault(room, []).append([pattern, count])
    return [(p, c) for room in sorted(by_room) for p, c in by_room[room]]


def places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """By length: rows of (first rank, sequence of that rank, offset), by ascending rank."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            first = ranks.get(length, 0)
            found.setdefault(length, []).append((first, sequence, offset))
            ranks[length] = first + count
            offset += length
        sequence += count
    return {length: np.array(rows, np.int64) for length, rows in found.items()}


def ranked(cut: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0 without gaps among the pieces of one length; hot lengths are split by a salt."""
    salted = cut.withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(4 * partitions(cut.sparkSession)))
    )
    groups = salted.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("length", "salt", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
    numbered = salted.withColumn("inside", F.row_number().over(inside) - 1)
    return numbered.join(groups, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("inside"))


def pack(cut: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (of :func:`pieces`, written: they are read more than once)."""
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # max_tokens rows at most
    where = places(pack_histogram(counts, max_tokens))
    columns = cut.columns

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for one in np.unique(length):
                table, these = where[int(one)], np.nonzero(length == one)[0]
                row = table[np.searchsorted(table[:, 0], rank[these], "right") - 1]
                sequence[these] = row[:, 1] + rank[these] - row[:, 0]
                offset[these] = row[:, 2]
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return ranked(cut).select(*columns, "rank").mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence, from packed pieces that carry their ids (``pieces(..., with_ids=True)``)."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(inside, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pack_documents(docs: DataFrame, vocabulary: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    return pack(written(pieces(docs, vocabulary, max_tokens), "pieces"), max_tokens)


def op3_sequence_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), vocabulary_path("byte_bpe_50k.json"))
