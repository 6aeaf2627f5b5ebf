"""SentencePiece merge vocabularies: exact encoding by backtracking, and decoding.

Merging always takes the best pair of neighbours, so a row of tokens is the encoding of its text exactly if every two
neighbours, merged again from their characters, come out as these two tokens. The encoder therefore walks the text with
the longest token that begins at each place (one Aho-Corasick pass over the reversed text finds them), tries shorter
prefixes where neighbours do not agree, goes back a token where none is left, and marks the places from which no
encoding goes on in a bitfield, so that none is tried twice.

A text is cut between characters that no token of the vocabulary joins; the ids of the cuts put together are the ids of
the text. Each distinct cut is encoded once per worker's memory.

A null text is encoded as an empty one, which has no ids. Rows are independent: a null ``doc_id``, repeated rows and
ties are encoded as they stand, an empty table gives an empty one, and other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, slices, texts
from .packing import vocabulary_path

MEMORY = 6_000_000  # characters of cuts that a worker remembers
PAIRS = 1_000_000  # neighbours that a worker remembers
REMEMBERED = 200  # longer cuts are not remembered
SPACE = "\u2581"  # how a vocabulary writes a blank
BREAK = "\n"  # stands between cuts in the search


class PieceMerges:
    """Encoder and decoder of one model: merge type with byte fallback, no normalisation but the blank in front, no
    user-defined pieces."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        if model.normalize("\ufb01  a ") != f"{SPACE}\ufb01{SPACE * 2}a{SPACE}":
            raise ValueError(f"{path} changes texts before it encodes them")
        every = range(model.get_piece_size())
        self.ids = {
            model.id_to_piece(i): i
            for i in every
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        }
        self.spelled = {piece: int(i).to_bytes(4, "little") for piece, i in self.ids.items()}
        self.scores = {piece: model.get_score(i) for piece, i in self.ids.items()}
        byte_ids = {int(model.id_to_piece(i)[1:-1], 16): i for i in every if model.is_byte(i)}
        if len(byte_ids) < 256:
            raise ValueError(f"{path} has no byte fallback")
        self.byte_ids = [byte_ids[b] for b in range(256)]
        surfaces = [b""] * len(every)
        for piece, i in self.ids.items():
            surfaces[i] = piece.replace(SPACE, " ").encode()
        for b, i in byte_ids.items():
            surfaces[i] = bytes([b])
        self.surfaces = pa.array(surfaces, pa.binary())
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 1, -1) if p[:n] in self.ids), p[:1]) for p in self.ids}
        self.endings = ahocorasick.Automaton()
        for piece in self.ids:
            if len(piece) > 1 and BREAK not in piece:
                self.endings.add_word(piece[::-1], piece)
        self.endings.make_automaton()
        self.cuts = self._cuts()
        self.agreed: defaultdict[str, dict[str, bool]] = defaultdict(dict)
        self.pairs = 0
        self.known: dict[str, bytes] = {}
        self.size = 0

    def _cuts(self) -> re.Pattern:
        """Runs of characters that tokens can join, each with the blanks in front. Two characters are of one group if
        a token has them side by side, also over others; no token lies across two groups."""
        group: dict[str, set[str]] = {}
        for piece in self.ids:
            letters = piece.lstrip(SPACE)
            if SPACE in letters:
                return re.compile(r"(?s).+")
            for a, b in zip(letters, letters[1:]):
                one, other = group.setdefault(a, {a}), group.setdefault(b, {b})
                if one is not other:
                    small, large = sorted((one, other), key=len)
                    large |= small
                    for c in small:
                        group[c] = large
        groups = {id(members): members for members in group.values()}.values()
        runs = ["[" + "".join(map(re.escape, sorted(members))) + "]+" for members in sorted(groups, key=len, reverse=True)]
        return re.compile(rf"(?s){SPACE}*(?:" + "|".join([*runs, f"[^{SPACE}]"]) + f")|{SPACE}+")

    def merged(self, text: str) -> list[str]:
        """The text merged pair by pair: the best score first, of equal ones the leftmost."""
        symbols, scores = list(text), self.scores
        while len(symbols) > 1:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = scores.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def agree(self, left: str, right: str) -> bool:
        """Whether the two, merged again from their characters, stay the two tokens (``left`` empty: the one token)."""
        self.pairs += 1
        fits = self.agreed[left][right] = self.merged(left + right) == ([left, right] if left else [right])
        return fits

    def longest(self, cuts: list[str]) -> list[list[str]]:
        """For each cut the longest token that begins at each of its characters, or the character."""
        text = BREAK.join(cuts)
        found = list(text)
        last, end = len(text) - 1, -1
        for at, piece in self.endings.iter(text[::-1]):
            if at != end:  # the first match that ends here is the longest
                found[last - at], end = piece, at
        result, at = [], 0
        for cut in cuts:
            result.append(found[at : at + len(cut)])
            at += len(cut) + 1
        return result

    def backtracked(self, longest: list[str]) -> list[str]:
        agreed, shorter = self.agreed, self.shorter
        n = len(longest)
        failed, any_failed = bytearray((n >> 3) + 1), False
        tokens: list[str] = []
        last, at, token = "", 0, longest[0]
        while at < n:
            right = agreed[last]
            while True:  # the longest token here that agrees with the last and does not end where all has failed
                end = at + len(token)
                if not (any_failed and failed[end >> 3] >> (end & 7) & 1):
                    fits = right.get(token)
                    if fits or fits is None and self.agree(last, token):
                        tokens.append(token)
                        last, at = token, end
                        token = longest[at] if at < n else ""
                        break
                if len(token) == 1:
                    failed[at >> 3] |= 1 << (at & 7)
                    any_failed = True
                    token = tokens.pop()
                    at -= len(token)
                    last = tokens[-1] if tokens else ""
                    break
                token = shorter[token]
        return tokens

    def ids_of(self, tokens: list[str]) -> bytes:
        spelled = self.spelled
        for token in tokens:
            if token not in spelled:  # a character without a token of its own
                spelled[token] = np.array([self.byte_ids[b] for b in token.encode()], "<i4").tobytes()
        return b"".join([spelled[token] for token in tokens])

    def learn(self, cuts: Iterable[str]) -> dict[str, bytes]:
        """The ids of new cuts, of which the long ones are not remembered."""
        cuts = list(cuts)
        new = {cut: self.ids_of(self.backtracked(longest)) for cut, longest in zip(cuts, self.longest(cuts), strict=True)}
        kept = {cut: ids for cut, ids in new.items() if len(cut) <= REMEMBERED}
        self.size += sum(map(len, kept))
        self.known.update(kept)
        return {cut: ids for cut, ids in new.items() if len(cut) > REMEMBERED}

    def forget(self) -> None:
        """Drops the half of the cuts that was learned first, and all neighbours, where they are too many."""
        if self.pairs > PAIRS:
            self.agreed.clear()
            self.pairs = 0
        if self.size > MEMORY:
            for cut in list(islice(self.known, len(self.known) // 2)):
                self.size -= len(cut)
                del self.known[cut]

    def encode(self, some: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        self.forget()
        split = [self.cuts.findall(SPACE + text.replace(" ", SPACE)) if text else [] for text in some]
        new: set[str] = set()
        for cuts in split:
            new.update(cuts)
        once = self.learn(new - self.known.keys())
        known = self.known.__getitem__
        if not once:
            return [b"".join(map(known, cuts)) for cuts in split]
        return [b"".join(once[c] if c in once else known(c) for c in cuts) for cuts in split]

    def decode(self, rows: list[bytes]) -> list[str]:
        """The text of each row of ids: surfaces put together, without the blank in front. Bytes that are no UTF-8 are
        replaced."""
        ids = np.frombuffer(b"".join(rows), "<i4")
        surfaces = self.surfaces.take(pa.array(ids))
        ends = np.frombuffer(surfaces.buffers()[1], np.int32)[surfaces.offset : surfaces.offset + len(ids) + 1]
        data = memoryview(surfaces.buffers()[2]) if len(ids) else memoryview(b"")
        bounds = ends[np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])]).astype(np.int64)] if len(ids) else np.zeros(len(rows) + 1, int)
        done = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            text = bytes(data[a:b]).decode("utf-8", "replace")
            done.append(text[1:] if text[:1] == " " else text)
        return done


_OPEN: dict[str, PieceMerges] = {}


def _coder(path: str) -> PieceMerges:
    if path not in _OPEN:
        _OPEN[path] = PieceMerges(path)
    return _OPEN[path]


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id`` and ``ids`` of each document, and the text ``decoded`` from the ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary)
        for batch in batches:
            for some in slices(batch, 1):
                found = coder.encode(some.column(1).to_pylist())
                ends = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids in found])]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(found), "<i4"), pa.int32())
                columns = [some.column(0), pa.ListArray.from_arrays(pa.array(ends), values), pa.array(coder.decode(found), pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded"])

    return texts(docs).mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")


def op12_piece_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    coded = encode(documents(spark, sf_dir), vocabulary_path("piece_bpe_32k.model"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
