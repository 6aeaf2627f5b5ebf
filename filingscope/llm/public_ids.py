"""Token ids of a public byte-level vocabulary, as the tokenizers library gives them.

The pattern of such a vocabulary never joins a word to what stands before the blank in front of it, so a text can be
cut before every blank that a visible character follows, around a single line break between visible characters, and
between a word and the marks that end it; the ids of the cuts put together are the ids of the text. Each distinct cut
goes through the library once and is remembered. Texts that hold one of the vocabulary's special tokens go through
the library whole.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np

from .common import uncollected

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores

UNSIGNED = "I"
LITTLE = sys.byteorder == "little" and array(UNSIGNED).itemsize == 4
MARKS = frozenset(".,!?;:")
MARKED = re.compile(r"(.*[^\W_])([.,!?;:]+)", re.DOTALL)
VISIBLE_CUT = re.compile(r" (?:\s|\Z)")


#: Byte-level vocabularies write a byte as its own character if that can be seen, else as the next one from 256 on.
_SEEN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARACTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SEEN)}


def single_breaks(lines: list[str]) -> bool:
    """Whether every line break stands alone between visible characters."""
    return not any(
        not a or not b or a[-1].isspace() or b[0].isspace() for a, b in zip(lines[:-1], lines[1:], strict=True)
    )


class TokenIds:
    """Ids as little-endian unsigned 32-bit integers. ``memory`` bounds what is remembered, in characters."""

    def __init__(self, path: str, memory: int = 8_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.memory = memory
        self.known: dict[str, bytes] = {}
        self.heads: dict[str, bytes] = {}  # what stands before a text's first cut has no blank in front
        self.marks: dict[str, bytes] = {}
        self.spelled_blank, self.spelled_break = self.spelling(" "), self.spelling("\n")
        self.line_break = self.library(["\n"])[0]
        self.size = 0

    def library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(UNSIGNED, e.ids).tobytes() if LITTLE else np.array(e.ids, "<u4").tobytes() for e in found]

    def spelling(self, text: str) -> str:
        """The text in the characters that stand for its bytes in the vocabulary."""
        return text.encode().decode("latin-1").translate(BYTE_CHARACTERS)

    def merged(self, spelled: str) -> bytes:
        ids = [t.id for t in self.tokenizer.model.tokenize(spelled)]
        return array(UNSIGNED, ids).tobytes() if LITTLE else np.array(ids, "<u4").tobytes()

    def cuts(self, text: str) -> list[str]:
        pieces = text.split(" ")
        if VISIBLE_CUT.search(text) is None:
            return pieces
        joined = pieces[:1]
        for piece in pieces[1:]:
            if not piece or piece[0].isspace():
                joined[-1] += " " + piece
            else:
                joined.append(piece)
        return joined

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    @uncollected()
    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. What is new in any of them goes through the library together."""
        if self.size > self.memory:
            self.known, self.heads, self.size = {}, {}, 0
        done: list[list[bytes]] = []
        later: list[tuple[list[bytes], str, list[str]]] = []
        for text in texts:
            if any(s in text for s in self.special):
                done.append([self.library([text])[0]])
                continue
            lines = text.split("\n")
            if not single_breaks(lines):
                lines = [text]
            done.append([])
            for line in lines:
                head, *rest = self.cuts(line)
                later.append((done[-1], head, rest))
        known, heads = self.known, self.heads
        self._learn(heads, "", {head for _, head, _ in later if head not in heads})
        self._learn(known, " ", {c for c in set().union(*[rest for _, _, rest in later]) if c not in known})
        for parts, head, rest in later:
            parts.append(heads[head] + b"".join(map(known.__getitem__, rest)))
        return [self.line_break.join(parts) for parts in done]

    def _learn(self, known: dict[str, bytes], blank: str, new: set[str]) -> None:
        parts = {p: m.groups() for p in new if p[-1:] in MARKS and (m := MARKED.fullmatch(p))}
        whole = {*(new - parts.keys()), *(word for word, _ in parts.values() if word not in known)}
        words = [p for p in whole if p.isalpha()]  # the pattern leaves these whole: only the merges are left to do
        ascii_words, wide = [p for p in words if p.isascii()], [p for p in words if not p.isascii()]
        spelled = self.spelling("\n".join(wide)).split(self.spelled_break) if wide else []
        front = self.spelled_blank if blank else ""
        for some, written in ((ascii_words, ascii_words), (wide, spelled)):
            known.update(zip(some, [self.merged(front + w) for w in written], strict=True))
        others = list(whole.difference(words))
        known.update(zip(others, self.library([blank + p for p in others]), strict=True))
        for piece, (word, marks) in parts.items():
            if marks not in self.marks:
                self.marks[marks] = self.library([marks])[0]
            known[piece] = known[word] + self.marks[marks]
        self.size += sum(map(len, new))


_OPEN: dict[str, TokenIds] = {}


def token_ids(path: str) -> TokenIds:
    """One per vocabulary and Python worker."""
    if path not in _OPEN:
        _OPEN[path] = TokenIds(path)
    return _OPEN[path]
