"""Exact tokenisation with a memory for pieces that recur.

A text is cut where its tokenizer never joins tokens across the cut, so its ids are those of its pieces in order. A worker
encodes a piece it does not remember, and looks up the others.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Sequence
from itertools import chain

import numpy as np
import tiktoken
from tokenizers import Tokenizer

#: Pieces that each of the two generations of a worker's memory holds, and the longest piece that is kept. Results do not depend on them.
MEMORY = 600_000
LONGEST = 48

#: Fixed value: the public pattern by which this family of byte-level tokenizers cuts a text into words.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space other than blank and line feed (of either library's definition).
_OTHER_SPACE = re.compile(r"[^\S \n]").search

_LOADED: dict[tuple[str, str], "_Remembering"] = {}


class _Remembering:
    """Two generations of remembered pieces: a full one becomes the old one, from which pieces still in use return."""

    def __init__(self) -> None:
        self.young: dict = {}
        self.old: dict = {}

    def encode(self, pieces: list[str]) -> list:
        raise NotImplementedError

    def learn(self, cut: Sequence[Sequence[str]]) -> list[str]:
        """Sees to it that `young` holds all pieces of these texts; gives the long ones, which may be forgotten after use."""
        missing = set(chain.from_iterable(cut)).difference(self.young)
        if len(self.young) + len(missing) > MEMORY:
            self.young, self.old = {}, self.young
            missing = set(chain.from_iterable(cut))
        again = missing.intersection(self.old)
        self.young.update(zip(again, map(self.old.__getitem__, again)))
        new = list(missing.difference(again))
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            self.young.update(zip(part, self.encode(part)))
        return [p for p in new if len(p) > LONGEST]

    def forget(self, pieces: Sequence[str]) -> None:
        for piece in pieces:
            del self.young[piece]


class WordCounts(_Remembering):
    """Numbers of tokens of a tokenizer that drops white space: no token reaches over a blank."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()

    def encode(self, pieces: list[str]) -> list[int]:
        return [len(e) for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)]

    def counts(self, texts: Sequence[str]) -> list[int]:
        cut = [re.split("[ \t\n\r]+", t) if "\n" in t or "\t" in t or "\r" in t else t.split(" ") for t in texts]
        long = self.learn(cut)
        counts = [sum(map(self.young.__getitem__, pieces)) for pieces in cut]
        self.forget(long)
        return counts


class ByteIds(_Remembering):
    """Ids of a byte-level tokenizer whose tokens start, but never go on, with white space.

    The vocabulary is that of the tokenizer's file; tiktoken merges by rank, which is the order of the file's merges (checked), and
    special strings inside texts become their ids, as the file's own library has it.
    """

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in merges)
        if [vocabulary[a + b] for a, b in pairs] != list(range(256, 256 + len(merges))):
            raise ValueError("the vocabulary is not in the order of its merges")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # the files write bytes as printable characters: the printable ones as themselves, the others from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*plain}))}
        ranks = {bytes(map(byte_of.__getitem__, token)): i for token, i in vocabulary.items() if token not in special}
        self.library = tiktoken.Encoding("own", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.special = re.compile("|".join(map(re.escape, special))).search if special else None
        self.widths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, i in ranks.items():
            self.widths[i] = len(token)

    def _cut(self, text: str) -> list[str] | None:
        """Pieces cut before each blank or line feed; None where these do not stand alone between other characters."""
        if _OTHER_SPACE(text) or (self.special and self.special(text)):
            return None
        pieces = text.replace("\n", " \n").split(" ")
        return pieces if "" not in pieces and "\n" not in pieces else None

    def encode(self, pieces: list[str]) -> list[bytes]:
        whole = [p if p[0] == "\n" else " " + p for p in pieces]
        ids = np.array(self.library.encode_ordinary("".join(whole)), np.int64)
        ends = np.searchsorted(np.cumsum(self.widths[ids]), np.cumsum([len(p.encode()) for p in whole]), side="left") + 1
        data = ids.astype("<u4").tobytes()
        return [data[4 * a : 4 * b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, allowed_special="all"), "<u4").tobytes()

    def ids(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        cut = [self._cut(text) for text in texts]
        first = [pieces.pop(0) if pieces else None for pieces in cut]  # has no blank before it
        long = self.learn([pieces for pieces in cut if pieces])
        ids = [
            self.whole(text) if pieces is None else self.whole(head) + b"".join(map(self.young.__getitem__, pieces))
            for text, head, pieces in zip(texts, first, cut)
        ]
        self.forget(long)
        return ids


def loaded(kind: Callable[[str], _Remembering], path: str) -> _Remembering:
    """One for each worker."""
    if (kind.__name__, path) not in _LOADED:
        _LOADED[kind.__name__, path] = kind(path)
    return _LOADED[kind.__name__, path]
