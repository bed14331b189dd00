"""Texts as byte arrays: windows of bounded size, runs of bytes, and hashes of runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

#: Bytes of text that are taken apart at once.
WINDOW = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers; a bijection."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of true begin and end."""
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


#: A number for each byte at each of 64 places, for either hash.
_PLACES = 64
_TABLES = [mixed(mixed(np.arange(256 * _PLACES, dtype=np.uint64) + np.uint64(seed << 32))) for seed in (1, 2)]


def run_hashes(raw: np.ndarray, inside: np.ndarray, start: np.ndarray, end: np.ndarray, n: int = 2) -> list[np.ndarray]:
    """`n` independent 64-bit hashes of the bytes of each run: sums of what each byte gives at its place."""
    if not len(start):
        return [np.empty(0, np.uint64)] * n
    length = end - start
    first = np.cumsum(length) - length
    position = np.arange(first[-1] + length[-1], dtype=np.int32) - np.repeat(first.astype(np.int32), length)
    entry = ((position & (_PLACES - 1)) << 8) | raw[inside]
    # only bytes beyond the places, so that a run has one hash whatever other runs lie beside it
    far = np.flatnonzero(position >= _PLACES) if length.max() > _PLACES else position[:0]
    beyond = (position[far] >> 6).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    out = []
    for table in _TABLES[:n]:
        given = table[entry]
        if len(far):
            given[far] = mixed(given[far] * beyond)
        out.append(np.add.reduceat(given, first))
    return out


def parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Record batches in slices of a few rows, so that only their texts are turned into Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def windows(texts: Sequence[bytes], cut: Callable[[bytes, int], int], size: int | None = None) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Texts joined by line feeds to about `size` bytes: the bytes, the start of each part, and the place of its text.

    A longer text is cut into parts where `cut(text, from)` says: the first end of a part at or after `from`.
    """
    size = size or WINDOW
    own, places, held = [], [], 0
    for place, text in enumerate(texts):
        at = 0
        while at < len(text):
            stop = cut(text, at + size) if len(text) - at > size else len(text)
            own.append(text[at:stop])
            places.append(place)
            held += stop - at
            at = stop
            if held >= size:
                yield _joined(own, places)
                own, places, held = [], [], 0
    if own:
        yield _joined(own, places)


def _joined(parts: list[bytes], places: list[int]) -> tuple[bytes, np.ndarray, np.ndarray]:
    starts = np.cumsum([0, *(len(p) + 1 for p in parts[:-1])])
    return b"\n".join(parts), starts, np.array(places)
