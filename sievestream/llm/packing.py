"""Packing documents into sequences by cutting-stock column generation."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from sievestream.llm.common import cut_lineage, in_order
from sievestream.llm.tokens import ByteIds, loaded

GRAIN = 8
PIECES_DDL = "key LONG, start LONG, length LONG, ids_crc32 LONG, doc_tokens LONG"
GAP = 1e-3
STEPS = 8
ROWS = 256


def cut_pieces(docs: DataFrame, capacity: int, path: str, end_id: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The pieces of every document's ids (and the end id): of `capacity` as long as they fill one, then the rest."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = loaded(ByteIds, path).ids
        for pdf in batches:
            keys, rows = pdf["key"].tolist(), []
            for at in range(0, len(pdf), ROWS):
                for own, ids in zip(keys[at : at + ROWS], ids_of(pdf["text"].iloc[at : at + ROWS].tolist())):
                    data = ids + int(end_id).to_bytes(4, "little")
                    n = len(data) // 4
                    for start in range(0, n, capacity):
                        part = data[4 * start : 4 * (start + capacity)]
                        rows.append((own, start, len(part) // 4, zlib.crc32(part), n))
            yield pd.DataFrame({name: pd.Series([r[i] for r in rows], dtype="Int64") for i, name in enumerate(("key", "start", "length", "ids_crc32", "doc_tokens"))})

    return docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInPandas(cut, PIECES_DDL)


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The unbounded knapsack by dynamic programming: the pattern of items (counts) of the highest price that fits."""
    use = np.flatnonzero(prices > 1e-12)
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    size, price = sizes[use], prices[use]
    fits = np.searchsorted(size, np.arange(capacity + 1), side="right")  # sizes ascend
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        if fits[room]:
            with_item = value[room - size[: fits[room]]] + price[: fits[room]]
            k = int(with_item.argmax())
            if with_item[k] > value[room] + 1e-12:
                value[room], choice[room] = with_item[k], k
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[use[choice[room]]] += 1
            room -= size[choice[room]]
    return float(value[capacity]), pattern


def generate_patterns(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is used, as the linear program min sum(x), patterns * x = demand has it.

    Column generation: the basis begins with one pattern of each size; the duals price the items, the knapsack finds the column of
    lowest reduced cost, the ratio test drops a column. It ends when Farley's bound puts the optimum within GAP, or after STEPS times as
    many columns as sizes: any basis on the way is feasible, and the next ones are hardly better.
    """
    unit = int(np.gcd.reduce(np.append(sizes, capacity)))
    sizes, capacity = sizes // unit, capacity // unit
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1 / np.diag(basis))
    amounts = (inverse * demand).sum(axis=1)
    best_bound = 0.0
    for step in range(STEPS * m):
        duals = inverse.sum(axis=0)  # every pattern costs one sequence
        worth, pattern = best_pattern(duals, sizes, capacity)
        best_bound = max(best_bound, float((np.maximum(duals, 0) * demand).sum()) / max(worth, 1.0))
        if worth <= 1 + 1e-9 or amounts.sum() <= best_bound * (1 + GAP):
            break
        used = np.flatnonzero(pattern)
        direction = (inverse[:, used] * pattern[used]).sum(axis=1)
        rows = np.flatnonzero(direction > 1e-9)
        leave = rows[np.argmin(amounts[rows] / direction[rows])]
        by = max(amounts[leave] / direction[leave], 0.0)
        amounts = np.maximum(amounts - by * direction, 0)
        amounts[leave] = by
        basis[:, leave] = pattern
        inverse[leave] /= direction[leave]
        others = np.arange(m) != leave
        inverse[others] -= np.outer(direction[others], inverse[leave])
    if np.abs((basis * amounts).sum(axis=1) - demand).max() > 1e-3:  # drift of the updates
        amounts = np.maximum(np.linalg.solve(basis, demand), 0)
    return [(basis[:, k].astype(np.int64), float(amounts[k])) for k in range(m) if amounts[k] > 1e-9]


def plan_sequences(histogram: dict[int, int], capacity: int, grain: int = GRAIN) -> pd.DataFrame:
    """Which ranks of each length go where: rows (size, first, last, per, sequence, offset), one for each pattern and size.

    The pieces of size class `size` (lengths rounded up to `grain`) that have the ranks first..last-1 lie `per` to a sequence,
    from sequence `sequence` on, the first of each at `offset` (in rounded lengths). Rounded down patterns come first; what they leave is
    packed best-fit, largest first, at most a few items of each size. The table has a few rows for each size class, whatever the input.
    """
    counts: dict[int, int] = {}
    for length, n in histogram.items():
        size = min(capacity, -(-length // grain) * grain)
        counts[size] = counts.get(size, 0) + n
    rows, used, next_sequence = [], dict.fromkeys(counts, 0), 0

    def place(pattern: dict[int, int], times: int) -> None:
        nonlocal next_sequence
        offset = 0
        for size, per in sorted(pattern.items(), reverse=True):
            rows.append((size, used[size], used[size] + per * times, per, next_sequence, offset))
            used[size] += per * times
            offset += per * size
        next_sequence += times

    if counts.get(capacity):
        place({capacity: 1}, counts[capacity])
    sizes = np.array(sorted(s for s in counts if s < capacity), np.int64)
    if len(sizes):
        for pattern, amount in generate_patterns(sizes, np.array([counts[s] for s in sizes], float), capacity):
            chosen = {int(s): int(n) for s, n in zip(sizes, pattern) if n}
            times = min([int(amount + 1e-6), *((counts[s] - used[s]) // n for s, n in chosen.items())])
            if times > 0:
                place(chosen, times)
        open_bins: list[tuple[int, dict[int, int]]] = []
        for size in sizes[::-1].tolist():
            for _ in range(counts[size] - used[size]):
                fitting = [k for k, (room, _) in enumerate(open_bins) if room >= size]
                if fitting:
                    k = min(fitting, key=lambda k: open_bins[k][0])
                    room, content = open_bins[k]
                    content[size] = content.get(size, 0) + 1
                    open_bins[k] = (room - size, content)
                else:
                    open_bins.append((capacity - size, {size: 1}))
        for _, content in open_bins:
            place(content, 1)
    return pd.DataFrame(rows, columns=["size", "first", "last", "per", "sequence", "slot"]).sort_values(["size", "first"], kind="stable")


def pack(docs: DataFrame, capacity: int, path: str, end_id: int, grain: int = GRAIN, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every piece of every document with its sequence: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Documents are cut into pieces that fill a sequence and a rest. The histogram of rounded lengths (at most capacity / grain numbers) goes to
    the driver, which solves the linear program over patterns and rounds it. Pieces are ranked within their
    length in global order, and take the place that the patterns give to their rank. Sequences are gapless: places follow the
    exact lengths.

    A null or empty text is the end id alone. Repeated rows are documents of their own, though pieces of one id can then not be told apart. An empty
    table gives no rows. A null key stays null.
    """
    pieces = cut_lineage(cut_pieces(docs, capacity, path, end_id, text=text, key=key), "pack-pieces")  # the ranges sample them, too
    rounded = F.least(F.lit(capacity), F.ceil(F.col("length") / grain) * grain).cast("long")
    ranked = in_order(pieces.withColumn("size", rounded), ["size", "length", "key", "start", "ids_crc32"], None, "pack")
    histogram = {r["size"]: r["n"] for r in ranked.groupBy("size").agg(F.count("*").alias("n")).collect()}
    plan = plan_sequences(histogram, capacity, grain)
    first_of = dict(zip(sorted(histogram), np.concatenate(([0], np.cumsum([histogram[s] for s in sorted(histogram)])[:-1])).tolist())) if histogram else {}
    span = max(histogram.values(), default=0) + 1
    keys = plan["size"].to_numpy(np.int64) * span + plan["first"].to_numpy(np.int64)
    columns = {name: plan[name].to_numpy(np.int64) for name in plan}

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            size = pdf["size"].to_numpy(np.int64)
            rank = pdf["_idx"].to_numpy(np.int64) - np.array([first_of[s] for s in size.tolist()], np.int64)
            at = np.searchsorted(keys, size * span + rank, side="right") - 1
            within = rank - columns["first"][at]
            out = pdf[["key", "start", "length", "ids_crc32", "doc_tokens"]].copy()
            out["sequence_id"] = columns["sequence"][at] + within // columns["per"][at]
            out["slot"] = columns["slot"][at] + within % columns["per"][at] * size
            yield out

    placed = ranked.mapInPandas(place, f"{PIECES_DDL}, sequence_id LONG, slot LONG")
    # at most `capacity` pieces share a sequence, so this window is bounded
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        F.col("key").alias(key), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset")
    )
