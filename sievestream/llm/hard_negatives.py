"""Hard negatives: for each anchor and positive the best rows of other labels within a band of scores, by filtering on segment summaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from sievestream.llm.common import cut_lineage, in_order

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative's score is at least LOW and at most HIGH hundredths of its positive's.
LOW, HIGH = 30, 90
#: Segments of a vector, from coarse to fine; summaries are stored for the finest, a coarser one is put together from them.
LEVELS = (4, 16)
#: Anchors and rows that meet in one task; tasks hold these and a few numbers for each row, whatever the table's size.
ANCHORS = 16_384
ROWS = 65_536
#: Rows to a task at least, as long as that leaves tasks for all cores.
_FEW_ROWS = 2_048
#: Anchors whose coarse bounds are computed in one go.
_CHUNK = 32
#: Sums of products below this are exact in doubles.
_EXACT = 2**53

_PREPARED = "id LONG, label INT, length INT, v BINARY, mean BINARY, deviation BINARY"


def _edges(length: int, segments: int) -> np.ndarray:
    return np.linspace(0, length, min(segments, length) + 1).astype(np.int64)


def summaries(vectors: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean (times the root of the segment's length) and deviation (root of the summed squares) of each segment.

    So the product of two segments is that of their means, give or take at most that of their deviations.
    """
    edges = _edges(vectors.shape[1], segments)
    lengths = np.diff(edges)
    mean = np.add.reduceat(vectors, edges[:-1], axis=1) / lengths
    spread = np.add.reduceat((vectors - np.repeat(mean, lengths, axis=1)) ** 2, edges[:-1], axis=1)
    return mean * np.sqrt(lengths), np.sqrt(spread)


def coarser(mean: np.ndarray, deviation: np.ndarray, length: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of fewer segments from those of more: what the finer means differ by counts as deviation."""
    lengths = np.diff(_edges(length, mean.shape[1]))
    edges = _edges(mean.shape[1], segments)
    total = np.add.reduceat(lengths, edges[:-1])
    sums = np.add.reduceat(mean * np.sqrt(lengths), edges[:-1], axis=1)
    squares = np.add.reduceat(mean**2 + deviation**2, edges[:-1], axis=1)
    return sums / np.sqrt(total), np.sqrt(np.maximum(squares - sums**2 / total, 0))


def _prepared(vectors: DataFrame, vector: str, key: str, label: str, scale: int) -> DataFrame:
    """The rows that take part, as whole numbers with the summaries of their finest segments."""
    good = F.col(key).isNotNull() & F.col(label).isNotNull() & (F.size(vector) > 0)
    good &= F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lengths = pdf["vector"].map(len).to_numpy()
            for length in np.unique(lengths):
                own = pdf[lengths == length]
                whole = np.floor(np.array(own["vector"].tolist(), np.float64) * scale)
                if np.abs(whole).max(initial=0) >= 2**31:
                    raise ValueError("components have to be below 2 ** 31 after scaling")
                mean, deviation = summaries(whole, LEVELS[-1])
                pack = lambda m, kind: [r.tobytes() for r in m.astype(kind)]
                yield pd.DataFrame(
                    {"id": own["id"].to_numpy(), "label": own["label"].to_numpy(), "length": int(length), "v": pack(whole, "<i4"), "mean": pack(mean, "<f8"), "deviation": pack(deviation, "<f8")}
                )

    rows = vectors.where(good).select(F.col(key).cast("long").alias("id"), F.col(label).cast("int").alias("label"), F.col(vector).alias("vector"))
    return rows.mapInPandas(run, _PREPARED)


class _Side:
    """Rows of one length in memory."""

    def __init__(self, pdf: pd.DataFrame, length: int):
        own = pdf[pdf["length"] == length].sort_values("id", kind="stable")
        self.frame, self.length = own, length
        self.id, self.label = own["id"].to_numpy(), own["label"].to_numpy()
        read = lambda c, kind: np.frombuffer(b"".join(own[c]), kind).reshape(len(own), -1)
        self.vectors = read("v", "<i4").astype(np.float64)
        fine = read("mean", "<f8"), read("deviation", "<f8")
        self.levels = [coarser(*fine, length, n) if n < fine[0].shape[1] else fine for n in LEVELS]
        self.norms = np.sqrt((self.vectors**2).sum(axis=1))
        self.exact = (np.abs(self.vectors).max(initial=0) ** 2) * length < _EXACT / 2

    def scores(self, vector: np.ndarray, at: np.ndarray, exact: bool) -> np.ndarray:
        if exact:
            return (self.vectors[at] @ vector).astype(np.int64)
        sums = self.vectors[at].astype(np.int64).astype(object) @ vector.astype(np.int64).astype(object)
        return np.array([int(s) for s in sums], np.int64)  # beyond 64 bits: an error


def _bounds(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], slack: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle, width = x[0] @ y[0].T, x[1] @ y[1].T + slack
    return middle - width, middle + width


def _threshold(low: np.ndarray, sure: np.ndarray, k: int) -> float:
    """The k-th highest of the lower bounds of rows that surely belong to a band: what cannot reach it is not among its best k."""
    certain = low[sure]
    return float(np.partition(certain, len(certain) - k)[len(certain) - k]) if len(certain) >= k else -np.inf


def _best(anchors: _Side, rows: _Side, pairs, bands, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(anchor's place, band, places of rows, scores) of the best `k` rows in each band, ties to the smaller id.

    `pairs(anchor)` marks the rows an anchor is compared with; `bands(anchor)` are (lowest, highest) scores. A band's rows are narrowed by the bounds from coarse
    summaries, the rest by those from finer ones, and what is left is scored exactly.
    """
    exact = anchors.exact and rows.exact
    for low in range(0, len(anchors.id), _CHUNK):
        chunk = range(low, min(low + _CHUNK, len(anchors.id)))
        # rounding of the bounds is far below this
        slack = 1e-9 * np.outer(anchors.norms[chunk.start : chunk.stop], rows.norms) + 1e-6
        lowest, highest = _bounds(tuple(m[chunk.start : chunk.stop] for m in anchors.levels[0]), rows.levels[0], slack)
        for a in chunk:
            wanted = bands(a)
            if not wanted:
                continue
            at = np.flatnonzero(pairs(a))
            down, up = lowest[a - low][at], highest[a - low][at]
            for level in range(len(LEVELS)):
                if level:
                    finer = tuple(m[at] for m in rows.levels[level])
                    down, up = (b[0] for b in _bounds(tuple(m[a : a + 1] for m in anchors.levels[level]), finer, slack[a - low][at][None]))
                keep = np.zeros(len(at), bool)
                for bottom, top in wanted:
                    keep |= (up >= max(bottom, _threshold(down, (down >= bottom) & (up <= top), k))) & (down <= top)
                at = at[keep]
            scores = rows.scores(anchors.vectors[a], at, exact)
            order = np.argsort(-scores, kind="stable")  # rows are in the order of their ids
            at, scores = at[order], scores[order]
            for band, (bottom, top) in enumerate(wanted):
                inside = np.flatnonzero((scores >= bottom) & (scores <= top))[:k]
                yield a, band, at[inside], scores[inside]


def _blocks(spark, rows: DataFrame, n_rows: int, n_anchors: int) -> tuple[int, int]:
    """Parts of the rows and blocks of the anchors, by size of the table."""
    fit = -(-n_rows // ROWS)
    wide = min(-(-n_rows // _FEW_ROWS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(1, fit, wide), max(1, -(-n_anchors // ANCHORS))


def mine(
    vectors: DataFrame, every: int = 100, vector: str = "embedding", key: str = "vec_id", label: str = "label", scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors, rows whose key is divisible by `every`.

    Components become floor(scale * x); a score is the inner product of these whole numbers, higher first, then the smaller key. An anchor's positives are its
    first `positives` other rows of its label. For each of them the first `negatives` rows of other labels are returned whose score is at least `low` and
    at most `high` hundredths of the positive's.

    Every block of anchors meets every part of the rows, by equality of both numbers; a task gives its best rows of each band, of which the best of
    all are taken. Bounds from segment summaries (mean and deviation, see summaries()) decide which rows are scored at all; they leave none out that belongs to the result.

    Rows with a null key, label or vector, an empty vector or a null or non-finite component take no part; vectors of different length are not
    compared. Scores have to fit into 64 bits and scaled components into 32, else it is an error. Rows of one key are no positives of each other; a repeated
    anchor has a result of its own for each row, equal in all columns. An empty table, or one without anchors, gives no rows. Columns besides these three are ignored.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(_prepared(vectors, vector, key, label, scale), "negatives-rows")
    anchors = in_order(rows.where(F.col("id") % every == 0), ["label", "id"], None, "negatives-anchors").withColumnRenamed("_idx", "anchor").drop("_before")
    anchors = cut_lineage(anchors, "negatives-numbered")
    n_parts, n_blocks = _blocks(spark, rows, rows.count(), anchors.count())

    part = F.pmod(F.xxhash64("id"), n_parts).cast("int")
    right = rows.withColumn("part", part).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).groupBy("block", "part")
    block = F.floor(F.col("anchor") / ANCHORS).cast("int")

    def met(sides: DataFrame, work, schema: str) -> DataFrame:
        left = sides.withColumn("block", block).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1)))).groupBy("block", "part")
        return left.cogroup(right).applyInPandas(work, schema)

    def find_positives(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        for length in np.intersect1d(left["length"].unique(), right["length"].unique()):
            ours = left[left["length"] == length]
            for own in ours["label"].unique():
                theirs = right[right["label"] == own]
                if not (theirs["length"] == length).any():
                    continue
                a, b = _Side(ours[ours["label"] == own], length), _Side(theirs, length)
                numbers = a.frame["anchor"].to_numpy()
                everything = [(-np.inf, np.inf)]
                for x, _, at, scores in _best(a, b, lambda x, a=a, b=b: b.id != a.id[x], lambda x: everything, positives):
                    found.append(pd.DataFrame({"anchor": numbers[x], "positive_id": b.id[at], "positive_score": scores}))
        return pd.concat(found) if found else pd.DataFrame({"anchor": [], "positive_id": [], "positive_score": []})

    def first(found: DataFrame, by: list[str], score: str, tie: str, n: int) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), tie))
        return found.withColumn("rank", rank).where(F.col("rank") <= n)

    best = first(met(anchors, find_positives, "anchor LONG, positive_id LONG, positive_score LONG"), ["anchor"], "positive_score", "positive_id", positives)
    best = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("positives"))
    best = best.select("anchor", F.col("positives.rank").alias("positive_rank"), F.col("positives.positive_id").alias("positive_id"), F.col("positives.positive_score").alias("positive_score"))
    questions = cut_lineage(anchors.join(best, "anchor"), "negatives-questions")

    def find_negatives(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        for length in np.intersect1d(left["length"].unique(), right["length"].unique()):
            a, b = _Side(left, length), _Side(right, length)
            numbers, asked = a.frame["anchor"].to_numpy(), a.frame["positive_score"].to_list()
            # scores s with low * p <= 100 * s <= high * p
            bands = [[(-(-low * int(p) // 100), high * int(p) // 100) for p in scores] for scores in asked]
            for x, band, at, scores in _best(a, b, lambda x, a=a, b=b: b.label != a.label[x], lambda x, bands=bands: bands[x], negatives):
                found.append(pd.DataFrame({"anchor": numbers[x], "positive_rank": band + 1, "negative_id": b.id[at], "negative_score": scores}))
        return pd.concat(found) if found else pd.DataFrame({"anchor": [], "positive_rank": [], "negative_id": [], "negative_score": []})

    found = met(questions, find_negatives, "anchor LONG, positive_rank INT, negative_id LONG, negative_score LONG")
    found = first(found, ["anchor", "positive_rank"], "negative_score", "negative_id", negatives)
    pairs = questions.select("anchor", F.col("id").alias("anchor_id"), F.explode(F.arrays_zip("positive_rank", "positive_id", "positive_score")).alias("p")).select("anchor", "anchor_id", "p.*")
    return pairs.join(found, ["anchor", "positive_rank"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
