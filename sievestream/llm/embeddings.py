"""Near-duplicate vectors by sorted projection passes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sievestream.llm.common import components, cut_lineage, in_order

RECALL = 0.98
HASHES = 64
WINDOW = 64
BLOCK = 2048
COUNT_BLOCK = 512
#: A vector lies dense where the end of its window is still this close in some pass: other vectors may then have kept a partner out of the window.
DENSE = 0.7


def _unit(vectors: pd.Series) -> np.ndarray:
    rows = np.array(vectors.tolist(), np.float64)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _same_length(vectors: pd.Series) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and unit vectors, for each vector length by itself: vectors of different length are not compared."""
    lengths = vectors.map(len).to_numpy()
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield at, _unit(vectors.iloc[at])


def passes_for(n: int, threshold: float, window: int, recall: float) -> int:
    """Passes after which a pair at the threshold has met in a window with probability `recall`.

    Two vectors meet when their first log2(n / window) signs agree; one sign agrees with probability 1 - angle / pi.
    """
    agree = 1 - np.arccos(threshold) / np.pi
    meet = min(agree ** max(0.0, np.log2(max(n, 1) / window)), 1 - 1e-9)
    return max(2, int(np.ceil(np.log(1 - recall) / np.log(1 - meet))))


def _keys(vectors: DataFrame, passes: int, hashes: int) -> DataFrame:
    """One row for each vector and pass: the signs on random directions, concatenated to the text the pass sorts by."""

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            for at, unit in _same_length(pdf["vector"]):
                for run in range(passes):
                    random = np.random.default_rng(np.random.PCG64([run, unit.shape[1]]))
                    bits = (unit @ random.standard_normal((unit.shape[1], hashes)) > 0).astype(np.uint8)
                    words = np.packbits(bits, axis=1)
                    yield pd.DataFrame(
                        {"run": np.int32(run), "hash": [f"{unit.shape[1]:08d}{w.tobytes().hex()}" for w in words], "node": pdf["node"].to_numpy()[at], "vector": pdf["vector"].to_numpy()[at]}
                    )

    return vectors.mapInPandas(project, "run INT, hash STRING, node LONG, vector ARRAY<FLOAT>" if dict(vectors.dtypes)["vector"] == "array<float>" else "run INT, hash STRING, node LONG, vector ARRAY<DOUBLE>")


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs that hang together as the given ones do, at most one for each node: every node with the lowest that it reaches."""
    nodes, inverse = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = inverse[: len(a)], inverse[len(a) :]
    low = np.arange(len(nodes))
    while True:
        before = low.copy()
        reached = np.minimum(low[a], low[b])
        np.minimum.at(low, a, reached)
        np.minimum.at(low, b, reached)
        low = low[low]
        if np.array_equal(low, before):
            break
    at = np.flatnonzero(low != np.arange(len(nodes)))
    return np.column_stack([nodes[low[at]], nodes[at]])


def _window_links(threshold: float, window: int, dense: float):
    """Per block of sorted nodes: links (a, b) of kind 0, as a forest, and of kind 1 those that tie dense nodes to their neighbourhood."""

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_idx", kind="stable").reset_index(drop=True)
        runs, nodes, found, close = pdf["run"].to_numpy(), pdf["node"].to_numpy(), [], []
        own = (pdf["_idx"] // BLOCK == key[0]).to_numpy()
        for at, unit in _same_length(pdf["vector"]):
            edge = np.zeros(len(at), bool)
            for step in range(min(window, len(at) - 1), 0, -1):
                a, b = at[:-step], at[step:]
                cosines = np.einsum("ij,ij->i", unit[:-step], unit[step:])
                valid = (runs[a] == runs[b]) & own[a] & (b - a <= window)
                near = valid & (cosines >= threshold)
                found.append(np.column_stack([nodes[a[near]], nodes[b[near]]]))
                if step == window:
                    edge[:-step] = valid & (cosines >= dense)
                if step in (window, 1):
                    tied = valid & (cosines >= dense) & edge[:-step]
                    close.append(np.column_stack([nodes[a[tied]], nodes[b[tied]]]))
        parts = []
        for kind, pairs in ((0, found), (1, close)):
            pairs = np.concatenate(pairs) if pairs else np.empty((0, 2), np.int64)
            pairs = _forest(pairs[:, 0], pairs[:, 1]) if len(pairs) else pairs
            parts.append(pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1], "kind": np.int32(kind)}))
        return pd.concat(parts)

    return compare


def _counts(threshold: float):
    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        total = np.zeros(len(left), np.int64)
        for at, unit in _same_length(left["vector"]):
            for other, unit2 in _same_length(right["vector"]) if len(right) else ():
                if unit.shape[1] == unit2.shape[1]:
                    near = unit @ unit2.T >= threshold
                    same = left["node"].to_numpy()[at][:, None] == right["node"].to_numpy()[other][None, :]
                    total[at] += (near & ~same) @ right["copies"].to_numpy()[other]
        return pd.DataFrame({"node": left["node"].to_numpy(), "links": total})

    return count


def _tiles(members: DataFrame, group: str) -> DataFrame:
    """Every pair of blocks of a group's members (group, node, vector, ...) as (group, x, y, side, ...): side 0 are the rows of block x, side 1 those of y."""
    numbered = in_order(members, [group, "node"], None, "vectors-members").drop("_before").withColumn("_block", F.floor(F.col("_idx") / COUNT_BLOCK)).drop("_idx")
    numbered = cut_lineage(numbered, "vectors-blocks")
    span = numbered.groupBy(group).agg(F.min("_block").alias("low"), F.max("_block").alias("high"))
    numbered = numbered.join(span, group)
    others = F.explode(F.sequence("low", "high"))
    rest = [c for c in members.columns if c != group]
    return numbered.select(group, F.col("_block").alias("x"), others.alias("y"), F.lit(0).alias("side"), *rest).union(
        numbered.select(group, others.alias("x"), F.col("_block").alias("y"), F.lit(1).alias("side"), *rest)
    )


def _tile_links(threshold: float):
    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        pairs = []
        for at, unit in _same_length(left["vector"]):
            for other, unit2 in _same_length(right["vector"]) if len(right) else ():
                if unit.shape[1] == unit2.shape[1]:
                    x, y = np.nonzero(unit @ unit2.T >= threshold)
                    a, b = left["node"].to_numpy()[at][x], right["node"].to_numpy()[other][y]
                    pairs.append(np.column_stack([a, b])[a != b])
        pairs = np.concatenate(pairs) if pairs else np.empty((0, 2), np.int64)
        pairs = _forest(pairs[:, 0], pairs[:, 1]) if len(pairs) else pairs
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return link


def near_vectors(vectors: DataFrame, threshold: float = 0.9, vector: str = "embedding", key: str = "vec_id", recall: float = RECALL, hashes: int = HASHES, window: int = WINDOW, dense: float = DENSE) -> DataFrame:
    """One row per vector: key, `n_links`, `component_id` (smallest key reachable), `kept` (the row is its component's smallest).

    Equal vectors are one node with a number of copies. Each pass sorts the nodes by the concatenated signs
    on random directions of its own (passes_for() gives their number) and compares every node with the next `window` ones by cosine in double precision;
    blocks of sorted nodes carry the head of the next block, so no neighbour is lost at a border. Verified pairs of all passes
    are united to components. In sparse places only pairs within the windows are candidates: recall is measured, not certain. Where the end of a window is still
    close (cosine `dense` or more) the window may have been too short: such vectors are tied to their neighbours of the window, and all vectors that
    hang together so are compared with each other, block against block. Links are then counted exactly, block against block within a
    component. Neither step emits pairs: a block gives one link for each node at most.

    Null and empty vectors, zero vectors and those with null or non-finite components link with nothing. Vectors of different
    length are never compared. Equal cosines need no order: every link counts. A row with a null key counts as a copy; repeated keys are rows of their own. An
    empty table gives no rows.
    """
    good = (
        (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )
    positive = F.transform(vector, lambda x: F.when(x == 0, F.lit(0).cast(vectors.schema[vector].dataType.elementType)).otherwise(x))
    rows = cut_lineage(
        vectors.select(key, F.when(F.coalesce(good, F.lit(False)), positive).alias("vector")).withColumn("_digest", F.sha2(F.to_json(F.struct("vector")), 256)),
        "vectors",
    )
    distinct = rows.where("vector IS NOT NULL").groupBy("_digest").agg(F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min(key).alias("first_key"))
    distinct = cut_lineage(in_order(distinct, ["_digest"], None, "vectors-distinct").withColumnRenamed("_idx", "node").drop("_before"), "vectors-nodes")

    passes = passes_for(distinct.count(), threshold, window, recall)
    ordered = in_order(_keys(distinct.select("node", "vector"), passes, hashes), ["run", "hash", "node"], None, "vectors-passes")
    home = F.floor(F.col("_idx") / BLOCK)
    blocks = F.when((F.col("_idx") % BLOCK < window) & (home > 0), F.array(home, home - 1)).otherwise(F.array(home))
    found = ordered.withColumn("block", F.explode(blocks)).groupBy("block").applyInPandas(_window_links(threshold, window, dense), "a LONG, b LONG, kind INT")
    found = cut_lineage(found.distinct(), "vectors-found")
    crowds = components(found.where("kind = 1").select("a", "b"), "vectors-crowds").select("node", F.col("component").alias("crowd"))
    crowded = _tiles(distinct.join(crowds, "node").select("crowd", "node", "vector"), "crowd").where("x <= y")
    within = crowded.groupBy("crowd", "x", "y").applyInPandas(_tile_links(threshold), "a LONG, b LONG")
    groups = cut_lineage(components(found.where("kind = 0").select("a", "b").union(within).distinct(), "vectors-components"), "vectors-groups")

    sides = _tiles(distinct.join(groups, "node").select("component", "node", "vector", "copies"), "component")
    counts = sides.groupBy("component", "x", "y").applyInPandas(_counts(threshold), "node LONG, links LONG").groupBy("node").agg(F.sum("links").alias("links"))

    named = distinct.drop("vector").join(groups, "node", "left").join(counts, "node", "left")
    own = F.coalesce("component", "node")
    first = named.groupBy(own.alias("component")).agg(F.min("first_key").alias("component_id"))
    named = named.withColumn("component", own).join(first, "component").select("_digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    named = cut_lineage(named, "vectors-named")
    return rows.drop("vector").join(named, "_digest", "left").select(
        key,
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", key).alias("component_id"),
    ).withColumn("kept", F.col(key) == F.col("component_id"))
