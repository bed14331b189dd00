"""Token-bucket rate limiting per rule value.

Tokens are kept in integer units (`_UNIT` per token), so results do not depend on how a series is cut into pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from sievestream.functions import values as V
from sievestream.operators.distribute import salted_join
from sievestream.session import cut_lineage

_UNIT = 1_000_000_000


@dataclass(frozen=True)
class Bucket:
    """`rate` tokens per second up to `capacity`; a message costs `cost` tokens per rule value."""

    rate: float = 10.0
    capacity: int = 10
    cost: int = 1

    def __post_init__(self) -> None:
        object.__setattr__(self, "rate", max(1.0, float(self.rate)))
        object.__setattr__(self, "capacity", max(1, int(self.capacity)))
        object.__setattr__(self, "cost", max(1, int(self.cost)))

    @property
    def full(self) -> int:
        return self.capacity * _UNIT

    @property
    def price(self) -> int:
        return self.cost * _UNIT

    @property
    def refill(self) -> int:
        """Units per microsecond (rates are exact to three decimals)."""
        return round(self.rate * 1000)

    @property
    def burst(self) -> int:
        """Messages a full bucket pays for."""
        return self.capacity // self.cost

    @property
    def idle_us(self) -> int:
        """After this long without a message the bucket is full, whatever happened before."""
        return -(-self.full // self.refill)


def walk(at: np.ndarray, tokens: int, last: int, bucket: Bucket) -> tuple[np.ndarray, int, int]:
    """Admits a time-ordered series (microseconds) starting from `tokens` at time `last`.

    Refused messages take nothing, so after a refusal the walk jumps to the first message late enough to be paid.
    Returns the admitted mask and the bucket after the last admission. A clock that runs back adds no tokens.
    """
    admitted = np.zeros(len(at), dtype=bool)
    full, price, refill = bucket.full, bucket.price, bucket.refill
    if price > full:
        return admitted, tokens, last
    i, n = 0, len(at)
    while i < n:
        t = max(int(at[i]), last)
        have = min(full, tokens + (t - last) * refill)
        if have >= price:
            admitted[i] = True
            tokens, last = have - price, t
            i += 1
        else:
            ready = last - ((tokens - price) // refill)
            i += max(1, int(np.searchsorted(at[i:], ready)))
    return admitted, tokens, last


def _placed(keyed: DataFrame, bucket: Bucket, row_id: str, key: str, ts: str) -> DataFrame:
    narrow = keyed.select(F.col(row_id).alias("row_id"), F.col(key).alias("key"), F.col(ts).alias("ts"))
    timed = narrow.withColumn("at", V.micros(F.col("ts")))
    return cut_lineage(timed.withColumn("cell", V.floor_div(F.col("at"), bucket.idle_us)), "limiter")


def _in_stretches(placed: DataFrame, bucket: Bucket) -> DataFrame:
    """(row_id, key, at, stretch, n_stretch) of the rows that may pass.

    * Of rows with one key and time at most a burst can pass: the others go before the shuffle.
    * A series falls apart wherever it pauses long enough for the bucket to fill. Such stretches do not depend on each
      other, so they, not keys, are the unit of work. They are found on the distinct (key, cell) pairs: two busy cells
      with an idle one between them are at least one idle time apart.
    """
    rank = F.row_number().over(Window.partitionBy("key", "at").orderBy("row_id"))
    candidates = placed.withColumn("rank", rank).where(F.col("rank") <= bucket.burst).drop("rank", "ts")
    candidates = cut_lineage(candidates, "candidates")

    cells = candidates.groupBy("key", "cell").agg(F.count("*").alias("n"))
    in_time = Window.partitionBy("key").orderBy("cell")
    starts = F.coalesce(F.col("cell") - F.lag("cell").over(in_time) > 1, F.lit(True))
    stretches = (
        cells.withColumn("is_start", starts)
        .withColumn("stretch", F.max(F.when(F.col("is_start"), F.col("cell"))).over(in_time))
        .withColumn("n_stretch", F.sum("n").over(Window.partitionBy("key", "stretch")))
        .select("key", "cell", "stretch", "n_stretch")
    )
    return salted_join(candidates, stretches, ["key", "cell"], F.col("row_id"))


def _admitted(placed: DataFrame, bucket: Bucket) -> DataFrame:
    """(row_id, key) of the admitted rows.

    A stretch that a full bucket pays for is admitted as it is. Only the rest is streamed, in time order, through a
    walk that keeps two numbers.
    """
    assigned = _in_stretches(placed, bucket)
    quiet = assigned.where(F.col("n_stretch") <= bucket.burst).select("row_id", "key")
    busy = assigned.where(F.col("n_stretch") > bucket.burst).select("row_id", "key", "stretch", "at")
    ordered = busy.repartition("key", "stretch").sortWithinPartitions("key", "stretch", "at", "row_id")
    walked = ordered.mapInPandas(_walk_batches(bucket), ordered.select("row_id", "key").schema)
    return quiet.unionByName(walked)


def _walk_batches(bucket: Bucket):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, tokens, last = None, 0, 0
        for batch in batches:
            if batch.empty:
                continue
            at = batch["at"].to_numpy()
            groups = pd.MultiIndex.from_frame(batch[["key", "stretch"]])
            codes = groups.factorize()[0]
            edges = [0, *(np.flatnonzero(np.diff(codes)) + 1), len(batch)]
            keep = np.zeros(len(batch), dtype=bool)
            for lo, hi in zip(edges, edges[1:]):
                if groups[lo] != current:
                    current, tokens, last = groups[lo], bucket.full, int(at[lo])
                keep[lo:hi], tokens, last = walk(at[lo:hi], tokens, last, bucket)
            yield batch.loc[keep, ["row_id", "key"]]

    return run


def rate_limit(
    keyed: DataFrame, bucket: Bucket, row_id: str = "row_id", key: str = "rule_value", ts: str = "ts"
) -> DataFrame:
    """(row_id, key, ts, admitted) for every row of `keyed`; the order within a key is (ts, row_id).

    (row_id, key) must be unique and not null.
    """
    placed = _placed(keyed, bucket, row_id, key, ts)
    passed = _admitted(placed, bucket).withColumn("admitted", F.lit(True))
    flagged = placed.join(passed, ["row_id", "key"], "left")
    return flagged.select(
        F.col("row_id").alias(row_id),
        F.col("key").alias(key),
        F.col("ts").alias(ts),
        F.coalesce("admitted", F.lit(False)).alias("admitted"),
    )


STATE_DDL = "key STRING, tokens BIGINT, last BIGINT"
_WALKED_DDL = "row_id STRING, key STRING, stretch BIGINT, tokens BIGINT, last BIGINT"


def _walk_from(bucket: Bucket):
    """As `_walk_batches`, from the bucket that a row brings along; a row without id tells how a stretch leaves its bucket."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, tokens, last = None, 0, 0
        left = lambda: pd.DataFrame(
            {"row_id": [None], "key": [current[0]], "stretch": [current[1]], "tokens": [tokens], "last": [last]}
        )
        for batch in batches:
            if batch.empty:
                continue
            at, keys, stretches = batch["at"].to_numpy(), batch["key"].to_numpy(), batch["stretch"].to_numpy()
            edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]) | (stretches[1:] != stretches[:-1])) + 1), len(batch)]
            for lo, hi in zip(edges, edges[1:]):
                if (keys[lo], stretches[lo]) != current:
                    if current is not None:
                        yield left()
                    known = not pd.isna(batch["tokens"].iloc[lo])
                    current = (keys[lo], stretches[lo])
                    tokens, last = (int(batch["tokens"].iloc[lo]), int(batch["last"].iloc[lo])) if known else (bucket.full, int(at[lo]))
                keep, tokens, last = walk(at[lo:hi], tokens, last, bucket)
                passed = batch.iloc[lo:hi][keep]
                yield pd.DataFrame({"row_id": passed["row_id"], "key": passed["key"], "stretch": passed["stretch"], "tokens": None, "last": None})
        if current is not None:
            yield left()

    return run


def rate_limit_from(keyed: DataFrame, bucket: Bucket, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The decisions of `rate_limit` for rows that follow on earlier ones, and the buckets they leave.

    `keyed` is (row_id, rule_value, ts) with text ids; `state` is (key, tokens, last), the buckets so far; values without one begin with
    a full bucket. Only a value's first stretch depends on its bucket, so stretches are walked apart from each other here, too.
    """
    placed = _placed(keyed, bucket, "row_id", "rule_value", "ts")
    assigned = _in_stretches(placed, bucket)
    first = placed.groupBy("key").agg(F.min("cell").alias("stretch")).join(state, "key")
    rows = salted_join(assigned, first, ["key", "stretch"], F.col("row_id"), how="left")
    rows = rows.select("row_id", "key", "stretch", "at", F.col("tokens").cast("double"), F.col("last").cast("double"))
    # Doubles carry the missing values; both numbers are below 2 ** 53.
    ordered = rows.repartition("key", "stretch").sortWithinPartitions("key", "stretch", "at", "row_id")
    walked = cut_lineage(ordered.mapInPandas(_walk_from(bucket), _WALKED_DDL), "walked")
    passed = walked.where("row_id IS NOT NULL").select("row_id", "key", F.lit(True).alias("admitted"))
    decided = placed.join(passed, ["row_id", "key"], "left").select(
        "row_id", F.col("key").alias("rule_value"), "ts", F.coalesce("admitted", F.lit(False)).alias("admitted")
    )
    left = walked.where("row_id IS NULL").groupBy("key").agg(F.max_by(F.struct("tokens", "last"), "stretch").alias("b"))
    left = left.select("key", "b.*")
    return decided, left.unionByName(state.join(left, "key", "left_anti").select("key", "tokens", "last"))


def dropped_messages(decided: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Ids of messages with at least one rule value, all of them over their limit."""
    return decided.groupBy(row_id).agg(F.bool_or("admitted").alias("any")).where("NOT any").select(row_id)


def admit(messages: DataFrame, decided: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Messages that may be sent; messages without a rule value always may."""
    return messages.join(dropped_messages(decided, row_id), row_id, "left_anti").select(*messages.columns)


def unexpired(series: DataFrame, now_us: int, age_us: int, ts: str = "ts") -> DataFrame:
    """The part of an event series that is younger than `age_us`."""
    return series.where(V.micros(F.col(ts)) > now_us - age_us)


def expired_keys(series: DataFrame, now_us: int, age_us: int, key: str = "rule_value", ts: str = "ts") -> DataFrame:
    """Rule values without a young event: their series and bucket are forgotten."""
    newest = series.groupBy(key).agg(F.max(V.micros(F.col(ts))).alias("_newest"))
    return newest.where(F.col("_newest") <= now_us - age_us).select(key)
