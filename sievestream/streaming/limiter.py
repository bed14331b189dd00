"""The rate limiter on a stream: the batch limiter in every micro-batch, the buckets handed on from one to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievestream.functions import values as V
from sievestream.operators.limiter import STATE_DDL, Bucket, rate_limit_from
from sievestream.session import cut_lineage
from sievestream.streaming.state import BatchTable

EXPIRATION_SECONDS = 60.0


class BucketStore(BatchTable):
    """The buckets after each micro-batch."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, folder, STATE_DDL, "buckets")


def limit_batch(
    keyed: DataFrame, batch_id: int, bucket: Bucket, store: BucketStore, expiration_seconds: float | None = EXPIRATION_SECONDS
) -> DataFrame:
    """(row_id, rule_value, ts, admitted) of a micro-batch of (row_id, rule_value, ts); ids and times only, never messages.

    The order within a batch is (ts, row_id); across batches time must not run back. A rule value whose last admission lies
    more than the expiration time before the batch's newest row loses its bucket and later starts with a full one.
    """
    decided, state = rate_limit_from(keyed, bucket, store.before(batch_id))
    decided = cut_lineage(decided, "decided")
    if expiration_seconds is not None:
        newest = decided.agg(F.max(V.micros(F.col("ts"))).alias("at")).first()["at"]
        if newest is not None:
            state = state.where(F.col("last") >= newest - int(expiration_seconds * V.MICROS))
    store.write(state, batch_id)
    return decided
