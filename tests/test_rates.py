import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievestream.functions import values as V
from sievestream.operators import limiter as L
from sievestream.operators import rates as A
from sievestream.streaming.limiter import BucketStore, limit_batch


def timed(spark, rows, ddl="rule_value STRING"):
    frame = spark.createDataFrame(rows, f"{ddl}, at_us BIGINT")
    return frame.select("*", F.timestamp_micros("at_us").alias("ts")).drop("at_us")


@pytest.mark.parametrize(
    "events, expected", [([1, 2, 3], (3, 1.0, 0.75, 0.0)), ([], (0, 0.0, 0.0, 0.0)), ([2], (1, 1.0, 0.25, 0.0))]
)
def test_golden_rates(spark, events, expected):
    data = timed(spark, [("test", e * V.MICROS) for e in events])
    keys = spark.createDataFrame([("test",)], "rule_value STRING")
    rows = A.rate_stats(data, 4 * V.MICROS, 4 * V.MICROS, keys).collect()
    assert [tuple(r)[1:] for r in rows] == [expected]
    assert A.rate_stats(data, 4 * V.MICROS, 0, keys).count() == 0


def direct_rates(times, now, window):
    recent = sorted(t for t in times if t >= now - window)
    seconds = window / V.MICROS
    average = len(recent) / seconds
    buckets = Counter({i: 0 for i in range(int(seconds))})
    buckets.update((t - recent[0]) // V.MICROS for t in recent)
    return len(recent), max(average, *buckets.values()), average, min(average, *buckets.values())


@pytest.mark.parametrize("window", [5_000_000, 3_500_000, 60_000_000])
def test_rates_like_direct_computation(spark, window):
    rng = random.Random(window)
    now = 100_000_000
    times = {k: [now - rng.randint(0, 8_000_000) for _ in range(n)] for k, n in {"hot": 400, "b": 20, "c": 3}.items()}
    data = timed(spark, [(k, t) for k, ts in times.items() for t in ts])
    got = {r[0]: tuple(r)[1:] for r in A.rate_stats(data, now, window).collect()}
    assert got == {k: pytest.approx(direct_rates(ts, now, window)) for k, ts in times.items() if any(t >= now - window for t in ts)}


@pytest.mark.parametrize("window", [900, 7])
def test_rolling_counts_like_direct_computation(spark, window):
    rng = random.Random(window)
    rows = [(rng.choice("hhhhab"), rng.randint(0, 4000) * 500_000 + rng.choice([0, 0, 1, 999_999])) for _ in range(400)]
    rows += [("h", 2_000_000), ("h", 2_000_000 + window * V.MICROS), ("h", 2_000_001 + window * V.MICROS), ("h", -5)]
    got = A.rolling_counts(timed(spark, rows, "rule_id STRING"), window_seconds=window)
    got = {(r[0], r[1]): r[2] for r in got.select("rule_id", V.micros(F.col("ts")), "n").collect()}
    assert got == {
        (k, t): sum(1 for k2, t2 in rows if k2 == k and t - window * V.MICROS <= t2 <= t) for k, t in set(rows)
    }


def test_zero_filled_counters(spark):
    rules = spark.createDataFrame([("1",), ("2",)], "rule_id STRING")
    counts = spark.createDataFrame([("1", 3), ("1", 2)], "rule_id STRING, n BIGINT")
    assert sorted(map(tuple, A.zero_filled(rules, counts).collect())) == [("1", 5), ("2", 0)]


def test_evaluation_span():
    assert A.evaluation_span_us(100, 40, 20) == 40 and A.evaluation_span_us(100, 90, 20) == 10


# --- token bucket --------------------------------------------------------------------------------------------------


def scalar_bucket(times, rate, capacity, cost):
    """Tokens in millionths, one message after the other."""
    tokens, last, admitted = capacity * 1_000_000, times[0] if times else 0, []
    for t in times:
        tokens = min(capacity * 1_000_000, tokens + (t - last) * rate)
        last = t
        admitted.append(tokens >= cost * 1_000_000)
        tokens -= cost * 1_000_000 * admitted[-1]
    return admitted


@pytest.mark.parametrize("rate, capacity, cost", [(10, 10, 1), (1, 3, 2), (5, 1, 1), (2, 1, 3)])
def test_walk_like_scalar_bucket(rate, capacity, cost):
    rng = random.Random(rate)
    bucket = L.Bucket(rate, capacity, cost)
    for _ in range(30):
        times = sorted(rng.randint(0, 6_000_000) for _ in range(rng.randint(1, 80)))
        cut = rng.randint(0, len(times))
        first, tokens, last = L.walk(np.array(times[:cut], dtype=np.int64), bucket.full, times[0], bucket)
        second, _, _ = L.walk(np.array(times[cut:], dtype=np.int64), tokens, last, bucket)
        assert [*first, *second] == scalar_bucket(times, rate, capacity, cost)


def test_hundred_messages_ten_milliseconds_apart(spark):
    rows = [("air force", i * 10_000, f"{i:03d}") for i in range(100)]
    frame = timed(spark, [(k, r, t) for k, t, r in rows], "rule_value STRING, row_id STRING")
    decided = L.rate_limit(frame, L.Bucket())
    assert decided.count() == 100
    assert decided.where("admitted").count() == 19


@pytest.mark.parametrize("seed", range(3))
def test_limiter_like_scalar_bucket(spark, seed):
    rng = random.Random(seed)
    times = {
        "hot": [rng.randint(0, 3_000_000) for _ in range(500)],
        "bursts": [s * 5_000_000 + rng.randint(0, 200_000) for s in range(8) for _ in range(25)],
        "same": [1_000_000] * 200 + [1_400_000] * 200,
        "slow": [i * 700_000 for i in range(30)],
    }
    rows = [(k, f"{k}{i:04d}", t) for k, ts in times.items() for i, t in enumerate(sorted(ts))]
    frame = timed(spark, rows, "rule_value STRING, row_id STRING")
    got = {(r["rule_value"], r["row_id"]): r["admitted"] for r in L.rate_limit(frame, L.Bucket(4, 5)).collect()}
    expected = {}
    for k, ts in times.items():
        for i, ok in enumerate(scalar_bucket(sorted(ts), 4, 5, 1)):
            expected[(k, f"{k}{i:04d}")] = ok
    assert got == expected


def test_bucket_settings_are_at_least_one():
    bucket = L.Bucket(rate=0.1, capacity=0, cost=0)
    assert (bucket.rate, bucket.capacity, bucket.cost) == (1.0, 1, 1)


def test_message_passes_when_one_value_passes_or_none_counts(spark):
    decided = spark.createDataFrame(
        [("1", "a", False), ("1", "b", True), ("2", "a", False), ("2", "b", False)], "row_id STRING, rule_value STRING, admitted BOOLEAN"
    )
    messages = spark.createDataFrame([("1",), ("2",), ("3",)], "row_id STRING")
    assert sorted(r[0] for r in L.admit(messages, decided).collect()) == ["1", "3"]


def test_expiry(spark):
    now = 1_000 * V.MICROS
    data = timed(spark, [("test", now - s * V.MICROS) for s in (360, 240, 120, 0)] + [("old", now - 30 * V.MICROS)])
    kept = L.unexpired(data, now, 30 * V.MICROS).collect()
    assert [r["rule_value"] for r in kept] == ["test"]
    assert [r[0] for r in L.expired_keys(data, now, 30 * V.MICROS).collect()] == ["old"]


def test_limiter_on_a_stream(spark, tmp_path):
    """Two batches in turn: the bucket goes on where the first one left it; a batch that runs again decides the same."""
    rows = [(f"{i:03d}", "air force", i * 10_000) for i in range(100)] + [(f"{i:03d}", "second", i * 10_000) for i in range(0, 100, 20)]
    store = BucketStore(spark, str(tmp_path / "buckets"))

    def run(part, batch_id):
        keyed = spark.createDataFrame(part, "row_id STRING, rule_value STRING, at BIGINT").select("row_id", "rule_value", F.timestamp_micros("at").alias("ts"))
        return {(r["row_id"], r["rule_value"]): r["admitted"] for r in limit_batch(keyed, batch_id, L.Bucket(), store, None).collect()}

    first, second = [r for r in rows if r[2] < 400_000], [r for r in rows if r[2] >= 400_000]
    got = run(first, 0)
    again = run(second, 1)
    assert run(second, 1) == again
    got |= again
    expected = scalar_bucket([i * 10_000 for i in range(100)], 10, 10, 1)
    assert [got[f"{i:03d}", "air force"] for i in range(100)] == expected and sum(expected) == 19
    assert all(got[f"{i:03d}", "second"] for i in range(0, 100, 20)) and len(got) == 105
    assert store.before(2).count() == 2
    limit_batch(spark.createDataFrame([], "row_id STRING, rule_value STRING, ts TIMESTAMP"), 2, L.Bucket(), store)
    assert store.before(3).count() == 2


def test_idle_buckets_expire(spark, tmp_path):
    store = BucketStore(spark, str(tmp_path / "buckets"))
    for batch_id, (key, second) in enumerate([("a", 0), ("b", 50), ("b", 100)]):
        keyed = spark.createDataFrame([("1", key, second)], "row_id STRING, rule_value STRING, s LONG").select("row_id", "rule_value", F.timestamp_seconds("s").alias("ts"))
        limit_batch(keyed, batch_id, L.Bucket(), store, 60.0)
    assert [r["key"] for r in store.before(3).collect()] == ["b"]


def test_limited_collector_end_to_end(spark, make_rules, tmp_path):
    import json

    from tests.samples import rule, tweet

    from sievestream.sources.messages import stream_lines
    from sievestream.streaming.collector import start_collector

    (tmp_path / "in").mkdir()
    lines = [json.dumps(tweet(text="air force one")) for _ in range(40)] + [json.dumps({"warning": {"code": "x"}})] * 3
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    rules = make_rules(rule(1, "air force", "keyword"))
    sent, reported, counted, numbers = [], [], [], []
    start_collector(
        stream_lines(spark, str(tmp_path / "in")),
        lambda: rules,
        "track",
        0,
        lambda batch, i: sent.extend(r["output"] for r in batch.collect()),
        str(tmp_path / "ck"),
        bucket=L.Bucket(),
        on_series=lambda batch, i: reported.extend(batch.collect()),
        on_increments=lambda batch, i: counted.extend(batch.collect()),
        on_counts=lambda counts, i: numbers.append(counts),
        available_now=True,
    ).awaitTermination()
    # All lines of a file arrive at one time: the burst passes, and so does what no rule is about.
    assert len(sent) == 10 + 3 and len(reported) == 40
    # Every match counts, also of messages that the limiter drops.
    assert len(counted) == 40 and numbers == [{"keep_alives": 0, "malformed": 0, "messages": 43}]
    assert sum("warning" in s for s in sent) == 3
