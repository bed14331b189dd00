"""Counters, rolling windows and traffic rates per rule."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from sievestream.functions import values as V
from sievestream.operators.distribute import salted_join
from sievestream.session import cut_lineage

ROLLING_WINDOW_SECONDS = 900
_SLICES = 900


def rule_increments(tagged: DataFrame, *keep: Column | str) -> DataFrame:
    """One row per (message, matched rule)."""
    return tagged.select(*keep, F.explode("collection_rules.rule_id").alias("rule_id")).where("rule_id IS NOT NULL")


def rolling_counts(
    increments: DataFrame, key: str = "rule_id", ts: str = "ts", window_seconds: int = ROLLING_WINDOW_SECONDS
) -> DataFrame:
    """(key, ts, n): how many increments of the key fall into [ts - window, ts], at every time that has one.

    A range frame over the key would sort a hot key in one task. Instead equal times are counted first, the time line
    is cut into slices, and the count at ts is put together from
      * the increments of the same slice up to ts,
      * the whole slices in between, from per-slice totals,
      * the increments of the slice that holds ts - window, from there on.
    No task sees more than one slice of one key (or a few thousand slice totals).
    """
    window_us = window_seconds * V.MICROS
    n_slices = max(n for n in range(1, _SLICES + 1) if window_us % n == 0)
    slice_us = window_us // n_slices
    slice_of = lambda c: V.floor_div(c, slice_us)

    counted = cut_lineage(
        increments.select(F.col(key).alias("key"), F.col(ts).alias("ts")).groupBy("key", "ts").agg(F.count("*").alias("n")),
        "rolling",
    )
    points = counted.select("key", V.micros(F.col("ts")).alias("at"), "n")
    # Every point is looked at twice: as data in its own slice, and as a question to the slice one window earlier.
    roles = F.array(
        F.struct(F.col("at").alias("pos"), F.col("n").alias("add"), F.lit(True).alias("is_data")),
        F.struct((F.col("at") - window_us).alias("pos"), F.lit(0).cast("long").alias("add"), F.lit(False).alias("is_data")),
    )
    placed = points.select("key", "at", F.explode(roles).alias("r")).select("key", "at", "r.*")
    placed = placed.withColumn("slice", slice_of(F.col("pos")))
    in_slice = Window.partitionBy("key", "slice").orderBy("pos")
    up_to = F.sum("add").over(in_slice.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    from_here = F.sum("add").over(in_slice.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    edges = placed.withColumn("n", F.when(F.col("is_data"), up_to).otherwise(from_here))
    edges = edges.groupBy("key", "at").agg(F.sum("n").alias("n_edges"))

    # Per-slice totals, with the slices of a block of `n_slices` and of the block before it in one small group.
    totals = points.groupBy("key", slice_of(F.col("at")).alias("slice")).agg(F.sum("n").alias("n"))
    block = V.floor_div(F.col("slice"), n_slices)
    copies = F.array(F.struct(block.alias("block"), F.lit(True).alias("own")), F.struct((block + 1).alias("block"), F.lit(False).alias("own")))
    blocks = totals.select("key", "slice", "n", F.explode(copies).alias("c")).select("key", "slice", "n", "c.*")
    around = Window.partitionBy("key", "block").orderBy("slice").rangeBetween(-(n_slices - 1), -1)
    between = blocks.withColumn("n_between", F.coalesce(F.sum("n").over(around), F.lit(0)))
    between = between.where("own").select("key", "slice", "n_between")

    total = edges.withColumn("slice", slice_of(F.col("at"))).join(between, ["key", "slice"])
    result = total.select("key", "at", (F.col("n_edges") + F.col("n_between")).alias("n"))
    return result.select(F.col("key").alias(key), F.timestamp_micros("at").alias(ts), "n")


def zero_filled(rules: DataFrame, counts: DataFrame, count: str = "n") -> DataFrame:
    """A count for every rule, 0 where nothing matched."""
    joined = rules.select("rule_id").distinct().join(counts.groupBy("rule_id").agg(F.sum(count).alias(count)), "rule_id", "left")
    return joined.select("rule_id", F.coalesce(count, F.lit(0)).alias(count))


def current_version(counts: DataFrame, versions: DataFrame) -> DataFrame:
    """Counters live per rules version: those of the newest version only."""
    newest = versions.agg(F.max("rules_version").alias("rules_version"))
    return counts.join(newest, "rules_version", "left_semi")


_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _seconds(interval: str) -> int:
    found = re.fullmatch(r"(\d+) (second|minute|hour|day)s?", interval)
    if not found:
        raise ValueError(f"not a whole number of seconds, minutes, hours or days: {interval!r}")
    return int(found[1]) * _SECONDS[found[2]]


def pane_length(window: str, every: str) -> str:
    """The longest pane that windows of this length and step are made of."""
    return f"{math.gcd(_seconds(window), _seconds(every))} seconds"


def limit_windows(limits: DataFrame, window: str = "900 seconds", every: str = "900 seconds") -> DataFrame:
    """Per window of (ts, limit_value): how many notices, their sum and maximum, and the latest value.

    Sliding windows are combined from panes that length and step have in common, so a row is counted once, not once per window.
    """
    pane = F.window("ts", pane_length(window, every))
    value = F.col("limit_value")
    panes = limits.groupBy(pane.alias("pane")).agg(
        F.count(value).alias("n"), F.sum(value).alias("total"), F.max(value).alias("top"),
        F.max(F.when(value.isNotNull(), F.struct("ts", "limit_value"))).alias("last"),
    )
    merged = panes.groupBy(F.window("pane.start", window, every).alias("w")).agg(
        F.sum("n").alias("n_limits"), F.sum("total").alias("sum_limit"), F.max("top").alias("max_limit"),
        F.max("last")["limit_value"].alias("last_limit"),
    )
    return merged.select(F.col("w.start").alias("window_start"), "n_limits", "sum_limit", "max_limit", "last_limit")


def rate_stats(
    series: DataFrame, now_us: Column | int, window_us: int, keys: DataFrame | None = None, weight: str | None = None
) -> DataFrame:
    """Count, average, highest and lowest per-second rate of every key over the last `window_us`.

    `series` is (rule_value, ts), each row one event or, with `weight`, as many as this column says. Seconds are counted from the key's first event in the window. `keys` lists values
    that get a row even without events. An empty window gives no rows.
    """
    now = F.lit(now_us) if isinstance(now_us, int) else now_us
    seconds = float(window_us) / V.MICROS
    whole_seconds = window_us // V.MICROS
    events = F.lit(1).cast("long") if weight is None else F.col(weight)
    recent = series.select("rule_value", V.micros(F.col("ts")).alias("at"), events.alias("n")).where(F.lit(window_us > 0) & (F.col("at") >= now - window_us))
    # One row per rule value. Written out, its size is known: where it is small the events are not shuffled for it.
    first = cut_lineage(recent.groupBy("rule_value").agg(F.min("at").alias("first_at")), "first-events")
    per_second = (
        salted_join(recent, first, ["rule_value"], F.col("at"))
        .groupBy("rule_value", V.floor_div(F.col("at") - F.col("first_at"), V.MICROS).alias("second"))
        .agg(F.sum("n").alias("n"))
    )
    stats = per_second.groupBy("rule_value").agg(
        F.sum("n").alias("count"),
        F.max("n").alias("hi"),
        F.min("n").alias("lo"),
        F.count_if(F.col("second") < whole_seconds).alias("busy"),
    )
    if keys is not None:
        stats = keys.select("rule_value").distinct().join(stats, "rule_value", "left").where(F.lit(window_us > 0))
    count = F.coalesce("count", F.lit(0))
    average = count / F.lit(seconds)
    quietest = F.when(F.col("busy") < whole_seconds, F.lit(0.0)).otherwise(F.col("lo").cast("double"))
    return stats.select(
        "rule_value",
        count.alias("count"),
        F.greatest(F.col("hi").cast("double"), average).alias("max_tps"),
        average.alias("average_tps"),
        F.least(quietest, average).alias("min_tps"),
    )


def evaluation_span_us(now_us: int, last_us: int, interval_us: int) -> int:
    return min(now_us - last_us, 2 * interval_us)


def rate_report(
    series: DataFrame, now_us: int, window_us: int, keys: DataFrame | None = None, weight: str | None = None
) -> DataFrame:
    """Rates of the inbound series and of the admitted one; `series` is (rule_value, ts, admitted)."""
    inbound = rate_stats(series, now_us, window_us, keys, weight).withColumn("direction", F.lit("in"))
    admitted = rate_stats(series.where("admitted"), now_us, window_us, keys, weight).withColumn("direction", F.lit("out"))
    return inbound.unionByName(admitted)


def distinct_values(collection_rules: Column) -> Column:
    """The normalized values of a message's matched rules, each once; rules without a value are skipped."""
    rules = F.filter(collection_rules, lambda r: r["value"].isNotNull())
    return F.array_distinct(F.transform(rules, lambda r: V.normalized_value(r["value"], r["orig_type"])))


def limit_keys(tagged: DataFrame, *keep: str) -> DataFrame:
    """(message, rule_value): what the rate limiter counts."""
    return tagged.select(*keep, F.explode(distinct_values(F.col("collection_rules"))).alias("rule_value"))


# --- metrics -------------------------------------------------------------------------------------------------------


def metric_names(prefix: str, more: dict[str, str] | None = None) -> dict[str, str]:
    """Event name -> metric name, for the events this engine has. `prefix` is the name of the deployment;
    `more` adds those of other parts of it."""
    return {
        "tweet_process_success": f"{prefix}.src.tweet_process.success",
        "tweet_process_failure": f"{prefix}.src.tweet_process.failure",
        "tweet_to_kafka_success": f"{prefix}.src.tweet_to_kafka.success",
        "tweet_to_kafka_failure": f"{prefix}.src.tweet_to_kafka.failure",
        "limit_message_received": f"{prefix}.src.limit.messages.count",
        "limit_message_count": f"{prefix}.src.limit.current_limited",
    } | (more or {})


def log_metric_names(more: dict[str, str] | None = None) -> dict[str, str]:
    """Log event -> metric name of the log-driven metrics; `more` adds others."""
    return {
        "tweet_process_success": "src.tweet_process.success",
        "tweet_to_kafka_success": "src.tweet_to_kafka.success",
        "tweet_to_kafka_failure": "src.tweet_to_kafka.failure",
        "limit_message_received": "src.limit.messages.count",
        "limit_message_count": "src.limit.current_limited",
        "Stream keep-alive received": "src.twitter.keepalive",
        "Waiting for rules": "src.rules.waiting",
    } | (more or {})


def _metric(event: Column, names: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), event)


def counters(
    events: DataFrame, names: dict[str, str], *tags: str, window: str = "1 day", weight: str | None = None
) -> DataFrame:
    """How often each metric's event came up per window and tags; `events` is (ts, event, tags), a row being `weight` events if given."""
    named = events.withColumn("metric", _metric(F.col("event"), names)).where("metric IS NOT NULL")
    often = F.count("*") if weight is None else F.sum(weight)
    counted = named.groupBy(F.window("ts", window).alias("w"), "metric", *tags).agg(often.alias("n"))
    return counted.select(F.col("w.start").alias("window_start"), "metric", *tags, "n")


def gauges(events: DataFrame, names: dict[str, str], *tags: str) -> DataFrame:
    """The last value of each metric; `events` is (ts, event, value, tags)."""
    named = events.withColumn("metric", _metric(F.col("event"), names)).where("metric IS NOT NULL")
    return named.groupBy("metric", *tags).agg(F.max(F.struct("ts", "value"))["value"].alias("value"))
