"""Rolling counters on streams: late rows beyond the watermark go uncounted."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sievestream.operators.rates import pane_length


def rolling_rule_counts(
    increments: DataFrame, window: str = "900 seconds", every: str = "5 seconds", delay: str = "60 seconds"
) -> DataFrame:
    """Matches per rule and sliding window; `increments` is (ts, rule_id).

    Rows are first counted per pane (the longest that windows are made of); only panes, not rows, are repeated for each window they
    belong to.
    """
    panes = (
        increments.withWatermark("ts", delay)
        .groupBy(F.window("ts", pane_length(window, every)).alias("pane"), "rule_id")
        .agg(F.count("*").alias("n"))
    )
    slid = panes.groupBy(F.window("pane", window, every).alias("w"), "rule_id").agg(F.sum("n").alias("n"))
    return slid.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "rule_id", "n")


def limit_counts(
    limits: DataFrame, window: str = "900 seconds", delay: str = "60 seconds", every: str | None = None
) -> DataFrame:
    """Per window (sliding by `every`, else one after the other): notices, sum, maximum and latest value of (ts, limit_value)."""
    value = F.col("limit_value")
    panes = (
        limits.withWatermark("ts", delay)
        .groupBy(F.window("ts", pane_length(window, every or window)).alias("pane"))
        .agg(
            F.count(value).alias("n"),
            F.sum(value).alias("total"),
            F.max(value).alias("top"),
            F.max(F.when(value.isNotNull(), F.struct("ts", "limit_value"))).alias("last"),
        )
    )
    stats = panes.groupBy(F.window("pane", window, every or window).alias("w")).agg(
        F.sum("n").alias("n_limits"),
        F.sum("total").alias("sum_limit"),
        F.max("top").alias("max_limit"),
        F.max("last")["limit_value"].alias("last_limit"),
    )
    return stats.select(F.col("w.start").alias("window_start"), "n_limits", "sum_limit", "max_limit", "last_limit")
