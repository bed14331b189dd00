"""Live counters and rates of a running collector: rings of short panes, handed on from batch to batch and trimmed by age."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievestream.functions import values as V
from sievestream.operators.rates import ROLLING_WINDOW_SECONDS, rate_report, zero_filled
from sievestream.streaming.state import BatchTable

#: Length of a pane: times are taken as its beginning.
PANE_US = V.MICROS


class CounterRing:
    """How often each rule matched within the window, for the rules of the newest version.

    The ring has a number for each (rule, pane) of the window and nothing older, so its size follows from the rules, not from the messages. With a new rules version
    every counter begins at zero. A batch that runs again gives the same counts and leaves the same ring.
    """

    def __init__(self, spark: SparkSession, folder: str, window_seconds: int = ROLLING_WINDOW_SECONDS, pane_us: int = PANE_US):
        if window_seconds * V.MICROS % pane_us:
            raise ValueError("a window is made of whole panes")
        self.window_panes, self.pane_us = window_seconds * V.MICROS // pane_us, pane_us
        self.table = BatchTable(spark, folder, "rules_version LONG, rule_id STRING, pane LONG, n LONG", "counters")

    def update(self, increments: DataFrame, batch_id: int, now_us: int, rules: DataFrame, rules_version: int = 0) -> DataFrame:
        """Counts of `rules` (rule_id) as of `now_us`, those without a match at zero; `increments` is (rule_id, ts).

        As rolling_counts() has it at a time T, for times cut down to panes: what falls into [T - window, T]. Null rule ids are left out; increments of rules not in `rules` stay
        in the ring but get no row.
        """
        pane = V.floor_div(V.micros(F.col("ts")), self.pane_us)
        fresh = increments.where("rule_id IS NOT NULL").select(F.lit(rules_version).cast("long").alias("rules_version"), F.col("rule_id").cast("string").alias("rule_id"), pane.alias("pane"), F.lit(1).cast("long").alias("n"))
        now = now_us // self.pane_us
        live = self.table.before(batch_id).where(F.col("rules_version") == rules_version).unionByName(fresh).where(F.col("pane") >= now - self.window_panes)
        ring = self.table.write(live.groupBy("rules_version", "rule_id", "pane").agg(F.sum("n").alias("n")), batch_id)
        asked = rules.where("rule_id IS NOT NULL").select(F.col("rule_id").cast("string").alias("rule_id"))
        return zero_filled(asked, ring.where(F.col("pane") <= now))


class RateRing:
    """Messages in and admitted for each rule value and pane, for reports at any batch without the events themselves.

    Values without an event in the window are no longer in the ring: their state has expired.
    """

    def __init__(self, spark: SparkSession, folder: str, window_seconds: int = 60, pane_us: int = PANE_US):
        self.window_us, self.pane_us = window_seconds * V.MICROS, pane_us
        self.table = BatchTable(spark, folder, "rule_value STRING, pane LONG, n_in LONG, n_out LONG", "rates")

    def update(self, decided: DataFrame, batch_id: int, now_us: int, window_us: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The rate_report() as of `now_us` over the last `window_us` (at most the ring's window), for times cut down to panes.

        `decided` is (rule_value, ts, admitted), as the limiter gives it. `keys` lists values that get a row in any case.
        """
        window_us = self.window_us if window_us is None else window_us
        if window_us > self.window_us:
            raise ValueError("the ring does not reach back so far")
        pane = V.floor_div(V.micros(F.col("ts")), self.pane_us)
        fresh = decided.select("rule_value", pane.alias("pane"), F.lit(1).cast("long").alias("n_in"), F.col("admitted").cast("long").alias("n_out"))
        live = self.table.before(batch_id).unionByName(fresh).where(F.col("pane") * self.pane_us >= now_us - self.window_us)
        sums = live.groupBy("rule_value", "pane").agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out"))
        return self.report(self.table.write(sums, batch_id), now_us, window_us, keys)

    def report(self, ring: DataFrame, now_us: int, window_us: int, keys: DataFrame | None = None) -> DataFrame:
        sides = F.array(F.struct(F.lit(False).alias("admitted"), (F.col("n_in") - F.col("n_out")).alias("n")), F.struct(F.lit(True).alias("admitted"), F.col("n_out").alias("n")))
        series = ring.select("rule_value", F.timestamp_micros(F.col("pane") * self.pane_us).alias("ts"), F.explode(sides).alias("s")).select("rule_value", "ts", "s.*").where("n > 0")
        return rate_report(series, now_us, window_us, keys, weight="n")
