"""The collector as a streaming query."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery

from sievestream.functions import values as V
from sievestream.operators import matching as X
from sievestream.operators.limiter import Bucket, admit
from sievestream.operators.messages import limit_value
from sievestream.operators.rates import ROLLING_WINDOW_SECONDS, limit_keys, rule_increments
from sievestream.operators.term_index import TermIndex
from sievestream.plans.enrich import enrich
from sievestream.schemas import DEFAULT_META
from sievestream.session import work_scope
from sievestream.sources.messages import number_lines
from sievestream.streaming.limiter import EXPIRATION_SECONDS, BucketStore, limit_batch
from sievestream.streaming.rings import CounterRing, RateRing
from sievestream.streaming.rule_versions import RuleLog

Sink = Callable[[DataFrame, int], None]


def start_collector(
    lines: DataFrame,
    read_rules: Callable[[], DataFrame],
    collector_type: str,
    instance_id: int,
    sink: Sink,
    checkpoint: str,
    bucket: Bucket | None = None,
    on_series: Sink | None = None,
    on_increments: Sink | None = None,
    on_limits: Sink | None = None,
    on_counts: Callable[[dict, int], None] | None = None,
    on_rule_counts: Sink | None = None,
    on_rates: Sink | None = None,
    on_metrics: Sink | None = None,
    meta: str = DEFAULT_META,
    available_now: bool = False,
    form: str = "in_place",
    expiration_seconds: float | None = EXPIRATION_SECONDS,
    rule_changes: Callable[[], object] | None = None,
    counter_seconds: int = ROLLING_WINDOW_SECONDS,
    rate_seconds: int = 60,
) -> StreamingQuery:
    """Starts the query; `sink` gets every micro-batch (with an `output` column) and its id.

    Rules follow their table without a restart: each batch is logged with the rules version it uses (see RuleLog; `rule_changes` says when to look), so one that runs again
    after a failure uses the same rules. With an empty rule table messages pass as unmatched. In the join form the grams of keyword terms are kept in an index
    that follows the versions. With a limiter only lines that may be sent reach the sink; its buckets lie below the checkpoint folder, as does all other state.

    Further outputs, all from one enrichment and all before the limiter drops anything: `on_increments` gets one (rule_id, ts) row
    per matched rule (never for locations), `on_rule_counts` the (rule_id, n) of the last `counter_seconds` for every rule, from zero on with each rules version,
    `on_limits` the (ts, limit_value) rows of limit notices, `on_series` the (rule_value, ts, admitted) rows of the limiter, `on_rates` the report of
    the last `rate_seconds` (see rates.rate_report; without a limiter everything counts as admitted), `on_counts` the numbers of keep-alives, malformed lines and messages, `on_metrics` rows (ts, event, n) for
    rates.counters.
    """
    spark = lines.sparkSession
    root = checkpoint.rstrip("/")
    store = BucketStore(spark, f"{root}/limiter")
    log = RuleLog(spark, f"{root}/rules", read_rules, rule_changes)
    counter_ring = CounterRing(spark, f"{root}/counters", counter_seconds)
    rate_ring = RateRing(spark, f"{root}/rates", rate_seconds)
    index = TermIndex(spark, f"{root}/terms") if form == "joins" and collector_type == "track" else None

    def rules_of(version: int) -> tuple[DataFrame | X.RuleBag, DataFrame | None]:
        if form == "in_place" and collector_type != "locations":
            return log.bag(version, collector_type), None
        rules = log.rules(version)
        if index is None:
            return rules, None
        index.follow(X.with_basic_fields(rules).where("orig_type = 'keyword'"), version)
        return rules, index.anchors(version)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch = number_lines(batch)
        with work_scope(spark):
            observed = on_counts is not None or on_metrics is not None
            counts = Observation() if observed else None
            version = log.version(batch_id)
            rules, anchors = rules_of(version)
            enriched = enrich(batch, rules, collector_type, instance_id, meta=meta, observation=counts, form=form, anchors=anchors)
            enriched.persist()
            try:
                if observed:
                    enriched.count()  # what is observed is known after an action
                at = F.col("ingest_ts").alias("ts")
                if on_increments is not None and collector_type != "locations":
                    on_increments(rule_increments(enriched, at), batch_id)
                now_us = _newest(enriched, batch) if on_rule_counts is not None or on_rates is not None else None
                if on_rule_counts is not None and collector_type != "locations":
                    on_rule_counts(counter_ring.update(rule_increments(enriched, at), batch_id, now_us, log.rules(version), version), batch_id)
                if on_limits is not None:
                    notices = enriched.where("message_class = 'limit'")
                    on_limits(notices.select(at, limit_value(collector_type).alias("limit_value")), batch_id)
                keyed = limit_keys(enriched, "row_id", at)
                if bucket is None:
                    decided = keyed.select("rule_value", "ts", F.lit(True).alias("admitted"))
                    sink(enriched, batch_id)
                else:
                    decided = limit_batch(keyed, batch_id, bucket, store, expiration_seconds)
                    if on_series is not None:
                        on_series(decided.select("rule_value", "ts", "admitted"), batch_id)
                    sink(admit(enriched, decided), batch_id)
                if on_rates is not None:
                    on_rates(rate_ring.update(decided.select("rule_value", "ts", "admitted"), batch_id, now_us), batch_id)
                if on_counts is not None:
                    on_counts(dict(counts.get), batch_id)
                if on_metrics is not None:
                    on_metrics(metric_events(enriched, dict(counts.get), batch), batch_id)
            finally:
                enriched.unpersist()

    writer = lines.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _newest(enriched: DataFrame, batch: DataFrame) -> int:
    """Arrival time of a batch's newest message, else of its newest line (0 in a batch without lines), in microseconds."""
    for rows in (enriched, batch):
        found = rows.agg(F.max(V.micros(F.col("ingest_ts"))).alias("at")).first()["at"]
        if found is not None:
            return found
    return 0


def metric_events(enriched: DataFrame, counts: dict, batch: DataFrame) -> DataFrame:
    """(ts, event, n): how often each event of the metrics came up in a batch, at its newest arrival time; events that did not come up have no row."""
    spark = enriched.sparkSession
    classes = enriched.groupBy("message_class", F.col("enrichment_error").isNotNull().alias("failed")).agg(F.count("*").alias("n"))
    limits = failures = tweets = 0
    for r in classes.collect():  # one row for each class
        if r["message_class"] == "limit":
            limits += r["n"]
        elif r["message_class"] == "tweet":
            failures, tweets = failures + r["failed"] * r["n"], tweets + (not r["failed"]) * r["n"]
    found = {
        "tweet_process_success": tweets, "tweet_process_failure": failures + counts["malformed"],
        "limit_message_received": limits, "Stream keep-alive received": counts["keep_alives"],
    }
    at = _newest(enriched, batch)
    rows = [(at, event, n) for event, n in found.items() if n]
    return spark.createDataFrame(rows, "at LONG, event STRING, n LONG").select(F.timestamp_micros("at").alias("ts"), "event", "n")


def wait_for_rules(read_rules: Callable[[], DataFrame], check_seconds: float = 10.0, tries: int | None = None) -> bool:
    """Waits until there is a rule (before a collector is started); False after `tries` looks without one."""
    looked = 0
    while read_rules().isEmpty():
        looked += 1
        if tries is not None and looked >= tries:
            return False
        time.sleep(check_seconds)
    return True


def notices_for(notices: DataFrame, collector_type: str, instance_id: int, data: str = "data") -> DataFrame:
    """Rule-change notices (`type:id`) meant for one instance."""
    parts = F.split(F.col(data), ":")
    return notices.where((F.get(parts, 0) == collector_type) & (F.get(parts, 1) == str(instance_id)))


def latest_change(notices: DataFrame, ts: str = "ts") -> DataFrame:
    """When the rules of each instance changed last: its rules version."""
    parts = F.split(F.col("data"), ":")
    keyed = notices.select(F.get(parts, 0).alias("rule_type"), F.get(parts, 1).alias("instance_id"), ts)
    return keyed.groupBy("rule_type", "instance_id").agg(F.max(ts).alias("rules_version"))
