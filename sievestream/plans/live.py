"""Registered queries of what a running collector keeps: each runs its table through micro-batches and returns the last state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievestream.functions import values as V
from sievestream.operators import digests as DG
from sievestream.operators import limiter as L
from sievestream.operators import matching as X
from sievestream.operators import rates as A
from sievestream.operators import rules as R
from sievestream.operators.term_index import TermIndex
from sievestream.plans import feeds as D
from sievestream.plans.catalog import QUERIES, REPORT_TIME_US, _document_messages, _event_users, _keywords, _two_sets, query
from sievestream.plans.enrich import enrich
from sievestream.session import cut_lineage, work_dir
from sievestream.sources import batches as B
from sievestream.sources import messages as SM
from sievestream.sources import rules as SR
from sievestream.streaming import collector as SC
from sievestream.streaming import limiter as SL
from sievestream.streaming.history import EventCounts, NewestByKeyword, UserTable
from sievestream.streaming.rings import CounterRing, RateRing
from sievestream.streaming.rule_versions import RuleLog

__all__ = ["QUERIES"]

BATCHES = 3
#: Rows of a file, on average: tables are dealt to as many files as that takes, the same number of files for each micro-batch.
ROWS_OF_A_FILE = 50_000


def _files_of_a_batch(df: DataFrame) -> int:
    return max(1, -(-df.count() // (BATCHES * ROWS_OF_A_FILE)))


def _through_batches(df: DataFrame, by: str, work: Callable[[DataFrame, int, str], None]) -> str:
    """Deals a table by a column to files, equally many for each micro-batch of a stream, and runs `work(batch, batch_id, folder)` on them; the folder."""
    spark, path = df.sparkSession, work_dir(df.sparkSession, "live")
    files = _files_of_a_batch(df)
    df.repartition(BATCHES * files, by).write.parquet(f"{path}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/in")
    writer = stream.writeStream.foreachBatch(lambda batch, batch_id: work(batch, batch_id, path))
    writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return path


# --- lines in order ------------------------------------------------------------------------------------------------


def _event_files(spark: SparkSession, sf: str) -> tuple[str, int]:
    """Events as lines of text: those of a user in one file, in the order of their ids; the folder, and how many of its files make a micro-batch."""
    path = work_dir(spark, "event-files")
    events = D.table(spark, sf, "events").select("event_id", "user_id", V.micros(F.col("ts")).alias("at"))
    files = _files_of_a_batch(events)
    ordered = events.repartition(BATCHES * files, "user_id").sortWithinPartitions("event_id")
    ordered.select(F.to_json(F.struct("event_id", "user_id", "at")).alias("value")).write.text(path)
    return path, files


def _keyed_lines(lines: DataFrame) -> DataFrame:
    """Limiter rows of such lines: times are cut down to seconds, so what passes depends on the order of the lines."""
    read = lines.select("row_id", F.from_json("value", "event_id LONG, user_id LONG, at LONG").alias("e"))
    second = F.timestamp_micros(V.floor_div(F.col("e.at"), 100_000 * V.MICROS) * F.lit(V.MICROS))
    return read.select("row_id", F.col("e.event_id").alias("event_id"), F.col("e.user_id").cast("string").alias("rule_value"), second.alias("ts"))


@query
def limit_lines(spark, sf):
    """The limiter over lines of text files, equal times in the order of the lines."""
    keyed = cut_lineage(_keyed_lines(SM.read_lines(spark, _event_files(spark, sf)[0])), "keyed-lines")
    decided = L.rate_limit(keyed.drop("event_id"), L.Bucket(rate=1, capacity=1))
    return decided.join(keyed.select("row_id", "event_id"), "row_id").select("event_id", "rule_value", "admitted")


@query
def limit_lines_stream(spark, sf):
    """The same from a stream of the files, a third of them to a micro-batch."""
    path = work_dir(spark, "limit-lines")
    folder, files = _event_files(spark, sf)
    store = SL.BucketStore(spark, f"{path}/buckets")
    out = B.BatchFolder(spark, f"{path}/out")

    def on_batch(batch, batch_id):
        keyed = cut_lineage(_keyed_lines(SM.number_lines(batch)), "keyed-lines")
        decided = SL.limit_batch(keyed.drop("event_id"), batch_id, L.Bucket(rate=1, capacity=1), store, None)
        found = decided.join(keyed.select("row_id", "event_id"), "row_id").select("event_id", "rule_value", "admitted")
        out.write(found, batch_id, lambda frame, to: frame.write.parquet(to))

    lines = SM.stream_lines(spark, folder, max_files=files)
    writer = lines.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{path}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return out.read("parquet", "event_id LONG, rule_value STRING, admitted BOOLEAN")


# --- rules ---------------------------------------------------------------------------------------------------------


@query
def rule_log(spark, sf):
    """Which rules each of four batches used: two changes of the table in between, and batch 1 once more at the end."""
    rules = D.benchmark_rules(D.table(spark, sf, "benchmark")).select("rule_id", "value")
    shorter = rules.where("rule_id % 2 = 0")
    changed = shorter.withColumn("value", F.lower("value"))
    table = {"now": rules}
    log = RuleLog(spark, f"{work_dir(spark, 'rule-log')}/rules", lambda: table["now"])
    used = []
    for batch_id, table["now"] in [(0, rules), (1, rules), (2, shorter), (3, changed), (1, changed)]:
        used.append((batch_id, log.version(batch_id)))
    parts = [log.rules(version).select(F.lit(i).alias("turn"), F.lit(batch_id).alias("batch_id"), F.lit(version).alias("version"), "rule_id", "value") for i, (batch_id, version) in enumerate(used)]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.groupBy("turn", "batch_id", "version").agg(F.count("*").alias("n_rules"), F.min("value").alias("first_value"))


@query
def match_by_index(spark, sf):
    """Keyword matches by an index that saw rules come, go and change."""
    rules = D.benchmark_rules(D.table(spark, sf, "benchmark")).select("rule_id", "value")
    number = F.col("rule_id").cast("long")
    index = TermIndex(spark, f"{work_dir(spark, 'term-index')}/index")
    index.update(added=rules.where(number % 3 < 2))
    index.update(added=rules.where(number % 3 == 2), removed=rules.where(number % 5 == 0).where(number % 3 < 2))
    shortened = F.substring_index("value", " ", 1)
    index.update(added=rules.where(number % 7 == 1).where(number % 5 > 0).withColumn("value", shortened), removed=rules.where(number % 7 == 1).where(number % 5 > 0))
    index.compact()
    documents = D.documents(spark, sf).select(F.col("doc_id").alias("row_id"), F.lower("text").alias("keyword"))
    return index.pairs(documents).select(F.col("row_id").alias("doc_id"), "rule_id")


@query
def rule_json_round_trip(spark, sf):
    """Rules written as JSON lines and read as rule tables are; numbers come back as text."""
    path = work_dir(spark, "json-rules")
    part = D.table(spark, sf, "part").select(F.col("p_partkey").alias("rule_id"), F.col("p_name").alias("value"), F.when(F.col("p_size") > 20, F.col("p_brand")).alias("tag"), F.lit("ignored").alias("other"))
    part.write.json(path)
    return SR.read_json_rules(spark, path).select("rule_id", "value", "tag", "description")


@query
def rule_delta(spark, sf):
    """What differs between two rule tables, found from digests of id ranges."""
    left, right = _two_sets(spark, sf)
    same = right.withColumn("value", F.when(F.col("rule_id") % 3 > 0, F.lower("value")).otherwise(F.col("value")))
    return DG.delta(left, same, "rule_id", ["tag", "value"])


@query
def rule_same_tables(spark, sf):
    left, right = _two_sets(spark, sf)
    both, swapped = R.union(left, right), R.union(left, right).orderBy(F.desc("rule_id"))
    result = DG.same_tables(both, swapped, "rule_id", ["tag", "value"]).select(F.lit("shuffled").alias("pair"), "is_equal")
    return result.unionByName(DG.same_tables(left, right).select(F.lit("left and right").alias("pair"), "is_equal"))


@query
def collect_locations_sizes(spark, sf):
    """Boxes from the whole world down to a hundredth of a degree, areas of all sizes too."""
    nation, west, south = F.col("s_nationkey"), F.col("s_nationkey").cast("int") * 14 - 180, F.floor(F.col("s_acctbal") / 125).cast("int") - 10
    tiny = F.format_string("%d,%d,%d.01,%d.01", west, F.abs(south), west + 5, F.abs(south))
    value = F.when(F.col("s_suppkey") == 1, F.lit("-180,-90,-179,-89.5")).when(nation % 3 == 0, D.supplier_box()).otherwise(tiny)
    boxes = D.table(spark, sf, "supplier").select(value.alias("value"))
    lon, lat, size = F.col("c_nationkey") * 14.0 - 180.0, F.col("c_acctbal") / 125.0, F.when(F.col("c_custkey") % 50 == 0, 400.0).otherwise((F.col("c_custkey") % 7) / 4.0)
    area = F.struct((lon - size).alias("lon1"), (lat - size).alias("lat1"), (lon + size).alias("lon2"), (lat + size).alias("lat2"))
    return X.within_boxes(D.table(spark, sf, "customer"), boxes, area, form="joins").select("c_custkey")


# --- counters and rates --------------------------------------------------------------------------------------------

HOUR_US = 3600 * V.MICROS


@query
def live_rule_counts(spark, sf):
    """Every customer's events of the last ten days, as of the report time, from a ring of hours."""
    rules = D.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("rule_id"))
    ring = lambda path: CounterRing(spark, f"{path}/ring", 10 * 86_400, HOUR_US)

    def work(batch, batch_id, path):
        counts = ring(path).update(batch.select(F.col("user_id").alias("rule_id"), "ts"), batch_id, REPORT_TIME_US, rules)
        counts.write.mode("overwrite").parquet(f"{path}/counts-{batch_id}")

    events = D.table(spark, sf, "events").select("user_id", "event_id", "ts")
    path = _through_batches(events, "event_id", work)
    return spark.read.parquet(f"{path}/counts-{BATCHES - 1}")


@query
def live_rate_report(spark, sf):
    """The rate report of the last twenty days from a ring of seconds."""

    def work(batch, batch_id, path):
        ring = RateRing(spark, f"{path}/ring", 20 * 86_400)
        decided = batch.select(F.col("event_type").alias("rule_value"), "ts", (F.col("user_id") % 3 > 0).alias("admitted"))
        ring.update(decided, batch_id, REPORT_TIME_US).write.mode("overwrite").parquet(f"{path}/report-{batch_id}")

    events = D.table(spark, sf, "events").select("event_type", "user_id", "event_id", "ts")
    path = _through_batches(events, "event_id", work)
    return spark.read.parquet(f"{path}/report-{BATCHES - 1}")


@query
def event_counts_corrected(spark, sf):
    """Events by type and hour from batches whose times overlap: closed windows, corrections and open windows together."""

    def work(batch, batch_id, path):
        counts = EventCounts(spark, f"{path}/counts", 3600, 7200)
        closed, corrections = counts.update(batch.select(F.col("event_type").alias("key"), "ts"), batch_id)
        closed.unionByName(corrections).write.mode("overwrite").parquet(f"{path}/out/{batch_id}")

    events = D.table(spark, sf, "events").select("event_type", "event_id", "ts")
    path = _through_batches(events, "event_id", work)
    still_open = EventCounts(spark, f"{path}/counts", 3600, 7200).still_open(BATCHES - 1)
    given = spark.read.schema(still_open.schema).parquet(f"{path}/out/*")
    return given.unionByName(still_open).groupBy("key", "window_us").agg(F.sum("n").alias("n"))


# --- histories -----------------------------------------------------------------------------------------------------


@query
def recent_by_keyword_live(spark, sf):
    """The newest messages of each keyword, kept from batch to batch."""
    keywords = cut_lineage(_keywords(spark, sf), "keywords")

    def work(batch, batch_id, path):
        newest = NewestByKeyword(spark, f"{path}/newest", 100, "LONG")
        newest.update(batch, batch_id, keywords).write.mode("overwrite").parquet(f"{path}/ranks-{batch_id}")

    path = _through_batches(_document_messages(spark, sf), "row_id", work)
    found = spark.read.parquet(f"{path}/ranks-{BATCHES - 1}")
    return found.select("keyword", F.col("row_id").alias("doc_id"), F.col("rank").cast("long").alias("rank"))


@query
def user_table_live(spark, sf):
    """The newest name of each user from base and deltas."""

    def work(batch, batch_id, path):
        UserTable(spark, f"{path}/users", compact_every=2).update(batch, batch_id)

    path = _through_batches(_event_users(spark, sf), "screen_name", work)
    return UserTable(spark, f"{path}/users").users()


# --- the collector as a whole --------------------------------------------------------------------------------------


@query
def replayed_batches(spark, sf):
    """A stream's batches written twice each, as after a failure between writing and committing; readers see each once."""

    def work(batch, batch_id, path):
        for _ in range(2):
            B.daily_batches(f"{path}/daily")(batch, batch_id)
            B.json_batches(f"{path}/json")(batch.select(F.to_json(F.struct("event_id")).alias("output")), batch_id)

    events = D.table(spark, sf, "events").select("event_id", "event_type", "ts")
    path = _through_batches(events, "event_id", work)
    daily = B.read_daily_batches(spark, f"{path}/daily", events.schema).groupBy(F.col("day").alias("part")).agg(F.count("*").alias("n"))
    lines = B.read_json_batches(spark, f"{path}/json").agg(F.lit("lines").alias("part"), F.count("*").alias("n"))
    return daily.unionByName(lines)


@query
def metrics_live(spark, sf):
    """Counters of a collector over the lines of all classes, from what its batches observed."""
    lines = D.event_lines(D.table(spark, sf, "events")).select("value", F.col("event_id").cast("string").alias("row_id"), F.timestamp_seconds(F.lit(D.EPOCH_2024)).alias("ingest_ts"))
    rules = D.benchmark_rules(D.table(spark, sf, "benchmark"))
    path = work_dir(spark, "metrics-live")
    files = _files_of_a_batch(lines)
    lines.repartition(BATCHES * files, "row_id").write.parquet(f"{path}/in")
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", files).parquet(f"{path}/in")
    out = B.BatchFolder(spark, f"{path}/metrics")
    SC.start_collector(
        stream, lambda: rules, "track", 1, lambda batch, batch_id: None, f"{path}/checkpoint", available_now=True,
        on_metrics=lambda rows, batch_id: out.write(rows, batch_id, lambda frame, to: frame.write.parquet(to)),
    ).awaitTermination()
    events = out.read("parquet", "ts TIMESTAMP, event STRING, n LONG")
    names = A.metric_names("collector", {"Stream keep-alive received": "collector.src.twitter.keepalive"})
    return A.counters(events, names, weight="n").select("metric", "n")


@query
def enrich_events(spark, sf):
    """Enrichment of lines of all classes: tweets with metadata of their own or a time that cannot be read, notices and others as they came."""
    events = D.table(spark, sf, "events")
    number = F.col("event_id") % 5
    time = F.when(number == 1, F.lit("yesterday")).otherwise(D.feed_time(F.col("ts")))
    tweet = F.struct(F.col("event_id").cast("string").alias("id_str"), time.alias("created_at"), F.col("event_type").alias("text"))
    line = (
        F.when(number == 0, F.concat(F.lit('{"limit":{"track":'), "user_id", F.lit("}}")))
        .when(number == 4, F.concat(F.lit('{"delete":{"status":{"id":'), "event_id", F.lit("}}}")))
        .when(number == 3, F.to_json(F.struct(*[tweet[c].alias(c) for c in ("id_str", "created_at", "text")], F.struct(F.lit(77).alias("id_str"), F.col("user_id").alias("seen")).alias("collector"))))
        .otherwise(F.to_json(tweet))
    )
    lines = events.select(line.alias("value"), F.col("event_id").cast("string").alias("row_id"), F.col("ts").cast("timestamp").alias("ingest_ts"))
    rules = D.table(spark, sf, "nation").where("n_nationkey < 2").select(
        F.concat(F.lit("r"), "n_nationkey").alias("rule_id"), F.when(F.col("n_nationkey") == 0, "click").otherwise("view").alias("value"), F.lit("keyword").alias("orig_type"), F.lit("t").alias("tag"),
    )
    enriched = enrich(lines, rules, "track", 9)
    at = lambda path: F.get_json_object("output", f"$.{path}")
    return enriched.select(
        F.col("row_id").cast("long").alias("event_id"), "message_class", "enrichment_error", (F.col("output") == F.col("value")).alias("unchanged"),
        at("collector.id_str").alias("meta_id"), at("collector.seen").alias("seen"), at("collector.created_at_iso").alias("created_at_iso"),
        at("collector.collection_rules[0].rule_id").alias("first_rule"), at("collector.rule_tag").alias("rule_tag"),
    )
