import json

from tests.samples import rule, tweet
from pyspark.sql import functions as F

from sievestream.plans import feeds as D
from sievestream.plans.enrich import enrich
from sievestream.sources import messages as SM
from sievestream.sources import sinks as K
from sievestream.streaming import counters as CT


def test_json_lines_sink(spark, make_rules, make_lines, tmp_path):
    enriched = enrich(make_lines(tweet(text="happy £ 今日"), {"warning": {"code": "x"}}), make_rules(rule(1, "今日", "keyword")), "track")
    K.write_json_lines(enriched, str(tmp_path / "out"))
    got = sorted((json.loads(r[0]) for r in spark.read.text(str(tmp_path / "out")).collect()), key=len)
    assert got[0] == {"warning": {"code": "x"}}
    assert got[1]["text"] == "happy £ 今日" and got[1]["collector"]["collection_rules"][0]["rule_value"] == "今日"


def test_kafka_options():
    options = K.kafka_options("host:9092", "out")
    assert (options["topic"], options["kafka.acks"], options["kafka.retries"]) == ("out", "1", "3")


def test_console_sink(spark, make_rules, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(tweet()))
    enriched = enrich(SM.stream_lines(spark, str(tmp_path / "in")), make_rules(rule(1, "happy", "keyword")), "track")
    query = K.console(enriched).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    query.awaitTermination()
    assert "Console" in query.lastProgress["sink"]["description"] and query.lastProgress["numInputRows"] == 1


def test_log_stream_to_daily_folders(spark, tmp_path):
    (tmp_path / "in").mkdir()
    logs = [
        {"ts": "2024-01-01T23:59:59Z", "tags": ["collector"], "value": 1.0},
        {"ts": "2024-01-02T00:00:01Z", "tags": ["collector", "x"], "value": 2.0},
        {"ts": "2024-01-02T00:00:02Z", "tags": ["other"], "value": 3.0},
        {"ts": "2024-01-02T00:00:03Z", "value": 4.0},
    ]
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, logs)))
    stream = SM.stream_logs(spark, str(tmp_path / "in"), "ts TIMESTAMP, tags ARRAY<STRING>, value DOUBLE", "collector")
    writer = K.stream_daily(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if "day" in p.name) == ["day=2024.01.01", "day=2024.01.02"]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_limit_counts_on_a_stream(spark, tmp_path):
    rows = spark.createDataFrame([(0, 5), (10, 9), (10, None), (901, 1), (5000, 7)], "s BIGINT, limit_value BIGINT")
    rows.select(F.timestamp_seconds("s").alias("ts"), "limit_value").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts TIMESTAMP, limit_value BIGINT").parquet(str(tmp_path / "in"))
    counted = CT.limit_counts(stream)
    writer = counted.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    writer.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("n_limits", "sum_limit", "max_limit")
    assert sorted(map(tuple, got.collect())) == [(1, 1, 1), (2, 14, 9)]


def test_tables_of_one_file_and_of_a_folder_are_streams(spark, tmp_path):
    rows = spark.range(20).selectExpr("id AS doc_id", "'x' AS text")
    rows.repartition(3).write.parquet(str(tmp_path / "many" / "documents.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "part"))
    (tmp_path / "one").mkdir()
    next((tmp_path / "part").glob("*.parquet")).rename(tmp_path / "one" / "documents.parquet")
    rows.write.parquet(str(tmp_path / "one" / "events.parquet"))
    for name in ("many", "one"):
        out = str(tmp_path / f"out-{name}")
        writer = D.stream_table(spark, str(tmp_path / name), "documents").writeStream.format("parquet").option("path", out)
        writer.option("checkpointLocation", str(tmp_path / f"ck-{name}")).trigger(availableNow=True).start().awaitTermination()
        assert sorted(r["doc_id"] for r in spark.read.parquet(out).collect()) == list(range(20))
