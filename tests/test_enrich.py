"""Golden enrichment results, on tables and on a stream of the same lines."""

import json

import pytest
from tests.samples import rule, tweet
from pyspark.sql import functions as F

from sievestream.plans.enrich import enrich
from sievestream.streaming.collector import start_collector

TRACK = rule(12347, "happy", "keyword")
FOLLOW = rule(12345, "17919972", "userid", "follow")
LOCATIONS = rule(12346, "-122.75,36.8,-121.75,37.8", "geo", "locations")

CONTROL = [
    {"limit": {"track": 41}},
    {"delete": {"status": {"id": 88001, "id_str": "88001", "user_id": 71, "user_id_str": "71"}, "timestamp_ms": "1700000000123"}},
    {"disconnect": {"code": 9, "stream_name": "main", "reason": "moved"}},
    {"scrub_geo": {"user_id": 5150, "user_id_str": "5150", "up_to_status_id": 990017}},
    {"status_withheld": {"id": 640021, "user_id": 8150, "withheld_in_countries": ["XX"]}},
    {"user_withheld": {"id": 8151, "withheld_in_countries": ["XY", "XX"]}},
    {"warning": {"code": "QUEUE", "message": "falling back", "percent_full": 12.5}},
]


def outputs(df):
    return [json.loads(r["output"]) for r in df.select("row_id", "output").orderBy("row_id").collect()]


@pytest.mark.parametrize("kind, the_rule", [("track", TRACK), ("follow", FOLLOW), ("locations", LOCATIONS)])
def test_golden_match(spark, make_rules, make_lines, kind, the_rule):
    out = outputs(enrich(make_lines(tweet()), make_rules(the_rule), kind, 3))[0]
    added = out.pop("collector")
    assert out == tweet()
    assert added["id_str"] == 3
    assert added["created_at_iso"] == "2016-02-22T01:34:53+00:00"
    expected = {k: str(v) for k, v in the_rule.items()} | {"rule_tag": "test", "rule_value": the_rule["value"]}
    assert added["collection_rules"] == [expected]
    assert "rule_tag" not in added


@pytest.mark.parametrize("kind", ["track", "follow"])
def test_no_match_marker(make_rules, make_lines, kind):
    rules = make_rules(rule(1, "elephants", "keyword"), rule(2, "99", "userid", "follow"))
    added = outputs(enrich(make_lines(tweet()), rules, kind, 7))[0]["collector"]
    assert added == {
        "id_str": 7,
        "created_at_iso": "2016-02-22T01:34:53+00:00",
        "collection_rules": [],
        "rule_type": kind,
        "id": 7,
        "rule_tag": "Not Found",
        "rule_value": "Not Found",
    }


def test_extended_text_and_author(make_rules, make_lines):
    message = tweet(
        text="cut off",
        truncated=True,
        user={"id_str": "735369652956766200", "screen_name": "x"},
        extended_tweet={"full_text": "this Tweet is long", "entities": {"hashtags": []}},
    )
    track = outputs(enrich(make_lines(message), make_rules(rule(1, "tweet", "keyword")), "track"))[0]
    follow = outputs(enrich(make_lines(message), make_rules(rule(1, "735369652956766200", "userid")), "follow"))[0]
    assert track["collector"]["collection_rules"][0]["rule_value"] == "tweet"
    assert follow["collector"]["collection_rules"][0]["rule_value"] == "735369652956766200"


def test_only_tweets_are_changed(make_rules, make_lines):
    assert outputs(enrich(make_lines(*CONTROL), make_rules(TRACK), "track")) == CONTROL


def test_blank_and_malformed_lines_are_dropped(make_rules, make_lines):
    lines = make_lines("", tweet(), '{"id_str": "1"', "[1]", "12", "  ", "{'id_str': 1}", '{"id_str": "1"} x')
    assert len(outputs(enrich(lines, make_rules(TRACK), "track"))) == 1


def test_earlier_metadata_is_kept_and_updated(make_rules, make_lines):
    message = tweet(collector={"created_at_iso": "old", "note": {"a": [1, None]}})
    out = outputs(enrich(make_lines(message), make_rules(TRACK), "track", 3))[0]
    added = out["collector"]
    assert "id_str" not in added
    assert added["note"] == {"a": [1, None]}
    assert added["created_at_iso"] == "2016-02-22T01:34:53+00:00"
    assert added["collection_rules"][0]["rule_value"] == "happy"
    assert out["geo"] is None and out["id_str"] == message["id_str"]


def test_unreadable_time_leaves_the_tweet_without_rules(make_rules, make_lines):
    df = enrich(make_lines(tweet(created_at="yesterday"), tweet(created_at="")), make_rules(TRACK), "track", 3)
    bad, empty = outputs(df)
    assert bad["collector"] == {"id_str": 3}
    assert "created_at_iso" not in empty["collector"] and empty["collector"]["collection_rules"]
    assert [r[0] for r in df.orderBy("row_id").select("enrichment_error").collect()] == ["created_at", None]


def test_offset_is_kept(make_rules, make_lines):
    out = outputs(enrich(make_lines(tweet(created_at="Mon Feb 22 01:34:53 -0530 2016")), make_rules(TRACK), "track"))[0]
    assert out["collector"]["created_at_iso"] == "2016-02-22T01:34:53-05:30"


def test_null_id_is_a_tweet_and_null_limit_is_not_a_limit(make_rules, make_lines):
    df = enrich(make_lines({"id_str": None, "limit": None}, {"limit": {"follow": 2}, "id_str": "1"}), make_rules(TRACK), "track")
    assert [r[0] for r in df.orderBy("row_id").select("message_class").collect()] == ["tweet", "limit"]


def test_wrong_types_do_not_stop_the_other_fields(make_rules, make_lines):
    out = outputs(enrich(make_lines(tweet(retweeted_status="x", user=5)), make_rules(TRACK), "track"))[0]
    assert out["collector"]["collection_rules"][0]["rule_value"] == "happy"


def test_empty_rule_table(make_rules, make_lines):
    rules = make_rules(TRACK).where("false")
    assert outputs(enrich(make_lines(tweet()), rules, "track"))[0]["collector"]["rule_tag"] == "Not Found"
    assert outputs(enrich(make_lines(tweet()), rules, "locations"))[0]["collector"]["collection_rules"] == [{}]


def test_locations_rules_fold_into_one(make_rules, make_lines):
    second = rule(12399, "1,2,3,4", "geo", "locations", tag="late")
    rules = make_rules(LOCATIONS, second)
    folded = outputs(enrich(make_lines(tweet()), rules, "locations"))[0]["collector"]["collection_rules"]
    assert [(r["rule_id"], r["rule_tag"], r["rule_value"]) for r in folded] == [("12399", "late", "1,2,3,4")]


def test_stream_equals_table(spark, make_rules, tmp_path):
    lines = [json.dumps(m) for m in [tweet(), *CONTROL, tweet(text="nothing", user={"id_str": "5"})]] + ["", "{"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    rules = make_rules(TRACK)
    from sievestream.sources.messages import read_lines, stream_lines

    expected = [r[0] for r in enrich(read_lines(spark, str(tmp_path / "in")), rules, "track").select("output").collect()]

    def sink(batch, batch_id):
        batch.select("output").write.mode("overwrite").parquet(f"{tmp_path}/out/{batch_id}")

    start_collector(
        stream_lines(spark, str(tmp_path / "in")), lambda: rules, "track", 0, sink, str(tmp_path / "ck"), available_now=True
    ).awaitTermination()
    got = [r[0] for r in spark.read.parquet(f"{tmp_path}/out/*").collect()]
    assert sorted(map(str, map(json.loads, got))) == sorted(map(str, map(json.loads, expected)))


def test_rules_are_read_again_for_every_batch(spark, make_rules, tmp_path):
    from sievestream.sources.messages import stream_lines

    source, seen = tmp_path / "in", {}
    source.mkdir()
    current = [make_rules(TRACK)]

    def sink(batch, batch_id):
        rows = batch.select(F.transform("collection_rules", lambda r: r["rule_id"]).alias("ids")).collect()
        seen[batch_id] = [r["ids"] for r in rows]

    def run():
        start_collector(
            stream_lines(spark, str(source)), lambda: current[0], "track", 0, sink, str(tmp_path / "ck"), available_now=True
        ).awaitTermination()

    (source / "a.json").write_text(json.dumps(tweet()))
    run()
    current[0] = make_rules(rule(99, "birthday", "keyword"))
    (source / "b.json").write_text(json.dumps(tweet()))
    run()
    assert list(seen.values()) == [[["12347"]], [["99"]]]


def test_dropped_lines_are_counted(make_rules, make_lines):
    from pyspark.sql import Observation

    counts = Observation()
    enrich(make_lines("", tweet(), "{", "", *CONTROL), make_rules(TRACK), "track", observation=counts).collect()
    assert counts.get == {"keep_alives": 2, "malformed": 1, "messages": 8}


def test_rule_increments_of_a_stream(spark, make_rules, tmp_path):
    from sievestream.sources.messages import stream_lines

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps(m) for m in [tweet(), tweet(text="x"), *CONTROL]))
    rules, seen, sent = make_rules(TRACK, rule(5, "birthday", "keyword")), [], []
    start_collector(
        stream_lines(spark, str(tmp_path / "in")),
        lambda: rules,
        "track",
        0,
        lambda batch, i: sent.append(batch.count()),
        str(tmp_path / "ck"),
        on_increments=lambda batch, i: seen.extend(r["rule_id"] for r in batch.collect()),
        available_now=True,
    ).awaitTermination()
    assert sorted(seen) == ["12347", "5"] and sent == [9]


def test_change_notices(spark):
    from sievestream.streaming.collector import latest_change, notices_for

    notices = spark.createDataFrame([("track:0", 1), ("track:1", 2), ("follow:0", 3), ("track:0", 4)], "data STRING, ts INT")
    assert [r["ts"] for r in notices_for(notices, "track", 0).collect()] == [1, 4]
    versions = {(r[0], r[1]): r[2] for r in latest_change(notices).collect()}
    assert versions == {("track", "0"): 4, ("track", "1"): 2, ("follow", "0"): 3}


def test_limit_notices_and_a_limited_collector_reads_rules_again(spark, make_rules, tmp_path):
    from sievestream.operators.limiter import Bucket
    from sievestream.sources.messages import stream_lines

    (tmp_path / "in").mkdir()
    current, sent, limits = [make_rules(TRACK)], [], []

    def run(name, *messages):
        (tmp_path / "in" / name).write_text("\n".join(map(json.dumps, messages)))
        start_collector(
            stream_lines(spark, str(tmp_path / "in")),
            lambda: current[0],
            "track",
            0,
            lambda batch, i: sent.append([[x["rule_id"] for x in r[0] or []] for r in batch.select("collection_rules").collect()]),
            str(tmp_path / "ck"),
            bucket=Bucket(),
            on_limits=lambda batch, i: limits.extend(r["limit_value"] for r in batch.collect()),
            available_now=True,
        ).awaitTermination()

    run("a.json", tweet(), {"limit": {"track": 77}})
    current[0] = make_rules(rule(99, "birthday", "keyword"))
    run("b.json", tweet())
    assert [sorted(x) for x in sent] == [[[], ["12347"]], [["99"]]] and limits == [77]


def test_waiting_for_the_first_rule(make_rules):
    from sievestream.streaming.collector import wait_for_rules

    tables = iter([make_rules(), make_rules(), make_rules(TRACK)])
    assert wait_for_rules(lambda: next(tables), 0.0)
    assert not wait_for_rules(make_rules, 0.0, tries=2)
