import json

import pytest

from sievestream.functions import values as V
from sievestream.operators import validate as Y
from pyspark.sql import functions as F

RING = [[100.0, -80.0], [101.0, 0.0], [101.0, 1.0], [100.0, 1.0], [100.0, 0.0]]


def feature(*rings, kind="Polygon", outer="Feature"):
    return json.dumps({"type": outer, "geometry": {"type": kind, "coordinates": list(rings)}})


def check_geo(spark, value="", complex_value=None):
    rules = spark.createDataFrame([("geo", value, (complex_value,))], "type STRING, value STRING, metadata STRUCT<complex_value: STRING>")
    row = Y.validate_geo(rules).collect()[0]
    return row["status"], row["error"], row["code"], row["geo_type"]


@pytest.mark.parametrize(
    "value, error",
    [
        ("80,80,80,80", None),
        ("-122.75,36.8,-121.75,37.8", None),
        ("5,5,1,1", None),
        ("100,100,100,100", "Lat/lon out of range: 100, 100"),
        ("1,91,2,92", "Lat/lon out of range: 92, 2"),
        ("1,2,3", "not enough values to unpack (expected 4, got 3)"),
        ("1,2,3,4,5", "too many values to unpack (expected 4)"),
        ("1,x,3,4", "could not convert string to float: 'x'"),
        ("1,91,3,", "could not convert string to float: ''"),
        ("1d,2,3,4", "could not convert string to float: '1d'"),
        ("nan,2,3,4", "Lat/lon out of range: 2, nan"),
    ],
)
def test_legacy_box(spark, value, error):
    expected = ("ok", None, 200, "legacy") if error is None else ("error", error, 500, None)
    assert check_geo(spark, value) == expected
    assert check_geo(spark, value, "not json") == expected
    assert check_geo(spark, "", json.dumps(value)) == expected


@pytest.mark.parametrize(
    "text, error",
    [
        (feature(RING), None),
        (feature(RING, outer="feature", kind="POLYGON"), None),
        (feature([[100.0, -100.0], *RING[1:]]), "Lat/lon out of range: -100.0, 100.0"),
        (feature([[200, 1], [1, 1]]), "Lat/lon out of range: 1, 200"),
        (feature([[1, 1], [1, 1], [2, 2]]), "Linear ring in coordinates is too short"),
        (feature(RING, [[1, 1], [2, 2]]), "Linear ring in coordinates is too short"),
        (feature([]), "Linear ring in coordinates is empty"),
        (feature(), "GeoJSON coordinates list is empty."),
        (feature([[1, 2, 3], [1, 1]]), "too many values to unpack (expected 2)"),
        (feature(RING, outer="Point"), "GeoJSON type not supported: Point"),
        (feature(RING, kind="Line"), "GeoJSON geometry type not supported: Feature"),
        ('{"a": 1}', "GeoJSON type not supported: None"),
        ('{"type": "Feature"}', "Invalid GeoJSON object"),
    ],
)
def test_polygon(spark, text, error):
    expected = ("ok", None, 200, "geo_json") if error is None else ("error", error, 500, None)
    assert check_geo(spark, "ignored", text) == expected


def test_polygon_repair(spark):
    text = feature([RING[0], RING[0], *RING[1:]])
    rules = spark.createDataFrame([("geo", "", text)], "type STRING, value STRING, complex_value STRING")
    assert Y.repaired_polygons(rules).collect()[0]["rings"] == [[*RING, RING[0]]]


def test_validate_dispatch(spark):
    users = spark.createDataFrame([("17", "CNN")], "userid STRING, screen_name STRING")
    rows = [(f"{i}", i * V.MICROS, "some Happy text" if i < 3 else "once only") for i in range(4)]
    messages = spark.createDataFrame(rows, "row_id STRING, at BIGINT, text STRING").select(
        "row_id", F.timestamp_micros("at").alias("ts"), "text"
    )
    cases = [
        ("username", "@cnn"), ("username", "nobody"), ("keyword", "happy"), ("hashtag", "once"), ("keyword", "absent"),
        ("keyword", "漢" * 21), ("geo", "80,80,80,80"), ("place", "x"), (None, "y"),
    ]
    rules = spark.createDataFrame(cases, "type STRING, value STRING")
    got = {(r["type"], r["value"]): r for r in Y.validate(rules, users, messages).collect()}
    assert len(got) == len(cases)
    brief = {k: (r["status"], r["code"], r["userid"], r["tweets_per_second"], r["geo_type"]) for k, r in got.items()}
    assert brief == {
        ("username", "@cnn"): ("ok", 200, "17", None, None),
        ("username", "nobody"): ("error", 500, None, None, None),
        ("keyword", "happy"): ("ok", 200, None, 1.5, None),
        ("hashtag", "once"): ("ok", 200, None, 0.0, None),
        ("keyword", "absent"): ("ok", 200, None, 0.0, None),
        ("keyword", "漢" * 21): ("error", 400, None, 0.0, None),
        ("geo", "80,80,80,80"): ("ok", 200, None, None, "legacy"),
        ("place", "x"): ("error", 500, None, None, None),
        (None, "y"): ("error", 500, None, None, None),
    }
    assert got[("keyword", "漢" * 21)]["error"] == "The byte length of the track phrase is over 60."


@pytest.mark.parametrize("form", ["in_place", "joins"])
def test_recent_messages_and_volume(spark, form):
    messages = spark.range(300).select(
        F.format_string("%04d", "id").alias("row_id"),
        F.timestamp_seconds(F.when(F.col("id") < 290, F.col("id")).otherwise(1000)).alias("ts"),
        F.when(F.col("id") % 3 == 0, "The red Door").when(F.col("id") >= 298, "twice").otherwise("red and door").alias("text"),
    )
    keywords = spark.createDataFrame([("Red door",), ("red",), ("twice",), ("none",)], "keyword STRING")
    recent = Y.recent_by_keyword(messages, keywords, 100, form)
    ranks = {r[0]: (r[1], r[2]) for r in recent.groupBy("keyword").agg(F.count("*"), F.max("rank")).collect()}
    assert ranks == {"Red door": (100, 100), "red": (100, 100), "twice": (2, 2)}
    rates = {r[0]: r[1] for r in Y.volume(recent, keywords).collect()}
    assert (rates["none"], rates["twice"]) == (0.0, 10000.0)
    ids = {r[0] for r in recent.where("keyword = 'Red door'").select("row_id").collect()}
    assert ids == {f"{i:04d}" for i in range(0, 300, 3)}


def test_user_dimension_takes_the_newest_name(spark):
    rows = spark.createDataFrame([("1", "old", 1), ("1", "New", 2), ("2", "b", 1)], "userid STRING, screen_name STRING, ts INT")
    users = Y.user_dimension(rows)
    ids = spark.createDataFrame([("1",), ("9",)], "userid STRING")
    assert sorted(map(tuple, Y.screen_names_for(ids, users).collect())) == [("1", "New", "ok"), ("9", None, "error")]
    names = spark.createDataFrame([("@NEW",), ("old",), ("@@b",)], "value STRING")
    assert [r["userid"] for r in Y.userids_for(names, users).orderBy("value").collect()] == [None, "1", None]
