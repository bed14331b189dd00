import json
import random

import pytest
from tests.samples import rule
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sievestream.operators import rules as R
from sievestream.plans.rule_etl import clean_rules
from sievestream.sources import rules as SR
from sievestream.sources import sinks as K


def values(df, column="value"):
    return sorted(r[0] for r in df.select(column).collect())


PHRASE_RULES = [
    (1, "happy", "keyword"),
    (2, "summer", "hashtag"),
    (3, "#apple", "hashtag"),
    (4, "#sliding door", "hashtag"),
    (5, "summer", "hashtag"),
    (6, "今日中国", "keyword"),
]


def test_phrases(make_rules):
    rules = make_rules(*[rule(i, v, k) for i, v, k in PHRASE_RULES])
    phrase = R.phrases(R.constrain(rules, "track")).collect()[0]["phrases"]
    assert set(phrase.split(",")) == {"#apple", "#sliding #door", "#summer", "今日中国", "happy"}


def test_normalized_value_keeps_null_and_drops_extra_blanks(make_rules):
    rules = make_rules(rule(1, None, "hashtag"), rule(2, " A  #b ", "hashtag"), rule(3, " A  B ", "keyword"))
    got = [r[0] for r in R.normalize(rules).orderBy("rule_id").select("norm_value").collect()]
    assert got == [None, "#a #b", " a  b "]


def test_constraints(make_rules):
    rules = make_rules(rule(1, "x" * 60, "keyword"), rule(2, "x" * 61, "keyword"), rule(3, "é" * 60, "keyword"))
    assert values(R.constrain(rules, "track"), "rule_id") == ["1", "3"]
    follow = make_rules(rule(1, "ishouldbeint", "userid"), rule(2, "17", "userid"), rule(3, "", "userid"))
    assert values(R.constrain(follow, "follow"), "rule_id") == ["2"]
    assert values(R.rejected(follow, "follow"), "rule_id") == ["1", "3"]
    with pytest.raises(ValueError):
        R.constrain(follow, "nearby")


@pytest.mark.parametrize("seed", range(4))
def test_set_algebra_like_python(spark, seed):
    rng = random.Random(seed)
    a = {str(i): f"a{i}" for i in rng.sample(range(30), 15)}
    b = {str(i): f"b{i}" for i in rng.sample(range(30), 12)}
    frame = lambda d: spark.createDataFrame(list(d.items()), "rule_id STRING, value STRING")
    as_dict = lambda df: {r["rule_id"]: r["value"] for r in df.collect()}
    left, right = frame(a), frame(b)
    assert as_dict(R.union(left, right)) == {**a, **b}
    assert as_dict(R.difference(left, right)) == {k: v for k, v in a.items() if k not in b}
    assert as_dict(R.intersection(left, right)) == {k: v for k, v in b.items() if k in a}
    flags = {r["rule_id"]: r["is_member"] for r in R.membership(left, right).collect()}
    assert flags == {k: k in b for k in a}
    assert R.same_ids(left, right).collect()[0]["is_equal"] == (set(a) == set(b))
    assert R.same_ids(left, frame({k: "other" for k in a})).collect()[0]["is_equal"]
    summary = R.summary(R.union(left, right)).collect()[0]
    assert (summary["n_rules"], summary["n_values"]) == (len({**a, **b}), len(set({**a, **b}.values())))


def test_membership_of_null_id(spark):
    items = spark.createDataFrame([(None, "x")], "rule_id STRING, value STRING")
    assert [r["is_member"] for r in R.membership(items, items).collect()] == [False]


def test_append(spark):
    ddl = "rule_id STRING, value STRING, seq INT"
    base = spark.createDataFrame([("1", "one", 9), ("2", "two", 9)], ddl)
    new = spark.createDataFrame([("2", "second", 1), ("2", "last", 2), ("3", "three", 1), (None, "x", 1), ("4", None, 1)], ddl)
    got = {r["rule_id"]: r["value"] for r in R.append(base, new, "seq").collect()}
    assert got == {"1": "one", "2": "last", "3": "three"}
    assert R.incomplete(new).count() == 2
    with pytest.raises(PySparkException):
        R.append(base, new, "seq", strict=True).collect()


def test_fixes(spark):
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "value STRING")
    assert values(R.fix_follow(frame("id 12345678 and 987654321", "123456", "x1234567y"))) == ["1234567", "12345678"]
    track = frame('url_contains: "a.b.com"', "url_contains:c.d", "see url_contains:e.f", "x.y")
    assert values(R.fix_track(track)) == ["a b com", "c d", "see url_contains:e f", "x y"]
    assert values(R.fix_locations(frame("[1.5 2][3\t4]", "", None))) == ["1.5,23,4"]


def test_dedup_keeps_last_tag_and_first_place(spark):
    rules = spark.createDataFrame([("a", "t1", 1), ("b", "t2", 2), ("a", "t3", 3)], "value STRING, tag STRING, seq INT")
    assert sorted(map(tuple, R.dedup_last(rules, "seq").collect())) == [("a", "t3", 1), ("b", "t2", 2)]


def test_etl_picks_type(spark):
    table = spark.createDataFrame(
        [("username", "t", "id 7654321", 1), ("keyword", "t", "a.b", 2), ("geo", "t", "[1 2 3 4]", 3)],
        "type STRING, tag STRING, value STRING, seq INT",
    )
    assert [values(clean_rules(table, k, "seq")) for k in ("follow", "track", "locations")] == [["7654321"], ["a b"], ["1,2,3,4"]]
    with pytest.raises(ValueError):
        SR.sql_rules(table, "nearby")


def test_shard_numbers_are_dense_however_skewed_the_order(spark):
    ids = spark.range(20_000).select((F.pow(F.lit(1.001), F.col("id")) * 10 + F.col("id")).cast("long").alias("seq"))
    rules = ids.distinct().withColumn("rule_type", F.lit("track"))
    rows = R.shard(rules, "seq").orderBy("seq").collect()
    assert [r["idx"] for r in rows] == list(range(len(rows)))
    assert all(r["instance_id"] == r["idx"] // 400 for r in rows)


def test_shard_unknown_type_fails(spark):
    with pytest.raises(PySparkException):
        R.shard(spark.range(2).select(F.col("id").alias("seq"), F.lit("nearby").alias("rule_type")), "seq").collect()


def test_plan_instances(spark):
    rules = spark.range(5500).select(F.lit("follow").alias("rule_type")).unionByName(
        spark.range(352).select(F.lit("track").alias("rule_type"))
    )
    got = {r["rule_type"]: r["n_instances"] for r in R.plan_instances(rules).collect()}
    assert got == {"follow": 2, "track": 1}


def test_cap_per_instance(spark):
    rules = spark.range(12_000).select(
        F.col("id").alias("rule_id"), F.lit("follow").alias("rule_type"), (F.col("id") % 2).cast("int").alias("instance_id")
    )
    caps = {"follow": 5000}
    kept = R.cap_per_instance(rules, caps)
    assert R.over_cap(rules, caps).count() == 2000
    with pytest.raises(Exception, match="unknown collector type"):
        R.cap_per_instance(rules.withColumn("rule_type", F.lit("odd")), caps).collect()
    assert kept.groupBy("instance_id").count().orderBy("instance_id").collect() == [(0, 5000), (1, 5000)]
    assert kept.agg(F.max("rule_id")).collect()[0][0] == 9999


def test_rule_table_is_pruned_to_the_instance(spark, make_rules, tmp_path):
    rules = make_rules(*[rule(i, f"w{i}", "keyword") for i in range(900)]).withColumn("seq", F.col("rule_id").cast("int"))
    K.write_sharded_rules(rules, str(tmp_path / "rules"), "seq")
    own = SR.instance_rules(SR.read_sharded_rules(spark, str(tmp_path / "rules")), "track", 2, "idx")
    assert own.count() == 100
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rule_type" in plan and "(instance_id" in plan


def test_json_rule_file(spark, tmp_path):
    (tmp_path / "rules.json").write_text(json.dumps(rule(12347, "happy", "keyword")))
    assert SR.read_json_rules(spark, str(tmp_path)).select("rule_id", "value").collect() == [("12347", "happy")]


def test_vendor_files(spark, tmp_path):
    for name, texts in {"a": ["from:12 OR from:34", "x"], "b": ["from:12 from:"]}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps({"rules": [{"value": t} for t in texts]}, indent=1))
    paths = [str(tmp_path / "a.json"), str(tmp_path / "b.json")]
    assert values(SR.vendor_ids(spark, paths), "id") == ["12", "34"]
    frame = spark.createDataFrame([("from:1 from:2",), ("from:1",)], "value STRING")
    assert values(SR.author_ids(frame), "id") == ["1", "1", "2"]
