"""Matching: both physical forms against a direct nested loop, on random data with hot words and authors."""

import itertools
import random

import pytest
from tests.samples import rule, tweet
from pyspark.sql import functions as F

from sievestream.functions import content as C
from sievestream.operators import distribute
from sievestream.operators import matching as X
from sievestream.operators import messages as M
from sievestream.plans.enrich import contents, prepare, tag


def ids(df):
    return {(r[0], r[1]) for r in df.collect()}


def brute_force(messages, rules, kinds):
    return {
        (row_id, r["rule_id"])
        for row_id, content in messages
        for r in rules
        if r["orig_type"] in kinds and all(t in content[r["orig_type"]] for t in r["value"].lower().split(" "))
    }


@pytest.mark.parametrize("seed", range(3))
def test_track_forms_agree(spark, make_rules, seed):
    rng = random.Random(seed)
    parts = ["ab", "abc", "bca", "x", "über", "日本", "a'b", "c\\d", "qrstuv", "stuvw"]
    word = lambda: "".join(rng.choice(parts) for _ in range(rng.randint(1, 3)))
    messages = []
    for i in range(60):
        text = " ".join(["hot", *[word() for _ in range(rng.randint(0, 8))]]).lower()
        messages.append((f"m{i:02d}", {"keyword": text, "hashtag": {word() for _ in range(2)} | {"hot"}}))
    rules = [
        {"rule_id": f"r{i:02d}", "orig_type": rng.choice(["keyword", "hashtag", "userid", "odd"]),
         "value": " ".join(rng.choice(["hot", "ho", word().upper(), "a", "'b", ""]) for _ in range(rng.randint(1, 3)))}
        for i in range(50)
    ]
    frame = spark.createDataFrame(
        [(i, c["keyword"], sorted(c["hashtag"])) for i, c in messages], "row_id STRING, keyword STRING, hashtag ARRAY<STRING>"
    )
    table = make_rules(*rules)
    expected = brute_force(messages, rules, ("keyword", "hashtag"))
    assert expected
    assert ids(X.match_long(frame, table, "track")) == expected
    assert ids(X.match_long(frame, table, "track", form="joins")) == expected
    joined = X.tag_by_joins(frame, table, "track")
    in_place = X.match_in_place(frame, X.rule_bag(table, "track"), {k: F.col(k) for k in ("keyword", "hashtag")})
    as_lists = lambda df: {r[0]: r[1] for r in df.select("row_id", "collection_rules.rule_id").collect()}
    assert as_lists(joined) == as_lists(in_place)


def test_contains_form_agrees_with_automaton(spark):
    entries = [(i, (f"w{i}", "x")) for i in range(20)] + [(20, ("",))]
    texts = spark.createDataFrame([("w1 w12 x",), ("w3",), ("",), (None,)], "t STRING")
    fast = [r[0] for r in texts.select(X.substring_hits(spark, F.col("t"), entries)).collect()]
    slow = [r[0] for r in texts.select(X.substring_hits(spark, F.col("t"), entries, automaton=False)).collect()]
    assert fast[:3] == slow[:3] == [[1, 12, 20], [20], [20]]


def test_follow_looks_at_authors_and_mentions(make_rules, make_lines):
    mention = {"user_mentions": [{"id_str": "55", "screen_name": "CNN"}, {"id_str": None}]}
    message = tweet(
        entities=mention,
        retweeted_status={"user": {"id_str": "66", "screen_name": "Re"}, "extended_tweet": {"entities": mention}},
        quoted_status={"user": {"id_str": "77"}, "entities": {"user_mentions": [{"screen_name": "quoted"}]}},
    )
    rules = make_rules(
        *[rule(i, v, "userid", "follow") for i, v in enumerate(["55", "66", "77", "5", "17919972"])],
        *[rule(10 + i, v, "username", "follow") for i, v in enumerate(["cnn", "Quoted", "WRITER", "wri"])],
        rule(20, "birthday", "keyword"),
    )
    tagged = tag(prepare(make_lines(message), 0), rules, "follow", 0).select("collection_rules.rule_id").collect()[0][0]
    assert sorted(tagged, key=int) == ["0", "1", "2", "4", "10", "11", "12"]


def test_track_looks_at_all_texts_urls_and_hashtags(make_rules, make_lines):
    urls = lambda name: {"urls": [{"expanded_url": f"http://{name}.org", "display_url": None}]}
    message = tweet(
        entities={**urls("root"), "media": [{"display_url": "pic.root"}], "hashtags": [{"text": "Summer"}, {"text": None}]},
        retweeted_status={"text": "re text", "entities": urls("retweet"), "extended_tweet": {"full_text": "re full"}},
        quoted_status={"extended_tweet": {"full_text": "Quote Full", "entities": {"hashtags": [{"text": "DOOR"}]}}},
    )
    words = ["happy birth", "root.org", "pic.root", "re full", "retweet.org", "quote", "writer", "nothing"]
    rules = make_rules(
        *[rule(i, w, "keyword") for i, w in enumerate(words)],
        rule(20, "summer door", "hashtag"),
        rule(21, "#summer", "hashtag"),
        rule(22, "sum", "hashtag"),
        rule(23, "writer", "username"),
    )
    tagged = tag(prepare(make_lines(message), 0), rules, "track", 0).select("collection_rules.rule_id").collect()[0][0]
    assert sorted(tagged, key=int) == ["0", "1", "2", "3", "4", "5", "6", "20"]


def test_content_of_an_empty_message(make_lines):
    parsed = M.parse(make_lines({"id_str": "1"}))
    row = parsed.select(C.keyword_text(), C.hashtags(), C.user_ids(), C.screen_names()).collect()[0]
    assert tuple(row) == ("", [], [], [])


def test_in_place_plan_has_no_join_shuffle_or_second_run(make_rules, make_lines):
    rules = make_rules(*[rule(i, f"word{i} x", "keyword") for i in range(30)])
    tagged = tag(prepare(make_lines(tweet()), 0), rules, "track", 0)
    hits = tagged.select("row_id", F.explode("collection_rules.rule_id"))
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "Join" not in plan and "Exchange" not in plan


def test_join_plan_has_no_cross_join(spark, make_rules):
    frame = spark.createDataFrame([("1", "some text", ["t"])], "row_id STRING, keyword STRING, hashtag ARRAY<STRING>")
    pairs = X.match_pairs(frame, make_rules(rule(1, "text some", "keyword"), rule(2, "t", "hashtag")), "track")
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert ids(pairs) == {("1", "1"), ("1", "2")}


def test_locations_filter_forms_agree(spark, make_lines):
    rng = random.Random(5)
    boxes, messages = [], []
    for _ in range(25):
        lon, lat = rng.uniform(-170, 150), rng.uniform(-80, 60)
        boxes.append((f"{lon},{lat},{lon + rng.uniform(0, 12)},{lat + rng.uniform(0, 12)}",))
    boxes += [("1,2,3",), ("5,5,1,1",)]
    for _ in range(80):
        lon, lat = rng.uniform(-180, 180), rng.uniform(-90, 90)
        ring = [[lon, lat], [lon + 3, lat], [lon + 3, lat + 2], [lon, lat + 2]]
        place = {"bounding_box": {"type": "Polygon", "coordinates": [ring]}}
        point = {"coordinates": [lon, lat]} if rng.random() < 0.5 else None
        messages.append(tweet(coordinates=point, place=place))
    messages.append(tweet())
    from sievestream.functions import geo as G

    parsed = M.parse(make_lines(*messages))
    table = spark.createDataFrame(boxes, "value STRING")
    few = {r[0] for r in X.within_boxes(parsed, table, G.message_area()).select("row_id").collect()}
    many = {r[0] for r in X.within_boxes(parsed, table, G.message_area(), form="joins").select("row_id").collect()}
    expected = set()
    for i, m in enumerate(messages):
        if "place" not in m:
            continue
        x, y = m["place"]["bounding_box"]["coordinates"][0][0]
        w, h = (0, 0) if m["coordinates"] else (3, 2)
        for (b,) in boxes[:25]:
            a1, b1, a2, b2 = map(float, b.split(","))
            if x <= a2 and x + w >= a1 and y <= b2 and y + h >= b1:
                expected.add(f"{i:04d}")
    assert few == many == expected and expected


def test_contents_follow_the_collector_type(spark):
    assert set(contents("track")) == {"keyword", "hashtag"} and set(contents("follow")) == {"userid", "username"}


def test_every_row_is_a_rule_in_both_forms(spark):
    rows = [("r1", "red door"), ("r1", "cat"), (None, "big"), ("r3", "big"), ("r3", "big"), (None, "  "), ("r4", None)]
    rules = spark.createDataFrame([(i, v, "t", "keyword") for i, v in rows], "rule_id STRING, value STRING, tag STRING, orig_type STRING")
    texts = [("a", "big red door"), ("a", "big cat"), (None, "nothing")]
    frame = spark.createDataFrame([(i, t, []) for i, t in texts], "row_id STRING, keyword STRING, hashtag ARRAY<STRING>")
    joined = X.tag_by_joins(frame, rules, "track")
    in_place = X.match_in_place(frame, X.rule_bag(rules, "track"), {k: F.col(k) for k in ("keyword", "hashtag")})
    both = [sorted((r["keyword"], [(x["rule_id"], x["value"]) for x in r["collection_rules"]]) for r in df.collect()) for df in (joined, in_place)]
    assert both[0] == both[1]
    assert [len(found) for _, found in both[0]] == [5, 5, 1]
    pairs = [sorted(map(str, X.match_long(frame, rules, "track", form=form).collect())) for form in X.FORMS]
    assert pairs[0] == pairs[1]


def test_too_many_rules_for_the_plan_are_an_error(make_rules):
    with pytest.raises(ValueError, match="form='joins'"):
        X.rule_bag(make_rules(*[rule(i, f"w{i}", "keyword") for i in range(50)]), "track", max_bytes=1000)


def test_pairs_of_rules_too_large_for_the_plan(spark, make_rules):
    rules = make_rules(*[rule(i, f"w{i}", "keyword") for i in range(40)], rule(40, "tag", "hashtag"), rule(41, "w3 w7", "keyword"))
    rows = [("a", "w3 and w7", []), ("a", "w12", ["tag"]), (None, "w5", None), ("b", None, ["tag"])]
    frame = spark.createDataFrame(rows, "row_id STRING, keyword STRING, hashtag ARRAY<STRING>")
    fits, too_large = (X.match_long(frame, rules, "track", max_bytes=n) for n in (1 << 20, 1000))
    assert sorted(map(str, too_large.collect())) == sorted(map(str, fits.collect())) and too_large.schema == fits.schema


def test_many_set_rules_in_place(spark):
    rules = spark.range(25_000).selectExpr("CAST(id AS STRING) AS rule_id", "CONCAT('n', id) AS value", "'userid' AS orig_type")
    frame = spark.createDataFrame([(1, ["n3", "n24999", "x"]), (2, ["n25000"]), (3, None)], "row_id INT, userid ARRAY<STRING>")
    frame = frame.withColumn("username", F.array().cast("array<string>"))
    assert ids(X.match_long(frame, rules, "follow")) == {(1, "3"), (1, "24999")} == ids(X.match_long(frame, rules, "follow", form="joins"))


def test_rule_tables_are_not_broadcast_by_their_size_before(spark, tmp_path):
    """Files of a few KB hold 300,000 rules, which Spark would send to all tasks several times each."""
    spark.range(300_000).selectExpr("CAST(id AS STRING) AS rule_id", "CAST(id % 3 AS STRING) AS term").write.parquet(str(tmp_path / "terms"))
    frame = spark.range(40).selectExpr("id AS row_id", "array(CAST(id AS STRING)) AS userid")
    pairs = X.set_pairs(frame, spark.read.parquet(str(tmp_path / "terms")), "userid")
    lines = pairs._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = itertools.takewhile(lambda x: depth(x) > depth(line), lines[i + 1 :])
            assert not any("_salt" in x for x in below), line
    assert pairs.count() == 300_000


def test_tables_of_few_and_of_many_rows_join_alike(spark, monkeypatch):
    tokens = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, None)], "row_id INT, token STRING")
    hits = spark.createDataFrame([("a", "x"), ("a", "y"), ("c", "z")], "token STRING, term STRING")
    want = [(1, "x"), (1, "y"), (2, "x"), (2, "y")]
    for rows in (100, 2):
        monkeypatch.setattr(distribute, "BROADCAST_ROWS", rows)
        joined = distribute.written_join(tokens, hits, ["token"], F.col("row_id")).select("row_id", "term")
        assert ("BroadcastExchange" in joined._jdf.queryExecution().executedPlan().toString()) == (rows == 100)
        assert sorted(map(tuple, joined.collect())) == want


def test_rules_come_with_all_their_terms(spark):
    """Repeated terms and rules, rules without id, terms nobody has: as in one pass over all pairs."""
    terms = spark.createDataFrame([("r1", "a"), ("r1", "b"), ("r2", "a"), ("r3", "a"), ("r3", "x"), (None, "a"), ("r4", "b"), ("r5", "a"), ("r5", "b"), ("r5", "c")], "rule_id STRING, term STRING")
    found = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "b"), (4, "a"), (4, "b"), (4, "c")], "row_id INT, term STRING")
    got = sorted(map(tuple, X._all_terms_found(found, terms, "row_id", "rule_id").collect()), key=str)
    want = [(m, "r1") for m in (1, 4)] + [(m, r) for m in (1, 2, 4) for r in ("r2", None)] + [(m, "r4") for m in (1, 3, 4)] + [(4, "r5")]
    assert got == sorted(want, key=str)


def test_few_terms_are_looked_up_where_the_tokens_lie(spark, monkeypatch):
    """Of messages and few terms only (row, term) is shuffled, once; many terms give the same pairs."""
    messages = [(1, "green tea, black tea\nmilk"), (2, "teapot"), (3, "blacktea a😀b"), (4, ""), (5, None), (1, "sugar"), (None, "tea sugar")]
    frame = spark.createDataFrame(messages, "row_id INT, keyword STRING")
    terms = spark.createDataFrame([("r1", "tea"), ("r2", "black"), ("r2", "tea"), ("r3", "sugar"), ("r3", "milk"), ("r4", "a😀"), ("r5", "nowhere"), ("r5", "tea"), ("r6", "k")], "rule_id STRING, term STRING")
    want = [(m, "r1") for m in (None, 1, 2, 3)] + [(1, "r2"), (3, "r2"), (1, "r3"), (3, "r4"), (1, "r6"), (3, "r6")]
    plans, write = {}, X.cut_lineage

    def seen(df, purpose):
        plans[purpose] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, purpose)

    monkeypatch.setattr(X, "cut_lineage", seen)
    for rows in (100, 1):
        plans.clear()
        monkeypatch.setattr(distribute, "BROADCAST_ROWS", rows)
        assert sorted(map(tuple, X.keyword_pairs(frame, terms).collect()), key=str) == sorted(want, key=str)
        assert ("token-hits" in plans) == (rows == 1)
        assert (plans["found"].count("hashpartitioning") == 1) == (rows == 100)


def test_few_rules_go_to_the_rows_that_propose_them(spark, monkeypatch):
    """The rows found are shuffled to confirm rules of several terms only; they are never sent to all tasks, and many rules give the same."""
    terms = spark.createDataFrame([("r1", "a"), ("r2", "a"), ("r2", "b"), ("r3", "b"), ("r4", "a"), ("r4", "x")], "rule_id STRING, term STRING")
    found = spark.createDataFrame([(i, t) for i in range(60) for t in ("a", "b") if t == "a" or i % 3 == 0], "row_id INT, term STRING")
    want = sorted([(i, "r1") for i in range(60)] + [(i, r) for i in range(0, 60, 3) for r in ("r2", "r3")])
    for rows in (100, 1):
        monkeypatch.setattr(distribute, "BROADCAST_ROWS", rows)
        pairs = X._all_terms_found(found, terms, "row_id", "rule_id")
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert ("hashpartitioning(term" in plan) == (rows == 1)
        assert "SortMergeJoin [row_id" in plan
        assert sorted(map(tuple, pairs.collect())) == want
