"""What a running collector keeps, next to the same over whole tables; replays and changes of rules in between."""

import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sievestream.functions import geo as G
from sievestream.operators import digests as DG
from sievestream.operators import limiter as L
from sievestream.operators import matching as X
from sievestream.operators import rates as A
from sievestream.operators import validate as Y
from sievestream.operators.term_index import TermIndex
from sievestream.plans import live
from sievestream.sources import batches as B
from sievestream.sources import messages as SM
from sievestream.streaming.collector import start_collector
from sievestream.streaming.history import EventCounts, NewestByKeyword, UserTable
from sievestream.streaming.rings import CounterRing, RateRing
from sievestream.streaming.rule_versions import RuleLog, table_digest
from tests.samples import rule, tweet

SECOND = 1_000_000
START = 1_700_000_000 * SECOND


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def timed(spark, events, ddl):
    """Frame of tuples whose last column is a time in microseconds."""
    return spark.createDataFrame(events, f"{ddl}, at LONG").withColumn("ts", F.timestamp_micros("at")).drop("at")


# --- lines in order ------------------------------------------------------------------------------------------------


@pytest.fixture
def files(tmp_path):
    """Files of lines of all lengths, each line with its place in all of them."""
    rng, n, folder = random.Random(1), 0, tmp_path / "lines"
    folder.mkdir()
    for i, name in enumerate(["b", "a", "c"]):
        lines = []
        for _ in range(120):
            lines.append(f"{n} " + "x" * rng.choice([0, 1, 30, 500]))
            n += 1
        (folder / name).write_text("\n".join(lines) + "\n")
        os.utime(folder / name, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder), n


def test_ids_of_lines_sort_as_the_lines_whatever_the_splits(spark, files):
    folder, n = files
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("700", "5000", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            found = SM.read_lines(spark, folder).select("row_id", F.split("value", " ")[0].cast("int").alias("n")).orderBy("row_id").collect()
            assert [r["n"] for r in found] == list(range(n))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_limiter_takes_lines_of_one_time_in_their_order(spark, files):
    folder, n = files
    at = F.timestamp_micros(F.lit(START))
    lines = SM.read_lines(spark, folder).select("row_id", (F.split("value", " ")[0].cast("int") % 7).cast("string").alias("rule_value"), F.split("value", " ")[0].cast("int").alias("n"), at.alias("ts"))
    decided = L.rate_limit(lines.drop("n"), L.Bucket(rate=1, capacity=5)).where("admitted").join(lines.select("row_id", "n"), "row_id")
    assert sorted(r["n"] for r in decided.collect()) == list(range(5 * 7))


# --- rules versions ------------------------------------------------------------------------------------------------


def test_a_batch_keeps_the_rules_it_had(spark, make_rules, tmp_path):
    table = {"now": make_rules(rule(1, "one", "keyword"))}
    asked = []
    log = lambda **more: RuleLog(spark, str(tmp_path / "log"), lambda: table["now"], **more)
    first = log()
    assert [first.version(0), first.version(1)] == [0, 0]
    bag = first.bag(0, "track")
    assert first.bag(0, "track") is bag and bag.finder(spark, True) is bag.finder(spark, True)
    table["now"] = make_rules(rule(2, "two", "keyword"))
    assert first.version(1) == 0 and first.version(2) == 1
    # after a restart: logged batches as before, an unchanged table makes no new version
    again = log()
    assert [again.version(b) for b in (0, 1, 2, 3)] == [0, 0, 1, 1]
    assert [r["value"] for r in again.rules(0).collect()] == ["one"] and [r["value"] for r in again.rules(1).collect()] == ["two"]
    # with notices the table is looked at when they say so
    notice = {"at": 1}
    told = RuleLog(spark, str(tmp_path / "told"), lambda: asked.append(1) or table["now"], lambda: notice["at"])
    assert [told.version(0), told.version(1)] == [0, 0] and len(asked) == 1
    notice["at"] = 2
    assert told.version(2) == 1 and len(asked) == 2


def test_digest_of_a_table_knows_no_order(spark, make_rules):
    one, two = rule(1, "a", "keyword"), rule(2, "b", "keyword", tag=None)
    assert table_digest(make_rules(one, two)) == table_digest(make_rules(two, one).repartition(3))
    assert len({table_digest(make_rules(*x)) for x in ((one, two), (one,), (one, one), (one, rule(2, "c", "keyword")))}) == 4


def test_a_replayed_batch_of_a_collector(spark, make_rules, tmp_path):
    """The sink fails after it has written; the batch runs again with other rules in the table: same rules, nothing twice."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("\n".join(json.dumps(tweet(id_str=str(i), text=f"happy {i}")) for i in range(6)) + "\n")
    table = {"now": make_rules(rule(1, "happy", "keyword"))}
    reports, failing = [], [True]
    write = B.json_batches(str(tmp_path / "out"))

    def sink(batch, batch_id):
        write(batch, batch_id)
        if failing[0]:
            raise RuntimeError("lost after writing")

    def run():
        start_collector(
            SM.stream_lines(spark, str(tmp_path / "in")), lambda: table["now"], "track", 0, sink, str(tmp_path / "ck"), available_now=True,
            bucket=L.Bucket(rate=1, capacity=4), on_rule_counts=lambda frame, b: reports.append((b, rows(frame))), on_rates=lambda frame, b: reports.append((b, rows(frame.select("rule_value", "count", "direction")))),
        ).awaitTermination()

    with pytest.raises(Exception, match="lost after writing"):
        run()
    failing[0], table["now"] = False, make_rules(rule(2, "other", "keyword"))
    run()
    assert reports == [(0, [("1", 6)]), (0, [("1", 6)]), (0, [("happy", 4, "out"), ("happy", 6, "in")])]
    output = [json.loads(r["output"]) for r in B.read_json_batches(spark, str(tmp_path / "out")).collect()]
    assert sorted(o["id_str"] for o in output) == ["0", "1", "2", "3"]
    assert {o["collector"]["collection_rules"][0]["rule_id"] for o in output} == {"1"}


# --- term index ----------------------------------------------------------------------------------------------------


def test_index_after_changes_equals_a_new_one(spark, tmp_path):
    rng = random.Random(6)
    words = ["spark", "sparkle", "par", "a", "é", "stream", "ream", "xy", "streaming", ""]
    value = lambda: " ".join(rng.choice(words) for _ in range(rng.choice([1, 1, 2, 3])))
    table = {str(i): value() for i in range(60)}
    frame = lambda d: spark.createDataFrame(sorted(d.items()) or [], "rule_id STRING, value STRING")
    messages = spark.createDataFrame([(i, " ".join(rng.choice(words + ["zz", "sparse"]) for _ in range(6))) for i in range(40)] + [(99, None)], "row_id LONG, keyword STRING")
    index = TermIndex(spark, str(tmp_path / "index"))
    assert index.pairs(messages).collect() == [] and index.version() == -1
    index.update(added=frame(table))
    gone = {k: table.pop(k) for k in list(table)[:20]}
    new = {str(100 + i): value() for i in range(10)}
    changed = {k: table[k] for k in list(table)[:10]}
    index.update(added=frame(new), removed=frame({**gone, **changed}))
    table |= new | {k: value() for k in changed}
    index.update(added=frame({k: table[k] for k in changed}), version=2)
    assert index.update(added=frame({"never": "spark"}), version=2) == 2  # published before: an update that runs again
    want = rows(X.keyword_pairs(messages, X.terms_table(frame(table).withColumn("orig_type", F.lit("keyword")), "keyword")))
    assert rows(index.pairs(messages)) == want and want
    assert index.compact() == 3 and rows(index.pairs(messages)) == want
    alive = {r["term"] for r in index.terms().collect()} - {""}
    assert {r["term"] for r in index.anchors().collect()} == alive
    # a whole table to follow: only what differs becomes a segment
    table.pop(next(iter(table)))
    index.follow(frame(table))
    fresh = TermIndex(spark, str(tmp_path / "fresh"))
    fresh.follow(frame(table))
    assert rows(index.terms()) == rows(fresh.terms()) and rows(index.pairs(messages)) == rows(fresh.pairs(messages))
    index.forget(index.version())
    assert rows(index.terms()) == rows(fresh.terms())


def test_joins_by_an_index_tag_the_same(spark, make_rules, make_lines, tmp_path):
    from sievestream.plans.enrich import enrich

    rules = make_rules(rule(1, "happy birthday", "keyword"), rule(2, "HAPPY", "keyword"), rule(3, "sad", "keyword"), rule(4, "Writer", "hashtag"))
    lines = make_lines(tweet(), tweet(id_str="2", text="sadly"), tweet(id_str="3", text="nothing"))
    index = TermIndex(spark, str(tmp_path / "index"))
    index.follow(rules.where("orig_type = 'keyword'"))
    plain = enrich(lines, rules, "track", form="joins").select("row_id", "output")
    assert rows(enrich(lines, rules, "track", form="joins", anchors=index.anchors()).select("row_id", "output")) == rows(plain)


# --- boxes ---------------------------------------------------------------------------------------------------------


def test_boxes_of_all_sizes_join_as_in_place(spark):
    rng = random.Random(12)
    boxes = [(f"{x},{y},{x + w},{y + h}",) for w, h in [(360, 180), (0.001, 0.001), (5, 5), (359, 0.01), (0, 0), (1e-9, 90)] for x, y in [(rng.uniform(-180, 180), rng.uniform(-90, 90)) for _ in range(4)]]
    boxes += [("170,-10,-170,10",), ("180,90,180,90",), ("-180,-90,-180,-90",), ("a,b,c,d",), (None,), ("500,500,600,600",)]
    areas = []
    for i in range(400):
        x, y, s = rng.uniform(-180, 180), rng.uniform(-90, 90), rng.choice([0, 0, 0, 0.01, 3, 200])
        areas.append((i, x - s, y - s, x + s, y + s))
    areas += [(1000, 180.0, 90.0, 180.0, 90.0), (1001, -180.0, 0.0, -180.0, 0.0), (1002, None, None, None, None), (1003, 550.0, 550.0, 550.0, 550.0)]
    messages = spark.createDataFrame(areas, "id LONG, lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE")
    area = F.when(F.col("lon1").isNotNull(), F.struct("lon1", "lat1", "lon2", "lat2"))
    for some in (boxes, [b for b in boxes if b[0] and "0.001" not in b[0]][4:8] + boxes[-6:], boxes[:1]):
        frame = spark.createDataFrame(some, "value STRING")
        results = [rows(X.within_boxes(messages, frame, area, form=form)) for form in X.FORMS]
        assert results[0] == results[1]
    assert results[0]


def test_cells_of_a_box_are_few(spark):
    boxes = spark.createDataFrame([(-180.0, -90.0, 180.0, 90.0), (0.0, 0.0, 1e-4, 1e-4), (-180.0, 0.0, 180.0, 1e-4), (3.0, 4.0, 3.0, 4.0)], "lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE")
    area = F.struct("lon1", "lat1", "lon2", "lat2")
    found = boxes.select(G.cell_level(area).alias("level"), area.alias("a")).select("level", F.size(G.cells(F.col("a"), F.col("level"), [])).alias("n")).collect()
    assert all(r["n"] <= G.MAX_CELLS for r in found) and [r["level"] for r in found][0] == 2 and found[3]["level"] == G.CELL_LEVELS


# --- counters and rates --------------------------------------------------------------------------------------------


def test_counter_ring_equals_rolling_counts_and_starts_anew_with_new_rules(spark, tmp_path):
    rng = random.Random(3)
    ring, window = CounterRing(spark, str(tmp_path / "ring"), 60), 60
    versions = [0, 0, 1, 1]
    seen = {0: [], 1: []}
    for batch_id, version in enumerate(versions):
        events = [(rng.choice("abc"), START + (40 * batch_id + rng.randrange(40)) * SECOND + rng.randrange(SECOND)) for _ in range(30)] + [(None, START)]
        rules = spark.createDataFrame([(r,) for r in ("abz" if version == 0 else "bcz")], "rule_id STRING")
        now = START + (40 * batch_id + 39) * SECOND + SECOND - 1
        for _ in range(2 if batch_id == 1 else 1):  # batch 1 runs twice
            got = dict(map(tuple, ring.update(timed(spark, events, "rule_id STRING"), batch_id, now, rules, version).collect()))
        seen[version] += [(r, at // SECOND * SECOND) for r, at in events if r]
        # as rolling_counts() has it at the report's time
        asked = [(r, now // SECOND * SECOND) for r in "abcz"]
        rolled = {r["rule_id"]: r["n"] - 1 for r in A.rolling_counts(timed(spark, [*seen[version], *asked], "rule_id STRING"), window_seconds=window).where(F.unix_micros("ts") == now // SECOND * SECOND).collect()}
        assert got == {r["rule_id"]: rolled[r["rule_id"]] for r in rules.collect()}
        assert got["z"] == 0
    assert rows(ring.table.after(3).select(F.min("rules_version"), F.min("pane") >= now // SECOND - 60)) == [(1, True)]


def test_rate_ring_equals_the_report_of_all_events(spark, tmp_path):
    rng, ring, events = random.Random(5), RateRing(spark, str(tmp_path / "ring"), 30), []
    for batch_id in range(3):
        fresh = [(rng.choice("ab"), rng.random() < 0.5, START + (20 * batch_id + rng.randrange(20)) * SECOND + rng.randrange(SECOND)) for _ in range(40)]
        fresh += [("early", True, START)] if batch_id == 0 else []
        events += [(v, ok, at // SECOND * SECOND) for v, ok, at in fresh]
        now = START + (20 * batch_id + 19) * SECOND
        got = ring.update(timed(spark, fresh, "rule_value STRING, admitted BOOLEAN"), batch_id, now)
        assert rows(got) == rows(A.rate_report(timed(spark, events, "rule_value STRING, admitted BOOLEAN"), now, 30 * SECOND))
    assert "early" not in {r["rule_value"] for r in ring.table.after(2).collect()}
    with pytest.raises(ValueError):
        ring.update(timed(spark, [], "rule_value STRING, admitted BOOLEAN"), 3, now, 31 * SECOND)


# --- histories -----------------------------------------------------------------------------------------------------


def test_newest_by_keyword_equals_a_search_of_the_history(spark, tmp_path):
    rng, newest, history = random.Random(8), NewestByKeyword(spark, str(tmp_path / "n"), 5), []
    keywords = spark.createDataFrame([("spark",), ("big Data",), ("never",)], "keyword STRING")
    for batch_id in range(3):
        batch = [(f"{rng.randrange(10**6):06d}", rng.choice(["Spark is big", "big data spark", "BIG  data", "nothing", None]), START + rng.randrange(50) * SECOND) for _ in range(25)]
        history += batch
        got = newest.update(timed(spark, batch, "row_id STRING, text STRING").select("row_id", "ts", "text"), batch_id, keywords)
        whole = timed(spark, history, "row_id STRING, text STRING").select("row_id", "ts", "text")
        want = rows(Y.recent_by_keyword(whole, keywords, 5))
        assert rows(got) == want
        assert rows(Y.recent_by_keyword(whole, keywords, 5, form="joins")) == want


def test_more_newest_than_spark_cuts_in_its_map_tasks(spark):
    messages = spark.range(6000).select("id", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 977).alias("ts"), F.lit("hot word").alias("text")).withColumnRenamed("id", "row_id")
    keywords = spark.createDataFrame([("hot",)], "keyword STRING")
    want = sorted(((i % 977, i) for i in range(6000)), reverse=True)[:5000]
    for form in X.FORMS:
        found = Y.recent_by_keyword(messages, keywords, 5000, form).orderBy("rank").collect()
        assert [r["row_id"] for r in found] == [i for _, i in want]


def test_user_table_takes_names_in_any_order(spark, tmp_path):
    rng, table, history = random.Random(9), UserTable(spark, str(tmp_path / "users"), compact_every=2), []
    assert table.users().collect() == []
    for batch_id in range(5):
        batch = [(rng.choice(["1", "2", "3", None]), rng.choice(["x", "y", "z", None]), START + rng.randrange(6) * SECOND) for _ in range(8)]
        history += batch
        for _ in range(2 if batch_id in (1, 2) else 1):  # also the batch that was just compacted
            table.update(timed(spark, batch, "userid STRING, screen_name STRING"), batch_id)
        assert rows(table.users()) == rows(Y.user_dimension(timed(spark, history, "userid STRING, screen_name STRING")))
    assert len(os.listdir(tmp_path / "users" / "deltas")) <= 3


def test_event_counts_lose_nothing(spark, tmp_path):
    rng, counts = random.Random(10), EventCounts(spark, str(tmp_path / "counts"), 10, 15)
    total, given, late = Counter(), Counter(), 0
    for batch_id in range(4):
        base = 30 * batch_id
        batch = [(rng.choice("ab"), START + (base + rng.randrange(30)) * SECOND) for _ in range(20)] + [("a", START + rng.randrange(max(base, 1)) * SECOND) for _ in range(5)] + [("b", None)]
        frame = timed(spark, batch, "key STRING")
        for _ in range(2 if batch_id == 2 else 1):
            closed, corrections = counts.update(frame, batch_id)
        for key, at in batch:
            if at is not None:
                total[key, at // (10 * SECOND) * 10 * SECOND] += 1
        for part in (closed, corrections):
            for r in part.collect():
                given[r["key"], r["window_us"]] += r["n"]
        assert sum(r["n"] for r in corrections.collect()) == counts.late_rows(frame, batch_id).count()
        late += corrections.count()
    for r in counts.still_open(3).collect():
        given[r["key"], r["window_us"]] += r["n"]
    assert given == total and late


# --- published batches, digests ------------------------------------------------------------------------------------


def test_batches_count_once(spark, tmp_path):
    folder = B.BatchFolder(spark, str(tmp_path / "out"))
    save = lambda frame, to: frame.write.parquet(to)
    assert folder.read("parquet", "id LONG").collect() == []
    assert folder.write(spark.range(3), 0, save) and not folder.write(spark.range(9), 0, save)

    def fails(frame, to):
        save(frame, to)
        raise RuntimeError

    with pytest.raises(RuntimeError):
        folder.write(spark.range(5), 1, fails)
    assert folder.read("parquet", "id LONG").count() == 3
    assert folder.write(spark.range(2), 1, save) and folder.read("parquet", "id LONG").count() == 5
    folder.sweep(below=2)
    assert len(os.listdir(tmp_path / "out" / "data")) == 2 and folder.read("parquet", "id LONG").count() == 5
    assert len(folder.folders(after=0)) == 1


def test_digests_find_what_the_joins_find(spark):
    left = spark.range(3000).select(F.col("id").alias("rule_id"), F.lit("v").alias("value"), F.when(F.col("id") % 2 == 0, F.lit("t")).alias("tag"))
    changed = left.where("rule_id NOT IN (7, 8)").withColumn("value", F.when(F.col("rule_id") == 100, "w").otherwise(F.col("value")))
    right = changed.unionByName(spark.createDataFrame([(5000, "v", None)], left.schema)).withColumn("tag", F.when(F.col("rule_id") == 200, None).otherwise(F.col("tag")))
    assert rows(DG.delta(left, right, "rule_id", ["value", "tag"])) == sorted([(7, "removed"), (8, "removed"), (100, "changed"), (200, "changed"), (5000, "added")], key=repr)
    assert rows(DG.delta(left, right)) == sorted([(7, "removed"), (8, "removed"), (5000, "added")], key=repr)
    assert DG.delta(left, left.repartition(3), "rule_id", ["value", "tag"]).collect() == []
    assert rows(DG.same_tables(left, left.orderBy("tag"), "rule_id", ["value", "tag"])) == [(True,)] and rows(DG.same_tables(left, right)) == [(False,)]
    leaves = {r["leaf"] for r in DG.unequal_leaves(DG.leaf_digests(left), DG.leaf_digests(right)).collect()}
    assert 1 <= len(leaves) <= 3
    empty = left.limit(0)
    assert rows(DG.same_tables(empty, empty)) == [(True,)] and DG.delta(empty, left.limit(2)).count() == 2


def test_files_of_a_batch_grow_in_number_not_in_size(spark, monkeypatch):
    """Three batches at every size, a key in one file, no task with a third of the table."""
    monkeypatch.setattr(live, "ROWS_OF_A_FILE", 50)
    seen = []

    def work(batch, batch_id, path):
        files = batch.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()
        seen.append((batch_id, [r["n"] for r in files], {r["id"] for r in batch.collect()}))

    live._through_batches(spark.range(3000).selectExpr("id % 1000 AS id"), "id", work)
    assert [batch_id for batch_id, _, _ in seen] == [0, 1, 2]
    sizes = [n for _, files, _ in seen for n in files]
    assert sum(sizes) == 3000 and max(sizes) <= 150 and len(sizes) <= 60
    assert sum(len(ids) for _, _, ids in seen) == 1000
