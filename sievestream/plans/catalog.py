"""The registered queries: every operator over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievestream.functions import content as C
from sievestream.functions import values as V
from sievestream.operators import limiter as L
from sievestream.operators import matching as X
from sievestream.operators import messages as M
from sievestream.operators import rates as A
from sievestream.operators import rules as R
from sievestream.operators import validate as Y
from sievestream.plans import feeds as D
from sievestream.plans.enrich import enrich
from sievestream.plans.rule_etl import clean_rules
from sievestream.schemas import SCAN_CAPS
from sievestream.session import work_dir
from sievestream.sources import messages as SM
from sievestream.sources import rules as SR
from sievestream.sources import sinks as K
from sievestream.streaming import collector as SC
from sievestream.streaming import counters as CT
from sievestream.streaming import limiter as SL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed time of the reports: the end of the events table.
REPORT_TIME_US = 1_706_659_200 * V.MICROS
DAY_US = 86_400 * V.MICROS


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _document_content(spark: SparkSession, sf: str) -> DataFrame:
    documents = D.documents(spark, sf)
    return documents.select(
        F.col("doc_id").alias("row_id"), F.lower("text").alias("keyword"), F.array("lang", "source").alias("hashtag")
    )


# --- matching ------------------------------------------------------------------------------------------------------


@query
def match_keyword(spark, sf):
    rules = D.benchmark_rules(D.table(spark, sf, "benchmark"))
    documents = D.documents(spark, sf).select("doc_id", "text")
    tagged = X.match_in_place(documents, X.rule_bag(rules, "track"), {"keyword": F.lower("text")})
    rows = tagged.select("doc_id", F.explode("collection_rules").alias("r"))
    return rows.select("doc_id", "r.rule_id", "r.rule_tag", "r.rule_value")


@query
def match_keyword_joins(spark, sf):
    rules = D.benchmark_rules(D.table(spark, sf, "benchmark"))
    pairs = X.keyword_pairs(_document_content(spark, sf), X.terms_table(rules, "keyword"))
    return pairs.select(F.col("row_id").alias("doc_id"), "rule_id")


@query
def match_not_found(spark, sf):
    rules = D.benchmark_rules(D.table(spark, sf, "benchmark"))
    content = _document_content(spark, sf)
    tagged = X.match_in_place(content, X.rule_bag(rules, "track"), {"keyword": F.col("keyword")})
    return X.mark_unmatched(tagged, "track", 0).select(
        F.col("row_id").alias("doc_id"),
        F.size("collection_rules").cast("long").alias("n_rules"),
        "rule_type",
        "rule_tag",
        "rule_value",
    )


def _nameless_rules(spark, sf):
    """Rules whose ids repeat or are missing, and one of blanks only."""
    nation = D.table(spark, sf, "nation")
    parts = [
        nation.select(F.when(F.col("n_nationkey") % 3 > 0, F.col("n_regionkey").cast("string")).alias("rule_id"), F.lower(F.substring("n_name", 1, 2)).alias("value")),
        nation.where("n_nationkey < 3").select(F.lit("twice").alias("rule_id"), F.concat(F.lit("the "), F.lower(F.substring("n_name", 1, 1))).alias("value")),
        nation.where("n_nationkey = 0").select(F.lit(None).cast("string").alias("rule_id"), F.lit("  ").alias("value")),
    ]
    rules = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rules.select("*", F.lit("t").alias("tag"), F.lit("keyword").alias("orig_type"))


def _nameless_counts(tagged):
    rules = tagged.select(F.col("row_id").alias("doc_id"), F.explode("collection_rules").alias("r"))
    return rules.groupBy("doc_id", "r.rule_id", "r.value").agg(F.count("*").alias("n"))


@query
def match_nameless(spark, sf):
    content, bag = _document_content(spark, sf), X.rule_bag(_nameless_rules(spark, sf), "track")
    return _nameless_counts(X.match_in_place(content, bag, {"keyword": F.col("keyword")}))


@query
def match_nameless_joins(spark, sf):
    return _nameless_counts(X.tag_by_joins(_document_content(spark, sf), _nameless_rules(spark, sf), "track"))


def _customer_rules(spark, sf):
    customer = D.table(spark, sf, "customer")
    return customer.select(
        F.col("c_custkey").cast("string").alias("rule_id"),
        F.col("c_custkey").cast("string").alias("value"),
        F.col("c_name").alias("tag"),
        F.lit("userid").alias("orig_type"),
    )


def _event_content(spark, sf):
    events = D.table(spark, sf, "events")
    nobody = F.array().cast("array<string>")
    return events.select(
        F.col("event_id").alias("row_id"), F.array(F.col("user_id").cast("string")).alias("userid"), nobody.alias("username")
    )


@query
def match_userid(spark, sf):
    pairs = X.match_long(_event_content(spark, sf), _customer_rules(spark, sf), "follow")
    return pairs.select(F.col("row_id").alias("event_id"), "rule_id")


@query
def match_userid_joins(spark, sf):
    terms = X.terms_table(_customer_rules(spark, sf), "userid")
    pairs = X.set_pairs(_event_content(spark, sf), terms, "userid")
    return pairs.select(F.col("row_id").alias("event_id"), "rule_id")


@query
def match_username(spark, sf):
    conversations = D.table(spark, sf, "conversations")
    rules = conversations.select(F.upper("role").alias("value")).distinct()
    rules = rules.select("value", F.col("value").alias("rule_id"), F.lit("username").alias("orig_type"))
    content = conversations.select(
        F.concat_ws("/", "conv_id", "turn").alias("row_id"),
        F.array(F.lower("role")).alias("username"),
        F.array().cast("array<string>").alias("userid"),
    )
    return X.match_long(content, rules, "follow")


def _hashtag_rules(spark, sf):
    pairs = D.table(spark, sf, "documents").select("lang", "source").distinct()
    value = F.concat_ws(" ", F.upper("lang"), "source")
    return pairs.select(value.alias("rule_id"), value.alias("value"), F.lit("hashtag").alias("orig_type"))


@query
def match_hashtag(spark, sf):
    pairs = X.match_long(_document_content(spark, sf), _hashtag_rules(spark, sf), "track")
    return pairs.select(F.col("row_id").alias("doc_id"), "rule_id")


@query
def match_hashtag_joins(spark, sf):
    pairs = X.set_pairs(_document_content(spark, sf), X.terms_table(_hashtag_rules(spark, sf), "hashtag"), "hashtag")
    return pairs.select(F.col("row_id").alias("doc_id"), "rule_id")


@query
def match_locations(spark, sf):
    supplier = D.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("seq"),
        F.col("s_suppkey").cast("string").alias("rule_id"),
        F.col("s_name").alias("tag"),
        D.supplier_box().alias("value"),
        F.when(F.col("s_nationkey") < 5, F.col("s_name")).alias("description"),
        F.lit("geo").alias("orig_type"),
    )
    lines = D.document_lines(D.documents(spark, sf))
    tagged = enrich(lines, supplier, "locations", order="seq").select("row_id", F.explode("collection_rules").alias("r"))
    return tagged.select(
        F.col("row_id").cast("long").alias("doc_id"), "r.rule_id", "r.description", "r.rule_tag", "r.rule_value"
    )


@query
def locations_fold(spark, sf):
    part = D.table(spark, sf, "part").select(
        F.col("p_partkey").alias("seq"),
        F.col("p_name").alias("value"),
        F.col("p_brand").alias("tag"),
        F.when(F.col("p_size") < 10, F.col("p_type")).alias("description"),
    )
    return R.fold_locations(part, "seq").select("value", "description", "rule_tag", "rule_value")


@query
def collect_filter(spark, sf):
    rules = D.benchmark_rules(D.table(spark, sf, "benchmark"))
    content = _document_content(spark, sf)
    tagged = X.match_in_place(content, X.rule_bag(rules, "track"), {"keyword": F.col("keyword")})
    return X.matching_only(tagged).select(F.col("row_id").alias("doc_id"))


def _within(spark, sf, **options):
    customer = D.table(spark, sf, "customer")
    boxes = D.table(spark, sf, "supplier").select(D.supplier_box().alias("value"))
    inside = X.within_boxes(customer, boxes, D.customer_area(), **options)
    return inside.select("c_custkey", "c_name")


@query
def collect_locations(spark, sf):
    return _within(spark, sf)


@query
def collect_locations_grid(spark, sf):
    return _within(spark, sf, form="joins")


# --- messages ------------------------------------------------------------------------------------------------------


@query
def keyword_content(spark, sf):
    pages = D.table(spark, sf, "pages")
    url = F.array(F.struct(F.col("url").alias("expanded_url"), F.upper("url").alias("display_url")))
    message = F.struct(
        F.col("page_id").cast("string").alias("id_str"),
        F.col("html").alias("text"),
        F.struct(F.struct(url.alias("media")).alias("entities"), F.col("html").alias("full_text")).alias("extended_tweet"),
    )
    lines = pages.select("page_id", F.to_json(message).alias("value"))
    parsed = M.well_formed(M.parse(M.drop_keep_alives(lines)))
    return parsed.select("page_id", C.keyword_text().alias("keyword"))


@query
def content_sets(spark, sf):
    lines = D.document_lines(D.documents(spark, sf))
    parsed = M.well_formed(M.parse(lines))
    return parsed.select(
        F.col("row_id").cast("long").alias("doc_id"),
        F.array_join(C.hashtags(), "|").alias("hashtags"),
        F.array_join(C.user_ids(), "|").alias("user_ids"),
        F.array_join(C.screen_names(), "|").alias("screen_names"),
    )


@query
def classify_messages(spark, sf):
    lines = D.event_lines(D.table(spark, sf, "events"))
    parsed = M.parse(M.drop_keep_alives(lines))
    classes = M.classify(M.well_formed(parsed)).select("message_class", M.limit_value("track").alias("limit_value"))
    none = F.lit(None).cast("long").alias("limit_value")
    others = M.keep_alives(lines).select(F.lit("keep-alive").alias("message_class"), none).unionByName(
        M.malformed(parsed).select(F.lit("malformed").alias("message_class"), none)
    )
    return classes.unionByName(others).groupBy("message_class").agg(
        F.count("*").alias("n"), F.sum("limit_value").alias("sum_limit")
    )


@query
def parse_json(spark, sf):
    lines = D.event_lines(D.table(spark, sf, "events"))
    parsed = M.classify(M.well_formed(M.parse(M.drop_keep_alives(lines)))).where("message_class = 'tweet'")
    return parsed.select(
        "event_id", F.col("message.id_str").alias("id_str"), F.col("message.user.id_str").alias("user_id"), "message.text"
    )


@query
def created_at_iso(spark, sf):
    events = D.table(spark, sf, "events").select("event_id", D.feed_time(F.col("ts")).alias("created_at"))
    return events.select("event_id", V.created_at_iso(F.col("created_at")).alias("created_at_iso"))


@query
def event_time(spark, sf):
    lines = D.event_lines(D.table(spark, sf, "events"))
    parsed = M.classify(M.well_formed(M.parse(M.drop_keep_alives(lines)))).where("message_class = 'tweet'")
    return M.with_event_time(parsed).select("event_id", V.micros(F.col("event_ts")).alias("at_us"))


def _enriched_columns(enriched: DataFrame) -> DataFrame:
    added = lambda path: F.get_json_object("output", f"$.collector.{path}")
    return enriched.select(
        F.get_json_object("output", "$.id_str").cast("long").alias("doc_id"),
        added("created_at_iso").alias("created_at_iso"),
        F.json_array_length(added("collection_rules")).cast("long").alias("n_rules"),
        added("collection_rules[0].rule_value").alias("first_value"),
        added("rule_tag").alias("rule_tag"),
    )


@query
def enrich_messages(spark, sf):
    lines = D.document_lines(D.documents(spark, sf))
    rules = D.benchmark_rules(D.table(spark, sf, "benchmark"))
    return _enriched_columns(enrich(lines, rules, "track", 1))


@query
def enrich_stream(spark, sf):
    rules = D.benchmark_rules(D.table(spark, sf, "benchmark"))
    lines = D.document_lines(D.stream_table(spark, sf, "documents"))
    path = work_dir(spark, "enrich-stream")

    def sink(batch: DataFrame, batch_id: int) -> None:
        K.write_json_lines(batch, f"{path}/out/batch={batch_id}", "overwrite")

    SC.start_collector(lines, lambda: rules, "track", 1, sink, f"{path}/checkpoint", available_now=True).awaitTermination()
    return _enriched_columns(spark.read.text(f"{path}/out/*").withColumnRenamed("value", "output"))


# --- rule tables ---------------------------------------------------------------------------------------------------


@query
def rule_normalize(spark, sf):
    return R.normalize(D.part_rules(D.table(spark, sf, "part"))).select("rule_id", "norm_value")


@query
def rule_phrases(spark, sf):
    rules = D.part_rules(D.table(spark, sf, "part")).withColumn("rule_type", F.lit("track"))
    return R.phrases(R.shard(R.constrain(rules, "track"), "rule_id"), "instance_id")


def _two_sets(spark, sf):
    part = D.table(spark, sf, "part")
    columns = [F.col("p_partkey").alias("rule_id"), F.col("p_brand").alias("tag")]
    left = part.where("p_size <= 30").select(*columns, F.col("p_name").alias("value"))
    right = part.where("p_size >= 20").select(*columns, F.upper("p_name").alias("value"))
    return left, right


@query
def rule_append(spark, sf):
    left, right = _two_sets(spark, sf)
    new = right.withColumn("value", F.when(F.col("tag") != "Brand#1", F.col("value")))
    twice = new.unionByName(new.withColumn("value", F.concat("value", F.lit("!"))))
    base = left.withColumn("seq", F.lit(0))
    appended = R.append(base, twice.withColumn("seq", F.length("value")), "seq")
    return appended.select("rule_id", "tag", "value")


@query
def rule_union(spark, sf):
    return R.union(*_two_sets(spark, sf))


@query
def rule_difference(spark, sf):
    return R.difference(*_two_sets(spark, sf))


@query
def rule_remove(spark, sf):
    left, right = _two_sets(spark, sf)
    return R.remove(right, left)


@query
def rule_intersection(spark, sf):
    return R.intersection(*_two_sets(spark, sf))


@query
def rule_member(spark, sf):
    return R.membership(*_two_sets(spark, sf))


@query
def rule_equal(spark, sf):
    left, right = _two_sets(spark, sf)
    both = R.union(left, right)
    same = R.same_ids(both, R.union(right, left)).select(F.lit("union both ways").alias("pair"), "is_equal")
    return same.unionByName(R.same_ids(left, right).select(F.lit("left and right").alias("pair"), "is_equal"))


@query
def rule_len(spark, sf):
    return R.summary(D.part_rules(D.table(spark, sf, "part")))


@query
def rule_dedup_last(spark, sf):
    rules = D.table(spark, sf, "part").select(
        F.col("p_name").alias("value"), F.col("p_brand").alias("tag"), F.col("p_partkey").alias("seq")
    )
    return R.dedup_last(rules, "seq")


def _constraint_input(spark, sf):
    track = D.table(spark, sf, "documents").select(F.col("doc_id").alias("rule_id"), F.col("text").alias("value"))
    follow = D.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("rule_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).otherwise(F.col("c_custkey").cast("string")).alias("value"),
    )
    return {"track": track, "follow": follow}


@query
def rule_constraints(spark, sf):
    parts = [
        R.constrain(rules, kind).select(F.lit(kind).alias("rule_type"), "rule_id")
        for kind, rules in _constraint_input(spark, sf).items()
    ]
    return parts[0].unionByName(parts[1])


@query
def rule_rejects(spark, sf):
    parts = [
        R.rejected(rules, kind).select(F.lit(kind).alias("rule_type"), "rule_id")
        for kind, rules in _constraint_input(spark, sf).items()
    ]
    return parts[0].unionByName(parts[1])


@query
def rule_shard(spark, sf):
    sharded = R.shard(D.all_rules(spark, sf), "rule_id")
    return sharded.select("rule_type", "rule_id", F.col("idx").cast("long").alias("idx"), "instance_id")


@query
def rule_table_round_trip(spark, sf):
    """Every rule of every type, from the instance's folder it was written to."""
    path = work_dir(spark, "sharded-rules")
    K.write_sharded_rules(D.all_rules(spark, sf), path, "rule_id")
    table = spark.read.parquet(path)
    return table.select("rule_type", "rule_id", F.col("idx").cast("long").alias("idx"), F.col("instance_id").cast("long").alias("instance_id"))


@query
def rule_shard_text(spark, sf):
    """Sharded by a text id."""
    rules = D.all_rules(spark, sf).withColumn("rule_id", F.concat(F.lit("r"), "rule_id"))
    sharded = R.shard(rules, "rule_id")
    return sharded.select("rule_type", "rule_id", F.col("idx").cast("long").alias("idx"), "instance_id")


@query
def rule_instances(spark, sf):
    return R.plan_instances(D.all_rules(spark, sf))


def _assigned_rules(spark, sf):
    """Rules by instance as they might have been written by hand, some instances over their cap."""
    customer, part, supplier = (D.table(spark, sf, n) for n in ("customer", "part", "supplier"))
    return (
        customer.select(F.lit("follow").alias("rule_type"), F.lit(0).alias("instance_id"), F.col("c_custkey").alias("rule_id"))
        .unionByName(part.select(F.lit("track").alias("rule_type"), F.lit(0).alias("instance_id"), F.col("p_partkey").alias("rule_id")))
        .unionByName(
            supplier.select(
                F.lit("locations").alias("rule_type"), F.col("s_nationkey").alias("instance_id"), F.col("s_suppkey").alias("rule_id")
            )
        )
    )


@query
def rule_cap(spark, sf):
    rules = _assigned_rules(spark, sf)
    kept = R.cap_per_instance(rules, SCAN_CAPS).withColumn("kept", F.lit(True))
    return kept.unionByName(R.over_cap(rules, SCAN_CAPS).withColumn("kept", F.lit(False)))


@query
def rule_count_gauge(spark, sf):
    return R.rule_count(_assigned_rules(spark, sf))


@query
def fix_follow(spark, sf):
    customer = D.table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("user "), "c_nationkey"))
        .otherwise(F.concat("c_name", F.lit(" or "), F.col("c_custkey") + 90000000))
        .alias("value"),
    )
    return R.fix_follow(customer)


def _url_values(spark, sf):
    host = F.regexp_extract("url", "https?://([^/]+)", 1)
    clause = F.concat(F.lit('url_contains: "'), host, F.lit('" url_contains:'), host)
    return D.table(spark, sf, "pages").select(
        "page_id", F.when(F.startswith("url", F.lit("https")), clause).otherwise(host).alias("value")
    )


@query
def fix_track(spark, sf):
    return R.fix_track(_url_values(spark, sf))


@query
def fix_locations(spark, sf):
    rules = D.table(spark, sf, "supplier").select(
        "s_suppkey", F.when(F.col("s_nationkey") > 2, D.supplier_box("[%d %d][ %d\t%d]")).otherwise("").alias("value")
    )
    return R.fix_locations(rules)


def _source_table(spark, sf):
    """A raw rule table as it might come from a database: type, tag, value, row number."""
    customer = D.table(spark, sf, "customer").select(
        F.lit("username").alias("type"), F.col("c_mktsegment").alias("tag"),
        F.concat(F.lit("id "), F.col("c_nationkey") + 7000000).alias("value"), F.col("c_custkey").alias("seq"),
    )
    part = D.table(spark, sf, "part").select(
        F.lit("keyword").alias("type"), F.col("p_brand").alias("tag"),
        F.translate("p_name", " ", ".").alias("value"), F.col("p_partkey").alias("seq"),
    )
    supplier = D.table(spark, sf, "supplier").select(
        F.lit("geo").alias("type"), F.col("s_name").alias("tag"),
        D.supplier_box("[%d %d %d %d]").alias("value"), F.col("s_suppkey").alias("seq"),
    )
    return customer.unionByName(part).unionByName(supplier)


@query
def rule_etl(spark, sf):
    table = _source_table(spark, sf)
    parts = [clean_rules(table, kind, "seq") for kind in ("follow", "track", "locations")]
    cleaned = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return R.shard(cleaned, "seq").select("rule_type", "value", "tag", F.col("idx").cast("long").alias("idx"), "instance_id")


def _vendor_values(spark, sf):
    text = F.concat(F.lit("(from:"), "c_custkey", F.lit(" OR from:"), "c_nationkey", F.lit(") lang:en from:x"))
    return D.table(spark, sf, "customer").select(text.alias("value"))


@query
def author_ids(spark, sf):
    return SR.author_ids(_vendor_values(spark, sf)).groupBy("id").agg(F.count("*").alias("n"))


@query
def vendor_ids(spark, sf):
    path = work_dir(spark, "vendor-rules")
    values = F.array(F.struct("value"), F.struct(F.concat(F.lit("lang:en "), "value").alias("value")))
    _vendor_values(spark, sf).select(values.alias("rules")).write.json(path)
    return SR.vendor_ids(spark, path, one_per_line=True)


# --- validation ----------------------------------------------------------------------------------------------------


def _document_messages(spark, sf):
    return D.documents(spark, sf).select(
        F.col("doc_id").alias("row_id"), D.document_time().alias("ts"), "text"
    )


def _keywords(spark, sf):
    return D.benchmark_words(D.table(spark, sf, "benchmark"), 3).select(F.col("word").alias("keyword")).distinct()


@query
def recent_by_keyword(spark, sf):
    found = Y.recent_by_keyword(_document_messages(spark, sf), _keywords(spark, sf), 100)
    return found.select("keyword", F.col("row_id").alias("doc_id"), F.col("rank").cast("long").alias("rank"))


@query
def recent_by_keyword_joins(spark, sf):
    found = Y.recent_by_keyword(_document_messages(spark, sf), _keywords(spark, sf), 100, form="joins")
    return found.select("keyword", F.col("row_id").alias("doc_id"), F.col("rank").cast("long").alias("rank"))


@query
def tweets_per_second(spark, sf):
    keywords = _keywords(spark, sf)
    return Y.volume(Y.recent_by_keyword(_document_messages(spark, sf), keywords, 100), keywords)


@query
def track_length(spark, sf):
    documents = D.table(spark, sf, "documents")
    return documents.select("doc_id", Y.is_too_long(F.col("text")).alias("too_long"))


def _event_users(spark, sf):
    return D.table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("userid"),
        F.concat("event_type", F.lit("_"), "user_id").alias("screen_name"),
        "ts",
    )


@query
def user_lookup(spark, sf):
    users = Y.user_dimension(_event_users(spark, sf))
    names = D.table(spark, sf, "customer").select(F.concat(F.lit("@CLICK_"), "c_custkey").alias("value"))
    return Y.userids_for(names, users)


@query
def screen_name_lookup(spark, sf):
    users = Y.user_dimension(_event_users(spark, sf))
    ids = D.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("userid"))
    return Y.screen_names_for(ids, users)


def _geo_legacy_rules(spark, sf):
    nation = F.col("s_nationkey")
    value = (
        F.when(nation < 3, D.supplier_box("%d,%d,%d"))
        .when(nation < 6, F.concat(D.supplier_box(), F.lit(",7")))
        .when(nation < 9, D.supplier_box("%d,north,%d,%d"))
        .when(nation < 14, D.supplier_box("%d,1%d,%d,%d"))
        .otherwise(D.supplier_box())
    )
    return D.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("rule_id"), value.alias("value"))


@query
def validate_geo_legacy(spark, sf):
    checked = Y.validate_geo(_geo_legacy_rules(spark, sf))
    return checked.select("rule_id", "status", "error", F.col("code").cast("long").alias("code"), "geo_type")


def _geojson_rules(spark, sf):
    """Polygons of every supplier: open, closed, out of range, too short, of the wrong type."""
    nation, lon = F.col("s_nationkey"), F.col("s_nationkey").cast("string")
    ring = (
        F.when(nation < 5, F.concat(F.lit("[["), lon, F.lit(",1.5],["), lon, F.lit(",1.5],[30,2],[31,4]]")))
        .when(nation < 10, F.concat(F.lit("[["), lon, F.lit(",1.5],[30,2],[31,4],["), lon, F.lit(",1.5]]")))
        .when(nation < 15, F.concat(F.lit("[["), lon, F.lit(",1],[30,-100.0],[31,4]]")))
        .otherwise(F.concat(F.lit("[["), lon, F.lit(",1],["), lon, F.lit(",1],[31,4]]")))
    )
    kind = F.when(nation == 20, "Polyline").otherwise("Polygon")
    feature = F.concat(
        F.lit('{"type":"Feature","geometry":{"type":"'), kind, F.lit('","coordinates":['), ring, F.lit("]}}")
    )
    return D.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("rule_id"), F.lit("").alias("value"), feature.alias("complex_value")
    )


@query
def validate_geojson(spark, sf):
    checked = Y.repaired_polygons(Y.validate_geo(_geojson_rules(spark, sf)))
    return checked.select(
        "rule_id",
        "status",
        "error",
        F.col("code").cast("long").alias("code"),
        "geo_type",
        F.size(F.get("rings", 0)).cast("long").alias("n_positions"),
    )


@query
def validate_rules(spark, sf):
    words = D.benchmark_words(D.table(spark, sf, "benchmark"), 1).select(F.lit("keyword").alias("type"), F.col("word").alias("value"))
    texts = D.table(spark, sf, "conversations").select(F.lit("hashtag").alias("type"), F.col("text").alias("value"))
    texts = texts.where(F.octet_length("value") > 60)
    boxes = _geo_legacy_rules(spark, sf).select(F.lit("geo").alias("type"), "value")
    names = D.table(spark, sf, "customer").select(F.lit("username").alias("type"), F.concat(F.lit("@click_"), "c_custkey").alias("value"))
    others = D.table(spark, sf, "nation").select(F.lit("place").alias("type"), F.col("n_name").alias("value"))
    rules = words.unionByName(texts).unionByName(boxes).unionByName(names).unionByName(others)
    users = Y.user_dimension(_event_users(spark, sf))
    checked = Y.validate(rules, users, _document_messages(spark, sf))
    return checked.withColumn("code", F.col("code").cast("long"))


# --- rates ---------------------------------------------------------------------------------------------------------


@query
def rolling_rule_count(spark, sf):
    increments = D.table(spark, sf, "events").select(F.col("event_type").alias("rule_id"), "ts")
    return A.rolling_counts(increments).select("rule_id", V.micros(F.col("ts")).alias("at_us"), "n")


@query
def rolling_count_by_match(spark, sf):
    """Documents matched by keyword rules, counted per rule over the last hour of arrival time."""
    rules = D.benchmark_rules(D.table(spark, sf, "benchmark"))
    pairs = X.match_long(_document_content(spark, sf), rules, "track")
    timed = pairs.withColumnRenamed("row_id", "doc_id").select("rule_id", D.document_time().alias("ts"))
    return A.rolling_counts(timed, window_seconds=3600).select("rule_id", V.micros(F.col("ts")).alias("at_us"), "n")


@query
def rule_counters_zero(spark, sf):
    rules = D.table(spark, sf, "customer").select(F.col("c_custkey").alias("rule_id"))
    counts = D.table(spark, sf, "events").groupBy(F.col("user_id").alias("rule_id")).agg(F.count("*").alias("n"))
    return A.zero_filled(rules, counts)


@query
def rule_counters_reset(spark, sf):
    """Counters kept per rules version (the day): only the newest version's count."""
    counts = D.table(spark, sf, "events").groupBy(
        F.col("event_type").alias("rule_id"), F.date_format("ts", "yyyy-MM-dd").alias("rules_version")
    ).agg(F.count("*").alias("n"))
    return A.current_version(counts, counts)


def _limits(spark, sf):
    lines = D.event_lines(D.table(spark, sf, "events"))
    parsed = M.classify(M.well_formed(M.parse(M.drop_keep_alives(lines)))).where("message_class = 'limit'")
    return parsed.select(F.col("ts").cast("timestamp").alias("ts"), M.limit_value("track").alias("limit_value"))


@query
def limit_counter(spark, sf):
    return A.limit_windows(_limits(spark, sf)).withColumn("window_start", F.unix_seconds("window_start"))


@query
def limit_counter_sliding(spark, sf):
    windows = A.limit_windows(_limits(spark, sf), "2 hours", "30 minutes")
    return windows.withColumn("window_start", F.unix_seconds("window_start"))


@query
def rate_stats(spark, sf):
    series = D.table(spark, sf, "events").select(F.col("event_type").alias("rule_value"), "ts")
    keys = D.table(spark, sf, "nation").select(F.col("n_name").alias("rule_value")).unionByName(series.select("rule_value"))
    return A.rate_stats(series, REPORT_TIME_US, 20 * DAY_US, keys)


BUCKET = L.Bucket(rate=2, capacity=5)


@query
def rate_report(spark, sf):
    series = L.rate_limit(D.dense_events(D.table(spark, sf, "events")), BUCKET)
    now = REPORT_TIME_US // 10000
    return A.rate_report(series, now, 120 * V.MICROS)


@query
def metrics_counts(spark, sf):
    named = F.create_map(
        *[F.lit(x) for x in ("click", "tweet_process_success", "error", "kafka_error", "view", "tweet_to_kafka_success")]
    )
    events = D.table(spark, sf, "events").select(
        "ts", F.element_at(named, F.col("event_type")).alias("event"), F.col("user_id").alias("instance_id")
    )
    names = A.metric_names("collector", {"kafka_error": "collector.src.kafka.error"})
    counted = A.counters(events, names, "instance_id")
    return counted.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


@query
def log_metrics(spark, sf):
    """Metrics read from log events: keep-alives and limit notices of the event lines."""
    named = F.create_map(*[F.lit(x) for x in ("view", "Stream keep-alive received", "error", "limit_message_received")])
    events = D.table(spark, sf, "events").select("ts", F.element_at(named, F.col("event_type")).alias("event"))
    counted = A.counters(events, A.log_metric_names(), window="1 hour")
    return counted.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH"))


@query
def metrics_gauges(spark, sf):
    named = F.when(F.col("event_type") == "error", "limit_message_count").otherwise(F.col("event_type"))
    events = D.table(spark, sf, "events").select("ts", named.alias("event"), "value", F.col("user_id").alias("instance_id"))
    more = {kind: f"collector.src.{kind}" for kind in ("click", "view", "signup", "purchase")}
    return A.gauges(events, A.metric_names("collector", more), "instance_id")


def _matched_documents(spark, sf):
    lines = D.document_lines(D.documents(spark, sf))
    rules = D.benchmark_rules(D.table(spark, sf, "benchmark"))
    return enrich(lines, rules, "track", 1)


@query
def limit_keys(spark, sf):
    keys = A.limit_keys(_matched_documents(spark, sf), "row_id")
    return keys.select(F.col("row_id").cast("long").alias("doc_id"), "rule_value")


# --- rate limiter --------------------------------------------------------------------------------------------------


@query
def rate_limit(spark, sf):
    decided = L.rate_limit(D.dense_events(D.table(spark, sf, "events")), BUCKET)
    return decided.select("row_id", "rule_value", "admitted")


@query
def rate_limit_messages(spark, sf):
    """Matched documents, a minute of them per second, that pass the limiter."""
    enriched = _matched_documents(spark, sf).select("row_id", "ingest_ts", "collection_rules")
    keyed = A.limit_keys(enriched, "row_id", "ingest_ts").select(
        F.col("row_id").cast("long").alias("row_id"),
        "rule_value",
        F.timestamp_micros(V.floor_div(V.micros(F.col("ingest_ts")), 100)).alias("ts"),
    )
    documents = D.table(spark, sf, "documents").select(F.col("doc_id").alias("row_id"))
    return L.admit(documents, L.rate_limit(keyed, L.Bucket(rate=1, capacity=2))).select(F.col("row_id").alias("doc_id"))


@query
def rate_limit_stream(spark, sf):
    """As the batch limiter, over the micro-batches of a stream."""
    dense = D.dense_events(D.stream_table(spark, sf, "events"))
    keyed = dense.select(F.lpad(F.col("row_id").cast("string"), 20, "0").alias("row_id"), F.col("rule_value").cast("string").alias("rule_value"), "ts")
    path = work_dir(spark, "rate-limit-stream")
    store = SL.BucketStore(spark, f"{path}/buckets")

    def on_batch(batch, batch_id):
        decided = SL.limit_batch(batch, batch_id, BUCKET, store, None)
        decided.select(F.col("row_id").cast("long").alias("row_id"), "rule_value", "admitted").write.mode("append").parquet(f"{path}/out")

    writer = keyed.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{path}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    kind = D.dense_events(D.table(spark, sf, "events")).schema["rule_value"].dataType
    return spark.read.parquet(f"{path}/out").withColumn("rule_value", F.col("rule_value").cast(kind))


@query
def state_expiry(spark, sf):
    series = D.table(spark, sf, "events").select(F.col("user_id").alias("rule_value"), "event_id", "ts")
    kept = L.unexpired(series, REPORT_TIME_US, 10 * DAY_US)
    return kept.select("rule_value", "event_id")


@query
def state_expiry_keys(spark, sf):
    series = D.table(spark, sf, "events").select(F.col("user_id").alias("rule_value"), "ts")
    return L.expired_keys(series, REPORT_TIME_US, DAY_US)


# --- change notices, logs ------------------------------------------------------------------------------------------


def _notices(spark, sf):
    kind = F.when(F.col("event_type") == "click", "track").when(F.col("event_type") == "view", "follow").otherwise("other")
    return D.table(spark, sf, "events").select("event_id", "ts", F.concat_ws(":", kind, "user_id").alias("data"))


@query
def notify_filter(spark, sf):
    return SC.notices_for(_notices(spark, sf), "track", 3).select("event_id", "data")


@query
def notify_versions(spark, sf):
    latest = SC.latest_change(_notices(spark, sf))
    return latest.withColumn("rules_version", V.micros(F.col("rules_version")))


@query
def log_daily(spark, sf):
    path = work_dir(spark, "logs")
    tags = F.when(F.col("event_type") == "error", F.array(F.lit("collector"), F.lit("alert"))).otherwise(F.array("event_type"))
    events = D.table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), tags.alias("tags"), "value")
    events.write.json(f"{path}/in")
    logs = SM.read_logs(spark, f"{path}/in", "ts STRING, tags ARRAY<STRING>, value DOUBLE", "collector")
    K.write_daily(logs, f"{path}/out")
    daily = spark.read.schema("ts STRING, tags ARRAY<STRING>, value DOUBLE, day STRING").parquet(f"{path}/out")
    return daily.groupBy("day").agg(F.count("*").alias("n"), F.max("value").alias("max_value"))


@query
def rolling_counts_stream(spark, sf):
    """Sliding counts of a stream; windows still open at its end are not there yet."""
    increments = D.stream_table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("rule_id")
    )
    path = work_dir(spark, "rolling-stream")
    counted = CT.rolling_rule_counts(increments, "2 hours", "30 minutes")
    counted = counted.select(F.unix_seconds("window_start").alias("window_start"), "rule_id", "n")
    writer = counted.writeStream.format("parquet").option("path", f"{path}/out").outputMode("append")
    writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(counted.schema).parquet(f"{path}/out")
