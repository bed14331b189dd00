"""Validation of rule tables: phrase length and volume, user lookup, boxes and polygons."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window, functions as F

from sievestream.functions import geo as G
from sievestream.functions import values as V
from sievestream.operators.distribute import first_per_group
from sievestream.operators.matching import check_form, few_rows, keyword_pairs, substring_hits
from sievestream.schemas import MAX_TRACK_LENGTH
from sievestream.session import cut_lineage

TOO_FAST_TO_MEASURE = 10000.0
# Fixed value: the error text of a track phrase that is too long.
TOO_LONG = "The byte length of the track phrase is over 60."


# --- user lookup ---------------------------------------------------------------------------------------------------


def user_dimension(messages: DataFrame, ts: str = "ts") -> DataFrame:
    """(userid, screen_name): the newest name of every author; `messages` is (userid, screen_name, ts)."""
    named = messages.where("userid IS NOT NULL AND screen_name IS NOT NULL")
    return named.groupBy("userid").agg(F.max_by("screen_name", F.struct(ts, "screen_name")).alias("screen_name"))


def screen_names_for(ids: DataFrame, users: DataFrame) -> DataFrame:
    found = ids.join(users.select("userid", "screen_name"), "userid", "left")
    return found.select(*ids.columns, "screen_name", _status(F.col("screen_name").isNotNull()).alias("status"))


def userids_for(names: DataFrame, users: DataFrame, name: str = "value") -> DataFrame:
    """`names` with `userid`; one leading '@' is ignored, and so is case. Of equal names the highest id is taken."""
    by_name = users.groupBy(F.lower("screen_name").alias("_name")).agg(F.max("userid").alias("userid"))
    asked = names.withColumn("_name", F.lower(F.regexp_replace(name, "^@", "")))
    found = asked.join(by_name, "_name", "left")
    return found.select(*names.columns, "userid", _status(F.col("userid").isNotNull()).alias("status"))


def _status(ok: Column) -> Column:
    return F.when(ok, F.lit("ok")).otherwise(F.lit("error"))


# --- keyword search and volume -------------------------------------------------------------------------------------


def recent_by_keyword(
    messages: DataFrame,
    keywords: DataFrame,
    n: int | None,
    form: str = "in_place",
) -> DataFrame:
    """(keyword, row_id, ts) of the newest `n` messages (None: all) that contain each keyword, whatever its case.

    `messages` is (row_id, ts, text), `keywords` is (keyword). Ranks are cut in the map tasks, so a keyword found
    everywhere does not move everything to one task.
    """
    asked = keywords.select("keyword").where("keyword IS NOT NULL").distinct()
    if check_form(form) == "in_place":
        few = few_rows(asked.withColumn("lowered", F.lower("keyword")), "keywords")
        words = [r["keyword"] for r in few]
        entries = [(i, (r["lowered"],)) for i, r in enumerate(few)]
        found = substring_hits(messages.sparkSession, F.lower("text"), entries)
        keyword_at = F.from_json(F.lit(json.dumps(words)), "ARRAY<STRING>")
        hits = messages.select("row_id", "ts", F.explode(found).alias("_i"))
        hits = hits.select("row_id", "ts", F.get(keyword_at, F.col("_i")).alias("keyword"))
    else:
        terms = asked.select(F.col("keyword").alias("rule_id"), F.explode(V.match_terms(F.col("keyword"))).alias("term"))
        texts = messages.select("row_id", "ts", F.lower("text").alias("keyword"))
        pairs = cut_lineage(keyword_pairs(texts.select("row_id", "keyword"), terms), "keyword-pairs")
        # Of one word the pair is proof enough; only phrases are looked for in the texts again, once for each message that may have one.
        is_phrase = F.contains("rule_id", F.lit(" "))
        words = messages.select("row_id", "ts").join(pairs.where(~is_phrase), "row_id")
        phrases = pairs.where(is_phrase).groupBy("row_id").agg(F.collect_set("rule_id").alias("_asked"))
        in_text = F.filter("_asked", lambda k: F.contains(F.col("keyword"), F.lower(k)))
        found = texts.join(phrases, "row_id").select("row_id", "ts", F.explode(in_text).alias("rule_id"))
        hits = words.unionByName(found).select("row_id", "ts", F.col("rule_id").alias("keyword"))
    if n is None:
        return hits.withColumn("rank", F.lit(None).cast("int")).select("keyword", "row_id", "ts", "rank")
    order = [F.col("ts").desc(), F.col("row_id").desc()]
    first = first_per_group(hits, ["keyword"], order, n, F.col("row_id"))
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("keyword").orderBy(*order)))
    return ranked.where(F.col("rank") <= n).select("keyword", "row_id", "ts", "rank")


def volume(recent: DataFrame, keywords: DataFrame | None = None) -> DataFrame:
    """(keyword, tweets_per_second) estimated from the newest messages of each keyword."""
    span = (F.max(V.micros(F.col("ts"))) - F.min(V.micros(F.col("ts")))) / F.lit(float(V.MICROS))
    seen = recent.groupBy("keyword").agg(F.count("*").alias("n"), span.alias("span"))
    if keywords is not None:
        seen = keywords.select("keyword").distinct().join(seen, "keyword", "left")
    rate = (
        F.when(F.coalesce("n", F.lit(0)) <= 1, F.lit(0.0))
        .when(F.col("span") == 0, F.lit(TOO_FAST_TO_MEASURE))
        .otherwise(F.col("n") / F.col("span"))
    )
    return seen.select("keyword", rate.alias("tweets_per_second"))


def is_too_long(value: Column) -> Column:
    return F.octet_length(value) > MAX_TRACK_LENGTH


# --- one result layout for all kinds -------------------------------------------------------------------------------

_RESULT = {
    "status": "string",
    "error": "string",
    "code": "int",
    "userid": "string",
    "tweets_per_second": "double",
    "geo_type": "string",
}


def _result(rules: DataFrame, columns: list[str], **values: Column) -> DataFrame:
    filled = [values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in _RESULT.items()]
    return rules.select(*columns, *filled)


def validate_follow(rules: DataFrame, users: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or rules.columns
    found = userids_for(rules.select(*columns), users)
    ok = F.col("userid").isNotNull()
    error = F.when(~ok, F.concat(F.lit("user not found: "), F.coalesce("value", F.lit("None"))))
    code = F.when(ok, 200).otherwise(500)
    return _result(found, columns, status=F.col("status"), error=error, code=code, userid=F.col("userid"))


def validate_track(rules: DataFrame, messages: DataFrame, columns: list[str] | None = None, n: int | None = 100, form: str = "in_place") -> DataFrame:
    columns = columns or rules.columns
    too_long = is_too_long(F.col("value"))
    keywords = rules.where(~too_long).select(F.col("value").alias("keyword")).distinct()
    rates = volume(recent_by_keyword(messages, keywords, n, form), keywords).withColumnRenamed("keyword", "value")
    rated = rules.select(*columns).join(rates, "value", "left")
    return _result(
        rated,
        columns,
        status=_status(~too_long),
        error=F.when(too_long, F.lit(TOO_LONG)),
        code=F.when(too_long, 400).otherwise(200),
        tweets_per_second=F.coalesce("tweets_per_second", F.lit(0.0)),
    )


def _complex_value(rules: DataFrame) -> Column:
    if "metadata" in rules.columns:
        return F.col("metadata.complex_value")
    return F.col("complex_value") if "complex_value" in rules.columns else F.lit(None).cast("string")


def validate_geo(rules: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A JSON object in the metadata is checked as polygon, anything else that is text as `lon1,lat1,lon2,lat2`."""
    columns = columns or rules.columns
    given = F.try_parse_json(_complex_value(rules))
    shape = F.schema_of_variant(given)
    is_object = F.startswith(shape, F.lit("OBJECT"))
    text = F.when(given.isNull(), F.col("value")).when(shape == "STRING", F.try_variant_get(given, "$", "string"))
    prepared = rules.withColumn("_text", text).withColumn("_is_object", F.coalesce(is_object, F.lit(False)))
    prepared = prepared.withColumn("_feature", F.from_json(F.when(F.col("_is_object"), _complex_value(rules)), G.GEOJSON_DDL))
    error = F.when(F.col("_is_object"), G.geojson_error(F.col("_feature"))).otherwise(G.legacy_box_error(F.col("_text")))
    prepared = prepared.withColumn("_error", error)
    checked = F.col("_is_object") | F.col("_text").isNotNull()
    ok = F.col("_error").isNull()
    return _result(
        prepared,
        columns,
        status=F.when(checked, _status(ok)),
        error=F.col("_error"),
        code=F.when(ok, 200).otherwise(500),
        geo_type=F.when(checked & ok, F.when(F.col("_is_object"), F.lit("geo_json")).otherwise(F.lit("legacy"))),
    )


def repaired_polygons(rules: DataFrame) -> DataFrame:
    """Adds `rings`: the polygon of each valid GeoJSON rule without repeats and closed."""
    feature = F.from_json(_complex_value(rules), G.GEOJSON_DDL)
    parsed = rules.withColumn("_feature", feature)
    rings = F.when(G.geojson_error(F.col("_feature")).isNull(), G.repaired_rings(F.col("_feature")))
    return parsed.withColumn("rings", rings).drop("_feature")


def validate(rules: DataFrame, users: DataFrame, messages: DataFrame) -> DataFrame:
    """All rules with status, error, code and what their kind yields; `rules` has `type` and `value`."""
    columns = rules.columns
    kind = F.coalesce("type", F.lit(""))
    known = ("username", "keyword", "hashtag", "geo")
    unknown = F.concat(F.lit("rule type not supported: "), F.coalesce("type", F.lit("None")))
    parts = [
        validate_follow(rules.where(kind == "username"), users),
        validate_track(rules.where(kind.isin("keyword", "hashtag")), messages),
        validate_geo(rules.where(kind == "geo")),
        _result(rules.where(~kind.isin(*known)), columns, status=F.lit("error"), error=unknown, code=F.lit(500)),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
