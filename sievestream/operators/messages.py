"""Operators on raw message lines: keep-alives, parsing, classes, metadata, output text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from sievestream.functions import values as V
from sievestream.schemas import DEFAULT_META, MESSAGE_DDL

_CORRUPT = "_corrupt"
_PARSE_OPTIONS = {"columnNameOfCorruptRecord": _CORRUPT, "allowSingleQuotes": "false"}


def drop_keep_alives(lines: DataFrame) -> DataFrame:
    return lines.where(F.length("value") > 0)


def keep_alives(lines: DataFrame) -> DataFrame:
    return lines.where(F.coalesce(F.length("value"), F.lit(0)) == 0)


def parse(lines: DataFrame) -> DataFrame:
    """Adds `message` (the fields operators use), `keys` (top-level names) and `is_malformed`.

    A line is malformed when it is not one JSON object. An object whose fields have unexpected types is kept, with
    those fields null.
    """
    # A generator, so that filters on its result do not parse the line a second time.
    parsed = lines.select(
        "*",
        F.inline(
            F.array(
                F.struct(
                    F.json_object_keys("value").alias("keys"),
                    F.from_json("value", f"{MESSAGE_DDL}, {_CORRUPT} STRING", _PARSE_OPTIONS).alias("message"),
                )
            )
        ),
    )
    not_object = F.col("keys").isNull() | ~F.endswith(F.rtrim("value"), F.lit("}"))
    not_json = F.col(f"message.{_CORRUPT}").isNotNull() & F.try_parse_json("value").isNull()
    return parsed.withColumn("is_malformed", not_object | not_json)


def well_formed(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("is_malformed")).drop("is_malformed")


def malformed(parsed: DataFrame) -> DataFrame:
    return parsed.where("is_malformed")


def classify(parsed: DataFrame) -> DataFrame:
    """`message_class`: limit notice, tweet (the id key is present, even if null) or other."""
    return parsed.withColumn(
        "message_class",
        F.when(F.col("message.limit").isNotNull(), "limit")
        .when(F.array_contains("keys", "id_str"), "tweet")
        .otherwise("other"),
    )


def limit_value(collector_type: str) -> Column:
    """The collector's own count in a limit notice."""
    return F.try_element_at(F.col("message.limit"), F.lit(collector_type))


def add_metadata(classified: DataFrame, instance_id: int, meta: str = DEFAULT_META) -> DataFrame:
    """What a tweet gets before matching: the instance id (unless metadata is there already) and the ISO time.

    `enrichment_error` marks tweets whose time can not be read; they leave the engine without rule information.
    """
    is_tweet = F.col("message_class") == "tweet"
    has_meta = F.array_contains("keys", meta)
    created = F.nullif(F.col("message.created_at"), F.lit(""))
    return (
        classified.withColumn("has_meta", has_meta)
        .withColumn("meta_id", F.when(is_tweet & ~F.col("has_meta"), F.lit(instance_id)))
        .withColumn("created_at_iso", F.when(is_tweet, V.created_at_iso(created)))
        .withColumn(
            "enrichment_error",
            F.when(is_tweet & created.isNotNull() & F.col("created_at_iso").isNull(), F.lit("created_at")),
        )
    )


def with_event_time(classified: DataFrame) -> DataFrame:
    """Adds `event_ts`, the time a tweet says it was written, for counting by event time instead of arrival."""
    return classified.withColumn("event_ts", V.created_at_timestamp(F.col("message.created_at")))


def observe_lines(parsed_all: DataFrame, observation: Observation | str) -> DataFrame:
    """Counts keep-alives, malformed lines and messages while they pass; apply to `parse` of all lines."""
    blank = F.coalesce(F.length("value"), F.lit(0)) == 0
    return parsed_all.observe(
        observation,
        F.count_if(blank).alias("keep_alives"),
        F.count_if(~blank & F.col("is_malformed")).alias("malformed"),
        F.count_if(~F.col("is_malformed")).alias("messages"),
    )


def output_json(value: Column, added: Column, has_meta: Column, meta: str = DEFAULT_META) -> Column:
    """The input line with the `added` struct under `meta`; every other field, known or not, is kept.

    Without earlier metadata the new field is written before the closing brace, so the line is not rebuilt.
    Otherwise the new fields go over the old ones.
    """
    body = F.rtrim(value)
    spliced = F.concat(
        F.substr(body, F.lit(1), F.length(body) - 1), F.lit(f',"{meta}":'), F.to_json(added), F.lit("}")
    )
    whole = F.try_parse_json(value).cast("map<string,variant>")
    old = F.try_variant_get(F.try_parse_json(value), f"$.{meta}", "map<string,variant>")
    new = F.try_parse_json(F.to_json(added)).cast("map<string,variant>")
    nothing = F.create_map().cast("map<string,variant>")
    kept_old = F.map_filter(F.coalesce(old, nothing), lambda k, v: ~F.map_contains_key(new, k))
    merged = F.map_concat(
        F.map_filter(whole, lambda k, v: k != meta),
        F.create_map(F.lit(meta), F.to_variant_object(F.map_concat(kept_old, new))),
    )
    return F.when(has_meta, F.to_json(F.to_variant_object(merged))).otherwise(spliced)
