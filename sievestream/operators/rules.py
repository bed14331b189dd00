"""Operators on rule tables: cleaning, set algebra by `rule_id`, de-duplication, sharding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sievestream.functions import values as V
from sievestream.operators.distribute import number_rows
from sievestream.schemas import MAX_TRACK_LENGTH, SCAN_CAPS, SHARD_CAPS, check_collector_type


def _orig_type(rules: DataFrame) -> Column:
    return F.col("orig_type") if "orig_type" in rules.columns else F.lit(None).cast("string")


def normalize(rules: DataFrame) -> DataFrame:
    return rules.withColumn("norm_value", V.normalized_value(F.col("value"), _orig_type(rules)))


# --- set algebra ---------------------------------------------------------------------------------------------------


def complete(rules: DataFrame) -> DataFrame:
    """Rules that have an id and a value; `incomplete` gives the rest."""
    return rules.where(F.col("rule_id").isNotNull() & F.col("value").isNotNull())


def incomplete(rules: DataFrame) -> DataFrame:
    return rules.where(F.col("rule_id").isNull() | F.col("value").isNull())


def append(rules: DataFrame, new: DataFrame, order: str, strict: bool = False) -> DataFrame:
    """Upsert by `rule_id`; of several new rows with one id the last by `order` stays.

    Incomplete rows are left out, or fail the query when `strict`.
    """
    columns = rules.columns
    if strict:
        fail = F.raise_error(F.lit("rule without id or value"))
        checked = {c: F.coalesce(c, fail.cast(rules.schema[c].dataType)) for c in ("rule_id", "value")}
        new = new.withColumns(checked)
    else:
        new = complete(new)
    both = rules.withColumn("_new", F.lit(0)).unionByName(new.select(*columns).withColumn("_new", F.lit(1)))
    row = F.struct(*columns)
    return both.groupBy("rule_id").agg(F.max_by(row, F.struct("_new", order)).alias("_row")).select("_row.*")


def remove(rules: DataFrame, others: DataFrame) -> DataFrame:
    return rules.join(others.select("rule_id"), "rule_id", "left_anti").select(*rules.columns)


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    return remove(left, right)


def union(left: DataFrame, right: DataFrame) -> DataFrame:
    """On a common id the right-hand rule stays."""
    return remove(left, right).unionByName(right)


def intersection(left: DataFrame, right: DataFrame) -> DataFrame:
    """The right-hand rules whose id is on both sides."""
    return right.join(left.select("rule_id"), "rule_id", "left_semi").select(*right.columns)


def membership(items: DataFrame, rules: DataFrame) -> DataFrame:
    """`items` with a flag that tells whether a rule of that id exists; a null id is no member."""
    known = rules.select("rule_id").distinct().withColumn("_known", F.lit(True))
    joined = items.join(known, "rule_id", "left")
    return joined.select(*items.columns, F.coalesce("_known", F.lit(False)).alias("is_member"))


def summary(rules: DataFrame) -> DataFrame:
    """Number of distinct ids and of distinct normalized values."""
    return normalize(rules).agg(
        F.count_distinct("rule_id").alias("n_rules"), F.count_distinct("norm_value").alias("n_values")
    )


def same_ids(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: do both sides hold the same rule ids?"""
    sides = left.select("rule_id", F.lit(1).alias("side")).unionByName(right.select("rule_id", F.lit(2).alias("side")))
    per_id = sides.groupBy("rule_id").agg(F.min("side").alias("lo"), F.max("side").alias("hi"))
    return per_id.agg((F.count_if(F.col("lo") == F.col("hi")) == 0).alias("is_equal"))


# --- cleaning ------------------------------------------------------------------------------------------------------


def dedup_last(rules: DataFrame, order: str) -> DataFrame:
    """One rule per exact value: the tag of its last row, in the place of its first."""
    return rules.groupBy("value").agg(F.max_by("tag", order).alias("tag"), F.min(order).alias(order))


def fix_follow(rules: DataFrame) -> DataFrame:
    return rules.withColumn("value", V.follow_id(F.col("value"))).where(F.col("value") != "")


def fix_track(rules: DataFrame) -> DataFrame:
    return rules.withColumn("value", V.track_phrase(F.col("value")))


def fix_locations(rules: DataFrame) -> DataFrame:
    return rules.where(F.col("value") != "").withColumn("value", V.location_box(F.col("value")))


FIXES = {"follow": fix_follow, "track": fix_track, "locations": fix_locations}


def _acceptable(collector_type: str) -> Column:
    check_collector_type(collector_type)
    if collector_type == "track":
        return F.char_length("value") <= MAX_TRACK_LENGTH
    if collector_type == "follow":
        return V.all_digits(F.col("value"))
    return F.lit(True)


def constrain(rules: DataFrame, collector_type: str) -> DataFrame:
    """Rules the collector type can use: short enough phrases, numeric ids, any box."""
    return rules.where(F.coalesce(_acceptable(collector_type), F.lit(False)))


def rejected(rules: DataFrame, collector_type: str) -> DataFrame:
    return rules.where(~F.coalesce(_acceptable(collector_type), F.lit(False)))


# --- per-instance views --------------------------------------------------------------------------------------------


def phrases(rules: DataFrame, *by: str) -> DataFrame:
    """The distinct normalized values as one comma-separated filter phrase for each instance.

    `by` names the instance columns; sharding bounds how many values an instance has.
    """
    distinct = normalize(rules).select(*by, "norm_value").where("norm_value IS NOT NULL").distinct()
    return distinct.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list("norm_value")), ",").alias("phrases"))


def _cap(caps: dict[str, int]) -> Column:
    known = F.create_map(*[F.lit(x) for pair in caps.items() for x in pair])
    cap = F.element_at(known, F.col("rule_type"))
    unknown = F.raise_error(F.concat(F.lit("unknown collector type: "), F.coalesce("rule_type", F.lit("NULL"))))
    return F.when(cap.isNotNull(), cap).otherwise(unknown.cast("int"))


def shard(rules: DataFrame, order: str, caps: dict[str, int] = SHARD_CAPS) -> DataFrame:
    """Position `idx` within the collector type, and the instance that takes the rule."""
    numbered = number_rows(rules, ["rule_type"], order)
    return numbered.withColumn("instance_id", F.floor(F.col("idx") / _cap(caps)).cast("int"))


def plan_instances(rules: DataFrame, caps: dict[str, int] = SHARD_CAPS) -> DataFrame:
    counts = rules.groupBy("rule_type").agg(F.count("*").alias("n_rules"))
    return counts.withColumn("n_instances", F.ceil(F.col("n_rules") / _cap(caps)).cast("long"))


def _place_in_instance(rules: DataFrame, caps: dict[str, int], order: str) -> DataFrame:
    numbered = number_rows(rules, ["rule_type", "instance_id"], order, "_place")
    return numbered.withColumn("_kept", F.col("_place") < _cap(caps))


def cap_per_instance(rules: DataFrame, caps: dict[str, int], order: str = "rule_id") -> DataFrame:
    """The first rules of each instance, up to `caps` of its type (an unknown type is an error); `over_cap` has the others."""
    return _place_in_instance(rules, caps, order).where("_kept").select(*rules.columns)


def over_cap(rules: DataFrame, caps: dict[str, int], order: str = "rule_id") -> DataFrame:
    """The rules that `cap_per_instance` leaves out."""
    return _place_in_instance(rules, caps, order).where("NOT _kept").select(*rules.columns)


def fold_locations(rules: DataFrame, order: str) -> DataFrame:
    """All rules merged into one row: every column takes its last value that is present."""
    columns = [c for c in rules.columns if c != order]
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns]
    return rules.agg(*last, F.max_by("tag", order).alias("rule_tag"), F.max_by("value", order).alias("rule_value"))


def rule_count(rules: DataFrame) -> DataFrame:
    return rules.groupBy("rule_type", "instance_id").agg(F.count("*").alias("rule_count"))
