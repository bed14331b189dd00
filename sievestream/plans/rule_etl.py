"""From a raw rule table to the sharded one collectors read."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sievestream.operators import rules as R
from sievestream.sources.rules import sql_rules


def clean_rules(table: DataFrame, collector_type: str, order: str) -> DataFrame:
    """Select by type, one rule per value, repair values; `rule_type` is set."""
    rules = R.dedup_last(sql_rules(table, collector_type), order)
    return R.FIXES[collector_type](rules).withColumn("rule_type", F.lit(collector_type))


def clean_and_shard(table: DataFrame, collector_type: str, order: str) -> DataFrame:
    return R.shard(clean_rules(table, collector_type, order), order)
