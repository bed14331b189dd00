"""Where rules come from: JSON lines, SQL tables, nested vendor files, a sharded rule table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievestream.functions import values as V
from sievestream.operators.rules import cap_per_instance
from sievestream.schemas import RULE_DDL, SOURCE_RULE_TYPES, check_collector_type

SHARDED_RULE_DDL = RULE_DDL + ", idx BIGINT, instance_id INT"


def read_json_rules(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One rule per line; numbers become text, as rule ids are text everywhere."""
    return spark.read.schema(RULE_DDL).json(path)


def sql_rules(table: DataFrame, collector_type: str) -> DataFrame:
    """The (tag, value) rules of a collector type; on a JDBC or parquet table the filter goes to the source."""
    if collector_type not in SOURCE_RULE_TYPES:
        raise ValueError(f"{collector_type} is not a valid collector type")
    return table.where(F.col("type") == SOURCE_RULE_TYPES[collector_type])


def read_jdbc_rules(spark: SparkSession, collector_type: str, table: str = "rules", **options: str) -> DataFrame:
    return sql_rules(spark.read.format("jdbc").options(dbtable=table, **options).load(), collector_type)


def vendor_ids(spark: SparkSession, paths: str | Sequence[str], one_per_line: bool = False) -> DataFrame:
    """Distinct author ids named in the `rules` of vendor rule files (one object per file, or per line)."""
    files = spark.read.schema("rules ARRAY<STRUCT<value: STRING>>").json(paths, multiLine=not one_per_line)
    values = files.select(F.explode("rules").alias("rule")).select(F.col("rule.value").alias("value"))
    return author_ids(values).distinct()


def author_ids(values: DataFrame, value: str = "value") -> DataFrame:
    """Every author id named in a column of rule texts, repeats included."""
    return values.select(F.explode(V.author_ids(F.col(value))).alias("id"))


def read_sharded_rules(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARDED_RULE_DDL).parquet(path)


def instance_rules(
    table: DataFrame, collector_type: str, instance_id: int, order: str = "rule_id", cap: int | None = None
) -> DataFrame:
    """The rules of one collector instance: all of them, or the first `cap` (`over_cap` of operators.rules has the rest).

    On a table written by `write_sharded_rules` only the instance's folder is read.
    """
    check_collector_type(collector_type)
    own = table.where((F.col("rule_type") == collector_type) & (F.col("instance_id") == instance_id))
    return own if cap is None else cap_per_instance(own, {collector_type: cap}, order)
