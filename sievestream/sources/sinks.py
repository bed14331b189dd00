"""Where results go: Kafka, JSON text, console, the sharded rule table, daily partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from sievestream.operators.rules import shard


def kafka_options(servers: str, topic: str) -> dict[str, str]:
    """Acknowledged by the leader, three retries."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "1", "kafka.retries": "3"}


def write_kafka(enriched: DataFrame, servers: str, topic: str) -> None:
    """Sends `output` as UTF-8 value without key."""
    enriched.select(F.col("output").alias("value")).write.format("kafka").options(**kafka_options(servers, topic)).save()


def write_json_lines(enriched: DataFrame, path: str, mode: str = "append") -> None:
    enriched.select(F.col("output").alias("value")).write.mode(mode).text(path)


def console(enriched: DataFrame) -> DataStreamWriter:
    return enriched.select("output").writeStream.format("console").option("truncate", "false")


def write_sharded_rules(rules: DataFrame, path: str, order: str, mode: str = "overwrite") -> None:
    """Writes the rules of each instance to a folder of their own."""
    sharded = shard(rules, order)
    sharded.write.mode(mode).partitionBy("rule_type", "instance_id").parquet(path)


def with_day(records: DataFrame, ts: str = "ts") -> DataFrame:
    return records.withColumn("day", F.date_format(ts, "yyyy.MM.dd"))


def write_daily(records: DataFrame, path: str, ts: str = "ts", mode: str = "append") -> None:
    with_day(records, ts).write.mode(mode).partitionBy("day").parquet(path)


def stream_daily(records: DataFrame, path: str, checkpoint: str, ts: str = "ts") -> DataStreamWriter:
    daily = with_day(records, ts).writeStream.partitionBy("day").format("parquet")
    return daily.option("path", path).option("checkpointLocation", checkpoint)
