"""Where messages come from: lines of text files or of a Kafka topic, and JSON logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from sievestream.functions import values as V


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, row_id, ingest_ts) of line-delimited messages; the order of the ids is that of the lines (see `number_lines`)."""
    return number_lines(_arrived(spark.read.text(path)))


def stream_lines(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """(value, split_id, ingest_ts) from a growing folder, its older files first; `number_lines` gives a micro-batch its ids (a collector does so itself)."""
    return _arrived(spark.readStream.option("maxFilesPerTrigger", max_files).text(path))


def _arrived(lines: DataFrame) -> DataFrame:
    file = F.col("_metadata")
    parts = V.micros(file["file_modification_time"]), file["file_block_start"]
    written, start = (F.lpad(number.cast("string"), 20, "0") for number in parts)
    return lines.select("value", F.concat_ws("/", written, file["file_path"], start).alias("split_id"), F.current_timestamp().alias("ingest_ts"))


def number_lines(lines: DataFrame) -> DataFrame:
    """`row_id` for the lines of files: a text that sorts as they arrived, by time and path of the file, start of the split, place within it.

    A split is read by one task from its beginning, so the number that the task gives a line grows with its place. How files are cut into splits
    and splits put together may change from one reading to the next, and with it the last numbers, but never the order. No line is moved for it. Lines that have an
    id of their own stay as they are.
    """
    if "split_id" not in lines.columns:
        return lines
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    row_id = F.concat_ws("/", "split_id", F.lpad(place.cast("string"), 10, "0"))
    return lines.select("value", row_id.alias("row_id"), "ingest_ts")


def stream_kafka(spark: SparkSession, servers: str, topic: str, max_offsets: int = 1_000_000) -> DataFrame:
    """The same columns from a topic; needs the Kafka connector on the class path."""
    records = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
    )
    return records.select(
        F.col("value").cast("string").alias("value"),
        F.concat_ws("/", "topic", F.lpad(F.col("partition").cast("string"), 10, "0"), F.lpad(F.col("offset").cast("string"), 20, "0")).alias("row_id"),
        F.col("timestamp").alias("ingest_ts"),
    )


def tagged_logs(logs: DataFrame, tag: str) -> DataFrame:
    return logs.where(F.array_contains("tags", tag))


def read_logs(spark: SparkSession, path: str, schema: StructType | str, tag: str) -> DataFrame:
    return tagged_logs(spark.read.schema(schema).json(path), tag)


def stream_logs(spark: SparkSession, path: str, schema: StructType | str, tag: str) -> DataFrame:
    return tagged_logs(spark.readStream.schema(schema).json(path), tag)
