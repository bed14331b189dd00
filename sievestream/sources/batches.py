"""Results of a stream as published batches: each counts once, however often it was written."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sievestream.files import delete, names, publish, read_text
from sievestream.sources.sinks import with_day


class BatchFolder:
    """`path/data` has a folder for each attempt at a batch, `path/published` a small file for each batch that names the one that counts.

    A batch is there once its file is; a batch that runs again after that leaves everything as it is, and one that failed before leaves a folder
    that no reader looks at. Readers follow the published files, so they see whole batches only.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _entry(self, batch_id: int) -> str:
        return f"{self.path}/published/{batch_id:020d}"

    def write(self, frame: DataFrame, batch_id: int, save: Callable[[DataFrame, str], None]) -> bool:
        """Saves a batch by `save(frame, folder)` and publishes it; False where it had been published before."""
        if read_text(self.spark, self._entry(batch_id)) is not None:
            return False
        name = f"batch={batch_id:020d}-{uuid.uuid4().hex}"
        save(frame, f"{self.path}/data/{name}")
        return publish(self.spark, self._entry(batch_id), json.dumps({"folder": name}))

    def folders(self, after: int = -1) -> list[str]:
        """The folders that count, in the order of their batches, from the batch that follows `after` on."""
        entries = [e for e in names(self.spark, f"{self.path}/published") if int(e) > after]
        found = (json.loads(read_text(self.spark, f"{self.path}/published/{e}"))["folder"] for e in entries)
        return [f"{self.path}/data/{name}" for name in found]

    def read(self, kind: str, schema: StructType | str) -> DataFrame:
        """All published batches as one table; an empty one before the first."""
        folders, empty = self.folders(), self.spark.createDataFrame([], schema)
        if not folders:
            return empty
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").format(kind).load(folders).select(*empty.columns)

    def sweep(self, below: int) -> None:
        """Deletes what failed attempts at batches below a number have left."""
        kept = {folder.rsplit("/", 1)[1] for folder in self.folders()}
        for name in names(self.spark, f"{self.path}/data"):
            if name not in kept and int(name.removeprefix("batch=").split("-")[0]) < below:
                delete(self.spark, f"{self.path}/data/{name}")


def json_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A collector's sink: the `output` lines of each batch once, as text."""

    def sink(enriched: DataFrame, batch_id: int) -> None:
        folder = BatchFolder(enriched.sparkSession, path)
        folder.write(enriched.selectExpr("output AS value"), batch_id, lambda frame, to: frame.write.text(to))

    return sink


def read_json_batches(spark: SparkSession, path: str) -> DataFrame:
    return BatchFolder(spark, path).read("text", "value STRING").withColumnRenamed("value", "output")


def daily_batches(path: str, ts: str = "ts") -> Callable[[DataFrame, int], None]:
    """A sink that writes each batch once, by day."""

    def sink(records: DataFrame, batch_id: int) -> None:
        folder = BatchFolder(records.sparkSession, path)
        folder.write(with_day(records, ts), batch_id, lambda frame, to: frame.write.partitionBy("day").parquet(to))

    return sink


def read_daily_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The daily batches; `schema` is that of the records, without `day`."""
    return BatchFolder(spark, path).read("parquet", StructType([*schema.fields]).add("day", "string"))
