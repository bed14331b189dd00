"""What one micro-batch hands on to the next, as a table below a folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sievestream.files import delete


class BatchTable:
    """The state after each micro-batch.

    A batch starts from the table of the batch before it and writes its own, so one that runs again after a failure decides the
    same and overwrites what it had written. The tables of earlier batches are deleted.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str, name: str = "state"):
        self.spark, self.folder, self.schema, self.name = spark, folder.rstrip("/"), schema, name

    def _path(self, batch_id: int) -> str:
        return f"{self.folder}/{self.name}-{batch_id}"

    def before(self, batch_id: int) -> DataFrame:
        return self.spark.createDataFrame([], self.schema) if batch_id == 0 else self.after(batch_id - 1)

    def after(self, batch_id: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self._path(batch_id))

    def write(self, state: DataFrame, batch_id: int) -> DataFrame:
        """Writes the state after a batch, and reads it back."""
        state.write.mode("overwrite").parquet(self._path(batch_id))
        delete(self.spark, self._path(batch_id - 2))
        return self.after(batch_id)
