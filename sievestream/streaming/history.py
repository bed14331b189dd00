"""Tables that follow a stream: the newest messages of each keyword, the newest name of each user, counts by event time."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sievestream.files import delete, names, publish, read_text
from sievestream.functions import values as V
from sievestream.operators.distribute import first_per_group
from sievestream.operators.validate import recent_by_keyword
from sievestream.streaming.state import BatchTable


class NewestByKeyword:
    """The newest `n` messages of each keyword so far, as recent_by_keyword() of the whole history would find them.

    What is kept are ids and times, at most `n` for each keyword: the newest of a batch and those of before are put together and cut again. A keyword that is
    no longer asked for goes; one that is new begins with the batch that brings it.
    """

    def __init__(self, spark: SparkSession, folder: str, n: int, row_id: str = "STRING"):
        self.n, self.table = n, BatchTable(spark, folder, f"keyword STRING, row_id {row_id}, ts TIMESTAMP", "newest")

    def update(self, messages: DataFrame, batch_id: int, keywords: DataFrame, form: str = "in_place") -> DataFrame:
        """(keyword, row_id, ts, rank) after a batch of (row_id, ts, text); `keywords` is (keyword)."""
        found = recent_by_keyword(messages, keywords, self.n, form).select("keyword", "row_id", "ts")
        old = self.table.before(batch_id).join(keywords.select("keyword").distinct(), "keyword", "left_semi")
        order = [F.col("ts").desc(), F.col("row_id").desc()]
        merged = first_per_group(old.unionByName(found), ["keyword"], order, self.n, F.col("row_id"))
        newest = self.table.write(merged.select("keyword", "row_id", "ts"), batch_id)
        return newest.withColumn("rank", F.row_number().over(Window.partitionBy("keyword").orderBy(*order)))


class UserTable:
    """(userid, screen_name) with the newest name of each user: a base and the deltas of the batches since.

    A delta has one row for each user of its batch. Every `compact_every` batches base and deltas become a new base, newest name first; nothing else ever reads
    the base's users again. Names may come in any order: of all names the latest by time counts, of equal times the greatest name, whenever they came.
    """

    _DDL = "userid STRING, screen_name STRING, ts TIMESTAMP"

    def __init__(self, spark: SparkSession, folder: str, compact_every: int = 20):
        self.spark, self.folder, self.compact_every = spark, folder.rstrip("/"), compact_every

    def _base(self) -> int:
        """The last batch that the newest base has, -1 without a base."""
        bases = names(self.spark, f"{self.folder}/bases")
        return int(bases[-1]) if bases else -1

    def _parts(self, base: int, upto: int | None = None) -> list[str]:
        deltas = [d for d in names(self.spark, f"{self.folder}/deltas") if int(d) > base and (upto is None or int(d) <= upto)]
        own = [read_text(self.spark, f"{self.folder}/bases/{base:020d}")] if base >= 0 else []
        return [*own, *(f"{self.folder}/deltas/{d}" for d in deltas)]

    def _newest(self, rows: DataFrame) -> DataFrame:
        best = rows.groupBy("userid").agg(F.max(F.struct("ts", "screen_name")).alias("b"))
        return best.select("userid", "b.screen_name", "b.ts")

    def update(self, messages: DataFrame, batch_id: int) -> None:
        """Takes in a batch of (userid, screen_name, ts); nulls are left out. A batch that runs again replaces its delta."""
        if batch_id <= self._base():
            return
        named = messages.where("userid IS NOT NULL AND screen_name IS NOT NULL").select(F.col("userid").cast("string").alias("userid"), "screen_name", F.col("ts").cast("timestamp").alias("ts"))
        self._newest(named).write.mode("overwrite").parquet(f"{self.folder}/deltas/{batch_id:020d}")
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(batch_id)

    def users(self) -> DataFrame:
        parts = self._parts(self._base())
        rows = self.spark.read.schema(self._DDL).parquet(*parts) if parts else self.spark.createDataFrame([], self._DDL)
        return self._newest(rows).select("userid", "screen_name")

    def compact(self, upto: int) -> None:
        """Base and deltas up to a batch become the new base; it counts from the moment its name is published."""
        base = self._base()
        parts = self._parts(base, upto)
        if not parts or upto <= base:
            return
        target = f"{self.folder}/base-{upto}"
        self._newest(self.spark.read.schema(self._DDL).parquet(*parts)).write.mode("overwrite").parquet(target)
        publish(self.spark, f"{self.folder}/bases/{upto:020d}", target)
        # readers that began with the base before still find it; the one before that goes
        for name in names(self.spark, f"{self.folder}/bases"):
            if int(name) < base:
                delete(self.spark, read_text(self.spark, f"{self.folder}/bases/{name}"))
                delete(self.spark, f"{self.folder}/bases/{name}")
        for name in names(self.spark, f"{self.folder}/deltas"):
            if int(name) <= base:
                delete(self.spark, f"{self.folder}/deltas/{name}")


class EventCounts:
    """Counts by event time on a stream, in which no row is lost: a window is given out once it has closed, later rows as corrections.

    The watermark of a batch is the newest event time of the batches before it less `delay_seconds`; it is written down with the batch, so one that runs again has the same. A
    window whose end the watermark has reached is closed. All closed counts, all corrections and the windows still open together are the
    counts of the whole table.
    """

    def __init__(self, spark: SparkSession, folder: str, window_seconds: int, delay_seconds: int):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.window_us, self.delay_us = window_seconds * V.MICROS, delay_seconds * V.MICROS
        self.table = BatchTable(spark, folder, "key STRING, window_us LONG, n LONG", "windows")

    def _time(self, batch_id: int) -> dict:
        """The watermark of a batch and the newest event time up to its end; both null before there was one."""
        text = read_text(self.spark, f"{self.folder}/times/{batch_id:020d}") if batch_id >= 0 else None
        return json.loads(text) if text else {"watermark": None, "newest": None}

    def update(self, rows: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame]:
        """(closed, corrections), both (key, window_us, n), of a batch of (key, ts); `late_rows` has the late ones themselves. Null times are left out."""
        before = self._time(batch_id - 1)["newest"]
        watermark = None if before is None else before - self.delay_us
        placed = rows.select(F.col("key").cast("string").alias("key"), V.micros(F.col("ts")).alias("at")).where("at IS NOT NULL")
        counted = placed.groupBy("key", (V.floor_div(F.col("at"), self.window_us) * self.window_us).alias("window_us")).agg(F.count("*").alias("n"), F.max("at").alias("newest"))
        counted = BatchTable(self.spark, self.folder, "key STRING, window_us LONG, n LONG, newest LONG", "batch").write(counted, batch_id)
        is_late = self._closed(watermark)
        corrections = counted.where(is_late).select("key", "window_us", "n")
        open_before = self.table.before(batch_id).unionByName(counted.where(~is_late).select("key", "window_us", "n"))
        newest = [x for x in (before, counted.agg(F.max("newest")).first()[0]) if x is not None]
        after = max(newest) if newest else None
        publish(self.spark, f"{self.folder}/times/{batch_id:020d}", json.dumps({"watermark": watermark, "newest": after}))
        summed = open_before.groupBy("key", "window_us").agg(F.sum("n").alias("n"))
        closes = self._closed(None if after is None else after - self.delay_us)
        closing = BatchTable(self.spark, self.folder, self.table.schema, "closing").write(summed, batch_id)
        self.table.write(closing.where(~closes), batch_id)
        return closing.where(closes), corrections

    def _closed(self, watermark: int | None):
        return F.lit(False) if watermark is None else F.col("window_us") + self.window_us <= watermark

    def late_rows(self, rows: DataFrame, batch_id: int, ts: str = "ts") -> DataFrame:
        """The rows of a batch that came after their window had closed, for a side output."""
        watermark = self._time(batch_id)["watermark"]
        end = V.floor_div(V.micros(F.col(ts)), self.window_us) * self.window_us + self.window_us
        return rows.where(F.lit(False) if watermark is None else end <= watermark)

    def still_open(self, batch_id: int) -> DataFrame:
        return self.table.after(batch_id)
