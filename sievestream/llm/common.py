"""Shared steps: tables, global numbering, connected components."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sievestream.session import cut_lineage, work_dir

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: F.Column) -> F.Column:
    """A-Z only: other letters keep their case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_mark(text: str) -> F.Column:
    """Digest that tells rows of one key apart, as `_mark`; a null text is not an empty one."""
    return F.xxhash64(F.col(text).isNull(), F.col(text)).alias("_mark")


def crc_mod(doc_id: F.Column, n: int) -> F.Column:
    """crc32 of the id as text, modulo `n`; a null id counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n).cast("int")


def in_order(df: DataFrame, order: Sequence[str], size: str | None = None, purpose: str = "ordered") -> DataFrame:
    """Adds `_idx` (position) and `_before` (sum of `size` over all rows before) in the global order of `order`.

    Range partitions are sorted and numbered each by itself; what lies before a partition comes from one total per
    partition. Only these totals (one row per partition) meet on the driver. The rows are written once in between, so
    that the numbers of both steps belong to the same partitions. Rows equal in all of `order` are numbered in any order.
    """
    spark = df.sparkSession
    schema = T.StructType(
        [*df.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_row", T.LongType()), T.StructField("_sum", T.LongType())]
    )

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            sizes = batch.column(batch.schema.get_field_index(size)).to_numpy(zero_copy_only=False) if size else np.zeros(n, np.int64)
            sums = total + np.cumsum(sizes, dtype=np.int64)
            extra = [np.full(n, part, np.int32), np.arange(row, row + n), sums - sizes]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, extra)], names=[*batch.schema.names, "_part", "_row", "_sum"])
            if n:
                row, total = row + n, int(sums[-1])

    local = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, schema), purpose)
    amount = F.col(size).cast("long") if size else F.lit(0).cast("long")
    offsets, rows, total = [], 0, 0
    for part, n, amount_of_part in sorted(map(tuple, local.groupBy("_part").agg(F.count("*"), F.sum(amount)).collect())):
        offsets.append((part, rows, total))
        rows, total = rows + n, total + amount_of_part
    before = spark.createDataFrame(offsets, "_part INT, _rows_before LONG, _sum_before LONG")
    return local.join(F.broadcast(before), "_part").select(
        *(local[f.name] for f in df.schema.fields),
        (F.col("_row") + F.col("_rows_before")).alias("_idx"),
        (F.col("_sum") + F.col("_sum_before")).alias("_before"),
    )


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b); the component is its smallest node.

    Alternating large-star and small-star steps: every node hands its larger, then its smaller neighbours on to the
    smallest node it knows. Each step is one aggregate and one join on distinct edges. The loop ends when the edges are
    stars: no parent is itself a child. Null ends and self-links are ignored.
    """
    edges = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), purpose)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut_lineage(large, purpose)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        handed = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(handed.union(low.select("u", F.col("m").alias("v"))).distinct(), purpose)
        parents = edges.select(F.col("v").alias("u")).distinct()
        many = edges.groupBy("u").count().where("count > 1")
        if parents.join(edges, "u", "left_semi").isEmpty() and many.isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


__all__ = ["WORD", "ascii_lower", "components", "crc_mod", "cut_lineage", "in_order", "table", "text_mark", "work_dir"]
