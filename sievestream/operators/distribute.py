"""Ways to keep one hot key from landing in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sievestream.session import cut_lineage

DEFAULT_SALTS = 16
_MAP_SIDE_RANKS = 1000
# Rows of a few words that go to all tasks: some ten MB.
BROADCAST_ROWS = 100_000


def spread(rows: DataFrame, by: Column, salts: int = DEFAULT_SALTS) -> DataFrame:
    """Adds `_salt`; `by` must be deterministic and vary among the rows of one join key."""
    return rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))


def repeated(keyed: DataFrame, salts: int = DEFAULT_SALTS) -> DataFrame:
    """The counterpart of `spread`: every row once per salt."""
    return keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def salted_join(
    rows: DataFrame, keyed: DataFrame, on: Sequence[str], by: Column, how: str = "inner", salts: int = DEFAULT_SALTS, shuffled: bool = False
) -> DataFrame:
    """Equi-join in which the rows of one key are spread over `salts` partitions.

    `keyed` is the side with few rows per key. Where it turns out small, adaptive execution broadcasts it; not if `shuffled`, for tables that can be large: before
    it runs Spark takes repeated rows for one, and files for what they hold, so the driver would get tables far beyond its threshold.
    """
    copies = repeated(keyed, salts)
    return spread(rows, by, salts).join(copies.hint("merge") if shuffled else copies, [*on, "_salt"], how).drop("_salt")


def are_few(written: DataFrame) -> bool:
    """Whether the rows of a table that has been written can go to all tasks."""
    return written.count() <= BROADCAST_ROWS


def written_join(rows: DataFrame, written: DataFrame, on: Sequence[str], by: Column, salts: int = DEFAULT_SALTS) -> DataFrame:
    """Equi-join with a table that has been written, so that its rows are known: where they are few they go to all tasks and `rows` stay where they are."""
    if are_few(written):
        return rows.join(F.broadcast(written), list(on))
    return salted_join(rows, written, on, by, salts=salts, shuffled=True)


def first_per_group(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column | str], n: int, by: Column, salts: int = 64
) -> DataFrame:
    """The first `n` rows of every group by a total order.

    Spark cuts ranks in the map tasks only up to a limit of its own (1000 by default). Above it a group is first cut in
    `salts` parts, so that at most `n` rows of each part meet in one task.
    """
    rank = lambda keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    if n > _MAP_SIDE_RANKS:
        parts = spread(df, by, salts)
        df = parts.withColumn("_rank", rank([*groups, "_salt"])).where(F.col("_rank") <= n).drop("_rank", "_salt")
    return df.withColumn("_rank", rank(groups)).where(F.col("_rank") <= n).drop("_rank")


def number_rows(df: DataFrame, groups: Sequence[str], order: str, name: str = "idx") -> DataFrame:
    """0-based position of every row within its group by a unique `order` column of any sortable type.

    A plain `row_number()` sorts each group in one task. Here all rows are dealt to ranges of (groups, order) and numbered
    range by range; a group's number begins where its rows of the ranges before end. The ranges are written once, so that
    both steps see the same; only one row for each group and range is left to sum up.
    """
    place = [*groups, order]
    ranged = df.repartitionByRange(*place).sortWithinPartitions(*place)
    # The id counts the rows of a partition in its lower 33 bits.
    numbered = ranged.withColumn("_part", F.spark_partition_id()).withColumn(
        "_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    )
    numbered = cut_lineage(numbered, "numbered")
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = numbered.groupBy(*groups, "_part").agg(F.count("*").alias("_n"), F.min("_pos").alias("_first"))
    offsets = counts.select(*groups, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    offsets = cut_lineage(offsets, "number-offsets")
    joined = numbered.join(offsets, _null_safe(numbered, offsets, [*groups, "_part"]))
    return joined.select(*[numbered[c] for c in df.columns], (F.col("_pos") - F.col("_first") + F.col("_offset")).alias(name))


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition
