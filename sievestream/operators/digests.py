"""Comparing large tables by digests of id ranges: only ranges that differ are compared row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sievestream.session import cut_lineage

#: Ranges of an id's hash at the lowest level; each level above has FAN times fewer.
LEAVES = 4096
FAN = 16


def _leaf(key: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("leaf"), key), F.lit(LEAVES)).cast("int")


def leaf_digests(rows: DataFrame, key: str = "rule_id", columns: list[str] | None = None) -> DataFrame:
    """(leaf, n, a, b): number of rows and sums of two hashes of each range, whatever the order; sums of parts can be added up.

    `columns` are those that make rows equal (the key alone: tables of equal ids). Written by one table's owner, they tell another whether anything differs.
    """
    compared = [F.col(f"`{c}`") for c in sorted({key, *([key] if columns is None else columns)})]
    text = F.to_json(F.struct(*compared), {"ignoreNullFields": "false"})
    wide = lambda seed: F.sum(F.xxhash64(F.lit(seed), text).cast("decimal(20,0)"))
    return rows.groupBy(_leaf(F.col(key)).alias("leaf")).agg(F.count("*").alias("n"), wide("a").alias("a"), wide("b").alias("b"))


def above(digests: DataFrame) -> DataFrame:
    """The digests one level up."""
    return digests.groupBy(F.floor(F.col("leaf") / FAN).cast("int").alias("leaf")).agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))


def unequal(left: DataFrame, right: DataFrame) -> DataFrame:
    """(leaf) of the ranges whose digests differ; one side may lack a range."""
    same = F.lit(True)
    for c in ("n", "a", "b"):
        same &= F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    both = left.alias("l").join(right.alias("r"), F.col("l.leaf") == F.col("r.leaf"), "full")
    return both.where(~same).select(F.coalesce("l.leaf", "r.leaf").alias("leaf"))


def unequal_leaves(left: DataFrame, right: DataFrame) -> DataFrame:
    """As unequal(), from the top down: a range is looked at when the one above it differs. At most LEAVES rows."""
    levels = [(left, right)]
    size = LEAVES
    while size > FAN:
        levels.append(tuple(above(d) for d in levels[-1]))
        size //= FAN
    wanted = unequal(*levels.pop())
    while levels:
        sides = levels.pop()
        below = [d.join(wanted.select(F.col("leaf").alias("_up")), F.floor(F.col("leaf") / FAN) == F.col("_up"), "left_semi") for d in sides]
        wanted = unequal(*below)
    return wanted


def delta(left: DataFrame, right: DataFrame, key: str = "rule_id", columns: list[str] | None = None) -> DataFrame:
    """(key, change) from `left` to `right`: `added`, `removed`, or `changed` where `columns` differ. Keys are unique and not null.

    Only rows of ranges with different digests are shuffled; for equal tables that is none.
    """
    compared = sorted(set([] if columns is None else columns) - {key})
    sides = [cut_lineage(leaf_digests(t, key, columns), "digests") for t in (left, right)]
    # at most LEAVES numbers: small whatever the tables' size
    leaves = F.broadcast(cut_lineage(unequal_leaves(*sides), "unequal"))
    narrowed = []
    for t in (left, right):
        rows = t.select(key, F.struct(*(F.col(f"`{c}`") for c in compared)).alias("_row") if compared else F.lit(0).alias("_row"))
        narrowed.append(rows.join(leaves, _leaf(F.col(key)) == F.col("leaf"), "left_semi"))
    l, r = narrowed[0].withColumnRenamed("_row", "_left"), narrowed[1].withColumnRenamed("_row", "_right")
    both = l.withColumn("_l", F.lit(True)).join(r.withColumn("_r", F.lit(True)), key, "full")
    change = F.when(F.col("_l").isNull(), "added").when(F.col("_r").isNull(), "removed").when(~F.col("_left").eqNullSafe(F.col("_right")), "changed")
    return both.select(key, change.alias("change")).where("change IS NOT NULL")


def same_tables(left: DataFrame, right: DataFrame, key: str = "rule_id", columns: list[str] | None = None) -> DataFrame:
    """(is_equal): one row, from digests alone."""
    differ = unequal_leaves(*(leaf_digests(t, key, columns) for t in (left, right)))
    return differ.agg((F.count("*") == 0).alias("is_equal"))
