"""Mixing sources to target weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from sievestream.llm.common import WORD, cut_lineage, in_order


def source_targets(sizes: DataFrame, weights: Sequence[float], max_epochs: float) -> DataFrame:
    """(source, source_size) with `target`: the total size dealt by weight, no source above `max_epochs` times its size.

    Sources take the weights in the order of their code points (null last), repeating. Capped water-filling: sources
    whose share exceeds their cap are clamped to it and the excess is dealt to the others by weight, until none exceeds.
    A round is one aggregate over the sources; only the level goes through the driver.
    """
    listed = in_order(sizes.withColumn("_null", F.col("source").isNull()), ["_null", "source"], None, "mix-sources")
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("_idx") % len(weights) + 1).cast("int"))
    listed = listed.select("source", "source_size", weight.alias("_weight"), (F.col("source_size") * float(max_epochs)).alias("_cap"))
    total = listed.agg(F.sum("source_size")).first()[0] or 0
    level, clamped = 0.0, -1
    while True:
        over = F.col("_weight") * level > F.col("_cap")
        n, taken, free = listed.agg(
            F.count_if(over), F.coalesce(F.sum(F.when(over, F.col("_cap"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("_weight"))), F.lit(0.0))
        ).first()
        if n == clamped or not free:
            break
        level, clamped = max(level, (total - taken) / free), n
    return listed.select("source", "source_size", F.least(F.col("_weight") * level, F.col("_cap")).alias("target"))


def mix(docs: DataFrame, weights: Sequence[float], max_epochs: float, seed: str = "mix", text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """How many copies of each document the mix takes.

    A source that gets `r` times its words is taken floor(r) times as a whole; the fraction is a seeded sample: its documents in the order
    of a seeded digest, up to the fraction's words (a document counts as in if its middle is). All rows are
    ordered and summed at once by ranges of (source, digest), so a large source is spread over many tasks.

    Returns key, `source`, `size` (words; null text: 0), `source_size`, `target`, `copies` and `taken` (copies times
    size). Documents without words come along whenever their place in the order is in. Repeated rows are rows of their own;
    rows equal in text and id are sampled in any order. An empty table gives no rows.
    """
    return _mixed(docs, weights, max_epochs, seed, text, key, source).drop("_text")


def _mixed(docs: DataFrame, weights: Sequence[float], max_epochs: float, seed: str, text: str, key: str, source: str) -> DataFrame:
    """mix() with the digest of each row's text as `_text`."""
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    identity = F.concat_ws("|", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")))
    rows = cut_lineage(
        docs.select(
            F.col(key),
            F.col(source).alias("source"),
            F.col(source).isNull().alias("_null"),
            words.alias("size"),
            F.md5(identity.cast("binary")).alias("_digest"),
            F.xxhash64(text).alias("_text"),
        ),
        "mix-rows",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut_lineage(source_targets(sizes, weights, max_epochs), "mix-targets")
    placed = in_order(rows, ["_null", "source", "_digest", "_text", key], "size", "mix")
    starts = in_order(targets.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "source_size", "mix-starts")
    starts = starts.select(F.col("source").alias("_source"), "source_size", "target", F.col("_before").alias("_start"))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    middle = F.col("_before") - F.col("_start") + F.col("size") / 2
    part = (F.col("_share") - F.floor("_share")) * F.col("source_size")
    return (
        placed.join(starts, placed["source"].eqNullSafe(starts["_source"]))
        .withColumn("_share", share)
        .withColumn("copies", (F.floor("_share") + F.when(middle < part, 1).otherwise(0)).cast("long"))
        .select(key, "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "_text")
    )


def repeated(docs: DataFrame, weights: Sequence[float], max_epochs: float, text: str = "text", key: str = "doc_id", source: str = "source", seed: str = "mix") -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it.

    A row is known by its key and text. Of rows equal in both the copies are dealt evenly, the first of them one more where they don't come out even; so the result
    has as many rows as mix() has copies. Columns may have any name.
    """
    copies = _mixed(docs, weights, max_epochs, seed, text, key, source).groupBy(F.col(key).alias("_id"), F.col("_text").alias("_mark_taken"))
    copies = cut_lineage(copies.agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows")).where("_copies > 0"), "mix-copies")
    rows = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_mark"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"))
    joined = rows.join(copies, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_mark_taken"))).select("_key", "_mark", "_doc", "_copies", "_rows")
    alone = joined.where("_rows = 1").select("_doc", F.col("_copies").alias("_share"))
    numbered = in_order(joined.where("_rows > 1"), ["_key", "_mark"], None, "mix-equal").drop("_before")
    first = numbered.groupBy(F.col("_key").alias("_id"), F.col("_mark").alias("_mark_taken")).agg(F.min("_idx").alias("_first"))
    equal = numbered.join(first, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_mark_taken")))
    more = (F.col("_idx") - F.col("_first") < F.col("_copies") % F.col("_rows")).cast("long")
    equal = equal.select("_doc", (F.floor(F.col("_copies") / F.col("_rows")) + more).alias("_share")).where("_share > 0")
    dealt = alone.unionByName(equal).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_share")))
    return dealt.select("_doc.*")
