"""Contiguous shards of near equal bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sievestream.llm.common import in_order


def shard_by_bytes(docs: DataFrame, shards: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Deals documents to `shards` shards of near equal bytes; rows of equal text stay in one shard.

    Documents are ordered by a digest of their text, then by id. Byte totals of the range partitions give every row its
    global prefix sum. Each cut stands at an equal share of the bytes not yet dealt, and moves to the nearer end of the
    group of equal texts it falls into, so a shard differs from its target by half a group at most. A group larger than
    a whole share fills a shard of its own, and the cuts after it share what is left.

    Returns the key, `size` (UTF-8 bytes plus 1), `text_crc32`, `shard` and `slot` (position in the shard, from 0).
    A null text counts as empty; rows that repeat are rows of their own; an empty table gives no rows. Shards stay empty only
    when there are fewer groups than shards.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key),
        (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(whole.cast("binary"))).alias("_digest"),
    )
    placed = in_order(rows, ["_digest", key], "size", "shards")
    total, n = placed.agg(F.max(F.col("_before") + F.col("size")), F.count("*")).first()
    cuts: list[tuple[int, int]] = []  # bytes and rows before each cut
    done = 0
    for left in range(shards, 1, -1):
        if not n or done >= total:
            break
        at = done + (total - done) / left
        hit = placed.where((F.col("_before") <= at) & (F.col("_before") + F.col("size") > at)).select("_digest").first()
        group = placed.where(F.col("_digest") == F.lit(bytes(hit[0])))
        begin, end, row, count = group.agg(F.min("_before"), F.max(F.col("_before") + F.col("size")), F.min("_idx"), F.count("*")).first()
        done, first = (begin, row) if begin > done and at - begin <= end - at else (end, row + count)
        cuts.append((done, first))
    shard, start = F.lit(0), F.lit(0).cast("long")
    for k, (done, first) in enumerate(cuts, 1):
        past = F.col("_before") >= done
        shard, start = F.when(past, k).otherwise(shard), F.when(past, F.lit(first).cast("long")).otherwise(start)
    return placed.select(key, "size", "text_crc32", shard.cast("int").alias("shard"), (F.col("_idx") - start).alias("slot"))
