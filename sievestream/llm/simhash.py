"""SimHash near-duplicates by deletion-variant signatures."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from sievestream.llm.common import WORD, ascii_lower, components, cut_lineage, text_mark

_WORDS = re.compile(WORD.encode())
_BITS = np.arange(64, dtype=np.uint64)
#: Distinct fingerprints whose variants one task makes, on average: 64 rows each, which it holds while it counts them.
TASK_FINGERPRINTS = 1 << 13


def fingerprint(text: bytes, shingle: int) -> int:
    """64 majority bits over the XXH64 (seed 42) of all word shingles; a tie gives 0, a text without words 0."""
    words = _WORDS.findall(text)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), last.tolist())), np.uint64, n)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, 4096):  # blocks bound the memory of a very long text
        bits = np.unpackbits(hashes[at : at + 4096].view(np.uint8), bitorder="little").reshape(-1, 64)
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int(((set_bits * 2 > n).astype(np.uint64) << _BITS).sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, shingle: int, text: str = "text", key: str = "doc_id", *more: F.Column) -> DataFrame:
    """(key, fp) of every row, and `more` columns: the fingerprint as a signed long. A null text has no words."""

    @F.pandas_udf("long")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(t or b"", shingle) for t in batch], np.uint64).view(np.int64))

    return docs.select(F.col(key), of(ascii_lower(F.col(text)).cast("binary")).alias("fp"), *more)


def _masked() -> F.Column:
    """The 64 variants of `fp`: each half of 32 bits, once for each of its bits left out, as (half and bit, masked half)."""
    variants = []
    for half in (0, 1):
        part = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)) if half == 0 else F.shiftrightunsigned("fp", 32)
        variants += [part.bitwiseAND(F.lit(0xFFFFFFFF ^ (1 << bit))) + F.lit((half * 32 + bit) << 32) for bit in range(32)]
    return F.array(*variants)


def _variants(distinct: DataFrame) -> DataFrame:
    """(fp, variant), 64 rows for each distinct fingerprint. Few bytes become many rows, so tasks follow from the number of fingerprints, not from their bytes."""
    tasks = -(-distinct.count() // TASK_FINGERPRINTS) or 1
    return distinct.repartition(tasks, "fp").select("fp", F.explode(_masked()).alias("variant"))


def links(distinct: DataFrame) -> DataFrame:
    """Pairs (a < b) of the distinct fingerprints `fp` that differ in at most 3 bits.

    Of 3 differing bits at most 1 lies in one of the two halves, so that half agrees in a variant that leaves out one bit.
    An equality join on the variants finds every such pair. It is taken at one variant only: of the lowest half with at
    most one differing bit, the one that leaves out this bit (bit 0 where the halves are equal). `distinct` is read several times.
    """
    variants = _variants(distinct)
    several = cut_lineage(variants.groupBy("variant").agg(F.count("*").alias("n")).where("n > 1").select("variant"), "simhash-variants")
    kept = cut_lineage(variants.join(several, "variant", "left_semi"), "simhash-members")
    left, right = kept.select("variant", F.col("fp").alias("a")), kept.select("variant", F.col("fp").alias("b"))
    differing = F.col("a").bitwiseXOR(F.col("b"))
    low, high = differing.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(differing, 32)
    one = F.when(F.bit_count(low) <= 1, low).otherwise(high)
    bit = F.when(one == 0, 0).otherwise(F.bit_count(one - 1)) + F.when(F.bit_count(low) <= 1, 0).otherwise(32)
    return (
        left.join(right, "variant")
        .where((F.col("a") < F.col("b")) & (F.bit_count(differing) <= 3) & (F.shiftrightunsigned("variant", 32) == bit))
        .select("a", "b")
    )


def near_duplicates(docs: DataFrame, shingle: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, `fingerprint` as 16 hex digits, `component_id`): the smallest key reachable over fingerprints 3 bits apart or less.

    Equal fingerprints are one node from the start, so copies never meet in pairs. All texts without words share the
    fingerprint zero. A row with a null key takes part as a text but names no component; a class of null keys only has a null one. Repeated
    rows give repeated rows; an empty table none.
    """
    rows = cut_lineage(fingerprints(docs, shingle, text, key), "simhash-rows")
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min(key).alias("_first")), "simhash-distinct")
    groups = components(links(distinct.select("fp")), "simhash-components")
    # components() names a group by its smallest fingerprint; the smallest key of its members is asked for
    named = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    first = named.groupBy("component").agg(F.min("_first").alias("component_id"))
    classes = cut_lineage(named.join(first, "component").select("fp", "component_id"), "simhash-classes")
    return rows.join(classes, "fp").select(key, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = 5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of `docs` for each component: the one of its smallest key, of those the smallest text digest.

    Rows are told apart by key and text: rows of one key with different texts each belong to the component of their text. Null keys
    come last. Of rows equal in both any one stays.
    """
    rows = cut_lineage(fingerprints(docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")), shingle, "_text", "_key", text_mark("_text")), "simhash-rows")
    distinct = cut_lineage(rows.select("fp").distinct(), "simhash-distinct")
    groups = components(links(distinct), "simhash-components")
    members = rows.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select("_key", "_mark", F.coalesce("component", "fp").alias("group"))
    return first_of_groups(docs, members, text, key)


def first_of_groups(docs: DataFrame, members: DataFrame, text: str, key: str) -> DataFrame:
    """The row of `docs` of the smallest key and text digest of each `group`; `members` has `_key`, `_mark` and `group` of each row."""
    once = members.groupBy("_key", "_mark").agg(F.min("group").alias("group"), F.count("*").alias("n"))
    kept = once.groupBy("group").agg(F.min(F.struct(F.col("_key").isNull().alias("last"), "_key", "_mark", "n")).alias("first"))
    kept = cut_lineage(kept.select(F.col("first._key").alias("kept_key"), F.col("first._mark").alias("kept_mark"), F.col("first.n").alias("n")), "simhash-kept")
    rows = docs.select(F.col(key).alias("_key"), text_mark(text), F.struct(*docs.columns).alias("_doc"))
    found = rows.join(kept, F.col("_key").eqNullSafe(F.col("kept_key")) & (F.col("_mark") == F.col("kept_mark")))
    repeated = found.where("n > 1").dropDuplicates(["_key", "_mark"])
    return found.where("n = 1").select("_doc.*").union(repeated.select("_doc.*"))
