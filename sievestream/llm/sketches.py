"""Bottom-k sketches of word shingles, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sievestream.llm.common import WORD

K = 128
SHINGLE = 5
#: Bytes of text that share a bucket of neighbouring documents, and the most buckets.
BUCKET_BYTES = 8 << 20
MAX_BUCKETS = 10_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def shingle_hashes(words: Column, shingle: int = SHINGLE) -> Column:
    """XXH64 of every run of `shingle` words (fewer words: of all of them together; none: an empty array).

    `words` should be a column of its own: it is read several times.
    """
    few = F.when(F.size(words) > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))
    runs = F.transform(F.sequence(F.lit(0), F.size(words) - shingle), lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(shingle))))
    return F.when(F.size(words) >= shingle, runs).otherwise(few)


def sketch(hashes: Column, k: int = K) -> Column:
    """The k smallest distinct hashes, in order."""
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of both parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_groups(rows: DataFrame, groups: list[str], column: str, k: int = K) -> DataFrame:
    """One sketch for each group of sketches: the k smallest distinct hashes over all rows of the group.

    A hash matters only if fewer than k of its group are smaller, so ranks are cut before the sketches are put together.
    """
    hashes = rows.select(*groups, F.explode(column).alias("_hash")).distinct()
    rank = Window.partitionBy(*groups).orderBy("_hash")
    kept = hashes.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= k)
    return kept.groupBy(*groups).agg(F.sort_array(F.collect_list("_hash")).alias(column))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else (k - 1) over the share of the hash space below the k-th."""
    share = (F.element_at(a, k).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def _shared(a: Column, b: Column, k: int) -> tuple[Column, Column]:
    union = merge(a, b, k)
    return F.size(F.array_intersect(F.array_intersect(union, a), b)), F.size(union)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness of the shingle sets: the share of the union's sketch that both have. Two empty ones are alike."""
    both, all_ = _shared(a, b, k)
    return F.when(all_ == 0, 1.0).otherwise(both / all_)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of `a` that `b` has too; an empty `a` is contained in anything."""
    both = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), both / distinct_count(a, k)))


def as_text(a: Column) -> Column:
    """The hashes as 16 hex digits each."""
    return F.lower(F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def _buckets(rows: DataFrame, key: str, text: str) -> tuple[Column, int]:
    """The bucket of a key, as a column, and how many there are. Cut points are quantiles of the keys; binary search finds a key's place."""
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = int(min(MAX_BUCKETS, max(1, size // BUCKET_BYTES)))
    cuts: list[int] = []
    if n > 1:
        cuts = sorted(set(rows.agg(F.percentile_approx(key, [i / n for i in range(1, n)], F.lit(MAX_BUCKETS))).first()[0] or []))
    if not cuts:
        return F.lit(0), 1
    table = F.array(*map(F.lit, cuts))
    # how many cuts are at or below the key, from the highest bit of that number down
    bucket = F.aggregate(
        F.array(*(F.lit(1 << b) for b in range(len(cuts).bit_length() - 1, -1, -1))),
        F.lit(0),
        lambda below, bit: F.when((below + bit <= len(cuts)) & (F.get(table, below + bit - 1) <= F.col(key)), below + bit).otherwise(below),
    )
    return bucket, len(cuts) + 1


def neighbours(docs: DataFrame, text: str = "text", key: str = "doc_id", k: int = K) -> DataFrame:
    """Every document with its edited text and the sketches of itself, the edited text and the next document.

    In the edited text the last floor(n / 2) of its n code points are replaced by the first as many of the next document
    in ascending key (ties by text, null keys first; after the last comes the first). Documents are dealt to buckets of neighbouring keys; the
    first rows of each bucket also go to the bucket before it as guests, so every text is shuffled once and no sort is
    global. Buckets end up empty only if keys are very unequal; then guests are taken from the next bucket that has rows.

    Returns key, `n_chars`, `edited_sha256`, `fingerprint`, `edited_fingerprint` (hex of the sketches), `near_edited`, `near_next` and the
    arrays `sketch`, `edited_sketch`. A null text is empty; repeated rows follow one another; an empty table gives no rows.
    """
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias(text))
    bucket, _ = _buckets(rows, key, text)
    rows = rows.withColumn("_bucket", bucket.cast("int"))
    # one row per bucket: its smallest key and the bucket before it
    nulls = F.count_if(F.col(key).isNull()) > 0
    heads = sorted(map(tuple, rows.groupBy("_bucket").agg(F.min(key), nulls).collect()))
    hosts = rows.sparkSession.createDataFrame(
        [(b, None if has_null else low, heads[at - 1][0]) for at, (b, low, has_null) in enumerate(heads)], "_bucket INT, _low LONG, _host INT"
    )
    placed = rows.join(F.broadcast(hosts), "_bucket")
    own = F.struct("_bucket", F.lit(False).alias("_guest"))
    guest = F.struct(F.col("_host").alias("_bucket"), F.lit(True).alias("_guest"))
    homes = F.when(F.col(key).eqNullSafe(F.col("_low")), F.array(own, guest)).otherwise(F.array(own))
    placed = placed.select(key, text, F.explode(homes).alias("_home")).select(key, text, "_home.*")

    order = Window.partitionBy("_bucket").orderBy("_guest", key, text)
    n = F.char_length(text)
    edited = F.concat(F.expr(f"substring(`{text}`, 1, char_length(`{text}`) - char_length(`{text}`) div 2)"), F.expr(f"substring(_next, 1, char_length(`{text}`) div 2)"))
    paired = placed.withColumn("_next", F.lead(text).over(order)).select(
        key,
        text,
        "_bucket",
        "_guest",
        n.cast("long").alias("n_chars"),
        F.when(~F.col("_guest"), edited).alias("_edited"),
        words_of(F.col(text)).alias("_words"),
    )
    ready = paired.withColumn("sketch", sketch(shingle_hashes(F.col("_words")), k)).drop("_words")
    ready = ready.withColumn("_next_sketch", F.lead("sketch").over(order)).where("NOT _guest")
    ready = ready.withColumn("_words", words_of(F.col("_edited"))).withColumn("edited_sketch", sketch(shingle_hashes(F.col("_words")), k))
    ready = ready.select(key, "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), "sketch", "edited_sketch", "_next_sketch")
    return ready.select(
        key,
        "n_chars",
        "edited_sha256",
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("_next_sketch"), k).alias("near_next"),
        "sketch",
        "edited_sketch",
    )
