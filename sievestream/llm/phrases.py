"""Collocations by the partition method of frequent-set mining: local support in shards, then exact counts of all that passed."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from sievestream.llm.common import cut_lineage
from sievestream.llm.text_arrays import mixed, parts, run_hashes, runs, windows

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
#: Shards that are mined each by itself. A shard's support is the global one times its share of the words, so more shards prune less.
SHARDS = 16
#: Filters have FILTER_BITS bits for each entry, up to MAX_FILTER_BITS (64 MB): what is broadcast has this bound at every size.
FILTER_BITS = 16
MAX_FILTER_BITS = 1 << 29
#: Filters are put together from blocks of this many bits.
_BLOCK_BITS = 1 << 16
#: Phrase keys that are counted at once, and bytes of text that are taken apart at once: with the JVM's share two workers have to fit an executor.
_KEYS, _WINDOW = 1_000_000, 1 << 20
#: Rows of a record batch.
_BATCH = 512
#: Words of all texts for each part of the keys, at most: one task adds up a part in memory.
_WORDS_OF_A_PART, _FEW_PARTS = 1_000_000, 8

_BREAK = re.compile(rb"[.,;:!?\n-\r]")
_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_IS_GAP = _IS_BREAK.copy()
_IS_GAP[list(b" \t")] = True
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


@dataclass
class _Words:
    """The words of some texts, in order: where each lies in `data`, its piece, its text's place in the batch, two hashes of it."""

    data: bytes
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    text: np.ndarray
    hash: np.ndarray
    check: np.ndarray | None = None

    def phrase(self, at: int, last: int) -> str:
        return b" ".join(self.data[self.start[at] : self.end[last]].split()).decode("utf-8", "replace")


def _after_break(text: bytes, at: int) -> int:
    found = _BREAK.search(text, at)
    return found.end() if found else len(text)


def _words(texts: list[bytes], hashes: int = 2) -> Iterator[_Words]:
    for data, starts, places in windows(texts, _after_break, _WINDOW):
        data = data.translate(_LOWER)
        raw = np.frombuffer(data, np.uint8)
        inside = ~_IS_GAP[raw]
        start, end = runs(inside)
        if not len(start):
            continue
        piece = np.cumsum(_IS_BREAK[raw])[start]
        text = places[np.searchsorted(starts, start, side="right") - 1]
        yield _Words(data, start, end, piece, text, *run_hashes(raw, inside, start, end, hashes))


def _phrase_hashes(words: _Words, longest: int, which: str = "hash") -> list[np.ndarray]:
    """At index k: hashes of the k-word phrases from each word on; those that leave their piece count for nothing."""
    single = getattr(words, which)
    out = [single[:0], single]
    for k in range(2, longest + 1):
        n = max(len(single) - k + 1, 0)
        out.append(mixed(out[-1][:n] * np.uint64(0xA0761D6478BD642F) + single[k - 1 : k - 1 + n]))
    return out


def _bit(keys: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(keys ^ np.uint64(0x51ED270B)) & np.uint64(bits - 1)).astype(np.int64)


@dataclass(frozen=True)
class _Filter:
    """A bit for each entry: what is not in it was never entered."""

    bits: int
    words: object  # broadcast array

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = _bit(keys, self.bits)
        return (self.words.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _own_keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield batch.column(0).to_numpy().view(np.uint64)


def _filter(entries: DataFrame, keys: Callable[[pa.RecordBatch], Iterator[np.ndarray]] = _own_keys) -> _Filter:
    """The filter of the keys that `keys` finds in the rows. Blocks are built where their entries meet; the driver gets the finished blocks only."""
    spark = entries.sparkSession
    bits = min(max(_BLOCK_BITS, 1 << max(1, int(entries.count()) * FILTER_BITS - 1).bit_length()), MAX_FILTER_BITS)
    n_blocks = bits // _BLOCK_BITS

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in (found for batch in batches for found in keys(batch)):
            at = np.unique(_bit(found, bits))
            yield pa.RecordBatch.from_arrays([pa.array((at // _BLOCK_BITS).astype(np.int32)), pa.array((at % _BLOCK_BITS).astype(np.int32))], names=["block", "bit"])

    def build(table: pa.Table) -> pa.Table:
        block = np.zeros(_BLOCK_BITS // 8, np.uint8)
        at = table.column("bit").to_numpy()
        np.bitwise_or.at(block, at >> 3, (1 << (at & 7)).astype(np.uint8))
        return pa.table({"block": table.column("block")[:1], "bytes": pa.array([block.tobytes()], pa.binary())})

    blocks = entries.mapInArrow(place, "block INT, bit INT").groupBy("block").applyInArrow(build, "block INT, bytes BINARY")
    whole = np.zeros(bits // 8, np.uint8).reshape(n_blocks, -1)
    for row in blocks.toLocalIterator():
        whole[row["block"]] = np.frombuffer(row["bytes"], np.uint8)
    return _Filter(bits, spark.sparkContext.broadcast(whole.reshape(-1)))


def _in_shard(keys: np.ndarray, shards: np.ndarray) -> np.ndarray:
    return mixed(keys + (shards.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))


def _tallied(keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """First places and counts of equal keys; None if two different things have one key."""
    _, first, inverse, counts = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return (first, counts) if np.array_equal(checks[first][inverse], checks) else None


def _scan(docs: DataFrame, schema: str, work: Callable[[_Words, np.ndarray, np.ndarray, np.ndarray], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Runs `work` on the words of all texts, with language hash, language and shard of each text of the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches, _BATCH):
            langs = batch.column(0).to_numpy(zero_copy_only=False)
            lang_hash, shards = batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy()
            for words in _words(batch.column(3).cast(pa.binary()).to_pylist()):
                yield from work(words, lang_hash[words.text], langs, shards)

    return docs.mapInArrow(run, schema)


def _count_members(docs: DataFrame, member: Callable[[list[np.ndarray], np.ndarray], Iterator[tuple[int, np.ndarray]]], longest: int, totals: bool = False) -> DataFrame:
    """(lang, phrase, words, f) of the phrases that `member` lets pass, counted by their text over all documents.

    With `totals` also the words of each language and shard, under the number -1 - shard instead of that of the words, without a phrase.
    """

    def count(words: _Words, lang_hash: np.ndarray, langs: np.ndarray, shards: np.ndarray) -> Iterator[pa.RecordBatch]:
        def rows(langs: np.ndarray, phrases: list, k: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array(k.astype(np.int32)), pa.array(n.astype(np.int64))], names=["lang", "phrase", "words", "n"])

        if totals:
            texts, n = np.unique(words.text, return_counts=True)
            yield rows(langs[texts], [None] * len(texts), -1 - shards[texts], n)
        hashes, checks = _phrase_hashes(words, longest), _phrase_hashes(words, longest, "check")
        for k, at in member(hashes, lang_hash):
            at = at[words.piece[at] == words.piece[at + k - 1]] if k > 1 else at
            keys, twice = mixed(hashes[k][at] ^ lang_hash[at]), mixed(checks[k][at] + lang_hash[at])
            tally = _tallied(keys, twice)
            first, n = tally if tally else (np.arange(len(at)), np.ones(len(at), np.int64))
            yield rows(langs[words.text[at[first]]], [words.phrase(i, i + k - 1) for i in at[first].tolist()], np.full(len(first), k), n)

    counted = _scan(docs, "lang STRING, phrase STRING, words INT, n LONG", count)
    return counted.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("f"))


def _mine(docs: DataFrame, k: int, shorter: _Filter, totals: DataFrame, min_count: int, n_parts: int) -> DataFrame:
    """(key, shard): the phrases of `k` words that are frequent in a shard, given a filter of those of k - 1 words.

    Tasks count what they hold and hand on packed columns of keys, counts and shards, by language and part of the keys; each part is added up by one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[np.ndarray]] = {}
        size = 0

        def counted() -> Iterator[pa.RecordBatch]:
            for lang in {of for of, _ in held}:
                own = [(shard, *np.unique(np.concatenate(found), return_counts=True)) for (of, shard), found in held.items() if of == lang]
                shard = np.concatenate([np.full(len(keys), s, "<i4") for s, keys, _ in own])
                keys, n = (np.concatenate([x[i] for x in own]) for i in (1, 2))
                part = (mixed(keys ^ np.uint64(0x2545F491)) % np.uint64(n_parts)).astype(np.int32)
                order = np.argsort(part, kind="stable")
                part, columns = part[order], [c[order] for c in (keys, n.astype("<i8"), shard)]
                cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
                spans = list(zip(cuts, cuts[1:]))
                packed = [pa.array([c[lo:hi].tobytes() for lo, hi in spans], pa.binary()) for c in columns]
                yield pa.RecordBatch.from_arrays([pa.array(part[cuts[:-1]]), pa.array(np.full(len(spans), lang, np.int64)), *packed], names=["part", "lang_hash", "keys", "counts", "shards"])
            held.clear()

        for batch in parts(batches, _BATCH):
            lang_hash, shards = batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy()
            for words in _words(batch.column(3).cast(pa.binary()).to_pylist(), 1):
                hashes, of = _phrase_hashes(words, k), lang_hash[words.text]
                n = len(hashes[k])
                known = mixed(hashes[k - 1] ^ of[: len(hashes[k - 1])])
                known = shorter.has(known if k == 2 else _in_shard(known, shards[words.text[: len(known)]]))
                at = np.flatnonzero(known[:n] & known[1 : n + 1] & (words.piece[:n] == words.piece[k - 1 : k - 1 + n]))
                keys, texts = mixed(hashes[k][at] ^ of[at]), words.text[at]
                order = np.lexsort((lang_hash[texts], shards[texts]))
                keys, texts = keys[order], texts[order]
                cuts = np.flatnonzero((np.diff(shards[texts]) != 0) | (lang_hash[texts[1:]] != lang_hash[texts[:-1]])) + 1
                for lo, hi in zip([0, *cuts], [*cuts, len(keys)]):
                    if hi > lo:
                        held.setdefault((int(lang_hash[texts[lo]].view(np.int64)), int(shards[texts[lo]])), []).append(keys[lo:hi].copy())
                size += len(keys)
                if size >= _KEYS:
                    yield from counted()
                    size = 0
        yield from counted()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, of = [], None

        def added(needs: list[int]) -> pa.RecordBatch:
            keys, n, shard = (np.frombuffer(b"".join(x), kind) for x, kind in zip(zip(*held), (np.uint64, np.int64, np.int32)))
            held.clear()
            order = np.lexsort((keys, shard))
            keys, n, shard = keys[order], n[order], shard[order]
            first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (shard[1:] != shard[:-1])]))
            frequent = first[np.add.reduceat(n, first) >= np.array(needs)[shard[first]]]
            return pa.RecordBatch.from_arrays([pa.array(keys[frequent].view(np.int64)), pa.array(shard[frequent])], names=["key", "shard"])

        for batch in batches:
            for part, lang, needs, *packed in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if held and (part, lang) != of[:2]:
                    yield added(of[2])
                of = (part, lang, needs)
                held.append(packed)
        if held:
            yield added(of[2])

    packed = docs.mapInArrow(run, "part INT, lang_hash LONG, keys BINARY, counts BINARY, shards BINARY")
    # frequent: n * n_lang >= min_count * n_shard; a shard without words needs nothing, for it has nothing
    need = F.expr(f"(CAST({int(min_count)} AS DECIMAL(18,0)) * n_shard + n_lang - 1) div n_lang").cast("long")
    by_shard = F.map_from_entries(F.collect_list(F.struct("shard", need)))
    needs = totals.groupBy(F.xxhash64("lang").alias("lang_hash")).agg(by_shard.alias("m"))
    needs = needs.select("lang_hash", F.transform(F.sequence(F.lit(0), F.array_max(F.map_keys("m"))), lambda s: F.coalesce(F.element_at("m", s), F.lit(0).cast("long"))).alias("needs"))
    met = packed.join(needs, "lang_hash").select("part", "lang_hash", "needs", "keys", "counts", "shards")
    # several parts may come to one task, which holds a language of one of them at a time
    return met.repartition(n_parts, "part").sortWithinPartitions("part", "lang_hash").mapInArrow(add_up, "key LONG, shard INT")


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Record batches of few rows for the jobs run inside: a batch lies in memory twice, in the JVM's share and in the worker's."""
    name, rows = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set(name, _BATCH)
    try:
        yield
    finally:
        spark.conf.set(name, rows)


def frequent_phrases(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, min_count: int = MIN_COUNT, shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) of all phrases of 1 to `longest` words with at least `min_count` places, and (lang, n) of all words.

    Documents are dealt into `shards` by their text. Each shard is mined completely, word count by word count: a phrase is
    counted in a shard when both its parts of one word less are frequent there, and is frequent there from its share of `min_count` on (share of the
    language's words that the shard has). A phrase frequent in all is so in at least one shard. All phrases frequent in some shard are then
    counted by their text over all documents. Between passes only filters go round, of bounded size: they let pass too much, never too little,
    as do equal hashes of different phrases.
    """
    with _small_batches(docs.sparkSession):
        return _frequent_phrases(docs, text, lang, longest, min_count, shards)


def _frequent_phrases(docs: DataFrame, text: str, lang: str, longest: int, min_count: int, shards: int) -> tuple[DataFrame, DataFrame]:
    language = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    rows = docs.select(
        language.alias("lang"), F.xxhash64(language).alias("lang_hash"), F.pmod(F.xxhash64(F.lit("shard"), F.col(text)), shards).cast("int").alias("shard"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    every_word = lambda hashes, of: iter([(1, np.arange(len(hashes[1])))])
    counted = cut_lineage(_count_members(rows, every_word, 1, totals=True).where((F.col("f") >= min_count) | (F.col("words") < 0)), "phrases-words")
    singles = counted.where("words > 0")
    by_shard = counted.where("words < 0").select("lang", (-1 - F.col("words")).alias("shard"), F.col("f").alias("n_shard"))
    totals = cut_lineage(by_shard.join(by_shard.groupBy("lang").agg(F.sum("n_shard").alias("n_lang")), "lang"), "phrases-shards")
    words = totals.agg(F.sum("n_shard")).first()[0] or 0
    n_parts = max(_FEW_PARTS, -(-words // _WORDS_OF_A_PART))
    shorter, found = _filter(singles.select("phrase", F.xxhash64("lang")), _word_keys), []
    for k in range(2, longest + 1):
        frequent = cut_lineage(_mine(rows, k, shorter, totals, min_count, n_parts), f"phrases-{k}")
        found.append(frequent)
        if k < longest:
            shorter = _filter(frequent, _shard_keys)
    union = found[0]
    for frequent in found[1:]:
        union = union.unionByName(frequent)
    candidates = _filter(union.select("key").distinct())

    def member(hashes: list[np.ndarray], of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        for k in range(2, longest + 1):
            yield k, np.flatnonzero(candidates.has(mixed(hashes[k] ^ of[: len(hashes[k])])))

    counted = cut_lineage(_count_members(rows, member, longest).where(F.col("f") >= min_count), "phrases-counted")
    return singles.unionByName(counted), totals.groupBy("lang").agg(F.max("n_lang").alias("n"))


def _word_keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The keys of counted words, as the scans compute them."""
    of = batch.column(1).to_numpy().view(np.uint64)
    for words in _words(batch.column(0).cast(pa.binary()).to_pylist(), 1):
        yield mixed(words.hash ^ of[words.text])


def _shard_keys(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield _in_shard(batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy())


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, min_count: int = MIN_COUNT, top: int = TOP, shards: int = SHARDS) -> DataFrame:
    """The `top` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    Candidates are the phrases of 2 to `longest` words with a >= `min_count` places (frequent_phrases()). Cut after k words, l and r are the counts of both
    parts and the score is floor(1000 * a * n / (l * r)), in exact decimals; the lowest-scoring cut counts, of equal ones the
    first. A candidate goes when a longer one that contains it has as many places; it is enough to look at those longer by one word, since what
    lies between two equal counts has the same. Order: score and a descending, phrase ascending by UTF-8 bytes.

    A null text is empty, a null language `und`; empty texts have no words. Repeated rows count as often as they are there. An
    empty table gives no rows. Memory of a task grows with the longest piece (text without a break), not with the longest text. Columns besides text and
    language are ignored, whatever their names. A language of one million candidates is ranked from the first `top` of each task.
    """
    counted, n = frequent_phrases(docs, text, lang, longest, min_count, shards)
    counted = counted.select("lang", "phrase", "words", "f")
    candidates = counted.where("words >= 2")
    longer = candidates.where("words >= 3").select("lang", F.col("f").alias("longer"), F.explode(F.array(F.expr("substring_index(phrase, ' ', words - 1)"), F.expr("substring_index(phrase, ' ', 1 - words)"))).alias("phrase"))
    swallowed = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.expr("transform(sequence(1, words - 1), k -> struct(k, substring_index(phrase, ' ', k) AS head, substring_index(phrase, ' ', k - words) AS rest))")).alias("c"))
    cuts = cuts.select("lang", "phrase", "a", "c.*")
    part = counted.select("lang", F.col("phrase").alias("part"), "f")
    heads = part.select("lang", F.col("part").alias("head"), F.col("f").alias("l"))
    rests = part.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).join(n, "lang")
    exact = scored.withColumn("score", F.expr("(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0))) div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))"))
    best = exact.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b")).select("lang", "phrase", "a", "n", "b.*")
    kept = best.join(swallowed, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = kept.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
