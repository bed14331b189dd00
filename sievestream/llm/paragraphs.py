"""Repeated paragraphs across documents: lines by MinHash banding, exact passages by anchors."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from sievestream.llm.common import WORD, ascii_lower, components, cut_lineage

_WORD = re.compile(WORD)
#: An exact passage is WORDS words that begin at an anchor; of any STEP passages in a row at least one has its anchor. So a run
#: of WORDS + STEP - 1 = 51 words that two documents share holds a passage of both.
WORDS = 41
STEP = 11
SHINGLE = 5
#: Long lines are cut where the hash of two words in a row is lowest among SPAN places on either side: pieces have at least SPAN
#: words, about 2 * SPAN as a rule, and an edit moves a cut only if it touches the words at it.
SPAN = 50
#: A band is the lowest shingles by PER_BAND hashes; a pair of likeness 0.8 meets with probability 1 - (1 - 0.8 ** 3) ** 6 = 0.986.
BANDS = 6
PER_BAND = 3
LIKENESS = 0.8
ROWS = 512
#: Buckets above this many different paragraphs or words are compared block against block.
BLOCK = 4096
BLOCK_WORDS = 2_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_HIGHEST = np.uint64(2**64 - 1)


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    x = x ^ np.uint64((seed * 0xD1B54A32D192ED03 + 1) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each `n` elements in a row."""
    out = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        out = out * _BASE + hashes[k : len(hashes) - n + 1 + k]
    return out


def _sliding(x: np.ndarray, n: int, of) -> np.ndarray:
    """`of` (minimum or maximum) over each `n` elements in a row."""
    width, out = 1, x
    while 2 * width <= n:
        out, width = of(out[:-width], out[width:]), 2 * width
    return of(out[: len(x) - n + 1], out[n - width :][: len(x) - n + 1]) if width < n else out


def _word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of all texts, and the number of words of each."""
    words: list[str] = []
    sizes = []
    for text in texts:
        own = _WORD.findall(text)
        words += own
        sizes.append(len(own))
    codes, names = pd.factorize(np.array(words, object))
    hashes = np.fromiter((xxhash.xxh64_intdigest(n.encode("utf-8", "surrogatepass"), 11) for n in names), np.uint64, len(names))
    return hashes[codes] if len(codes) else np.zeros(0, np.uint64), np.array(sizes, np.int64)


def _anchored(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word (of all texts' words) and digest of each exact passage."""
    if len(hashes) < WORDS + STEP - 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    left = (np.repeat(starts + sizes, sizes) - np.arange(len(hashes)))  # words from here to the end of the text
    digest = _mix(_runs(hashes, WORDS), 1)
    lowest = _sliding(digest, STEP, np.minimum)
    lowest[left[: len(lowest)] < WORDS + STEP - 1] = 0  # these reach over the end of their text
    padded = np.concatenate([np.zeros(STEP - 1, np.uint64), lowest, np.zeros(STEP - 1, np.uint64)])
    anchor = _sliding(padded, STEP, np.maximum) == digest
    anchor &= left[: len(digest)] >= WORDS
    anchor[1:] &= (digest[1:] != digest[:-1]) | (text_of[1 : len(digest)] != text_of[: len(digest) - 1])  # of a word on and on, the first only
    at = np.flatnonzero(anchor)
    return at, digest[at]


def _lines(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of words of each line, long ones cut; `sizes` has the words of each line."""
    ends = np.cumsum(sizes)
    cuts = np.zeros(0, np.int64)
    if len(hashes) > 2 * SPAN:
        pairs = np.concatenate(([_HIGHEST], _mix(_runs(hashes, 2), 2)))
        starts = (ends - sizes)[sizes > 0]
        pairs[starts] = _HIGHEST  # the word before is on another line
        lowest = _sliding(pairs, SPAN, np.minimum)
        at = np.arange(SPAN, len(pairs) - SPAN)
        inside = (at - np.repeat(ends - sizes, sizes)[at] >= SPAN) & (np.repeat(ends, sizes)[at] - at > SPAN)
        cuts = at[inside & (pairs[at] < lowest[at - SPAN]) & (pairs[at] <= lowest[at + 1])]
    first = np.union1d((ends - sizes)[sizes > 0], cuts)
    return first, np.diff(np.append(first, len(hashes)))


def _banded(hashes: np.ndarray, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Digest and the hash of each band of the paragraphs, which follow each other without gaps; those below SHINGLE words mean nothing."""
    place = np.arange(len(hashes)) - np.repeat(first, n)
    powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(int(n.max()), _BASE))))
    digest = _mix(np.add.reduceat(hashes * powers[place], first) + n.astype(np.uint64), 3)
    shingles = _runs(np.concatenate((hashes, np.zeros(SHINGLE - 1, np.uint64))), SHINGLE)
    beyond = place + SHINGLE > np.repeat(n, n)
    bands = []
    for band in range(BANDS):
        out = np.full(len(first), band, np.uint64)
        for row in range(PER_BAND):
            mixed = _mix(shingles, 10 + band * PER_BAND + row)
            mixed[beyond] = _HIGHEST
            out = _mix(out * _BASE + np.minimum.reduceat(mixed, first), 100)
        bands.append(out)
    return digest, bands


def _paragraph_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for begin in range(0, len(pdf), ROWS):
            part = pdf.iloc[begin : begin + ROWS]
            lines = [t.split("\n") for t in part["text"]]
            hashes, line_sizes = _word_hashes([line for text in lines for line in text])
            if len(hashes) < SHINGLE:
                continue
            counts = np.array([len(text) for text in lines])
            sizes = np.add.reduceat(line_sizes, np.cumsum(counts) - counts)
            rows, starts = np.repeat(part["row"].to_numpy(), sizes), np.repeat(np.cumsum(sizes) - sizes, sizes)
            at, digest = _anchored(hashes, sizes)
            first, n = _lines(hashes, line_sizes)
            line_digest, bands = _banded(hashes, first, n)
            whole = n >= SHINGLE
            columns = {f"band{b}": np.concatenate([np.zeros(len(at), np.int64), x[whole].view(np.int64)]) for b, x in enumerate(bands)}
            where = np.concatenate([at, first[whole]])
            yield pd.DataFrame(
                {
                    "digest": np.concatenate([digest, line_digest[whole]]).view(np.int64),
                    "row": rows[where],
                    "word": (where - starts[where]).astype(np.int32),
                    "words": np.concatenate([np.full(len(at), WORDS), n[whole]]).astype(np.int32),
                    "is_line": np.arange(len(where)) >= len(at),
                    **columns,
                }
            )


def _shingle_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for text, lines in zip(pdf["text"], pdf["lines"]):
            shingles = _runs(_word_hashes([text])[0], SHINGLE)
            rows += [(x["digest"], np.unique(shingles[x["word"] : x["word"] + x["words"] - SHINGLE + 1]).tobytes()) for x in lines]
        yield pd.DataFrame(rows, columns=["digest", "shingles"])


def _links(digests: list[int], shingles: list[bytes]) -> list[tuple[int, int]]:
    """Links that join all of a bucket's paragraphs whose likeness reaches LIKENESS; pairs that hang together already are passed over."""
    sets = [frozenset(np.frombuffer(x, np.int64).tolist()) for x in shingles]
    groups: list[list[int]] = []
    found = []
    for i, own in enumerate(sets):
        joined, apart = [i], []
        for group in groups:
            for j in group:
                other = sets[j]
                if min(len(own), len(other)) < LIKENESS * max(len(own), len(other)):
                    continue
                both = len(own & other)
                if both / (len(own) + len(other) - both) >= LIKENESS:
                    found.append((digests[i], digests[j]))
                    joined = group + joined
                    break
            else:
                apart.append(group)
        groups = [*apart, joined]
    return found


def _link_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of buckets whose rows follow each other."""
    bucket, digests, shingles = None, [], []
    for pdf in batches:
        found = []
        for band, x, y, digest, own in zip(*(pdf[c].tolist() for c in ("band", "x", "y", "digest", "shingles"))):
            if (band, x, y) != bucket:
                found += _links(digests, shingles)
                bucket, digests, shingles = (band, x, y), [], []
            digests.append(digest)
            shingles.append(own)
        yield pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)
    yield pd.DataFrame(_links(digests, shingles), columns=["a", "b"], dtype=np.int64)


def _near(lines: DataFrame, long: DataFrame) -> DataFrame:
    """Links (a, b) of the digests of lines that meet in a band and have the likeness; `lines` has one place of each digest."""
    bands = lines.select("digest", "words", F.explode(F.array(*(f"band{b}" for b in range(BANDS)))).alias("band"))
    members = [F.count("*").alias("n"), F.bit_xor("digest").alias("x"), F.bit_xor(F.xxhash64("digest")).alias("y"), F.sum("words").alias("words")]
    several = bands.groupBy("band").agg(*members).where("n > 1").groupBy("n", "x", "y", "words").agg(F.min("band").alias("band"))  # of buckets with the same members, one
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("words") / BLOCK_WORDS)).cast("int").alias("blocks")
    buckets = cut_lineage(bands.select("digest", "band").join(several.select("band", blocks), "band").select("band", "digest", "blocks"), "paragraph-buckets")
    wanted = lines.select("digest", "row", "word", "words").join(buckets.select("digest").distinct(), "digest", "left_semi")
    per_text = wanted.groupBy("row").agg(F.collect_list(F.struct("word", "words", "digest")).alias("lines"))
    sets = long.join(per_text, "row").select("text", "lines").mapInPandas(_shingle_rows, "digest LONG, shingles BINARY")
    sets = cut_lineage(sets, "paragraph-shingles").dropDuplicates(["digest"])  # rows that repeat
    # every block of a bucket meets every other one
    own, other = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    sides = buckets.withColumn("own", own).withColumn("other", other)
    sides = sides.select("digest", "band", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")).join(sets, "digest")
    return sides.repartition("band", "x", "y").sortWithinPartitions("band", "x", "y").mapInPandas(_link_rows, "a LONG, b LONG")


def repeated_paragraphs(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Paragraphs that occur in more than one document, one row for each place.

    Columns: key, `row` (digest of key and text), `word` (position of the first word), `words` (their number), `cluster`,
    `kept_id` (key of the cluster's first place: lowest key, then position), `removed` (False at this first place).

    Words are compared with A-Z in lower case. Paragraphs are of two kinds. Lines of five words and more, long ones cut by their words
    alone: equal ones are one class, classes that meet in a band are linked if the exact Jaccard likeness of their five-word shingles is at
    least 0.8; all members of a band's bucket are compared, large buckets block against block. Components of classes are the clusters. And
    runs of 41 words that begin at anchors, which depend on the text alone, so passages are cut alike wherever they stand: equal ones are a cluster.

    Lines below five words have no shingle and are no paragraphs; nor has an empty or null text any. Rows equal in key and text are one
    document; a null key is a key (the lowest). An empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("key"), ascii_lower(F.coalesce(F.col(text), F.lit(""))).alias("text")).withColumn("row", F.xxhash64("key", "text"))
    long = rows.select("row", "text").where(F.length("text") >= 2 * SHINGLE - 1)
    schema = "digest LONG, row LONG, word INT, words INT, is_line BOOLEAN, " + ", ".join(f"band{b} LONG" for b in range(BANDS))
    places = cut_lineage(long.mapInPandas(_paragraph_rows, schema), "paragraph-places")

    lines = cut_lineage(places.where("is_line").drop("is_line").dropDuplicates(["digest"]), "paragraph-lines")
    groups = components(_near(lines, long), "paragraph-components").select(F.col("node").alias("digest"), F.col("component").alias("cluster"))
    shared = places.groupBy("digest").agg(F.min("row").alias("low"), F.max("row").alias("high")).where("low < high").select("digest", F.col("digest").alias("cluster"))
    named = shared.union(groups).groupBy("digest").agg(F.min("cluster").alias("cluster"))  # a component is its lowest digest

    keys = rows.select("row", "key").distinct()
    once = places.select("digest", "row", "word", "words").join(named, "digest").select("row", "word", "words", "cluster").distinct()
    once = cut_lineage(once.join(keys, "row"), "paragraph-members")
    head = once.groupBy("cluster").agg(F.min(F.struct("key", "row", "word")).alias("head"), F.min("row").alias("low"), F.max("row").alias("high")).where("low < high")
    kept = (F.col("head.row") == F.col("row")) & (F.col("head.word") == F.col("word"))
    return once.join(head, "cluster").select(F.col("key").alias(key), "row", "word", "words", "cluster", F.col("head.key").alias("kept_id"), (~kept).alias("removed"))


def without_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The documents with the words of removed paragraphs cut out; texts without any are handed on as they are.

    Columns and rows are those of `docs`. A text that consists of repeats only becomes empty. Of a passage that documents share, the first
    keeps it.
    """
    found = repeated_paragraphs(docs, text, key).where("removed")
    cuts = found.groupBy(F.col("row").alias("_row")).agg(F.sort_array(F.collect_set(F.struct("word", "words"))).alias("_cuts"))

    @F.pandas_udf("string")
    def cut(texts: pd.Series, cuts: pd.Series) -> pd.Series:
        return pd.Series([t if c is None else _without(t, [(x["word"], x["words"]) for x in c]) for t, c in zip(texts, cuts)])

    own = F.xxhash64(F.col(key), ascii_lower(F.coalesce(F.col(text), F.lit(""))))
    joined = docs.select(own.alias("_row"), F.col(text).alias("_text"), F.struct(*docs.columns).alias("_doc")).join(cuts, "_row", "left")
    whole = cut(F.col("_text"), F.col("_cuts"))
    return joined.select(*(whole.alias(c) if c == text else F.col(f"_doc.`{c}`").alias(c) for c in docs.columns))


def _without(text: str, cuts: list[tuple[int, int]]) -> str:
    at = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, done = [], 0
    for start, words in cuts:
        out.append(text[done : max(done, at[start])])
        done = max(done, at[start + words])
    return "".join([*out, text[done:]])
