"""Encoding and decoding with a word-end BPE vocabulary: frequent words from a minimal transducer, the others merged exactly."""

from __future__ import annotations

import heapq
import json
import mmap
import os
import re
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from sievestream.llm.common import work_dir
from sievestream.llm.tokens import _Remembering

#: Most frequent words (between white space) whose parts are compiled; the driver gets these, of at most LONGEST bytes each, and no others.
LEXICON_WORDS = 50_000
LONGEST = 40
#: Distinct words that a task counts before it hands its counts on.
_COUNTED = 200_000
#: Characters or tokens that a worker has in hand at once, about; one longer text alone may be more.
_CHARACTERS = 1_000_000

#: Up to so many bytes a word is merged without a heap.
_SHORT = 32

_SPACE = re.compile("[ \t\n\r]+")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in vocabularies of this family: printable ones for themselves, the others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class Merges:
    """Vocabulary and merges of a tokenizer file (BPE over bytes with a mark at the end of each word), and its own cutting of texts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("unk_token") or model.get("continuing_subword_prefix") or not model.get("end_of_word_suffix"):
            raise ValueError("a BPE vocabulary with word ends and without unknown tokens is needed")
        self.end = model["end_of_word_suffix"]
        self.ids = model["vocab"]
        pairs = (tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"])
        self.ranks = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (1 + max(*self.ids.values(), *self.special.values()))
        for token, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = token
        characters = byte_characters()
        self.byte_of = {c: b for b, c in enumerate(characters)}
        self.inner = [self.ids[c] for c in characters]
        self.last = [self.ids[c + self.end] for c in characters]
        self.library = Tokenizer.from_file(path)
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def words(self, text: str) -> list[bytes]:
        """The words of a text without special strings, normalised and cut by the library."""
        cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.byte_of.__getitem__, piece)) for piece, _ in cut]

    def words_of_each(self, texts: Sequence[str]) -> list[list[bytes]]:
        """words() of many texts without white space, which go through the library joined by blanks: no word reaches over one."""
        joined = self.library.normalizer.normalize_str(" ".join(texts))
        parts = joined.split(" ")
        if len(parts) != len(texts):  # white space of another kind inside
            return [self.words(text) for text in texts]
        starts = np.cumsum([0, *(len(p) + 1 for p in parts[:-1])])
        cut = self.library.pre_tokenizer.pre_tokenize_str(joined)
        owners = np.searchsorted(starts, [at for _, (at, _) in cut], side="right") - 1
        out: list[list[bytes]] = [[] for _ in texts]
        for owner, (piece, _) in zip(owners.tolist(), cut):
            out[owner].append(piece.encode() if piece.isascii() else bytes(map(self.byte_of.__getitem__, piece)))
        return out

    def merge(self, word: bytes) -> tuple[int, ...]:
        """Ids of a word: of all neighbours that can merge the pair of lowest rank does, the leftmost first."""
        ids = [*map(self.inner.__getitem__, word[:-1]), self.last[word[-1]]]
        if len(ids) <= _SHORT:
            return self._merge_short(ids)
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        waiting = [(*self.ranks[pair], at, pair) for at, pair in enumerate(zip(ids, ids[1:])) if pair in self.ranks]
        waiting = [(rank, at, made, pair) for rank, made, at, pair in waiting]
        heapq.heapify(waiting)
        while waiting:
            _, at, made, pair = heapq.heappop(waiting)
            right = after[at]
            if ids[at] != pair[0] or right >= len(ids) or ids[right] != pair[1]:
                continue
            ids[at], ids[right] = made, -1
            after[at] = after[right]
            if after[at] < len(ids):
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < len(ids):
                    new = (ids[left], ids[after[left]])
                    if new in self.ranks:
                        rank, product = self.ranks[new]
                        heapq.heappush(waiting, (rank, left, product, new))
        return tuple(i for i in ids if i >= 0)

    def _merge_short(self, ids: list[int]) -> tuple[int, ...]:
        """The same for few ids: the best pair is looked for each time."""
        known, none = self.ranks.get, (len(self.ranks), 0)
        found = [known(pair, none) for pair in zip(ids, ids[1:])]
        while found:
            best = min(found)
            if best is none:
                break
            at = found.index(best)
            ids[at : at + 2] = [best[1]]
            del found[at]
            if at < len(found):
                found[at] = known((ids[at], ids[at + 1]), none)
            if at:
                found[at - 1] = known((ids[at - 1], ids[at]), none)
        return tuple(ids)


@lru_cache(maxsize=2)
def _merges(path: str) -> Merges:
    """One for each worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Merges(path)


def _common(a: Sequence[int], b: Sequence[int]) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def compile_transducer(entries: dict[bytes, tuple[int, ...]]) -> bytes:
    """The minimal acyclic transducer from words to ids, as a file to be memory-mapped.

    Words are added in order. What can no longer change, the part of the last word beyond what the next one shares, is looked
    up among the finished states: equal ends of words, outputs included, become one state. Ids stand on the first arc after
    which they are certain, so that words which share letters but not ids move them on, and equal ends stay equal.

    File: numbers of states, arcs and ids; arcs as (state * 256 + byte), ascending, their targets and the ends of their outputs; the
    outputs' ends of final states (-1 before a state that is none); the ids.
    """
    known: dict[tuple, int] = {}
    chain: list[dict] = [{"arcs": [], "final": None}]  # arcs: [byte, target, output]

    def settle(down_to: int) -> None:
        while len(chain) > down_to:
            state = chain.pop()
            mark = (state["final"], tuple(map(tuple, state["arcs"])))
            target = known.setdefault(mark, len(known))
            if chain:
                chain[-1]["arcs"][-1][1] = target

    previous = b""
    for word in sorted(entries):
        if not word:
            raise ValueError("a word has at least one byte")
        shared, rest = _common(previous, word), tuple(entries[word])
        settle(shared + 1)
        for depth in range(shared):
            arc = chain[depth]["arcs"][-1]
            same = _common(arc[2], rest)
            pushed, arc[2], rest = arc[2][same:], arc[2][:same], rest[same:]
            if pushed:
                below = chain[depth + 1]
                for later in below["arcs"]:
                    later[2] = pushed + later[2]
                if below["final"] is not None:
                    below["final"] = pushed + below["final"]
        for byte in word[shared:]:
            chain[-1]["arcs"].append([byte, None, rest])
            chain.append({"arcs": [], "final": None})
            rest = ()
        chain[-1]["final"] = rest
        previous = word
    settle(1)
    root = chain[0]
    states = [*known, (root["final"], tuple(map(tuple, root["arcs"])))]

    keys, targets, outputs, tails = [], [], [], []
    for number, (final, arcs) in enumerate(states):
        tails.append(final)
        for byte, target, output in arcs:
            keys.append(number * 256 + byte)
            targets.append(target)
            outputs.append(output)
    pool = [*outputs, *(t or () for t in tails)]
    ends = np.cumsum([0, *map(len, pool)], dtype=np.int64)
    finals = np.array([t is not None for t in tails], np.int64)
    ids = np.array([i for output in pool for i in output], np.int64)
    head = np.array([len(states), len(keys), len(ids)], np.int64)
    return b"".join(np.asarray(part, np.int64).tobytes() for part in (head, keys, targets, ends, finals, ids))


class Transducer:
    """A compiled transducer, memory-mapped: all workers of a machine share its pages."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        n_states, n_arcs, n_ids = np.frombuffer(self.map, np.int64, 3).tolist()
        sizes, at = [n_arcs, n_arcs, n_arcs + n_states + 1, n_states, n_ids], 24
        parts = []
        for size in sizes:
            parts.append(np.frombuffer(self.map, np.int64, size, at))
            at += 8 * size
        self.keys, self.targets, self.ends, self.finals, self.ids = parts
        self.root = n_states - 1

    def look_up(self, words: Sequence[bytes]) -> list[tuple[int, ...] | None]:
        """The ids of each word, None for those that are not in the lexicon; all words go through the states side by side."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        found: list[tuple[int, ...] | None] = [None] * len(words)
        if not len(words) or not len(self.keys):
            return found
        letters = np.frombuffer(b"".join(words), np.uint8)
        first = np.cumsum(lengths) - lengths
        state = np.full(len(words), self.root, np.int64)
        alive = np.flatnonzero(lengths > 0)
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        ended = []
        depth = 0
        while len(alive):
            key = state[alive] * 256 + letters[first[alive] + depth]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            alive, arc = alive[hit], arc[hit]
            state[alive] = self.targets[arc]
            emits = self.ends[arc + 1] > self.ends[arc]
            steps.append((alive[emits], arc[emits]))
            depth += 1
            over = lengths[alive] == depth
            done = alive[over]
            ended.append(done[self.finals[state[done]] == 1])
            alive = alive[~over]
        ended = np.concatenate(ended) if ended else np.empty(0, np.int64)
        accepted = np.zeros(len(words), bool)
        accepted[ended] = True
        for at in ended.tolist():
            found[at] = ()
        for at, arc in [*steps, (ended, len(self.keys) + state[ended])]:
            keep = accepted[at]
            for word, low, high in zip(at[keep].tolist(), self.ends[arc[keep]].tolist(), self.ends[arc[keep] + 1].tolist()):
                if high > low:
                    found[word] += tuple(self.ids[low:high].tolist())
        return found


class _Encoder(_Remembering):
    """Ids of what stands between white space, by transducer and merges; a worker remembers what it has seen lately."""

    def __init__(self, path: str, lexicon: str):
        super().__init__()
        self.merges, self.transducer = _merges(path), Transducer(lexicon)

    def encode(self, pieces: list[str]) -> list[bytes]:
        merges = self.merges
        parts: list[list] = merges.words_of_each(pieces)  # of each piece: words, or ids of special strings
        if merges.specials and merges.specials.search(" ".join(pieces)):
            for at, piece in enumerate(pieces):
                spans = merges.specials.split(piece)
                if len(spans) > 1:
                    parts[at] = [x for span in spans for x in ([merges.special[span]] if span in merges.special else merges.words(span))]
        words = list({x for part in parts for x in part if isinstance(x, bytes)})
        ids = dict(zip(words, self.transducer.look_up(words)))
        for word, known in ids.items():
            if known is None:
                ids[word] = merges.merge(word)
        flat = [ids[part[0]] if len(part) == 1 and isinstance(part[0], bytes) else [i for x in part for i in (ids[x] if isinstance(x, bytes) else (x,))] for part in parts]
        data = np.array([i for part in flat for i in part], "<i4").tobytes()
        ends = np.cumsum([0, *map(len, flat)]).tolist()
        return [data[4 * a : 4 * b] for a, b in zip(ends, ends[1:])]

    def ids(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        cut = [_SPACE.split(t) for t in texts]
        long = self.learn(cut)
        ids = [b"".join(map(self.young.__getitem__, pieces)) for pieces in cut]
        self.forget(long)
        return ids


_ENCODERS: dict[tuple[str, str], _Encoder] = {}


def frequent_words(docs: DataFrame, n: int = LEXICON_WORDS, text: str = "text") -> list[str]:
    """The `n` most frequent words between white space, of at most LONGEST bytes; of equally frequent ones the first by their bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def handed_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for value in batch.column(0).to_pylist():
                counts.update(w for w in _SPACE.split(value or "") if 0 < len(w) <= LONGEST)
                if len(counts) >= _COUNTED:
                    yield handed_on()
        yield handed_on()

    counted = docs.select(text).mapInArrow(count, "word STRING, n LONG").where(F.octet_length("word") <= LONGEST)
    best = counted.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(n)
    return [r["word"] for r in best.collect()]


def write_lexicon(spark: SparkSession, words: Sequence[str], path: str, folder: str) -> str:
    """Compiles what the words consist of, writes the file to `folder` in shared storage and has Spark hand it to all executors; its name there."""
    merges = _merges(path)
    parts = {w for word in words if not (merges.specials and merges.specials.search(word)) for w in merges.words(word)}
    data = compile_transducer({w: merges.merge(w) for w in parts})
    name = f"lexicon-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{name}")
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    spark.sparkContext.addFile(target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString())
    return name


def _encoder(path: str, lexicon: str) -> _Encoder:
    where = SparkFiles.get(lexicon)
    if (path, where) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, where] = _Encoder(path, where)
    return _ENCODERS[path, where]


def _encoded(batches: Iterator[pa.RecordBatch], path: str, lexicon: str) -> Iterator[pa.RecordBatch]:
    """(key, ids) of batches of (key, text)."""
    encoder = _encoder(path, lexicon)
    for batch in batches:
        for low, high in _slices(pc.utf8_length(batch.column(1)).fill_null(0).to_pylist(), _CHARACTERS):
            part = batch.slice(low, high - low)
            ids = encoder.ids(part.column(1).fill_null("").to_pylist())
            ends = np.cumsum([0, *(len(i) // 4 for i in ids)])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4")))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["key", "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], path: str, skip_special: bool) -> Iterator[pa.RecordBatch]:
    """(key, ids, decoded) of batches of (key, ids)."""
    merges = _merges(path)
    left_out = [*(merges.special.values() if skip_special else ()), *(i for i, t in enumerate(merges.tokens) if not t)]
    known = np.ones(len(merges.tokens), bool)
    known[left_out] = False
    tokens = np.array(merges.tokens, object)
    for batch in batches:
        for low, high in _slices(pc.list_value_length(batch.column(1)).fill_null(0).to_pylist(), _CHARACTERS):
            part = batch.slice(low, high - low)
            flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum([0, *pc.list_value_length(part.column(1)).fill_null(0).to_pylist()]).tolist()
            inside = (flat >= 0) & (flat < len(known))
            inside[inside] = known[flat[inside]]
            texts = [" ".join(tokens[flat[start:end][inside[start:end]]].tolist()) for start, end in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=["key", "ids", "decoded"])


def _own_lexicon(rows: DataFrame, path: str, words: int) -> str:
    spark = rows.sparkSession
    return write_lexicon(spark, frequent_words(rows, words), path, work_dir(spark, "lexicon"))


def encode(docs: DataFrame, path: str, lexicon: str | None = None, text: str = "text", key: str = "doc_id", words: int = LEXICON_WORDS) -> DataFrame:
    """(key, ids): the ids that the tokenizer of the file `path` gives each whole text, without special tokens at its ends.

    `lexicon` names a file of write_lexicon(); without one the `words` most frequent words of the texts themselves are compiled. Workers map it into memory, look up
    what they meet for the first time, and merge by rank what the lexicon lacks: ids do not depend on it. Special strings inside texts become
    their ids. `path` has to exist on the executors.

    A null text is empty: no ids. Repeated rows and texts each get their row; an empty table gives none. White space ends every word, so texts of
    any length go word by word; a single word's memory grows with the word. Columns besides key and text are ignored, whatever their names.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    name = lexicon or _own_lexicon(rows, path, words)
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: _encoded(batches, path, name), f"key {kind}, ids ARRAY<INT>").withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, ids: str = "ids", key: str = "doc_id", skip_special: bool = False) -> DataFrame:
    """(key, ids, decoded): the tokens of the ids, joined by blanks, as the library does for a file without decoder; special tokens stay unless skipped.

    Ids that the vocabulary lacks are left out. Null ids give an empty text. Repeated rows each get their row; an empty table gives none.
    """
    rows = encoded.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: _decoded(batches, path, skip_special), f"key {kind}, ids ARRAY<INT>, decoded STRING").withColumnRenamed("key", key)


def round_trip(docs: DataFrame, path: str, lexicon: str | None = None, text: str = "text", key: str = "doc_id", words: int = LEXICON_WORDS) -> DataFrame:
    """(key, ids, decoded): encode() and decode() of every text one after the other in the same worker."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    name = lexicon or _own_lexicon(rows, path, words)
    kind = rows.schema["key"].dataType.simpleString()
    both = rows.mapInArrow(lambda batches: _decoded(_encoded(batches, path, name), path, False), f"key {kind}, ids ARRAY<INT>, decoded STRING")
    return both.withColumnRenamed("key", key)


def _slices(sizes: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of places whose sizes sum up to about `most`; one place alone may be larger."""
    low, total = 0, 0
    for at, size in enumerate(sizes):
        if at > low and total + size > most:
            yield low, at
            low, total = at, 0
        total += size
    if low < len(sizes):
        yield low, len(sizes)
