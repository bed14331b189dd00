"""Collocations next to a plain count over all phrases."""

import random
import re
from collections import Counter, defaultdict

import pytest

from sievestream.llm import phrases, text_arrays

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_count, top):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        f = {p: c for p, c in f.items() if c >= min_count}
        swallowed = {p[i:j] for p, c in f.items() for i in range(len(p)) for j in range(i + 1, len(p) + 1) if j - i < len(p) and f[p[i:j]] <= c}
        found = []
        for p, a in f.items():
            if len(p) > 1 and p not in swallowed:
                score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def rows_of(frame):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in frame.collect())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    out = []
    for i in range(150):
        words = [rng.choice(["New", "york", "CITY", "the", "of", "a", "b", f"w{rng.randrange(30)}", "été", "日"]) for _ in range(rng.choice([0, 3, 40, 200]))]
        seps = [rng.choice([" ", "  ", "\t", ". ", ", ", "\n", "!"]) for _ in words]
        out.append((rng.choice(["en", "en", "en", "fr", None]), "".join(map("".join, zip(words, seps)))))
    out += [("en", None), (None, ""), ("fr", " \t. "), ("en", "x " * 500)] + [("en", "strong tea with milk. strong tea")] * 40
    return out


@pytest.mark.parametrize("shards,min_count,top", [(16, 20, 2000), (1, 5, 30), (40, 60, 2000)])
def test_equals_a_plain_count(spark, texts, shards, min_count, top):
    docs = spark.createDataFrame([(*r, "x", 1) for r in texts], "lang STRING, text STRING, phrase STRING, n INT").repartition(5)
    got = rows_of(phrases.collocations(docs, min_count=min_count, top=top, shards=shards))
    assert got == plain(texts, min_count, top) and got


def test_words_beside_long_ones_count_as_elsewhere(spark):
    """A word of more than 64 bytes changes nothing for the other words of its window."""
    rows = [("en", f"strong tea with milk. {'h' * (200 if i == 7 else 3)} at the end") for i in range(60)]
    rows += [("de", "x" * 64 + " a b. " + "y" * 65 + " a b")] * 30
    docs = spark.createDataFrame(rows, "lang STRING, text STRING").repartition(6)
    got = rows_of(phrases.collocations(docs, min_count=60, shards=4))
    assert got == plain(rows, 60, 2000) and got


def test_a_word_has_one_hash_wherever_it_lies():
    alone = next(phrases._words([b"tea"]))
    beside = next(phrases._words([b"tea " + b"h" * 65 + b" " + b"h" * 129 + b" " + b"h" * 64 + b"g" + b"h" * 64]))
    assert (alone.hash[0], alone.check[0]) == (beside.hash[0], beside.check[0])
    assert len(set(beside.hash.tolist())) == 4


def test_long_texts_are_cut_between_pieces_only(spark, monkeypatch):
    monkeypatch.setattr(text_arrays, "WINDOW", 300)
    rng = random.Random(9)
    long = "".join(rng.choice(["a b c", "d", " ", ". ", "e f", " g "]) for _ in range(5000))
    parts = list(phrases._words([long.encode(), b"a b", ("h" * 2000).encode()]))
    got = Counter(w.phrase(i, i) for w in parts for i in range(len(w.start)))
    assert got == Counter(re.findall("[^ .]+", f"{long} a b {'h' * 2000}"))
    pairs = Counter(w.phrase(i, i + 1) for w in parts for i in range(len(w.start) - 1) if w.piece[i] == w.piece[i + 1])
    want = Counter()
    for piece in [*long.split("."), "a b"]:
        words = piece.split()
        want.update(map(" ".join, zip(words, words[1:])))
    assert pairs == want


def test_nothing(spark, none):
    assert phrases.collocations(none.withColumnRenamed("source", "lang")).collect() == []
    blank = spark.createDataFrame([("en", None), (None, ""), ("en", " . ")], "lang STRING, text STRING")
    assert phrases.collocations(blank, min_count=1).collect() == []


def test_filters_lose_nothing(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) AS key")
    import numpy as np

    made = phrases._filter(keys)
    own = np.array([r["key"] for r in keys.collect()]).view(np.uint64)
    assert made.has(own).all()
    assert made.has(text_arrays.mixed(own + np.uint64(1))).mean() < 0.2


def test_products_beyond_64_bits_are_exact(spark):
    row = spark.sql("SELECT (CAST(1000 AS DECIMAL(4,0)) * CAST(900000000007L AS DECIMAL(17,0)) * CAST(90000000000001L AS DECIMAL(17,0))) div (CAST(900000000011L AS DECIMAL(19,0)) * CAST(900000000013L AS DECIMAL(19,0))) AS s").first()
    assert row["s"] == 1000 * 900000000007 * 90000000000001 // (900000000011 * 900000000013)


def test_a_task_holds_small_batches_and_one_part_at_a_time(spark, texts, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, write = spark.conf.get(name), {}, phrases.cut_lineage

    def noted(df, purpose):
        seen[purpose] = (int(spark.conf.get(name)), df._jdf.queryExecution().executedPlan().toString())
        return write(df, purpose)

    monkeypatch.setattr(phrases, "cut_lineage", noted)
    docs = spark.createDataFrame(texts, "lang STRING, text STRING")
    assert rows_of(phrases.collocations(docs, min_count=60)) == plain(texts, 60, 2000)
    assert spark.conf.get(name) == before
    assert len(seen) == 7 and all(rows <= phrases._BATCH for rows, _ in seen.values())
    assert all("Sort [part" in seen[f"phrases-{k}"][1] for k in range(2, 6))
