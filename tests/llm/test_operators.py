"""Each operator next to a plain version of itself on a small odd table, and on an empty one."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from sievestream.llm import common, embeddings, language_model, mixing, packing, paragraphs, sharding, simhash, sketches, token_counts, toxicity

WORD = re.compile(common.WORD)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def linked(nodes, pairs):
    """Smallest reachable node of each."""
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    return {n: root(n) for n in nodes}


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 60)] + [(100, k) for k in range(101, 140)] + [(5, 5), (200, 150)]
    got = dict(map(tuple, common.components(spark.createDataFrame(pairs, "a LONG, b LONG")).collect()))
    want = linked({n for p in pairs for n in p}, pairs)
    assert got == want
    assert common.components(spark.createDataFrame([], "a LONG, b LONG")).count() == 0


def test_in_order_numbers_and_sums(spark):
    df = spark.range(1000).selectExpr("id * 7919 % 1009 AS k", "id % 5 AS size").repartition(7)
    got = sorted((r["_idx"], r["k"], r["_before"], r["size"]) for r in common.in_order(df, ["k"], "size").collect())
    want = sorted((r["k"], r["size"]) for r in df.collect())
    assert [(i, k, sum(s for _, s in want[:i]), s) for i, (k, s) in enumerate(want)] == got


# 2
def test_shards(odd, none):
    got = sharding.shard_by_bytes(odd, 4).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(d for d, _ in texts(odd))
    for (d, t), r in zip(sorted(texts(odd), key=lambda x: (x[0], x[1] or "")), sorted(got, key=lambda r: (r["doc_id"], r["size"]))):
        assert r["size"] == len((t or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((t or "").encode())
    of_text = defaultdict(set)
    sizes, slots = Counter(), defaultdict(list)
    text_of = dict(texts(odd))
    for r in got:
        of_text[text_of[r["doc_id"]] or ""].add(r["shard"])
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in of_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = Counter()
    for r in got:
        groups[text_of[r["doc_id"]] or ""] += r["size"]
    assert max(sizes.values()) <= sum(sizes.values()) / 4 + max(groups.values())
    assert sharding.shard_by_bytes(none, 4).count() == 0


def test_a_group_above_a_share_leaves_no_shard_empty(spark):
    rows = [(i, "same text") for i in range(300)] + [(1000 + i, f"text {i:03d}") for i in range(200)]
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(6), 8).collect()
    assert len({r["shard"] for r in got if r["doc_id"] < 1000}) == 1
    assert {r["shard"] for r in got} == set(range(8))


# 3
def water_filling(sizes, weights, cap):
    total, targets, free = sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    while free:
        rest = total - sum(targets[i] for i in range(len(sizes)) if i not in free)
        over = [i for i in free if rest * w[i] / sum(w[j] for j in free) > cap * sizes[i] + 1e-9]
        if not over:
            for i in free:
                targets[i] = rest * w[i] / sum(w[j] for j in free)
            break
        for i in over:
            targets[i] = cap * sizes[i]
            free.discard(i)
    return targets


def test_mix(odd, none):
    got = mixing.mix(odd, (5, 2, 1), 3).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix(odd.repartition(3), (5, 2, 1), 3).collect()))
    size = Counter()
    for r in odd.collect():
        size[r["source"]] += len(WORD.findall(r["text"] or ""))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, water_filling([size[s] for s in order], (5, 2, 1), 3)))
    taken, most = Counter(), Counter()
    for r in got:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(targets[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        most[r["source"]] = max(most[r["source"]], r["size"])
    assert all(abs(taken[s] - targets[s]) <= most[s] for s in order)
    assert mixing.mix(none, (5, 2, 1), 3).count() == 0
    rows = mixing.repeated(odd, (5, 2, 1), 3)
    assert rows.columns == odd.columns and rows.count() >= sum(r["copies"] for r in got)


# 4
def test_token_counts_and_cache(spark, odd, none, tmp_path):
    cache = str(tmp_path / "cache")
    library = Tokenizer.from_file(WORDS)
    want = sorted((d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in texts(odd))
    assert sorted(map(tuple, token_counts.count_tokens(odd, cache, WORDS).collect())) == want
    stored = spark.read.parquet(cache).count()
    assert stored == len({re.sub("[ \t\n\r]+", " ", t or "") for _, t in texts(odd)})
    more = odd.union(spark.createDataFrame([(999, "only this is new", "a", "", "", 0, "")], odd.schema))
    assert token_counts.count_tokens(more, cache, WORDS).count() == len(want) + 1
    assert spark.read.parquet(cache).count() == stored + 1
    assert token_counts.count_tokens(none, cache, WORDS).count() == 0


# 5
def test_packing(odd, none):
    got = packing.pack(odd.dropDuplicates(["doc_id"]), 256, BYTES, 1).collect()
    library, pieces, bins = Tokenizer.from_file(BYTES), defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for d, t in texts(odd.dropDuplicates(["doc_id"])):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(pieces.pop(d), key=lambda r: r["start"]):
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(part))
            at += r["length"]
        assert at == len(ids)
    assert not pieces
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r["length"] for r in got)
    assert len(bins) <= math.ceil(total / 256) * 1.1 + 1
    assert packing.pack(none, 256, BYTES, 1).count() == 0


def test_patterns_reach_the_bound():
    sizes, demand = np.array([8, 24, 56, 88, 120, 136, 184, 200]), np.array([90, 40, 71, 33, 50, 61, 24, 12.0])
    used = packing.generate_patterns(sizes, demand, 256)
    assert np.allclose(sum(p * x for p, x in used), demand, atol=1e-4)
    assert all(p @ (sizes // 8) <= 32 for p, _ in used)
    assert sum(x for _, x in used) <= sizes @ demand / 256 * 1.05


# 6
def slow_fingerprint(text, n):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(odd, none):
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(odd, 3).collect()}
    fp = [(d, slow_fingerprint(t, 3)) for d, t in texts(odd)]
    near = [(a, b) for (a, x), (b, y) in itertools.combinations(fp, 2) if bin(x ^ y).count("1") <= 3]
    names = linked({d for d, _ in fp}, near)
    assert got == {(d, f"{x:016x}", names[d]) for d, x in fp}
    assert simhash.near_duplicates(none, 3).count() == 0
    kept = simhash.representatives(odd, 3)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(names.values()))


def test_simhash_links_every_distance(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 20, dtype=np.int64)
    found = [int(b) for b in base]
    for b in base:
        for bits in ([0], [31, 32], [5, 40, 63], [0, 1, 2], [33, 50, 62], [1, 2, 3, 4]):
            x = int(b) & (2**64 - 1)
            for bit in bits:
                x ^= 1 << bit
            found.append(x - 2**64 if x >= 2**63 else x)
    got = {tuple(r) for r in simhash.links(spark.createDataFrame([(x,) for x in set(found)], "fp LONG")).collect()}
    want = {(a, b) for a, b in itertools.permutations(set(found), 2) if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    assert got == want


def test_simhash_variants_are_made_by_many_tasks(spark, monkeypatch):
    """A few bytes in one partition, as a written table of fingerprints is read: no task makes the variants of all."""
    monkeypatch.setattr(simhash, "TASK_FINGERPRINTS", 100)
    distinct = spark.range(2000).select(common.F.xxhash64("id").alias("fp")).coalesce(1)
    counts = [r["count"] for r in simhash._variants(distinct).groupBy(common.F.spark_partition_id().alias("task")).count().collect()]
    assert sum(counts) == 64 * 2000 and len(counts) >= 15 and max(counts) <= 2 * 64 * 100


# 7
def test_language_model(odd, none):
    got = {r["doc_id"]: r for r in language_model.score_texts(odd.dropDuplicates(["doc_id"])).collect()}
    tokens = {d: [*WORD.findall((t or "").translate(LOWER)), ""] for d, t in texts(odd.dropDuplicates(["doc_id"]))}
    train = {d for d in tokens if zlib.crc32(str(d).encode()) % 7 != 2}
    c = Counter(t for d in train for t in tokens[d])
    n, v = sum(c.values()), len(c)
    assert set(got) == set(tokens)
    for d, ts in tokens.items():
        r = got[d]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (d not in train, len(ts), sum(c[t] > 0 for t in ts), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts))
        assert r["score"] <= 0
    assert language_model.score_texts(none).count() == 0


def test_language_model_mixes_its_estimates(spark, monkeypatch):
    """Over several blocks and slices, against plain counts with the same weights."""
    monkeypatch.setattr(language_model, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(language_model, "SLICE_ROWS", 500)
    rows = [(i, " ".join(f"t{(i * k * k) % 37}" for k in range(60))) for i in range(200)]
    weights = []
    learn = language_model.learn_weights
    monkeypatch.setattr(language_model, "learn_weights", lambda cells: weights.append(learn(cells)) or weights[-1])
    got = {r["doc_id"]: r["score"] for r in language_model.score_texts(spark.createDataFrame(rows, "doc_id LONG, text STRING")).collect()}
    tokens = {d: [*t.split(), ""] for d, t in rows}
    train = [d for d in tokens if zlib.crc32(str(d).encode()) % 7 != 2]
    one = Counter(t for d in train for t in tokens[d])
    two = Counter(p for d in train for p in zip(["", *tokens[d]], tokens[d]))
    n, v = sum(one.values()), len(one)
    for d, ts in tokens.items():
        total = 0.0
        for a, b in zip(["", *ts], ts):
            w = weights[0][min(int(math.log2(max(one[a], 1))) + (one[a] > 0), language_model.BUCKETS - 1)]
            parts = [two[a, b] / max(one[a], 1), one[b] / n, 1 / (v + 1)]
            total += math.log10(w @ parts / (w @ [one[a] > 0, 1, 1]))
        assert got[d] == pytest.approx(total)
    assert weights[0].sum(axis=1) == pytest.approx(np.ones(language_model.BUCKETS))


# 8
def test_fingerprints(odd, none, monkeypatch):
    monkeypatch.setattr(sketches, "BUCKET_BYTES", 20_000)
    docs = odd.dropDuplicates(["doc_id"])
    got = {r["doc_id"]: r for r in sketches.neighbours(docs).collect()}
    rows = sorted((d, t or "") for d, t in texts(docs))
    assert sorted(got) == [d for d, _ in rows]
    of_text = defaultdict(set)
    for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert (got[d]["n_chars"], got[d]["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        of_text[t].add(got[d]["fingerprint"])

        def shingles(x):
            w = WORD.findall(x)
            return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

        a, b = shingles(t), shingles(edited)
        if len(a | b) <= sketches.K:  # exact as long as the sketch holds everything
            assert got[d]["near_edited"] == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
        else:
            assert abs(got[d]["near_edited"] - len(a & b) / len(a | b)) < 0.2
    assert all(len(f) == 1 for f in of_text.values())
    assert sketches.neighbours(none).count() == 0


def test_sketches_merge_and_count(spark):
    df = spark.range(4).selectExpr("id", "transform(sequence(id * 1000, id * 1000 + 1999), x -> xxhash64(x)) AS h")
    parts = df.select("id", sketches.sketch(df["h"]).alias("s"))
    a = parts.where("id = 0").select(parts["s"].alias("a")).crossJoin(parts.where("id = 1").select(parts["s"].alias("b")))
    n, like, within = a.select(sketches.distinct_count(sketches.merge(a["a"], a["b"])), sketches.resemblance(a["a"], a["b"]), sketches.containment(a["a"], a["b"])).first()
    assert abs(n / 3000 - 1) < 0.3 and abs(like - 1 / 3) < 0.15 and abs(within - 1 / 2) < 0.2
    whole = df.selectExpr("explode(h) AS h").selectExpr("slice(array_sort(collect_set(h)), 1, 128) AS s").first()["s"]
    merged = sketches.merge_groups(parts.selectExpr("1 AS g", "s"), ["g"], "s").first()["s"]
    assert merged == whole


# 9
def test_paragraphs(odd, none):
    docs = odd.dropDuplicates(["doc_id"])
    got = paragraphs.repeated_paragraphs(docs).collect()
    windows = lambda t, n: {tuple(w[i : i + n]) for w in [WORD.findall((t or "").translate(LOWER))] for i in range(len(w) - n + 1)}
    seen = {n: defaultdict(set) for n in (37, 51)}
    for d, t in texts(docs):
        for n in seen:
            for w in windows(t, n):
                seen[n][w].add(d)
    sure, possible = ({d for ds in seen[n].values() if len(ds) > 1 for d in ds} for n in (51, 37))
    assert sure and sure <= {r["doc_id"] for r in got} <= possible
    cut = paragraphs.without_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    left, before = defaultdict(set), dict(texts(docs))
    for d, t in texts(cut):
        assert d in possible or t == before[d]
        for w in windows(t, 51):
            left[w].add(d)
    assert all(len(ds) == 1 for ds in left.values())
    assert paragraphs.without_repeats(none).count() == 0


# 10
def test_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 16)).astype("float32")
    rows = [b for b in base] + [base[0]] * 5 + [base[1] * 2.0]
    for _ in range(150):  # a dense group, larger than the window
        rows.append(base[2] + 0.05 * rng.standard_normal(16).astype("float32"))
    for k in range(40):
        rows.append(base[k] + 0.25 * rng.standard_normal(16).astype("float32"))
    data = [(i * 13 % 1009, [float(x) for x in v]) for i, v in enumerate(rows)]
    bad = [(2001, None), (2002, []), (2003, [0.0] * 16), (2004, [None] + [1.0] * 15), (2005, [float("nan")] * 16), (2006, [float("inf")] * 16), (2007, [1.0, 2.0])]
    df = spark.createDataFrame([*data, *bad], "vec_id LONG, embedding ARRAY<FLOAT>").repartition(5)
    got = {r["vec_id"]: r for r in embeddings.near_vectors(df, window=32).collect()}
    ids = [i for i, _ in data]
    x = np.array([v for _, v in data], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    want = {i: int(n) for i, n in zip(ids, near.sum(axis=1))}
    found = sum(got[i]["n_links"] for i in ids)
    assert found >= 0.9 * sum(want.values()) and all(got[i]["n_links"] <= want[i] for i in ids)
    names = linked(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))])
    assert sum(got[i]["component_id"] == names[i] for i in ids) >= 0.9 * len(ids)
    for i, _ in bad:
        assert tuple(got[i]) == (i, 0, i, True)
    assert embeddings.near_vectors(spark.createDataFrame([], df.schema)).count() == 0


# 1
def test_toxicity(spark, odd, none):
    rng = np.random.default_rng(4)
    plain = [f"plain{k}" for k in range(300)]
    rows, marks = [], []
    for i in range(400):
        words = list(rng.choice(plain, 40))
        if i % 5 == 0:
            for at in rng.choice(40, 4, replace=False):
                words[at] = ["idiot", "scum", "stupid"][at % 3]
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 5 == 0) if i % 2 == 0 else None))
    marks += [(None, 1), (0, 0), (99999, 1)]
    docs, labels = spark.createDataFrame(rows, "doc_id LONG, text STRING"), spark.createDataFrame(marks, "doc_id LONG, toxic INT")
    got = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    assert len(got) == 400 and all(r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    assert sum(r["predicted"] == (d % 5 == 0) for d, r in got.items() if r["held_out"]) >= 0.97 * sum(r["held_out"] for r in got.values())
    # labels of the held-out fold change nothing
    other = labels.where("toxic IS NULL OR crc32(cast(cast(doc_id AS STRING) AS BINARY)) % 4 <> 2")
    assert {d: r["score"] for d, r in got.items()} == {r["doc_id"]: r["score"] for r in toxicity.score(docs, other).collect()}
    assert {r["doc_id"] for r in toxicity.without_toxic(docs, labels).collect()} == {d for d, r in got.items() if not r["predicted"]}
    assert toxicity.score(odd, labels.limit(0)).where("score <> 0").count() == 0
    assert toxicity.score(odd, labels.where("toxic = 1")).count() == odd.count()
    assert toxicity.score(none, labels).count() == 0


# Findings of round 2
def test_near_paragraphs_are_found(spark):
    rng = np.random.default_rng(21)
    fresh = lambda n: [f"w{x}" for x in rng.integers(0, 50_000, n)]
    rows = []
    likeness = lambda x, y: len(x & y) / len(x | y)
    shingles = lambda w: {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    wanted = {}
    for i in range(300):
        base = fresh(int(rng.integers(50, 100)))
        other = list(base)
        for at in rng.choice(len(base), int(rng.integers(1, 4)), replace=False):
            other[at] = f"new{at}"
        for half, line in enumerate((base, other)):
            rows.append((2 * i + half, "\n".join(" ".join(x) for x in (fresh(20), line, fresh(int(rng.integers(5, 30)))))))
        wanted[2 * i + 1] = likeness(shingles(base), shingles(other)) >= 0.8
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(4)
    removed = {r["doc_id"] for r in paragraphs.repeated_paragraphs(docs).where("removed AND words >= 50").collect() if r["kept_id"] == r["doc_id"] - 1}
    want = {d for d, w in wanted.items() if w}
    assert len(want) > 100 and len(removed & want) >= 0.95 * len(want)
    # a line is found as far as its likeness goes; cut pieces of a line that differs more can be alike
    assert all(wanted[d] or len(rows[d][1].split("\n")[1].split()) > 2 * paragraphs.SPAN - 1 for d in removed)


def test_edits_move_few_cuts_of_a_long_line(spark):
    rng = np.random.default_rng(22)
    base = [f"w{x}" for x in rng.integers(0, 50_000, 2000)]
    other = list(base)
    for at in range(100, 2000, 200):
        other[at] = "new"
    docs = spark.createDataFrame([(1, " ".join(base)), (2, "some words before " + " ".join(other))], "doc_id LONG, text STRING")
    left = dict(texts(paragraphs.without_repeats(docs)))
    assert left[1] == " ".join(base) and len(left[2].split()) <= 400


def test_every_member_of_a_bucket_is_compared(spark, monkeypatch):
    monkeypatch.setattr(paragraphs, "BLOCK", 4)
    monkeypatch.setattr(paragraphs, "_banded", lambda hashes, first, n, f=paragraphs._banded: (f(hashes, first, n)[0], [np.full(len(first), b, np.uint64) for b in range(paragraphs.BANDS)]))
    rng = np.random.default_rng(23)
    rows, pairs = [], []
    for i in range(30):  # all in one bucket, most of them unlike
        words = [f"w{x}" for x in rng.integers(0, 50_000, 60)]
        rows.append((i, " ".join(words)))
        if i % 2:
            rows.append((100 + i, " ".join([*words[:-1], "new"])))
            pairs.append((i, 100 + i))
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    # without the anchors' passages: whole lines, and in one process since the bands are replaced in it
    long = [(i, t.lower()) for i, t in rows]
    pdf = next(paragraphs._paragraph_rows(iter([paragraphs.pd.DataFrame(long, columns=["row", "text"])])))
    lines = spark.createDataFrame(pdf[pdf["is_line"]].drop(columns="is_line"))
    near = {tuple(sorted(r)) for r in paragraphs._near(lines, docs.selectExpr("doc_id AS row", "text")).collect()}
    digest = dict(zip(lines.toPandas()["row"], lines.toPandas()["digest"]))
    assert near == {tuple(sorted((digest[a], digest[b]))) for a, b in pairs}


def test_stages_decide_by_row(spark, monkeypatch):
    rng = np.random.default_rng(31)
    a, b, c, d = (" ".join(f"w{x}" for x in rng.integers(0, 5000, 40)) for _ in range(4))
    rows = [(1, a), (2, a), (2, b), (2, b), (3, c), (3, d), (None, d), (None, "alone in its key"), (None, "alone in its key"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    got = sorted(map(tuple, simhash.representatives(docs).collect()), key=str)
    assert got == sorted([(1, a), (2, b), (3, c), (3, d), (None, "alone in its key"), (4, None)], key=str)
    monkeypatch.setattr(toxicity, "score", lambda docs, labels, text, key, carry: docs.select(key, *carry, toxicity.F.col(text).contains("alone").cast("int").alias("predicted")))
    spoiled = spark.createDataFrame([*rows, (2, "alone too")], docs.schema)
    left = toxicity.without_toxic(spoiled, spark.createDataFrame([], "doc_id LONG, toxic INT"))
    # a text without words is no toxic one either
    assert sorted(map(tuple, left.collect()), key=str) == sorted([r for r in rows if "alone" not in (r[1] or "")], key=str)


def test_copies_of_rows_that_share_a_key(spark):
    """A key with several texts, rows that are there several times: as many rows as mix() has copies, each by its own row."""
    rows = [(i % 30, f"text {i} " + "w " * (i % 9), "abc"[i % 3], i) for i in range(120)] + [(5, "same same", "a", 7)] * 5 + [(None, "no key", "b", 8), (6, None, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING, source STRING, `a.b` INT").repartition(4)
    mixed = mixing._mixed(docs, (5, 2, 1), 3, "mix", "text", "doc_id", "source").groupBy("doc_id", "_text").agg({"copies": "sum"})
    want = {(r["doc_id"], r["_text"]): r["sum(copies)"] for r in mixed.collect() if r["sum(copies)"]}
    got = Counter((r["doc_id"], r["mark"]) for r in mixing.repeated(docs, (5, 2, 1), 3).select("doc_id", common.F.xxhash64("text").alias("mark"), "`a.b`").collect())
    assert got == want
    assert mixing.repeated(docs.limit(0), (5, 2, 1), 3).collect() == []


def test_the_pipeline_drops_near_copies_as_op6_links_them(spark, odd, none):
    import corpus_pipeline

    kept = corpus_pipeline.drop_near_duplicates(spark, odd, "")
    linked_ids = {r["component_id"] for r in simhash.near_duplicates(odd, 3).collect()}
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == linked_ids and kept.count() == len(linked_ids)
    assert corpus_pipeline.drop_near_duplicates(spark, none, "").collect() == []
