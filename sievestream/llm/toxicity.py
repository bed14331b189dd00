"""Toxicity scores by gradient-boosted trees over dense features, with isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F

from sievestream.llm.common import crc_mod, cut_lineage, text_mark
from sievestream.llm.text_arrays import parts, run_hashes, runs, windows

#: Words that insult, by kind; the lists only make features, the labels decide what they weigh.
INSULTS = "airhead bozo buffoon clown coward creep cretin dimwit dolt dope dork dullard dumb dunce fool freak halfwit idiot ignoramus imbecile jerk liar loser lunatic moron nitwit numbskull oaf pig psycho rat scumbag simpleton slob snake stupid thug twit weasel wimp".split()
CONTEMPT = "abomination awful contemptible despicable disgrace disgusting filth filthy garbage gross hate hideous hopeless inferior laughable lousy miserable nasty parasite pathetic repulsive revolting rotten rubbish scum shameful sickening trash ugly useless vermin vile worthless wretched".split()
PROFANITY = "arse arsehole ass asshole bastard bitch bloody bollocks bullshit cock crap cunt damn dick dickhead douche fuck fucker fucking motherfucker piss prick pussy shit shitty slut twat wanker whore".split()
THREATS = "beat burn choke crush destroy die hang hurt kill murder punch rape shoot shut slap smash stab strangle suffer".split()
LISTS = {"insults": INSULTS, "contempt": CONTEMPT, "profanity": PROFANITY, "threats": THREATS}
YOU = "you your yours yourself youre ya u ur thou thy".split()

#: Labelled rows that the trees and their calibration are fitted on at most; every text is scored.
MAX_TRAINING_ROWS = 20_000
#: Labelled rows of either kind and half that lexicons are learned from at most, and entries that a learned lexicon has at most.
MAX_LEXICON_ROWS = 4_000
MAX_LEXICON = 20_000
#: Entries stand in at least this many toxic texts, and are this many times (as logarithm) as frequent in them as in others.
MIN_TOXIC, MIN_WEIGHT = 3, 2.0
#: Bytes of a gram, the blank before a word included; of a stretch of text that is looked at by itself.
GRAM = 6
STRETCH = 300
TREES = 20
DEPTH = 3
#: Of this many parts of the training rows the last is for the calibration; the others make two halves, each of which teaches the other's lexicon.
PARTS = 5
THRESHOLD = 0.3

_LETTER = np.zeros(256, bool)
_LETTER[list(b"abcdefghijklmnopqrstuvwxyz")] = True
_LETTER[128:] = True
_UPPER = np.zeros(256, bool)
_UPPER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_GAP = np.zeros(256, bool)
_GAP[list(b" \t\n\x0b\x0c\r")] = True
_SIGN = np.zeros(256, bool)
_SIGN[list(b"#$%&*@^~|")] = True
_STAND_IN = np.zeros(256, bool)
_STAND_IN[list(b"0123456789@$!*")] = True
_JOINER = np.zeros(256, bool)
_JOINER[list(b".*_-")] = True
#: Letters that digits and signs stand for.
_PLAIN = bytes.maketrans(b"013457@$", b"oieastas")

_COUNTS = ["bytes", "words", *LISTS, "hidden", "you", "you_near", "capitals", "shouted", "exclamation", "question", "signs", "mixed", "stretched", "grams", "gram_weight", "terms", "term_weight"]
_AT = {name: i for i, name in enumerate(_COUNTS)}
FEATURES = [
    *LISTS, "strong", "hits", "hidden", "you", "you_near", "capitals", "shouted", "exclamation", "question", "signs", "mixed", "stretched",
    "grams", "gram_weight", "gram_root", "terms", "term_weight", "term_root", "peak",
]


def _hashes(words: Sequence[str]) -> np.ndarray:
    raw = np.frombuffer("\n".join(words).encode(), np.uint8)
    inside = raw != 10
    return run_hashes(raw, inside, *runs(inside), 1)[0]


def _listed() -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all listed words and their plurals, ascending, with the number of the list; the last is YOU."""
    entries = {h: number for number, words in enumerate([*LISTS.values(), YOU]) for ending in (("", "s", "es") if number < len(LISTS) else ("",)) for h in _hashes([w + ending for w in words]).tolist()}
    keys = np.array(sorted(entries), np.uint64)
    return keys, np.array([entries[k] for k in keys.tolist()])


@dataclass(frozen=True)
class Lexicon:
    """Learned entries, ascending, with their weights: grams as numbers, words as hashes."""

    grams: np.ndarray
    gram_weights: np.ndarray
    words: np.ndarray
    word_weights: np.ndarray


NO_LEXICON = Lexicon(*[np.empty(0, t) for t in (np.uint64, np.float64) * 2])


def _found(keys: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys that are known, and their places among the known."""
    if not len(known) or not len(keys):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    bits = np.zeros(1 << 20, bool)  # most are unknown: a small table tells so without a search
    slot = lambda k: (k * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)
    bits[slot(known)] = True
    at = np.flatnonzero(bits[slot(keys)])
    where = np.minimum(np.searchsorted(known, keys[at]), len(known) - 1)
    hit = known[where] == keys[at]
    return at[hit], where[hit]


def _grams(raw: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """GRAM bytes from each place on, as a number; everything but letters counts as a blank."""
    plain = np.where(letters, raw, np.uint8(32)).astype(np.uint64)
    n = max(len(plain) - GRAM + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(GRAM):
        out = (out << np.uint64(8)) | plain[i : i + n]
    return out


def _within(at: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Whether the gram at each place lies in one part of a window."""
    ends = np.append(starts[1:] - 1, size)
    return at + GRAM <= ends[np.searchsorted(starts, at, side="right") - 1]


def _after_gap(text: bytes, at: int) -> int:
    found = text.find(b" ", at)
    return found + 1 if found >= 0 else len(text)


def dense_features(texts: Sequence[str], lexicon: Lexicon = NO_LEXICON) -> np.ndarray:
    """One row for each text, columns FEATURES: rates to 100 words or to the number of bytes.

    Texts go through in windows; those beyond one are cut at blanks and their counts summed up (what spans a cut is not seen as near).
    """
    counts, peaks = np.zeros((len(texts), len(_COUNTS))), np.zeros(len(texts))
    known, kinds = _listed()
    strong_kinds = len(LISTS) - 1  # all lists but the threats
    for data, starts, places in windows([t.encode() for t in texts], _after_gap):

        def add(name: str, at: np.ndarray, amount: np.ndarray | float = 1.0) -> None:
            np.add.at(counts[:, _AT[name]], places[np.searchsorted(starts, at, side="right") - 1], amount)

        raw = np.frombuffer(data, np.uint8)
        np.add.at(counts[:, _AT["bytes"]], places, np.diff([*starts, len(raw) + 1]) - 1)
        add("words", runs(~_GAP[raw])[0])
        upper = _UPPER[raw]
        add("capitals", np.flatnonzero(upper))
        start, end = runs(upper | _LETTER[raw])
        sums = np.cumsum(np.concatenate([[0], upper]))
        add("shouted", start[(end - start >= 2) & (sums[end] - sums[start] == end - start)])
        for name, byte in (("exclamation", 33), ("question", 63)):
            add(name, np.flatnonzero(raw == byte))
        add("signs", np.flatnonzero(_SIGN[raw]))
        either = upper | _LETTER[raw]
        start, end = runs(_STAND_IN[raw])
        inner = (start > 0) & (end < len(raw))
        start, end = start[inner], end[inner]
        add("mixed", start[either[start - 1] & either[end]])

        # lower case may change lengths: from here on places are those of the lowered text
        low = data.decode("utf-8", "replace").lower().encode()
        breaks = np.flatnonzero(np.frombuffer(low, np.uint8) == 10)
        own = np.flatnonzero(raw == 10)
        starts = np.concatenate([[0], breaks[np.searchsorted(own, starts[1:] - 1)] + 1])
        raw = np.frombuffer(low, np.uint8)
        letters = _LETTER[raw]
        same = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & letters[2:] & (raw[2:] < 128)
        add("stretched", runs(same)[0])

        start, end = runs(letters)
        (hashes,) = run_hashes(raw, letters, start, end, 1)
        at, which = _found(hashes, known)
        kind = kinds[which]
        for number, name in enumerate([*LISTS, "you"]):
            add(name, start[at[kind == number]])
        strong, you = at[kind < strong_kinds], at[kind == len(LISTS)]
        if len(strong) and len(you):
            text = np.searchsorted(starts, start, side="right")
            nearest = np.clip(np.searchsorted(you, strong), 1, max(len(you) - 1, 1))
            near = np.zeros(len(strong), bool)
            for other in (you[np.minimum(nearest - 1, len(you) - 1)], you[np.minimum(nearest, len(you) - 1)]):
                near |= (np.abs(other - strong) <= 4) & (text[other] == text[strong])
            add("you_near", start[strong[near]])

        plain = np.frombuffer(low.translate(_PLAIN), np.uint8)
        joined = np.zeros(len(plain), bool)
        joined[1:-1] = _JOINER[plain[1:-1]] & _LETTER[plain[:-2]] & _LETTER[plain[2:]]
        kept = np.flatnonzero(~joined)
        if (plain[kept] != raw[kept]).any() or len(kept) < len(raw):
            bare = plain[kept]
            letters_too = _LETTER[bare]
            start_too, end_too = runs(letters_too)
            at_too, which_too = _found(run_hashes(bare, letters_too, start_too, end_too, 1)[0], known)
            add("hidden", kept[start_too[at_too[kinds[which_too] < strong_kinds]]])
            add("hidden", start[strong], -1.0)

        at, which = _found(hashes, lexicon.words)
        add("terms", start[at])
        add("term_weight", start[at], lexicon.word_weights[which])
        hit, which = _found(_grams(raw, letters), lexicon.grams)
        whole = _within(hit, starts, len(raw))
        hit, which = hit[whole], which[whole]
        weights = lexicon.gram_weights[which]
        add("grams", hit)
        add("gram_weight", hit, weights)
        if len(hit):
            total = np.concatenate([[0.0], np.cumsum(weights)])
            text = np.searchsorted(starts, hit, side="right") - 1
            last = np.minimum(np.searchsorted(hit, hit + STRETCH), np.searchsorted(text, text, side="right"))
            np.maximum.at(peaks, places[text], total[last] - total[np.arange(len(hit))])

    c = {name: counts[:, i] for name, i in _AT.items()}
    words, size = np.maximum(c["words"], 1), np.maximum(c["bytes"], 1)
    strong = c["insults"] + c["contempt"] + c["profanity"]
    rates = {name: 100 * c[name] / words for name in (*LISTS, "you", "you_near", "shouted", "mixed", "stretched", "terms", "term_weight")}
    rates |= {name: c[name] / size for name in ("capitals", "exclamation", "question", "signs")} | {name: 100 * c[name] / size for name in ("grams", "gram_weight")}
    rates |= {"strong": 100 * strong / words, "hits": np.minimum(strong, 10), "hidden": 100 * np.maximum(c["hidden"], 0) / words}
    rates |= {"gram_root": c["gram_weight"] / np.sqrt(size), "term_root": c["term_weight"] / np.sqrt(words), "peak": peaks}
    return np.column_stack([rates[name] for name in FEATURES])


def learn_lexicons(rows: DataFrame, max_entries: int = MAX_LEXICON) -> list[Lexicon]:
    """Words and grams that toxic texts have more often than others, from (text, label, half): of half 0, of half 1, of both.

    An entry's weight is the logarithm of the ratio of the shares of texts that have it, smoothed. Texts are counted in one pass for all three.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            groups = 2 * batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64) + (batch.column(1).to_numpy(zero_copy_only=False) > 0)
            texts = [(t or "").lower().encode() for t in batch.column(0).to_pylist()]
            for data, starts, places in windows(texts, _after_gap):
                raw = np.frombuffer(data, np.uint8)
                letters = _LETTER[raw]
                start, end = runs(letters)
                grams = _grams(raw, letters)
                whole = np.flatnonzero(_within(np.arange(len(grams)), starts, len(raw)))
                for kind, keys, at in ((0, grams[whole], whole), (1, run_hashes(raw, letters, start, end, 1)[0], start)):
                    text = places[np.searchsorted(starts, at, side="right") - 1]
                    order = np.lexsort((text, keys))
                    keys, text = keys[order], text[order]
                    first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])])) if len(keys) else np.empty(0, np.int64)
                    keys, group = keys[first], groups[text[first]]
                    unique, inverse = np.unique(keys, return_inverse=True)
                    found = [pa.array(np.bincount(inverse[group == g], minlength=len(unique))) for g in range(4)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(unique), kind, np.int32)), pa.array(unique.view(np.int64)), *found], names=["kind", "key", "n0", "n1", "n2", "n3"])

    sizes = [0] * 4
    for r in rows.groupBy("half", (F.col("label") > 0).alias("toxic")).agg(F.count("*").alias("n")).collect():
        sizes[2 * r["half"] + r["toxic"]] = r["n"]
    schema = "kind INT, key LONG, n0 LONG, n1 LONG, n2 LONG, n3 LONG"
    counted = rows.select("text", "label", "half").mapInArrow(count, schema).groupBy("kind", "key").agg(*(F.sum(f"n{g}").alias(f"n{g}") for g in range(4)))
    counted = cut_lineage(counted.where(F.col("n1") + F.col("n3") >= MIN_TOXIC), "toxicity-grams")
    out = []
    for halves in ((0,), (1,), (0, 1)):
        toxic, clean = (sum(F.col(f"n{2 * h + g}") for h in halves) for g in (1, 0))
        all_toxic, all_clean = (sum(sizes[2 * h + g] for h in halves) for g in (1, 0))
        weight = F.log((toxic + 0.5) / (all_toxic + 1)) - F.log((clean + 0.5) / (all_clean + 1))
        weighed = counted.withColumn("weight", weight).where((toxic >= MIN_TOXIC) & (F.col("weight") >= MIN_WEIGHT)).withColumn("worth", F.col("weight") * toxic)
        learned = []
        for kind in (0, 1):
            best = weighed.where(F.col("kind") == kind).orderBy(F.desc("worth"), "key").limit(max_entries).collect()
            keys = np.array([r["key"] for r in best], np.int64).view(np.uint64)
            order = np.argsort(keys)
            learned += [keys[order], np.array([r["weight"] for r in best])[order]]
        out.append(Lexicon(*learned) if all_toxic and all_clean else NO_LEXICON)
    return out


def _featured(texts: DataFrame, lexicon: Lexicon) -> DataFrame:
    """`texts` with `text` turned into `features`; its other columns stay."""
    shared = texts.sparkSession.sparkContext.broadcast(lexicon)
    place = texts.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            values = [t or "" for t in batch.column(place).to_pylist()]
            rows = dense_features(values, shared.value)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * len(FEATURES), pa.int32()), pa.array(rows.reshape(-1)))
            columns = [lists if i == place else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    kinds = ", ".join("text ARRAY<DOUBLE>" if f.name == "text" else f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema)
    return texts.mapInArrow(run, kinds).withColumn("text", array_to_vector("text")).withColumnRenamed("text", "features")


def score(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, text: str = "text", key: str = "doc_id", label: str = "toxic", max_rows: int = MAX_TRAINING_ROWS, carry: tuple[str, ...] = (), max_lexicon_rows: int = MAX_LEXICON_ROWS) -> DataFrame:
    """Scores every text: key, `held_out`, `score` (0 to 1), `predicted` (1 from THRESHOLD on), and the columns to `carry`.

    Labels are learned only from keys whose crc32 (as text) modulo `folds` is not `held_out`. By digest of the key these rows fall into two halves and
    a rest. Lexicons of words and of grams, of whatever language, are learned from either half and from both (at most `max_lexicon_rows` of either kind and half).
    The trees see the rows of each half with the densities of the other half's lexicon (at most `max_rows`, the first by digest); everything else has those of the lexicon of both. The isotonic
    regression of the label on the trees' score is fitted on the rest (at most `max_rows`). So neither densities nor calibration are judged by rows they were made from.
    Features are computed once, in the scan of the texts. Labels, keys and carried columns are no inputs of a score.

    Of several labels of one key the highest counts; null labels and keys don't. Without labels of both kinds every score is the share
    of toxic labels (0 without any); without calibration rows of both kinds the trees' probability stands. Null and empty texts have zero features and get a
    score too; equal texts have equal scores. Texts of any length are taken whole. Repeated rows give repeated rows; an empty table none. Carried columns keep their names, whatever these are, except for those of the result.
    """
    carried = {f"_carry{i}": c for i, c in enumerate(carry)}
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), *(F.col(c).alias(n) for n, c in carried.items()))
    learned = labels.where(F.col(key).isNotNull() & (crc_mod(F.col(key), folds) != held_out))
    learned = learned.groupBy(F.col(key).alias("key")).agg(F.max(label).cast("double").alias("label")).where("label IS NOT NULL")
    part = F.pmod(F.xxhash64(F.lit("part"), "key"), F.lit(PARTS))
    learned = learned.withColumn("digest", F.xxhash64("key")).withColumn("half", F.when(part < PARTS - 1, (part % 2).cast("int")))
    learned = cut_lineage(learned, "toxicity-labels")

    first = lambda rows, n: rows.orderBy("digest").limit(n)
    teaching = [first(learned.where((F.col("half") == half) & ((F.col("label") > 0) == toxic)), max_lexicon_rows) for half in (0, 1) for toxic in (True, False)]
    seen = first(learned.where("half IS NOT NULL"), max_rows)
    chosen = seen.withColumn("use", F.lit("see"))
    for rows in teaching:
        chosen = chosen.unionByName(rows.withColumn("use", F.lit("teach")))
    chosen = cut_lineage(texts.select("key", "text").join(chosen, "key"), "toxicity-chosen")
    *by_half, lexicon = learn_lexicons(chosen.where("use = 'teach'"))
    seen = chosen.where("use = 'see'").select("text", "label", "half", "digest")
    seen = _featured(seen.where("half = 0"), by_half[1]).unionByName(_featured(seen.where("half = 1"), by_half[0]))

    rows = cut_lineage(_featured(texts, lexicon), "toxicity-features")
    calibrating = rows.select("key", "features").join(first(learned.where("half IS NULL"), max_rows), "key")
    sample = seen.select("features", "label", "digest", F.lit(False).alias("calibrates")).unionByName(calibrating.select("features", "label", "digest", F.lit(True).alias("calibrates")))
    sample = cut_lineage(sample.orderBy("digest"), "toxicity-sample").coalesce(2)
    shares = {r["calibrates"]: (r["n"], r["toxic"]) for r in sample.groupBy("calibrates").agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).collect()}
    both = lambda n, toxic: 0 < toxic < n
    if not both(*shares.get(False, (0, 0.0))):
        known = learned.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
        scored = rows.withColumn("score", F.lit(float(known["toxic"] / known["n"] if known["n"] else 0.0)))
    else:
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, minInstancesPerNode=5, seed=1, featuresCol="features", labelCol="label", maxBins=64)
        model = trees.fit(sample.where("NOT calibrates"))
        probability = vector_to_array("probability")[1]
        scored = model.transform(rows).withColumn("raw", probability)
        if both(*shares.get(True, (0, 0.0))):
            calibration = model.transform(sample.where("calibrates")).withColumn("raw", probability)
            isotonic = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(calibration.select("raw", "label"))
            scored = isotonic.transform(scored.select("key", *carried, "raw")).withColumnRenamed("calibrated", "score")
        else:
            scored = scored.withColumn("score", F.col("raw"))
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), "score"))
    held = crc_mod(F.col("key"), folds) == held_out
    return scored.select(F.col("key").alias(key), held.alias("held_out"), score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"), *(F.col(n).alias(c) for n, c in carried.items()))


def without_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of `docs` that are not predicted toxic, each by its own text, whatever its key."""
    marked = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), text_mark(text))
    toxic = score(marked, labels.select(F.col(key).alias("_key"), "toxic"), text="_text", key="_key", carry=("_mark",)).where("predicted = 1")
    toxic = toxic.select(F.col("_key").alias("toxic_key"), F.col("_mark").alias("toxic_mark")).distinct()
    rows = docs.select(F.col(key).alias("_key"), text_mark(text), F.struct(*docs.columns).alias("_doc"))
    return rows.join(toxic, F.col("_key").eqNullSafe(F.col("toxic_key")) & (F.col("_mark") == F.col("toxic_mark")), "left_anti").select("_doc.*")
