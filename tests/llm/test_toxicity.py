"""Toxicity: features next to plain counts, learned lexicons, accuracy on the held-out fold by language."""

import math
import os
import re
from collections import Counter

import numpy as np
import pytest

from sievestream.llm import text_arrays, toxicity

TABLES = "/root/testdata/sf0.1"


def features(*texts, lexicon=toxicity.NO_LEXICON):
    return [dict(zip(toxicity.FEATURES, row)) for row in toxicity.dense_features(list(texts), lexicon)]


def test_disguised_insults_at_any_place():
    disguised = ["$hit", "5tupid", "@sshole", "a$$hole", "1diot", "4$$", "i.d.i.o.t", "st_upid"]
    assert all(f["hidden"] > 0 for f in features(*disguised))
    assert all(f["hidden"] == 0 for f in features("plain words", "no. 9 and 10", "shit", "cree7", ""))


def test_counts():
    got = features("You STUPID idiots!! are what? #$", "well, you\u00c9 noooo", "", "idiot one two three four five you")
    assert got[0]["insults"] == pytest.approx(100 * 2 / 6) and got[0]["you"] == pytest.approx(100 / 6)
    assert got[0]["you_near"] == pytest.approx(100 * 2 / 6) and got[0]["shouted"] == pytest.approx(100 / 6)
    size = len("You STUPID idiots!! are what? #$")
    assert (got[0]["exclamation"], got[0]["question"], got[0]["signs"], got[0]["capitals"]) == pytest.approx((2 / size, 1 / size, 2 / size, 7 / size))
    assert got[1]["you"] == 0 and got[1]["stretched"] == pytest.approx(100 / 3)
    assert not any(got[2].values())
    assert got[3]["you_near"] == 0 and got[3]["you"] > 0


def test_long_texts_are_cut_at_blanks_and_summed_up(monkeypatch):
    text = " ".join(["idiot", "word", "\u0130stanbul", "YES", "you!"] * 400)
    whole = features(text, "scum", text)
    monkeypatch.setattr(text_arrays, "WINDOW", 500)
    cut = features(text, "scum", text)
    for a, b in zip(whole, cut):
        for name in toxicity.FEATURES:
            if name not in ("you_near", "peak"):
                assert a[name] == pytest.approx(b[name]), name


def test_a_learned_lexicon_has_what_toxic_texts_share(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(120):
        words = [f"w{x}" + "abcd"[x % 4] for x in rng.integers(0, 200, 30)]
        if i % 3 == 0:
            words[i % 30] = "grumbl" + "aeiou"[i % 5]  # one stem, many endings
            words[(i + 7) % 30] = "\u00e9grub"
        rows.append((" ".join(words).upper() if i % 2 else " ".join(words), float(i % 3 == 0)))
    # every row twice: of half 0 and of half 1, so that all three lexicons are alike but for the smoothing
    both = [(*r, half) for r in rows for half in (0, 1)]
    *_, lexicon = toxicity.learn_lexicons(spark.createDataFrame(both, "text STRING, label DOUBLE, half INT").repartition(3))
    # plain counts of texts that have each gram
    grams, clean = Counter(), Counter()
    for text, label in rows:
        low = re.sub(rb"[^a-z\x80-\xff]", b" ", text.lower().encode())
        (grams if label else clean).update({low[i : i + toxicity.GRAM] for i in range(len(low) - toxicity.GRAM + 1)})
    want = {}
    for gram, t in grams.items():
        weight = math.log((2 * t + 0.5) / 81) - math.log((2 * clean[gram] + 0.5) / 161)
        if 2 * t >= toxicity.MIN_TOXIC and weight >= toxicity.MIN_WEIGHT:
            want[int.from_bytes(gram, "big")] = weight
    assert dict(zip(lexicon.grams.tolist(), lexicon.gram_weights.tolist())) == pytest.approx(want)
    assert int.from_bytes(b" grumb", "big") in want and len(lexicon.words) >= 2
    toxic, other = features("a GRUMBLo text", "a plain text", lexicon=lexicon)
    assert toxic["peak"] > 0 == other["peak"] and toxic["gram_root"] > 0
    alone = spark.createDataFrame([("a", 1.0, 0)], "text STRING, label DOUBLE, half INT")
    assert all(x is toxicity.NO_LEXICON for x in toxicity.learn_lexicons(alone))


def test_carried_columns_may_have_any_name(spark):
    docs = spark.createDataFrame([(i, "scum " * (i % 2) + f"w{i} and more", 1, "x", "y", 2) for i in range(80)], "doc_id LONG, text STRING, label INT, raw STRING, digest STRING, features INT")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id LONG, toxic INT")
    got = toxicity.score(docs, labels, carry=("label", "raw", "digest", "features"))
    assert got.columns == ["doc_id", "held_out", "score", "predicted", "label", "raw", "digest", "features"]
    assert {tuple(r)[4:] for r in got.collect()} == {(1, "x", "y", 2)}


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="driver tables not here")
def test_toxic_texts_of_every_language_are_found(spark):
    docs, labels = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), labels).where("held_out").join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    found, total, wrong, clean = Counter(), Counter(), Counter(), Counter()
    for r in scored.collect():
        (total if r["toxic"] else clean)[r["lang"]] += 1
        (found if r["toxic"] else wrong)[r["lang"]] += r["predicted"]
    print(dict(found), dict(total), dict(wrong), dict(clean))
    # some labels are wrong; a language with few labelled toxic texts to learn from is found less well
    assert all(found[lang] >= (0.9 if n >= 15 else 0.6) * n for lang, n in total.items())
    assert all(wrong[lang] <= 0.05 * n for lang, n in clean.items())
