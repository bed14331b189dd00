"""The transducer lexicon next to the tokenizer's own library."""

import random

import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from sievestream.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def merges():
    return bpe.Merges(PATH)


def plain_encoder(merges, tmp_path, words):
    file = tmp_path / "lexicon"
    file.write_bytes(bpe.compile_transducer({w: merges.merge(w) for text in words for w in merges.words(text)}))
    return bpe._Encoder(PATH, str(file))


def test_ids_and_texts_are_those_of_the_library(spark, library, odd, odd_texts):
    coded = bpe.decode(bpe.encode(odd, PATH, words=200), PATH)
    got = sorted((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in coded.collect())
    want = []
    for r in odd.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((r["doc_id"], tuple(ids), library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want)
    assert sorted((r["doc_id"], tuple(r["ids"]), r["decoded"]) for r in bpe.round_trip(odd, PATH, words=200).collect()) == got


def test_result_does_not_depend_on_the_lexicon(spark, odd):
    results = [sorted(map(str, bpe.encode(odd, PATH, words=n).collect())) for n in (1, 50)]
    assert results[0] == results[1]


def test_empty_and_null(spark, none):
    assert bpe.decode(bpe.encode(none, PATH), PATH).collect() == bpe.round_trip(none, PATH).collect() == []
    blank = spark.createDataFrame([(1, None), (2, ""), (3, " \n\t"), (None, "a b")], "doc_id LONG, text STRING")
    got = {r["doc_id"]: (r["ids"], r["decoded"]) for r in bpe.decode(bpe.encode(blank, PATH), PATH).collect()}
    assert got[1] == got[2] == got[3] == ([], "") and len(got[None][0]) == 2
    odd_ids = spark.createDataFrame([("x", None), ("y", [320, -1, 10**7, 49407])], "doc_id STRING, ids ARRAY<INT>")
    assert {r["doc_id"]: r["decoded"] for r in bpe.decode(odd_ids, PATH).collect()} == {"x": "", "y": "a</w> <|endoftext|>"}
    assert {r["doc_id"]: r["decoded"] for r in bpe.decode(odd_ids, PATH, skip_special=True).collect()} == {"x": "", "y": "a</w>"}


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text("aAbéß'stmdelrv 0 9!.\ńİΣ<|>endoftx日🙂", max_size=40)))
def test_any_text(text):
    library = Tokenizer.from_file(PATH) if not hasattr(test_any_text, "library") else test_any_text.library
    test_any_text.library = library
    if not hasattr(test_any_text, "merges"):
        test_any_text.merges = bpe.Merges(PATH)
    merges = test_any_text.merges
    spans = merges.specials.split(text)
    ids = [i for span in spans for i in ([merges.special[span]] if span in merges.special else [j for w in merges.words(span) for j in merges.merge(w)])]
    assert ids == library.encode(text, add_special_tokens=False).ids


def test_white_space_parts_words_as_in_the_whole_text(merges, library, tmp_path):
    encoder = plain_encoder(merges, tmp_path, ["the cat's hat", "running runner"])
    rng = random.Random(4)
    letters = list("abcTHE 's\t\n\r \x0b\x1c\x85 é́<|>1,.!日") + ["<|endoftext|>", "<|startoftext|>", "the", "cat's", "  "]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)]
    ids = encoder.ids(texts)
    import numpy as np

    assert [np.frombuffer(i, "<i4").tolist() for i in ids] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_transducer_is_minimal_and_exact(tmp_path):
    rng = random.Random(1)
    # many words of few letters share beginnings and ends; ids follow the parts
    words = {bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 9))) for _ in range(600)}
    entries = {w: tuple(w[i] % 7 for i in range(0, len(w), 2)) for w in words}
    file = tmp_path / "t"
    file.write_bytes(bpe.compile_transducer(entries))
    transducer = bpe.Transducer(str(file))
    asked = sorted(words) + [b"", b"z", b"abcabcabcabcabc"] + [w + b"a" for w in sorted(words)] + [w[:-1] for w in sorted(words)]
    assert transducer.look_up(asked) == [entries.get(w) for w in asked]

    # no two states go on alike: the numbers of states are those of the classes of equal futures
    def future(state):
        arcs = [(int(k) % 256, int(k) // 256, i) for i, k in enumerate(transducer.keys) if k // 256 == state]
        outs = lambda i: tuple(transducer.ids[transducer.ends[i] : transducer.ends[i + 1]].tolist())
        final = outs(len(transducer.keys) + state) if transducer.finals[state] else None
        return final, tuple((byte, outs(i), int(transducer.targets[i])) for byte, _, i in arcs)

    futures = [future(s) for s in range(len(transducer.finals))]
    assert len(set(futures)) == len(futures)
    # shared ends: far fewer states than the words have letters
    assert len(futures) < len({w[:i] for w in words for i in range(len(w) + 1)})


def test_an_empty_lexicon_finds_nothing(tmp_path):
    file = tmp_path / "t"
    file.write_bytes(bpe.compile_transducer({}))
    assert bpe.Transducer(str(file)).look_up([b"a", b""]) == [None, None]


def test_long_words_merge_as_short_ones(merges, library):
    word = "ab" * 20_000
    assert list(merges.merge(word.encode())) == library.encode(word, add_special_tokens=False).ids
