import random

import pytest

SCHEMA = "doc_id LONG, text STRING, source STRING, size STRING, shard STRING, row LONG, component_id STRING"


def words(rng, n, vocabulary=3000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_texts():
    """Texts with copies, near copies, shared passages, nulls, empty, very long and symbol-only ones; ids in no order."""
    rng = random.Random(5)
    passage, texts = words(rng, 60), []
    base = words(rng, 300)
    for i in range(40):
        texts.append(words(rng, rng.choice([1, 4, 30, 120])))
    texts += [base] * 7 + [base + " " + words(rng, 2), base.replace("w1", "W1")]
    texts += [f"{words(rng, 40)} {passage} {words(rng, 25)}" for _ in range(6)]
    texts += [None, "", "", " \n\t ", "| " * 400, "x" * 5000, words(rng, 12_000), "Été ÀÉ 日本 🙂 \x1c\x85", "<|endoftext|> a<|endoftext|>b"]
    return texts


@pytest.fixture
def odd(spark, odd_texts):
    """The table: extra columns have names that operators use themselves; one row is there twice."""
    rows = [(i * 7 % 101, t, ("a", "b", "é", None)[i % 4] if i % 3 else "a", "x", "y", i, "z") for i, t in enumerate(odd_texts)]
    return spark.createDataFrame([*rows, rows[3]], SCHEMA).repartition(5)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)
