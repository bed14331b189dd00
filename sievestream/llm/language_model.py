"""Bigram language model by deleted interpolation."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from sievestream.llm.common import WORD, ascii_lower, crc_mod, cut_lineage

_WORDS = re.compile(WORD).findall
END = ""  # no word is empty, so the end of a text has this name
#: Bytes of text in one block of documents, and distinct n-grams in one slice of the counts.
BLOCK_BYTES = 12 << 20
SLICE_ROWS = 1 << 20
#: Contexts seen 2**b to 2**(b+1) - 1 times share mixture weights; the last bucket is open.
BUCKETS = 24
#: Cells to a factor e in which likelihood ratios are counted for the estimation.
CELLS = 4
CELL_MAX = 120
#: Tokens and distinct words of the texts that the weights leave in, then of all training texts.
TOTALS = ("fit_tokens", "fit_types", "tokens", "types")


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two 64-bit hashes, element by element."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31)))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Block:
    """The tokens of a block of documents, as positions in its sorted distinct unigram and bigram hashes."""

    def __init__(self, texts: list[str]):
        tokens: list[str] = []
        sizes = []
        for text in texts:
            words = _WORDS(text)
            tokens += words
            tokens.append(END)
            sizes.append(len(words) + 1)
        self.sizes = np.array(sizes, np.int64)
        codes, names = pd.factorize(np.array(tokens, object))
        del tokens
        n = len(names)
        last = np.cumsum(self.sizes) - 1
        before = np.roll(codes, 1)
        before[np.concatenate(([0], last[:-1] + 1))] = codes[last[0]]  # the first token of a text follows an end
        pairs, pair_at = np.unique(before * n + codes, return_inverse=True)
        # the lowest bit tells words from bigrams
        words = np.fromiter((xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), 7) | 1 for w in names), np.uint64, n)
        keys = np.concatenate([words, _mixed(words[pairs // n], words[pairs % n]) & ~np.uint64(1)])
        order = np.argsort(keys, kind="stable")
        rank = np.empty(len(keys), np.int64)
        rank[order] = np.arange(len(keys))
        self.keys, self.word, self.context, self.pair = keys[order], rank[codes], rank[before], rank[n + pair_at]

    def counts(self, of_token: np.ndarray) -> np.ndarray:
        """How often each key occurs, as word or as bigram, among the tokens chosen."""
        return np.bincount(np.concatenate([self.word[of_token], self.pair[of_token]]), minlength=len(self.keys))


def _packed(numbers: np.ndarray) -> bytes:
    """64-bit numbers, byte planes apart so that leading zeros cost nothing."""
    return zlib.compress(np.ascontiguousarray(numbers.astype("<u8")).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def _bounds(keys: np.ndarray, slices: int) -> np.ndarray:
    """Where the slices (equal parts of the hash space) begin among sorted keys."""
    cuts = np.array([(k << 64) // slices for k in range(1, slices)], np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, cuts), [len(keys)]))


def _count_block(slices: int):
    def count(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        block = Block(pdf["text"].tolist())
        roles = np.repeat(pdf["role"].to_numpy(), block.sizes)
        fit, dev = block.counts(roles == "fit"), block.counts(roles == "dev")
        bounds = _bounds(block.keys, slices)
        rows = []
        for part in range(slices):
            a, b = bounds[part], bounds[part + 1]
            if a < b:
                rows.append((part, key[0], _packed(np.diff(block.keys[a:b], prepend=np.uint64(0))), _packed(fit[a:b]), _packed(dev[a:b])))
        return pd.DataFrame(rows, columns=["part", "block", "keys", "fit", "dev"])

    return count


def _merge_slice(pdf: pd.DataFrame) -> pd.DataFrame:
    """Adds up the counts of one slice of keys over all blocks and gives every block the sums of its own keys."""
    keys = [np.cumsum(_unpacked(k), dtype=np.uint64) for k in pdf["keys"]]
    sizes = np.array(list(map(len, keys)))
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    sums = {}
    for name in ("fit", "dev"):
        parts = np.concatenate([_unpacked(x) for x in pdf[name]]).astype(np.int64)
        sums[name] = np.bincount(at, weights=parts, minlength=len(distinct)).astype(np.int64)
    split = np.split(at, np.cumsum(sizes)[:-1])
    out = pd.DataFrame(
        {"part": pdf["part"], "block": pdf["block"], "fit": [_packed(sums["fit"][s]) for s in split], "dev": [_packed(sums["dev"][s]) for s in split]}
    )
    word = (distinct & np.uint64(1)).astype(bool)
    both = sums["fit"] + sums["dev"]
    for name, total in zip(TOTALS, (sums["fit"][word].sum(), (sums["fit"][word] > 0).sum(), both[word].sum(), (both[word] > 0).sum())):
        out[name] = 0
        out.loc[out.index[0], name] = int(total)  # one row of a slice tells its totals
    return out


class _Counted:
    """Counts of a block's tokens from the replies of all slices."""

    def __init__(self, block: Block, replies: pd.DataFrame, final: bool):
        replies = replies.sort_values("part")
        total = {n: np.concatenate([_unpacked(x) for x in replies[n]]).astype(np.int64) if len(replies) else np.zeros(0, np.int64) for n in ("fit", "dev")}
        counts = total["fit"] + total["dev"] if final else total["fit"]
        self.word, self.context, self.pair = counts[block.word], counts[block.context], counts[block.pair]

    def mixture(self, tokens: int, types: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bucket of the context and the three estimates of each token: bigram, unigram, uniform."""
        bucket = np.minimum(np.floor(np.log2(np.maximum(self.context, 1))).astype(np.int64) + (self.context > 0), BUCKETS - 1)
        return bucket, self.pair / np.maximum(self.context, 1), self.word / max(tokens, 1), np.full(len(self.word), 1 / (types + 1))


def _ratio_cells(tokens: int, types: int):
    """Counts held-out tokens by bucket and by (rounded logarithms of) their bigram and unigram estimates over the uniform one."""

    def cells(key: tuple, docs: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame({"bucket": [], "pair": [], "word": [], "n": []})
        block = Block(docs["text"].tolist())
        chosen = np.repeat((docs["role"] == "dev").to_numpy(), block.sizes)
        bucket, pair, word, uniform = (x[chosen] for x in _Counted(block, replies, False).mixture(tokens, types))
        cell = lambda p: np.where(p > 0, np.clip(np.rint(np.log(np.maximum(p, 1e-300) / uniform) * CELLS), -CELL_MAX + 1, CELL_MAX), -CELL_MAX)
        frame = pd.DataFrame({"bucket": bucket, "pair": cell(pair).astype(np.int64), "word": cell(word).astype(np.int64), "n": 1})
        return frame.groupby(["bucket", "pair", "word"], as_index=False)["n"].sum()

    return cells


def learn_weights(cells: pd.DataFrame, rounds: int = 50) -> np.ndarray:
    """Mixture weights (bigram, unigram, uniform) of each bucket by expectation-maximisation on the counted cells.

    A bucket without held-out tokens has the weights of all tokens together; without any, a third each. The uniform weight stays
    above zero so that no token is impossible.
    """
    ratio = lambda c: np.where(c <= -CELL_MAX, 0.0, np.exp(np.asarray(c, float) / CELLS))

    def fitted(part: pd.DataFrame, start: np.ndarray) -> np.ndarray:
        if not part["n"].sum():
            return start
        likelihood = np.column_stack([ratio(part["pair"]), ratio(part["word"]), np.ones(len(part))])
        weight, n = np.full(3, 1 / 3), part["n"].to_numpy(float)
        for _ in range(rounds):
            shares = likelihood * weight
            shares /= shares.sum(axis=1, keepdims=True)
            weight = (shares * n[:, None]).sum(axis=0) / n.sum()
        weight = np.maximum(weight, 1e-6)
        return weight / weight.sum()

    overall = fitted(cells, np.full(3, 1 / 3))
    return np.array([fitted(cells[cells["bucket"] == b], overall) for b in range(BUCKETS)])


def score_texts(docs: DataFrame, folds: int = 7, held_out: int = 2, dev: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Scores every text by a bigram model: key, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`.

    Folds follow from crc32(key as text) modulo `folds`: fold `held_out` is never learned from; fold `dev` is left out of the counts while
    the mixture weights are learned, and counted in for the scores. A token's probability mixes its bigram's and its own
    relative frequency and 1 / (types + 1), with weights by the frequency of its context. `base_score` is the add-one unigram score.

    How it scales: documents are dealt to blocks of about BLOCK_BYTES. A block counts its own n-grams, and sends its distinct ones once, by
    slices of the hash space, to where all blocks' counts of a slice meet; it gets back the sums for its own keys. So what moves is each
    block's distinct n-grams, a frequent one as rarely as a rare one, and no model is ever held in one place. N-grams are
    known by 64-bit hashes.

    A null text is empty: it has one token, the end. Repeated rows are texts of their own. An empty table gives no rows; without training
    texts all tokens have the uniform probability 1. A null key is in the fold of the empty text.
    """
    fold = crc_mod(F.col(key), folds)
    role = F.when(fold == held_out, "held").when(fold == dev, "dev").otherwise("fit")
    rows = docs.select(F.col(key).alias("key"), ascii_lower(F.coalesce(F.col(text), F.lit(""))).alias("text"), role.alias("role"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, round(size / BLOCK_BYTES))
    # held-out tokens are asked for alone, so they have blocks of their own (odd numbers)
    digest = F.xxhash64("key", "text")
    block = F.when(F.col("role") == "dev", F.pmod(digest, F.lit(-(-blocks // folds))) * 2 + 1).otherwise(F.pmod(digest, F.lit(blocks)) * 2)
    rows = rows.withColumn("block", block)
    slices = max(1, round(size / 7 / SLICE_ROWS))  # about 7 bytes of text to a distinct n-gram of a block

    sent = rows.groupBy("block").applyInPandas(_count_block(slices), "part INT, block LONG, keys BINARY, fit BINARY, dev BINARY")
    reply = "part INT, block LONG, fit BINARY, dev BINARY, " + ", ".join(f"{name} LONG" for name in TOTALS)
    replies = cut_lineage(sent.groupBy("part").applyInPandas(_merge_slice, reply), "lm-counts")
    fit_tokens, fit_types, tokens, types = (int(x or 0) for x in replies.agg(*(F.sum(name) for name in TOTALS)).first())
    replies = replies.drop(*TOTALS)

    asked = rows.where("role = 'dev'").groupBy("block").cogroup(replies.where("block % 2 = 1").groupBy("block"))
    cells = asked.applyInPandas(_ratio_cells(fit_tokens, fit_types), "bucket LONG, pair LONG, word LONG, n LONG").groupBy("bucket", "pair", "word").agg(F.sum("n").alias("n"))
    weights = learn_weights(cells.toPandas())  # BUCKETS * (2 * CELL_MAX + 1) ** 2 rows at most; far fewer occur

    def score(key: tuple, docs: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        block = Block(docs["text"].tolist())
        found = _Counted(block, replies, True)
        bucket, pair, word, uniform = found.mixture(tokens, types)
        mixed = weights[bucket, 0] * pair + weights[bucket, 1] * word + weights[bucket, 2] * uniform
        # weights of estimates that do not exist (an unseen context) go to those that do
        known = (weights[bucket] * np.column_stack([found.context > 0, np.full(len(pair), tokens > 0), np.ones(len(pair), bool)])).sum(axis=1)
        starts = np.concatenate(([0], np.cumsum(block.sizes)[:-1]))
        total = lambda x: np.add.reduceat(x, starts)
        return pd.DataFrame(
            {
                "key": docs["key"],
                "held_out": docs["role"] == "held",
                "n_tokens": block.sizes,
                "n_known": total((found.word > 0).astype(np.int64)),
                "train_tokens": tokens,
                "base_score": total(np.log10((found.word + 1) / (tokens + types + 1))),
                "score": total(np.log10(mixed / known)),
            }
        )

    schema = "key LONG, held_out BOOLEAN, n_tokens LONG, n_known LONG, train_tokens LONG, base_score DOUBLE, score DOUBLE"
    scored = rows.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(score, schema)
    return scored.withColumnRenamed("key", key)
