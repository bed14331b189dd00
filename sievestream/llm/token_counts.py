"""Token counts with a digest cache."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sievestream.files import exists
from sievestream.llm.common import cut_lineage
from sievestream.llm.tokens import WordCounts, loaded

CACHE_DDL = "digest BINARY, tokenizer STRING, n_tokens LONG"
ROWS = 256


def _version(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def normalised(text: F.Column) -> F.Column:
    """What the digest is taken of: the tokenizer drops white space, so one blank stands for each run of it."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\t\\n\\r]+", " ")


def count_tokens(docs: DataFrame, cache: str, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Adds token counts: (key, `n_bytes`, `n_tokens`), looked up by digest; only distinct texts the cache lacks are encoded.

    `cache` is a Parquet folder in shared storage, of (digest of the normalised text, digest of the tokenizer's file, count);
    a missing folder is an empty cache. New counts are appended to it, then all rows read their count from it by an equality join. A run
    that fails before the append has changed nothing; a digest that two runs append at once is taken once. `path` has to exist on the executors.

    A null text is empty: 0 bytes, 0 tokens. Repeated texts and rows each get their row; an empty table gives none. Columns
    besides key and text are ignored, whatever their names.
    """
    spark = docs.sparkSession
    version = _version(path)
    digested = docs.select(
        F.col(key).alias("key"), F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes"), normalised(F.col(text)).alias("content")
    ).withColumn("digest", F.unhex(F.sha2("content", 256)))
    rows = cut_lineage(digested.drop("content"), "token-rows")

    def stored() -> DataFrame:
        known = spark.read.schema(CACHE_DDL).parquet(cache) if exists(spark, cache) else spark.createDataFrame([], CACHE_DDL)
        return known.where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))

    misses = digested.select("digest", "content").join(stored(), "digest", "left_anti").dropDuplicates(["digest"])

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = loaded(WordCounts, path).counts
        for pdf in batches:
            for at in range(0, len(pdf), ROWS):
                part = pdf.iloc[at : at + ROWS]
                yield pd.DataFrame({"digest": part["digest"], "tokenizer": version, "n_tokens": count(part["content"].tolist())})

    misses.mapInPandas(encode, CACHE_DDL).write.mode("append").parquet(cache)
    return rows.join(stored(), "digest").select(F.col("key").alias(key), "n_bytes", "n_tokens")
