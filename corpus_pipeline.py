"""From raw documents to training sequences, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sievestream.llm import mixing, packing, paragraphs, queries, simhash, toxicity
from sievestream.llm.common import cut_lineage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go, each by its own text; null and empty texts have no toxic words and stay unless most labels are toxic."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: fingerprints of three-word shingles at most three bits apart, as op6 links them.

    Texts without words are one group. Of rows equal in key and text one stays; ties go to the smallest key, then the smallest text digest, null keys last.
    """
    return simhash.representatives(docs, queries.SIMHASH_SHINGLE)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Paragraphs that an earlier document has are cut out; `n_chars`, where there is one, follows the text. All rows stay, texts may become empty, nulls stay null."""
    cut = paragraphs.without_repeats(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row as often as the mix takes it, none where that is zero; rows with a null source are a source of their own."""
    return mixing.repeated(docs, queries.WEIGHTS, queries.MAX_EPOCHS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences; a document without text is one piece, its end id. An empty table gives no rows."""
    return packing.pack(docs, queries.SEQUENCE, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("substrings", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trees, hashes and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
