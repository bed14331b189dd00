"""The operators over their whole tables, with production parameters, and the same results in SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sievestream.llm import bpe, embeddings, hard_negatives, language_model, mixing, packing, paragraphs, phrases, sharding, simhash, sketches, token_counts, toxicity
from sievestream.llm.common import table, work_dir

SHARDS = 8
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEQUENCE = 2048
SIMHASH_SHINGLE = 3
TOKEN_LIMIT = 2048


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(_documents(spark, sf_dir), SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, WEIGHTS, MAX_EPOCHS).select("doc_id", "size", "source_size", "target", "taken")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own that begins empty, so that every run encodes all distinct texts."""
    path = public_tokenizers.path("word_bpe_49k.json")
    counted = token_counts.count_tokens(_documents(spark, sf_dir), work_dir(spark, "token-cache"), path)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), SEQUENCE, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir), SIMHASH_SHINGLE)


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(_documents(spark, sf_dir))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.neighbours(_documents(spark, sf_dir)).drop("sketch", "edited_sketch")


def op9_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of a paragraph that several documents share, with the document that keeps it."""
    found = paragraphs.repeated_paragraphs(_documents(spark, sf_dir))
    return found.select("doc_id", F.col("word").alias("first_word"), F.col("words").alias("n_words"), "cluster", F.col("kept_id").alias("kept_doc_id"), "removed")


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 0.9)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.round_trip(_documents(spark, sf_dir), path)
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    ids = digest(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids, digest(F.col("decoded")).alias("decoded_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_shards, op3_mix, op4_token_counts, op5_packing, op6_simhash, op7_language_model, op8_fingerprints, op9_paragraphs, op10_near_vectors,
        op11_collocations, op12_bpe, op13_hard_negatives,
    )
}

ORACLE: dict[str, str] = {
    "op3_mix": r"""
        WITH sized AS (
          SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
            md5('mix|' || coalesce(doc_id::VARCHAR, '')) AS digest
          FROM documents),
        sources AS (
          SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i
          FROM sized GROUP BY source),
        weighed AS (SELECT *, CASE i % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w, source_size * 3.0::DOUBLE AS cap FROM sources),
        levels AS (
          SELECT cap / w AS stop, i, ((SELECT sum(source_size) FROM weighed)::DOUBLE
              - coalesce(sum(cap) OVER (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
          FROM weighed),
        targets AS (
          SELECT source, source_size, least(w * (SELECT level FROM levels WHERE level <= stop ORDER BY stop, i LIMIT 1), cap) AS target
          FROM weighed),
        placed AS (
          SELECT doc_id, size, source_size, target, target / source_size AS share,
            sum(size) OVER (PARTITION BY sized.source ORDER BY digest ROWS UNBOUNDED PRECEDING) - size AS before
          FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
        SELECT doc_id, size, source_size, target,
          (size * (floor(share) + CASE WHEN before + size / 2.0::DOUBLE < (share - floor(share)) * source_size THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM placed""",
    "op10_near_vectors": """
        WITH RECURSIVE good AS (
          SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
          WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        links AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
          ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
        reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        named AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
        counted AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
        FROM embeddings JOIN named ON named.a = vec_id LEFT JOIN counted ON counted.a = vec_id""",
    "op11_collocations": r"""
        WITH pieces AS (
          SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(body, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
          FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents)),
        places AS (
          SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k),
        counted AS (
          SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, any_value(w[i : i + k - 1]) AS w, count(*) AS f FROM places GROUP BY ALL HAVING f >= 100),
        totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
        swallowed AS (
          SELECT lang, phrase, max(f) AS longer FROM (
            SELECT lang, f, array_to_string(w[1 : k - 1], ' ') AS phrase FROM counted WHERE k > 2
            UNION ALL SELECT lang, f, array_to_string(w[2 : k], ' ') FROM counted WHERE k > 2)
          GROUP BY ALL),
        cuts AS (
          SELECT lang, phrase, f AS a, j, array_to_string(w[1 : j], ' ') AS head, array_to_string(w[j + 1 : k], ' ') AS rest
          FROM (SELECT *, unnest(range(1, k)) AS j FROM counted WHERE k > 1)),
        scored AS (
          SELECT c.lang, c.phrase, c.a, j, h.f AS l, r.f AS r, n, ((1000::HUGEINT * c.a * n) // (h.f::HUGEINT * r.f))::BIGINT AS score
          FROM cuts c JOIN counted h ON h.lang = c.lang AND h.phrase = c.head JOIN counted r ON r.lang = c.lang AND r.phrase = c.rest JOIN totals t ON t.lang = c.lang),
        best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
        SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, score
        FROM best b LEFT JOIN swallowed s ON s.lang = b.lang AND s.phrase = b.phrase
        WHERE longer IS NULL OR longer < a
        QUALIFY rank <= 2000""",
    "op13_hard_negatives": """
        WITH rows AS (
          SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v
          FROM embeddings
          WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        scored AS (
          SELECT a.id AS anchor_id, b.id, a.label = b.label AS alike, list_inner_product(a.v, b.v)::BIGINT AS score
          FROM rows a JOIN rows b ON a.id % 100 = 0 AND a.id <> b.id AND len(a.v) = len(b.v)),
        positives AS (
          SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE alike
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
          s.id AS negative_id, positive_score, s.score AS negative_score
        FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
        QUALIFY rank <= 10""",
}
