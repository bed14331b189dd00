"""Headline timings as one JSON line. BENCH_SF_DIR and BENCH_CPUS choose data and cores."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from sievestream.operators import matching as X  # noqa: E402
from sievestream.plans import feeds as D  # noqa: E402
from sievestream.plans.catalog import QUERIES  # noqa: E402
from sievestream.plans.enrich import enrich  # noqa: E402
from sievestream.session import cut_lineage, local_session  # noqa: E402

CATALOG = (
    "match_keyword_joins",
    "match_userid",
    "match_hashtag_joins",
    "classify_messages",
    "created_at_iso",
    "rule_shard",
    "rule_etl",
    "recent_by_keyword",
    "validate_rules",
    "collect_locations",
    "rolling_rule_count",
    "rate_stats",
    "rate_limit",
    "rate_limit_stream",
    "limit_counter",
)
RUNS = 3


def frequent_word_rules(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """The `n` most frequent words of the documents as keyword rules."""
    words = D.table(spark, sf_dir, "documents").select(F.explode(F.split(F.lower("text"), r"[^a-z]+")).alias("value"))
    top = words.where("length(value) >= 4").groupBy("value").count().orderBy(F.desc("count"), "value").limit(n)
    return cut_lineage(
        top.select(F.col("value").alias("rule_id"), "value", F.lit("bench").alias("tag"), F.lit("keyword").alias("orig_type")),
        "bench-rules",
    )


def timed(build) -> float:
    """Median seconds of building and running a query, after one warm-up."""
    seconds = []
    for _ in range(RUNS + 1):
        started = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - started)
    return round(statistics.median(seconds[1:]), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    results: dict[str, float] = {}

    documents = D.documents(spark, sf_dir)
    rules = {n: frequent_word_rules(spark, sf_dir, n) for n in (400, 5000)}
    lines = cut_lineage(D.document_lines(documents), "bench-lines")
    results["enrich_400_rules"] = timed(lambda: enrich(lines, rules[400], "track"))
    content = documents.select(F.col("doc_id").alias("row_id"), F.lower("text").alias("keyword"))
    for n in rules:
        results[f"match_{n}_rules"] = timed(
            lambda n=n: X.match_in_place(content, X.rule_bag(rules[n], "track"), {"keyword": F.col("keyword")})
        )
    for name in CATALOG:
        results[name] = timed(lambda name=name: QUERIES[name](spark, sf_dir))

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "messages_per_second": round(documents.count() / results["enrich_400_rules"]),
            }
        )
    )


if __name__ == "__main__":
    main()
