"""An index of keyword terms by one gram of each, kept in shared storage and changed by rule deltas."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievestream.files import delete, names, publish, read_text
from sievestream.functions import values as V
from sievestream.operators.matching import gram_of_terms, keyword_pairs, term_grams

_TERMS = "rule_key STRING, term STRING, n LONG"
_ANCHORS = "term STRING, gram STRING"


class TermIndex:
    """(rule, term) and (term, gram) of all keyword rules, as a list of segments under a version number.

    Every change appends a small segment: terms that rules gained (n = 1) or lost (n = -1), and the gram of each term that no earlier segment has. A term
    is found by any of its grams, so one chosen earlier stays right; it is the one that fewest terms had when the term came. Neither the
    grams of known terms nor the rules are read for a change, and nothing has to fit into memory. A version is a published list of segments: readers see it
    whole or not at all, and an update that runs again after a failure publishes the same version or finds it done.

    Rules are told apart by their id as text. A rule without id or value is left out; of several rules of one id a term counts as often as it is there.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def version(self) -> int:
        """The newest version, -1 before the first."""
        found = names(self.spark, f"{self.folder}/versions")
        return int(found[-1]) if found else -1

    def _segments(self, version: int) -> list[str]:
        if version < 0:
            return []
        return json.loads(read_text(self.spark, f"{self.folder}/versions/{version:010d}"))

    def _read(self, what: str, schema: str, version: int | None = None) -> DataFrame:
        segments = self._segments(self.version() if version is None else version)
        paths = [f"{self.folder}/segments/{s}/{what}" for s in segments]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def terms(self, version: int | None = None) -> DataFrame:
        """(rule_id, term) as of a version."""
        summed = self._read("terms", _TERMS, version).groupBy("rule_key", "term").agg(F.sum("n").alias("n"))
        return summed.where("n > 0").select(F.col("rule_key").alias("rule_id"), "term")

    def anchors(self, version: int | None = None) -> DataFrame:
        """(term, gram) as of a version; terms that no rule has any more may be there still."""
        return self._read("anchors", _ANCHORS, version)

    def update(self, added: DataFrame | None = None, removed: DataFrame | None = None, version: int | None = None) -> int:
        """Adds and removes rules (rule_id, value) and publishes the result as the next version (or as `version`, if that is not there yet).

        A changed rule is removed with its old value and added with its new one.
        """
        empty = self.spark.createDataFrame([], "rule_id STRING, value STRING")
        parts = [_term_rows(empty if rules is None else rules, n) for rules, n in ((added, 1), (removed, -1))]
        return self._apply(parts[0].unionByName(parts[1]), version)

    def follow(self, rules: DataFrame, version: int | None = None) -> int:
        """Brings the index to a whole rule table (rule_id, value): only what differs is added and removed, by one join of terms."""
        now = _term_rows(rules, 1).groupBy("rule_key", "term").agg(F.sum("n").alias("now"))
        had = self._read("terms", _TERMS).groupBy("rule_key", "term").agg(F.sum("n").alias("had"))
        both = now.join(had, ["rule_key", "term"], "full").select("rule_key", "term", F.coalesce("now", F.lit(0)).alias("now"), F.coalesce("had", F.lit(0)).alias("had"))
        delta = both.where("now <> had").select("rule_key", "term", (F.col("now") - F.col("had")).alias("n"))
        return self._apply(delta, version)

    def _apply(self, delta: DataFrame, version: int | None) -> int:
        before = self.version()
        target = before + 1 if version is None else version
        if target <= before:
            return before
        name = uuid.uuid4().hex
        segment = f"{self.folder}/segments/{name}"
        delta.write.parquet(f"{segment}/terms")
        changes = self.spark.read.schema(_TERMS).parquet(f"{segment}/terms")
        known = self.anchors(before)
        fresh = changes.where("n > 0 AND term <> ''").select("term").distinct().join(known.select("term"), "term", "left_anti")
        earlier = known.groupBy("gram").agg(F.count("*").alias("n_terms"))
        gram_of_terms(term_grams(fresh), earlier).write.parquet(f"{segment}/anchors")
        publish(self.spark, f"{self.folder}/versions/{target:010d}", json.dumps([*self._segments(before), name]))
        return target

    def compact(self) -> int:
        """Puts all segments together to one, without terms that no rule has any more, as the next version."""
        before = self.version()
        name = uuid.uuid4().hex
        segment = f"{self.folder}/segments/{name}"
        self._read("terms", _TERMS).groupBy("rule_key", "term").agg(F.sum("n").alias("n")).where("n > 0").write.parquet(f"{segment}/terms")
        alive = self.spark.read.schema(_TERMS).parquet(f"{segment}/terms").select("term").distinct()
        self.anchors(before).join(alive, "term", "left_semi").write.parquet(f"{segment}/anchors")
        publish(self.spark, f"{self.folder}/versions/{before + 1:010d}", json.dumps([name]))
        return before + 1

    def forget(self, below: int) -> None:
        """Deletes versions below a number, and the segments that no later one has."""
        versions = names(self.spark, f"{self.folder}/versions")
        kept = {s for v in versions if int(v) >= below for s in self._segments(int(v))}
        for v in versions:
            if int(v) < below:
                delete(self.spark, f"{self.folder}/versions/{v}")
        for s in names(self.spark, f"{self.folder}/segments"):
            if s not in kept:
                delete(self.spark, f"{self.folder}/segments/{s}")

    def pairs(self, messages: DataFrame, text: str = "keyword", row_id: str = "row_id", version: int | None = None) -> DataFrame:
        """(row_id, rule_id) of every rule whose terms are all substrings of the message text: keyword_pairs() by the index."""
        return keyword_pairs(messages, self.terms(version), text, row_id, "rule_id", self.anchors(version))


def _term_rows(rules: DataFrame, n: int) -> DataFrame:
    named = rules.where("rule_id IS NOT NULL AND value IS NOT NULL")
    return named.select(F.col("rule_id").cast("string").alias("rule_key"), F.explode(V.match_terms(F.col("value"))).alias("term"), F.lit(n).cast("long").alias("n"))
