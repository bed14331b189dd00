"""Which rules a micro-batch used: versions of the rule table, and a log of batches next to the checkpoint."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievestream.files import delete, names, publish, read_text
from sievestream.operators import matching as X


class RuleLog:
    """Every batch is logged with its rules version before it is worked on, so one that runs again uses the rules it had.

    A version is a snapshot of the rule table, written when the rules have changed: when `changed()` gives something else than it gave for the
    newest version (for instance the time of the latest notice that concerns the instance, see `collector.latest_change`), or without `changed` when
    the digest of the table differs. Rules in the form that travels with the plan are kept by version; they are read again for a new version only.
    Log entries and snapshots beyond the last `retain` batches are deleted.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        read_rules: Callable[[], DataFrame],
        changed: Callable[[], object] | None = None,
        retain: int = 100,
    ):
        self.spark, self.folder, self.read_rules, self.changed, self.retain = spark, folder.rstrip("/"), read_rules, changed, retain
        self._bags: dict[tuple[int, str], X.RuleBag] = {}
        logged = names(spark, f"{self.folder}/batches")
        self._newest = json.loads(read_text(spark, f"{self.folder}/batches/{logged[-1]}")) if logged else None

    def _entry(self, batch_id: int) -> str:
        return f"{self.folder}/batches/{batch_id:020d}"

    def _token(self) -> str:
        return json.dumps(self.changed(), default=str) if self.changed is not None else table_digest(self.read_rules())

    def version(self, batch_id: int) -> int:
        """The rules version of a batch: the logged one, else the newest, which is made if the rules have changed."""
        logged = read_text(self.spark, self._entry(batch_id))
        if logged is not None:
            return json.loads(logged)["version"]
        token = self._token()
        if self._newest is None or self._newest["token"] != token:
            version = 0 if self._newest is None else self._newest["version"] + 1
            self.read_rules().write.mode("overwrite").parquet(self._snapshot(version))
            self._newest = {"version": version, "token": token}
        publish(self.spark, self._entry(batch_id), json.dumps(self._newest))
        if batch_id % self.retain == 0:
            self._forget(batch_id - self.retain)
        return self._newest["version"]

    def _snapshot(self, version: int) -> str:
        return f"{self.folder}/rules-{version}"

    def rules(self, version: int) -> DataFrame:
        return self.spark.read.parquet(self._snapshot(version))

    def bag(self, version: int, collector_type: str, order: str = "rule_id") -> X.RuleBag:
        """The rules of a version as they travel with the plan, read once."""
        if (version, collector_type) not in self._bags:
            self._bags = {k: v for k, v in self._bags.items() if k[0] >= version - 1}
            self._bags[version, collector_type] = X.rule_bag(self.rules(version), collector_type, order)
        return self._bags[version, collector_type]

    def _forget(self, below: int) -> None:
        entries = names(self.spark, f"{self.folder}/batches")
        kept = [e for e in entries if int(e) >= below] or entries[-1:]
        oldest = json.loads(read_text(self.spark, f"{self.folder}/batches/{kept[0]}"))["version"]
        for entry in set(entries) - set(kept):
            delete(self.spark, f"{self.folder}/batches/{entry}")
        for name in names(self.spark, self.folder):
            if name.startswith("rules-") and int(name.split("-")[1]) < oldest:
                delete(self.spark, f"{self.folder}/{name}")


def table_digest(rows: DataFrame) -> str:
    """A digest of the rows in any order: their number, and sums of two hashes of each."""
    row = F.to_json(F.struct(*(F.col(f"`{c}`") for c in sorted(rows.columns))), {"ignoreNullFields": "false"})
    hashes = rows.select(F.xxhash64(row).cast("decimal(38,0)").alias("a"), F.xxhash64(row, F.lit(1)).cast("decimal(38,0)").alias("b"))
    found = hashes.agg(F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    return f"{found['n']}/{found['a']}/{found['b']}"
