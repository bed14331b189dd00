"""The whole way of a message, as one DataFrame -> DataFrame function for tables and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from sievestream.functions.content import CONTENT_BUILDERS
from sievestream.operators import matching as X
from sievestream.operators import messages as M
from sievestream.operators import rules as R
from sievestream.schemas import DEFAULT_META, MATCHABLE_KINDS, check_collector_type


def contents(collector_type: str, message: str = "message") -> dict[str, Column]:
    return {kind: CONTENT_BUILDERS[kind](message) for kind in MATCHABLE_KINDS[collector_type]}


def prepare(
    lines: DataFrame, instance_id: int, meta: str = DEFAULT_META, observation: Observation | str | None = None
) -> DataFrame:
    """Keep-alives and malformed lines out (counted by `observation`); parsed, classified, with time and instance id."""
    if observation is None:
        parsed = M.parse(M.drop_keep_alives(lines))
    else:
        parsed = M.drop_keep_alives(M.observe_lines(M.parse(lines), observation))
    parsed = M.well_formed(parsed)
    return M.add_metadata(M.classify(parsed), instance_id, meta)


def tag(
    prepared: DataFrame,
    rules: DataFrame | X.RuleBag,
    collector_type: str,
    instance_id: int,
    order: str = "rule_id",
    form: str = "in_place",
    anchors: DataFrame | None = None,
) -> DataFrame:
    """Adds `collection_rules` (null for what is not a tweet) and the marker for tweets without a match.

    `form` is how rules meet messages (see operators.matching); joins need a table or a micro-batch, and take `anchors` from an index of terms. In place
    the rules may be given as they travel with the plan.
    """
    check_collector_type(collector_type)
    X.check_form(form)
    if collector_type == "locations":
        tagged = _tag_locations(prepared, rules, order)
    else:
        if form == "in_place":
            bag = rules if isinstance(rules, X.RuleBag) else X.rule_bag(rules, collector_type, order)
            tagged = X.match_in_place(prepared, bag, contents(collector_type))
        elif prepared.isStreaming:
            raise ValueError("the join form needs a micro-batch: call enrich() inside foreachBatch")
        else:
            with_content = prepared.select("*", *[c.alias(k) for k, c in contents(collector_type).items()])
            tagged = X.tag_by_joins(with_content, rules, collector_type, order=order, anchors=anchors).drop(*MATCHABLE_KINDS[collector_type])
    enriched = (F.col("message_class") == "tweet") & F.col("enrichment_error").isNull()
    tagged = tagged.withColumn("collection_rules", F.when(enriched, F.col("collection_rules")))
    return X.mark_unmatched(tagged, collector_type, instance_id)


def _tag_locations(prepared: DataFrame, rules: DataFrame, order: str) -> DataFrame:
    """Every tweet of a locations collector carries the one folded rule; where it lies is not tested again."""
    source = rules if order != "rule_id" else rules.withColumn("_seq", F.col("rule_id"))
    source = X.with_basic_fields(source)
    folded = R.fold_locations(source, "_seq" if order == "rule_id" else order)
    row = folded.collect()[0].asDict()  # one row by construction
    fields = [F.lit(v).cast("string").alias(k) for k, v in row.items()]
    return prepared.withColumn("collection_rules", F.array(F.struct(*fields)))


_ADDED = ("created_at_iso", "collection_rules", "rule_type", "id", "rule_tag", "rule_value")


def add_output(tagged: DataFrame, meta: str = DEFAULT_META) -> DataFrame:
    """Adds `output`, the line to send: tweets with their metadata, everything else as it came."""
    added = F.struct(F.col("meta_id").alias("id_str"), *_ADDED)
    # A message with metadata of its own keeps its id.
    added = F.when(F.col("has_meta"), F.struct(F.lit(None).cast("int").alias("id_str"), *_ADDED)).otherwise(added)
    text = M.output_json(F.col("value"), added, F.col("has_meta"), meta)
    return tagged.withColumn("output", F.when(F.col("message_class") == "tweet", text).otherwise(F.col("value")))


def enrich(
    lines: DataFrame,
    rules: DataFrame | X.RuleBag,
    collector_type: str,
    instance_id: int = 0,
    order: str = "rule_id",
    meta: str = DEFAULT_META,
    observation: Observation | str | None = None,
    form: str = "in_place",
    anchors: DataFrame | None = None,
) -> DataFrame:
    """Message lines in; one row per well-formed message out, with `collection_rules` and the `output` line."""
    prepared = prepare(lines, instance_id, meta, observation)
    return add_output(tag(prepared, rules, collector_type, instance_id, order, form, anchors), meta)
