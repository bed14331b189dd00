"""Rule x message matching.

Two physical forms with one result; the caller chooses, the size of a table never does:

* *in place* (`match_in_place`): the rules of the collector, read once and checked to be at most `MAX_BAG_BYTES`, travel with
  the plan as a constant and every message is tested where it lies: no join, no shuffle, works on streams. Set rules
  (hashtag, user id, screen name) are native array expressions. Keyword rules look for many substrings in one text; one
  pass of a multi-pattern automaton over Arrow batches finds them all (`automaton=False`: a native `contains` per term).
* *by joins* (`keyword_pairs`, `set_pairs`, `tag_by_joins`): rule tables of any size. Only equi-joins, salted so that
  a frequent word, author or rule is spread over many tasks.

Every row of a rule table is a rule of its own, whatever its id.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sievestream.functions import geo as G
from sievestream.functions import values as V
from sievestream.operators.distribute import are_few, repeated, salted_join, spread, written_join
from sievestream.session import cut_lineage, rows_within
from sievestream.schemas import MATCHABLE_KINDS, NOT_FOUND, RULE_FIELDS, check_collector_type

FORMS = ("in_place", "joins")
# The most bytes of rules or boxes that travel with a plan; more is an error of the in-place form.
MAX_BAG_BYTES = 32 << 20
GRAM = 4
# Salts where the repeated side may itself be large; adaptive skew handling splits further.
WIDE_SALTS = 4


@dataclass(frozen=True)
class RuleBag:
    """The rules of one collector, small enough to travel with the plan."""

    columns: tuple[str, ...]
    rows: tuple[dict, ...]
    collector_type: str
    terms: dict[str, list[tuple[int, tuple[str, ...]]]] = field(default_factory=dict)
    _finders: dict = field(default_factory=dict, compare=False, repr=False)

    def finder(self, spark: SparkSession, automaton: bool) -> Callable[[Column], Column]:
        """The keyword search, made once for a bag that serves many micro-batches."""
        if automaton not in self._finders:
            self._finders[automaton] = substring_finder(spark, self.terms["keyword"], automaton)
        return self._finders[automaton]

    @property
    def matched_type(self) -> str:
        fields = "".join(f"{c}: STRING, " for c in self.columns)
        return f"ARRAY<STRUCT<{fields}rule_tag: STRING, rule_value: STRING>>"

    def literal(self) -> Column:
        """All rules in table order, each with the two compatibility fields `rule_tag` and `rule_value`."""
        full = [{**r, "rule_tag": r.get("tag"), "rule_value": r.get("value")} for r in self.rows]
        return F.from_json(F.lit(json.dumps(full)), self.matched_type)


def with_basic_fields(rules: DataFrame) -> DataFrame:
    missing = [c for c in ("tag", "orig_type") if c not in rules.columns]
    return rules.withColumns({c: F.lit(None).cast("string") for c in missing})


def check_form(form: str) -> str:
    if form not in FORMS:
        raise ValueError(f"unknown form: {form!r}")
    return form


class TooLarge(ValueError):
    """Rows do not fit into what travels with a plan."""


def few_rows(rows: DataFrame, what: str, max_bytes: int = MAX_BAG_BYTES) -> list:
    """Rows that travel with a plan; an error if they are too large for that."""
    found = rows_within(rows, max_bytes)
    if found is None:
        raise TooLarge(f"the {what} take more than {max_bytes} bytes: too large to travel with the plan, use form='joins'")
    return found


def rule_bag(rules: DataFrame, collector_type: str, order: str = "rule_id", max_bytes: int = MAX_BAG_BYTES) -> RuleBag:
    """Reads the rules, which have to fit into `max_bytes`."""
    check_collector_type(collector_type)
    rules = with_basic_fields(rules)
    columns = tuple(c for c in RULE_FIELDS if c in rules.columns)
    terms = V.match_terms(F.col("value")).alias("_terms")
    wanted = rules.where("value IS NOT NULL").select(
        *[F.col(c).cast("string") for c in columns], terms, F.col(order).alias("_order")
    )
    found = few_rows(wanted, "rules", max_bytes)
    found.sort(key=lambda r: (True,) if r["_order"] is None else (False, r["_order"]))
    by_kind: dict[str, list] = {k: [] for k in MATCHABLE_KINDS[collector_type]}
    for i, r in enumerate(found):
        if r["orig_type"] in by_kind:
            # Long terms are the rare ones: test them first.
            by_kind[r["orig_type"]].append((i, tuple(sorted(r["_terms"], key=lambda t: (-len(t), t)))))
    rows = tuple({c: r[c] for c in columns if r[c] is not None} for r in found)
    return RuleBag(columns, rows, collector_type, {k: v for k, v in by_kind.items() if v})


Entries = list[tuple[int, tuple[str, ...]]]


def substring_hits(spark: SparkSession, text: Column, entries: Entries, automaton: bool = True) -> Column:
    """Positions (ascending) of the entries whose terms all occur in `text`."""
    return substring_finder(spark, entries, automaton)(text)


def substring_finder(spark: SparkSession, entries: Entries, automaton: bool = True) -> Callable[[Column], Column]:
    """`substring_hits` of these entries, for any text. The automaton needs its library on the executors."""
    if automaton:
        return _automaton_hits(spark, entries)
    rules = _term_literal(entries)
    all_in = lambda t: F.filter(rules, lambda r: F.forall(r["terms"], lambda term: F.contains(t, term)))
    return lambda text: F.transform(V.let(text, all_in), lambda r: r["idx"])


def _term_literal(entries: Entries) -> Column:
    rows = [{"idx": i, "terms": list(terms)} for i, terms in entries]
    return F.from_json(F.lit(json.dumps(rows)), "ARRAY<STRUCT<idx: INT, terms: ARRAY<STRING>>>")


def _automaton_hits(spark: SparkSession, entries: Entries):
    """Arrow UDF: all terms are looked for in one pass over the text, however many there are."""
    shipped = spark.sparkContext.broadcast(entries)

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        always = [i for i, terms in shipped.value if terms[0] == ""]
        # An entry is looked up by its longest term; the rest is tested only when that one occurs.
        by_anchor: dict[str, list[tuple[int, tuple[str, ...]]]] = {}
        for i, terms in shipped.value:
            if terms[0] != "":
                by_anchor.setdefault(terms[0], []).append((i, tuple(t for t in terms[1:] if t)))
        finder = ahocorasick.Automaton()
        for anchor, found in by_anchor.items():
            finder.add_word(anchor, (anchor, found))
        finder.make_automaton()

        def one(text: str | None) -> list[int] | None:
            if text is None:
                return None
            anchors = dict(found for _, found in finder.iter(text)) if by_anchor else {}
            matched = [i for found in anchors.values() for i, rest in found if all(t in text for t in rest)]
            return sorted(always + matched)

        for texts in batches:
            yield texts.map(one)

    # Otherwise filters inferred from a later explode would run it a second time.
    return hits.asNondeterministic()


def _set_hits(members: str, kind: str, bag: RuleBag) -> Column:
    """Positions of the rules whose terms are all in the array column `members`.

    The few members of a message are looked up in a hash set of the rules' longest terms; only where one is known
    are that term's rules tested. They lie in many small maps chosen by a checksum, since Spark searches a map from its start.
    """
    by_anchor: dict[str, list[dict]] = {}
    for i, terms in bag.terms[kind]:
        by_anchor.setdefault(terms[0], []).append({"idx": i, "rest": list(terms[1:])})
    known = F.expr(f"filter({members}, m -> m IN ({', '.join(map(_sql_string, by_anchor))}))")
    n = len(by_anchor) // 4 + 1
    maps: list[dict] = [{} for _ in range(n)]
    for anchor, of_anchor in by_anchor.items():
        maps[zlib.crc32(anchor.encode()) % n][anchor] = of_anchor
    rules_of = F.from_json(F.lit(json.dumps(maps)), "ARRAY<MAP<STRING, ARRAY<STRUCT<idx: INT, rest: ARRAY<STRING>>>>>")
    place = lambda m: (F.crc32(m.cast("binary")) % n).cast("int")
    proposed = F.flatten(F.transform(known, lambda m: F.element_at(F.get(rules_of, place(m)), m)))
    hit = F.filter(proposed, lambda r: F.forall(r["rest"], lambda t: F.array_contains(F.col(members), t)))
    return F.transform(hit, lambda r: r["idx"])


def _sql_string(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def match_in_place(messages: DataFrame, bag: RuleBag, contents: dict[str, Column], automaton: bool = True) -> DataFrame:
    """Adds `collection_rules`: every rule the message satisfies, in rule order.

    `contents` gives, per rule kind, the text or set that rules of this kind look at; only kinds present in the
    bag are computed.
    """
    spark = messages.sparkSession
    empty = F.array().cast(bag.matched_type)
    kept = messages.columns
    positions = []
    for kind in bag.terms:
        if kind == "keyword":
            positions.append(bag.finder(spark, automaton)(contents[kind]))
        else:
            messages = messages.withColumn(f"_{kind}", contents[kind])
            positions.append(_set_hits(f"_{kind}", kind, bag))
    if not positions:
        return messages.withColumn("collection_rules", empty)
    found = F.sort_array(F.concat(*[F.coalesce(p, F.array().cast("array<int>")) for p in positions]))
    rules = bag.literal()
    tagged = messages.select(*kept, found.alias("_found"))
    return tagged.select(*kept, F.transform("_found", lambda i: F.get(rules, i)).alias("collection_rules"))


# --- join form -----------------------------------------------------------------------------------------------------


def with_key(rules: DataFrame) -> DataFrame:
    """Numbers the rows as `_key`, in table order; written once so that every use sees the same numbers."""
    return cut_lineage(with_basic_fields(rules).withColumn("_key", F.monotonically_increasing_id()), "rules")


def terms_table(rules: DataFrame, kind: str, key: str = "rule_id") -> DataFrame:
    """(key, term) of the rules of one kind; `key` has to be unique for rules to be told apart."""
    of_kind = rules.where((F.col("orig_type") == kind) & F.col("value").isNotNull())
    return of_kind.select(key, F.explode(V.match_terms(F.col("value"))).alias("term"))


def _grams(text: Column, length: int) -> Column:
    every = F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{length}}}))"), F.lit(1))
    return F.array_distinct(every)


def _all_grams(text: Column, lengths: list[int]) -> Column:
    return F.concat(*[_grams(text, n) for n in lengths])


def term_grams(terms: DataFrame) -> DataFrame:
    """(term, gram): every gram of each term; terms shorter than a gram are one themselves."""
    size = F.least(F.char_length("term"), F.lit(GRAM))
    own = F.lit(None).cast("array<string>")
    for n in range(1, GRAM + 1):
        own = F.when(size == n, _grams(F.col("term"), n)).otherwise(own)
    return terms.where("term <> ''").select("term", F.explode(own).alias("gram"))


def gram_of_terms(grams: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """(term, gram): of each term's grams the one it shares with the fewest others; `earlier` (gram, n_terms) counts terms not among these."""
    counts = grams.groupBy("gram").agg(F.count("*").alias("n_terms"))
    if earlier is not None:
        counts = counts.unionByName(earlier).groupBy("gram").agg(F.sum("n_terms").alias("n_terms"))
    rated = salted_join(grams, counts, ["gram"], F.col("term"), shuffled=True)
    return rated.groupBy("term").agg(F.min_by("gram", F.struct("n_terms", "gram")).alias("gram"))


def _anchored_terms(tokens: DataFrame, anchors: DataFrame) -> DataFrame:
    """The rows of `tokens` with each `term` that the token contains; `anchors` is (term, gram), written.

    Every term is looked up by its gram. Candidates are verified.
    """
    lengths = sorted(r["n"] for r in anchors.select(F.char_length("gram").alias("n")).distinct().collect())  # at most GRAM numbers
    if not lengths:
        return tokens.select("*", F.col("token").alias("term")).where(F.lit(False))
    token_grams = tokens.select("*", F.explode(_all_grams(F.col("token"), lengths)).alias("gram"))
    candidates = written_join(token_grams, anchors, ["gram"], F.col("token"))
    return candidates.where(F.contains("token", "term")).select(*tokens.columns, "term")


def keyword_pairs(
    messages: DataFrame,
    terms: DataFrame,
    text: str = "keyword",
    row_id: str = "row_id",
    key: str = "rule_id",
    anchors: DataFrame | None = None,
) -> DataFrame:
    """(row_id, key) of every keyword rule whose terms are all substrings of the message text.

    A term has no blank, so it can only occur inside one blank-separated token. Where the terms are few they go to all tasks and the tokens stay where
    they are. Otherwise substring search is done once on the distinct tokens of the whole input; messages meet the result by equality. `anchors` gives the gram of
    each term where an index keeps them; else it is the one that a term shares with the fewest others.
    """
    tokens = messages.select(
        row_id, F.explode(F.array_distinct(F.split(F.col(text), " "))).alias("token")
    ).where("token != ''")
    if anchors is None:
        anchors = gram_of_terms(term_grams(terms.select("term").where("term != ''").distinct()))
    anchors = cut_lineage(anchors, "anchors")
    if are_few(anchors):
        found = _anchored_terms(tokens, anchors)
    else:
        # Written out, its rows are known: where they are few the tokens stay where they are.
        hits = cut_lineage(_anchored_terms(tokens.select("token").distinct(), anchors), "token-hits")
        found = written_join(tokens, hits, ["token"], F.col(row_id), WIDE_SALTS)
    found = found.select(row_id, "term").distinct()
    worded = terms.where("term != ''")
    pairs = _all_terms_found(found, worded, row_id, key)
    # A value of blanks only has no word to look for: such a rule belongs to every message, as a constant.
    blank = terms.groupBy(key).agg(F.max("term").alias("top")).where("top = ''").select(key)
    everywhere = [r[key] for r in few_rows(blank, "rules without a word")]
    if not everywhere:
        return pairs
    listed = F.from_json(F.lit(json.dumps(everywhere)), f"ARRAY<{blank.schema[key].dataType.simpleString()}>")
    return pairs.unionByName(messages.where(F.col(text).isNotNull()).select(row_id, F.explode(listed).alias(key)))


def set_pairs(
    messages: DataFrame, terms: DataFrame, members: str, row_id: str = "row_id", key: str = "rule_id"
) -> DataFrame:
    """(row_id, key) of every rule whose terms are all members of the message's set."""
    present = messages.select(row_id, F.explode(F.array_distinct(members)).alias("term"))
    wanted = terms.select("term").distinct()
    found = salted_join(present, wanted, ["term"], F.col(row_id), salts=WIDE_SALTS, shuffled=True)
    return _all_terms_found(found.select(row_id, "term"), terms, row_id, key)


def _all_terms_found(found: DataFrame, terms: DataFrame, row_id: str, key: str) -> DataFrame:
    """Relational division of (row_id, term) by (key, term).

    A rule is first proposed only by its rarest term, so a frequent word shared by many rules proposes none of them;
    the other terms, which come with it, are then looked up. Rules with a term that no row has are not proposed. `found` is used three times: written once.
    """
    found = cut_lineage(found, "found")
    frequency = found.groupBy("term").agg(F.count("*").alias("n_rows"))
    rated = salted_join(terms, frequency, ["term"], F.col(key), how="left", salts=WIDE_SALTS, shuffled=True)
    per_rule = rated.groupBy(key).agg(
        F.min_by("term", F.struct("n_rows", "term")).alias("term"),
        F.count("*").alias("n_terms"),
        F.count("n_rows").alias("n_known"),
        F.collect_list("term").alias("terms"),
    )
    per_rule = cut_lineage(per_rule.where("n_known = n_terms").drop("n_known"), "proposals")
    # Few rules go to all tasks, and the rows stay where they are.
    proposed = written_join(found, per_rule, ["term"], F.col(row_id), WIDE_SALTS)
    single = proposed.where("n_terms = 1").select(row_id, key)
    several = proposed.where((F.col("n_terms") > 1) & F.col(key).isNotNull())
    others = several.select(row_id, key, "n_terms", F.explode(F.filter("terms", lambda t: t != F.col("term"))).alias("other")).withColumnRenamed("other", "term")
    confirmed = (
        others.join(found.hint("merge"), [row_id, "term"])  # its files are small for what they hold
        .groupBy(row_id, key)
        .agg(F.count("*").alias("n_found"), F.first("n_terms").alias("n_terms"))
        .where("n_found = n_terms - 1")
    )
    return single.unionByName(confirmed.select(row_id, key))


def _key_pairs(
    messages: DataFrame, keyed: DataFrame, collector_type: str, row_id: str, anchors: DataFrame | None = None
) -> DataFrame:
    """(row_id, _key) over all kinds the collector type can match."""
    parts = []
    for kind in MATCHABLE_KINDS[collector_type]:
        terms = terms_table(keyed, kind, "_key")
        if kind == "keyword":
            parts.append(keyword_pairs(messages, terms, kind, row_id, "_key", anchors))
        else:
            parts.append(set_pairs(messages, terms, kind, row_id, "_key"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def match_pairs(messages: DataFrame, rules: DataFrame, collector_type: str, row_id: str = "row_id") -> DataFrame:
    """(row_id, rule_id) of every rule that matches; `messages` has one content column per kind."""
    check_collector_type(collector_type)
    keyed = with_key(rules)
    content = messages.select(row_id, *MATCHABLE_KINDS[collector_type])
    numbered = cut_lineage(content.withColumn("_message", F.monotonically_increasing_id()), "messages")
    pairs = _key_pairs(numbered, keyed, collector_type, "_message")
    named = salted_join(pairs, keyed.select("_key", "rule_id"), ["_key"], F.col("_message"), salts=WIDE_SALTS, shuffled=True)
    return named.join(numbered.select("_message", row_id), "_message").select(row_id, "rule_id")


def match_long(
    messages: DataFrame, rules: DataFrame, collector_type: str, row_id: str = "row_id", form: str = "in_place", max_bytes: int = MAX_BAG_BYTES
) -> DataFrame:
    """(row_id, rule_id) by the form chosen; `messages` has one content column per kind.

    Pairs are the same in both forms, so rules that are too large to travel with the plan are matched by joins in either.
    """
    if check_form(form) == "joins":
        return match_pairs(messages, rules, collector_type, row_id)
    try:
        bag = rule_bag(rules, collector_type, max_bytes=max_bytes)
    except TooLarge:
        return match_pairs(messages, rules, collector_type, row_id).withColumn("rule_id", F.col("rule_id").cast("string"))
    contents = {kind: F.col(kind) for kind in bag.terms}
    tagged = match_in_place(messages.select(row_id, *bag.terms), bag, contents)
    return tagged.select(row_id, F.explode("collection_rules.rule_id").alias("rule_id"))


def matched_rules(rules: DataFrame) -> DataFrame:
    """The full rule rows with `rule_tag` and `rule_value`, as they are put into messages."""
    return rules.select(*_matched_columns(rules))


def _matched_columns(rules: DataFrame) -> list[Column]:
    columns = [F.col(c).cast("string").alias(c) for c in RULE_FIELDS if c in rules.columns]
    return [*columns, F.col("tag").alias("rule_tag"), F.col("value").alias("rule_value")]


def tag_by_joins(
    messages: DataFrame,
    rules: DataFrame,
    collector_type: str,
    row_id: str = "row_id",
    order: str = "rule_id",
    anchors: DataFrame | None = None,
) -> DataFrame:
    """`collection_rules` for rule tables of any size; `messages` has one content column per kind.

    Messages get a number of their own, so repeated and null ids keep their rows apart; `row_id` is not used. `anchors` are the grams of
    all keyword terms where an index (operators.term_index) keeps them.
    """
    keyed = with_key(rules)
    rows = keyed.select("_key", F.col(order).alias("_order"), F.struct(*_matched_columns(keyed)).alias("_rule"))
    numbered = cut_lineage(messages.withColumn("_message", F.monotonically_increasing_id()), "messages")
    content = numbered.select("_message", *MATCHABLE_KINDS[collector_type])
    pairs = _key_pairs(content, keyed, collector_type, "_message", anchors)
    # As in place: by the order column, null last, equal ones in table order.
    tag = F.struct(F.col("_order").isNull().alias("_last"), "_order", "_key", "_rule")
    tags = salted_join(pairs, rows, ["_key"], F.col("_message"), salts=WIDE_SALTS, shuffled=True).groupBy("_message").agg(F.array_sort(F.collect_list(tag)).alias("_tags"))
    empty = F.array().cast(T.ArrayType(rows.schema["_rule"].dataType))
    picked = F.coalesce(F.transform("_tags", lambda t: t["_rule"]), empty)
    return numbered.join(tags, "_message", "left").select(*messages.columns, picked.alias("collection_rules"))


def mark_unmatched(matched: DataFrame, collector_type: str, instance_id: int) -> DataFrame:
    """The fields that tell that no rule matched; null where one did."""
    none = F.size("collection_rules") == 0
    return (
        matched.withColumn("rule_type", F.when(none, F.lit(collector_type)))
        .withColumn("id", F.when(none, F.lit(instance_id)))
        .withColumn("rule_tag", F.when(none, F.lit(NOT_FOUND)))
        .withColumn("rule_value", F.when(none, F.lit(NOT_FOUND)))
    )


# --- collection filter ---------------------------------------------------------------------------------------------

def matching_only(tagged: DataFrame) -> DataFrame:
    """Messages that satisfy at least one track or follow rule."""
    return tagged.where(F.size("collection_rules") > 0)


def within_boxes(
    messages: DataFrame,
    boxes: DataFrame,
    area: Column,
    form: str = "in_place",
) -> DataFrame:
    """Messages whose area touches a box of a locations rule (`boxes` has `value`).

    In place every box is tested on every message, also on streams. The join form meets them in cells: a box is covered by a few cells of the level that fits its
    size, and so is an area. Of two that touch, the cells of the larger are the same as, or lie above, those of the smaller; so either side is also looked up
    by the cells above its own, on the levels that the other side has. Rows in the join grow with boxes and messages, whatever their sizes.
    """
    parsed = boxes.select(G.box(F.col("value")).alias("box")).where("box IS NOT NULL").distinct()
    if check_form(form) == "in_place":
        few = few_rows(parsed, "boxes")
        literal = F.from_json(
            F.lit(json.dumps([r["box"].asDict() for r in few])),
            "ARRAY<STRUCT<lon1: DOUBLE, lat1: DOUBLE, lon2: DOUBLE, lat2: DOUBLE>>",
        )
        return messages.where(V.let(area, lambda a: F.exists(literal, lambda b: G.overlaps(a, b))))
    numbered = cut_lineage(messages.withColumn("_message", F.monotonically_increasing_id()), "messages")
    placed = numbered.select("_message", area.alias("area")).where("area IS NOT NULL").withColumn("level", G.cell_level(F.col("area")))
    placed = cut_lineage(placed, "areas")
    levelled = cut_lineage(parsed.withColumn("level", G.cell_level(F.col("box"))), "boxes")
    levels = [sorted(r["level"] for r in side.select("level").distinct().collect()) for side in (levelled, placed)]  # at most CELL_LEVELS numbers
    by_cell = placed.withColumn("cell", F.explode(G.cells(F.col("area"), F.col("level"), levels[0])))
    by_cell = spread(by_cell, F.col("_message"), WIDE_SALTS)
    box_cells = repeated(levelled.withColumn("cell", F.explode(G.cells(F.col("box"), F.col("level"), levels[1]))), WIDE_SALTS)
    # A semi join stops at the first box that fits: no message x box pairs are produced.
    fits = (
        (by_cell["cell"] == box_cells["cell"])
        & (by_cell["_salt"] == box_cells["_salt"])
        & G.overlaps(by_cell["area"], box_cells["box"])
    )
    inside = by_cell.join(box_cells, fits, "left_semi").select("_message").distinct()
    return numbered.join(inside, "_message", "left_semi").select(*messages.columns)
