"""Scalar column expressions on rule values and message fields."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

MICROS = 1_000_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once per row.

    Inside a higher-order function an expression is evaluated once per element, so anything costly that is
    used there has to be bound to a lambda variable first.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def normalized_value(value: Column, orig_type: Column) -> Column:
    """Lower-cased rule value; every word of a hashtag rule starts with '#'."""
    words = F.filter(F.split(value, " "), lambda w: w != "")
    tagged = F.transform(words, lambda w: F.when(F.startswith(w, F.lit("#")), w).otherwise(F.concat(F.lit("#"), w)))
    return F.lower(F.when(orig_type == "hashtag", F.array_join(tagged, " ")).otherwise(value))


def match_terms(value: Column) -> Column:
    """The distinct terms that all have to be found for a rule value to match ('' counts as a term)."""
    return F.array_distinct(F.split(F.lower(value), " "))


def micros(ts: Column) -> Column:
    """Microseconds since the epoch; zone-less timestamps are read in the session time zone."""
    return F.unix_micros(ts.cast("timestamp"))


def floor_div(value: Column, step: int) -> Column:
    """Whole-number division rounding down, exact where a division of doubles is not."""
    return F.call_function("div", value - F.pmod(value, F.lit(step)), F.lit(step))


_MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def created_at_iso(created_at: Column) -> Column:
    """`Mon Feb 22 01:34:53 +0000 2016` as `2016-02-22T01:34:53+00:00`, keeping the given offset.

    ISO input is kept as it is up to a 'T' separator. NULL for anything that is not a valid time.
    """
    date_part = F.substring(created_at, 5, 26)
    valid = F.try_to_timestamp(date_part, F.lit("MMM dd HH:mm:ss Z yyyy")).isNotNull()
    month_number = F.element_at(
        F.create_map(*[F.lit(x) for i, m in enumerate(_MONTHS, 1) for x in (m, f"{i:02d}")]),
        F.substring(created_at, 5, 3),
    )
    from_feed = F.concat(
        F.substring(created_at, 27, 4),
        F.lit("-"),
        month_number,
        F.lit("-"),
        F.substring(created_at, 9, 2),
        F.lit("T"),
        F.substring(created_at, 12, 8),
        F.substring(created_at, 21, 3),
        F.lit(":"),
        F.substring(created_at, 24, 2),
    )
    iso_like = created_at.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?([+-]\d{2}:\d{2}|Z)?$")
    from_iso = F.regexp_replace(F.regexp_replace(created_at, "^(.{10}) ", "$1T"), "Z$", "+00:00")
    return F.when(valid, from_feed).when(iso_like & F.try_to_timestamp(created_at).isNotNull(), from_iso)


def created_at_timestamp(created_at: Column) -> Column:
    """The same field as an event time."""
    return F.coalesce(
        F.try_to_timestamp(F.substring(created_at, 5, 26), F.lit("MMM dd HH:mm:ss Z yyyy")),
        F.try_to_timestamp(created_at),
    )


def follow_id(value: Column) -> Column:
    """The first run of at least seven digits, '' when there is none."""
    return F.regexp_extract(value, r"(?U)(\d{7,})", 1)


def track_phrase(value: Column) -> Column:
    """Takes the operand of a leading `url_contains:` clause and turns dots into blanks."""
    operand = F.regexp_replace(value, r'(?U)url_contains:\s?"?([\w.]+)"?', "$1")
    return F.translate(F.when(F.startswith(value, F.lit("url_contains")), operand).otherwise(value), ".", " ")


def location_box(value: Column) -> Column:
    """`[lon lat][lon lat]` style text as comma-separated numbers."""
    return F.regexp_replace(F.translate(value, "[]", ""), r"(?U)\s", ",")


def author_ids(value: Column) -> Column:
    """All ids written as `from:<digits>`."""
    return F.regexp_extract_all(value, F.lit(r"(?U)from:(\d+)"), F.lit(1))


def all_digits(value: Column) -> Column:
    return value.rlike(r"^[\p{Nd}²³¹⁰⁴-⁹₀-₉]+$")
