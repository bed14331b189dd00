"""What a message offers for matching: free text, hashtags, user ids and screen names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Places in a message that can carry text and entities of their own.
_STATUSES = ("", "retweeted_status.", "quoted_status.")
_CARRIERS = tuple(prefix + part for prefix in _STATUSES for part in ("", "extended_tweet."))


def _present(array: Column, element_type: str = "string") -> Column:
    return F.coalesce(array, F.array().cast(f"array<{element_type}>"))


def _each_entity(message: str, kind: str, field: str) -> list[Column]:
    return [_present(F.col(f"{message}.{carrier}entities.{kind}.{field}")) for carrier in _CARRIERS]


def _clean_set(values: Column) -> Column:
    return F.array_remove(F.array_distinct(F.array_compact(values)), "")


def url_fields(entities: Column) -> Column:
    """All expanded and displayed addresses of a url or media array."""
    return F.array_compact(F.concat(_present(entities["expanded_url"]), _present(entities["display_url"])))


def free_text_parts(message: str = "message") -> Column:
    """The set of texts keyword rules look at."""
    texts = [f"{message}.{prefix}{field}" for prefix in _STATUSES for field in ("text", "extended_tweet.full_text")]
    texts.append(f"{message}.user.screen_name")
    urls = [
        url_fields(F.col(f"{message}.{carrier}entities.{kind}")) for carrier in _CARRIERS for kind in ("urls", "media")
    ]
    return _clean_set(F.concat(F.array(*[F.col(t) for t in texts]), *urls))


def keyword_text(message: str = "message") -> Column:
    return F.lower(F.array_join(free_text_parts(message), " "))


def hashtags(message: str = "message") -> Column:
    tags = F.array_compact(F.concat(*_each_entity(message, "hashtags", "text")))
    return _clean_set(F.transform(tags, F.lower))


def user_ids(message: str = "message") -> Column:
    authors = F.array(*[F.col(f"{message}.{prefix}user.id_str") for prefix in _STATUSES])
    return _clean_set(F.concat(authors, *_each_entity(message, "user_mentions", "id_str")))


def screen_names(message: str = "message") -> Column:
    authors = F.array(*[F.col(f"{message}.{prefix}user.screen_name") for prefix in _STATUSES])
    names = F.array_compact(F.concat(authors, *_each_entity(message, "user_mentions", "screen_name")))
    return _clean_set(F.transform(names, F.lower))


CONTENT_BUILDERS = {
    "keyword": keyword_text,
    "hashtag": hashtags,
    "userid": user_ids,
    "username": screen_names,
}
