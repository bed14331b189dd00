"""Column layouts and fixed limits shared by the operators."""

from __future__ import annotations

COLLECTOR_TYPES = ("track", "follow", "locations")

# How many rules one collector instance may hold when it reads its rules.
SCAN_CAPS = {"follow": 5000, "track": 400, "locations": 1}

# How many rules go into one instance when a rule table is sharded.
SHARD_CAPS = {"follow": 5000, "track": 400, "locations": 25}

# The `type` a rule has in the source table, per collector type.
SOURCE_RULE_TYPES = {"follow": "username", "track": "keyword", "locations": "geo"}

# Which rule kinds each collector type can match.
MATCHABLE_KINDS = {"track": ("keyword", "hashtag"), "follow": ("userid", "username"), "locations": ()}

MAX_TRACK_LENGTH = 60
NOT_FOUND = "Not Found"

# Field of the output message that holds what the engine adds.
DEFAULT_META = "collector"

RULE_FIELDS = (
    "rule_id",
    "value",
    "tag",
    "orig_type",
    "rule_type",
    "status",
    "description",
    "appid",
    "date_added",
    "campaign_id",
    "project_id",
    "project_version_id",
    "node_id",
)
RULE_DDL = ", ".join(f"{name} STRING" for name in RULE_FIELDS)

_URLS = "ARRAY<STRUCT<expanded_url: STRING, display_url: STRING>>"
_ENTITIES = (
    f"STRUCT<urls: {_URLS}, media: {_URLS}, hashtags: ARRAY<STRUCT<text: STRING>>, "
    "user_mentions: ARRAY<STRUCT<id_str: STRING, screen_name: STRING>>>"
)
_USER = "STRUCT<id_str: STRING, screen_name: STRING>"
_EXTENDED = f"STRUCT<full_text: STRING, entities: {_ENTITIES}>"
_STATUS = f"STRUCT<text: STRING, user: {_USER}, entities: {_ENTITIES}, extended_tweet: {_EXTENDED}>"

MESSAGE_DDL = (
    f"id_str STRING, created_at STRING, text STRING, user {_USER}, entities {_ENTITIES}, "
    f"extended_tweet {_EXTENDED}, retweeted_status {_STATUS}, quoted_status {_STATUS}, "
    "limit MAP<STRING, BIGINT>, coordinates STRUCT<coordinates: ARRAY<DOUBLE>>, "
    "place STRUCT<bounding_box: STRUCT<coordinates: ARRAY<ARRAY<ARRAY<DOUBLE>>>>>"
)


def check_collector_type(collector_type: str) -> str:
    if collector_type not in COLLECTOR_TYPES:
        raise ValueError(f"unknown collector type: {collector_type!r}")
    return collector_type
