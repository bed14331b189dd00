"""The same results in plain SQL over the driver tables (DuckDB dialect)."""

from __future__ import annotations

BENCH_WORDS = """
words AS (
  SELECT item_id, word, row_number() OVER (PARTITION BY item_id ORDER BY length(word), word) AS rank
  FROM (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS word FROM benchmark)
)"""

BENCH_RULES = (
    BENCH_WORDS
    + """,
rules AS (
  SELECT lpad(item_id::VARCHAR, 8, '0') AS rule_id, upper(string_agg(word, ' ' ORDER BY rank)) AS value
  FROM words WHERE rank <= 2 GROUP BY item_id
)"""
)

ALL_TERMS = "list_bool_and(list_transform(string_split(lower(value), ' '), lambda t: contains({text}, t)))"

KEYWORD_PAIRS = (
    BENCH_RULES
    + f""",
pairs AS (SELECT doc_id, rule_id, value FROM documents, rules WHERE {ALL_TERMS.format(text="lower(text)")})"""
)

# The free text of a document as message: its text, author and addresses.
MESSAGE_TEXT = (
    "lower(concat_ws(' ', text, 'Desk_' || source, 'https://' || source || '.example.org/' || doc_id, "
    "source || '.example.org'))"
)

ENRICHED_PAIRS = (
    BENCH_RULES
    + f""",
pairs AS (SELECT doc_id, rule_id, value FROM documents, rules WHERE {ALL_TERMS.format(text=MESSAGE_TEXT)})"""
)

TWO_SETS = """
a AS (SELECT p_partkey AS rule_id, p_brand AS tag, p_name AS value FROM part WHERE p_size <= 30),
b AS (SELECT p_partkey AS rule_id, p_brand AS tag, upper(p_name) AS value FROM part WHERE p_size >= 20)"""

PART_RULES = """
normalized AS (
  SELECT p_partkey AS rule_id, p_name AS value, lower(CASE WHEN p_type = 'PROMO' THEN
    list_aggregate(list_transform(list_filter(string_split(p_name, ' '), lambda w: w <> ''),
      lambda w: CASE WHEN starts_with(w, '#') THEN w ELSE '#' || w END), 'string_agg', ' ')
    ELSE p_name END) AS norm_value
  FROM part
)"""

ALL_RULES = """
all_rules AS (
  SELECT 'follow' AS rule_type, c_custkey AS rule_id, 5000 AS cap FROM customer
  UNION ALL SELECT 'track', p_partkey, 400 FROM part
  UNION ALL SELECT 'locations', s_suppkey, 25 FROM supplier
)"""

NAMELESS = """
WITH rules AS (
  SELECT CASE WHEN n_nationkey % 3 > 0 THEN n_regionkey::VARCHAR END AS rule_id, lower(left(n_name, 2)) AS value FROM nation
  UNION ALL SELECT 'twice', 'the ' || lower(left(n_name, 1)) FROM nation WHERE n_nationkey < 3
  UNION ALL SELECT NULL, '  '
)
SELECT doc_id, rule_id, value, count(*) AS n FROM documents, rules
WHERE list_bool_and(list_transform(string_split(value, ' '), lambda w: contains(lower(text), w)))
GROUP BY ALL"""

ASSIGNED = """
assigned AS (
  SELECT 'follow' AS rule_type, 0 AS instance_id, c_custkey AS rule_id, 5000 AS cap FROM customer
  UNION ALL SELECT 'track', 0, p_partkey, 400 FROM part
  UNION ALL SELECT 'locations', s_nationkey, s_suppkey, 1 FROM supplier
),
capped AS (
  SELECT rule_type, instance_id, rule_id, rn <= cap AS kept FROM (
    SELECT *, row_number() OVER (PARTITION BY rule_type, instance_id ORDER BY rule_id) AS rn FROM assigned)
)"""

BOXES = """
edges AS (
  SELECT *, s_nationkey * 14 - 180 AS west, floor(s_acctbal / 125)::INT - 10 AS south FROM supplier
),
boxes AS (
  SELECT *, west + 9 AS east, south + 12 AS north, west || ',' || south || ',' || (west + 9) || ',' || (south + 12) AS box
  FROM edges
)"""

ROLLING = """
SELECT DISTINCT rule_id, epoch_us(ts) AS at_us,
  count(*) OVER (PARTITION BY rule_id ORDER BY ts RANGE BETWEEN INTERVAL {window} SECONDS PRECEDING AND CURRENT ROW) AS n
FROM {increments}"""

DENSE = """
dense AS (
  SELECT event_id AS row_id, event_type AS rule_value, epoch_us(ts) // 10000 AS at_us FROM events
)"""


def _bucket(source: str, rate: int, capacity: int) -> str:
    """Token bucket by recursion over the position in each key's series; tokens in millionths."""
    full, price = capacity * 1_000_000, 1_000_000
    return f"""
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY rule_value ORDER BY at_us, row_id) AS rn FROM {source}
),
decided AS (
  SELECT rule_value, rn, row_id, at_us, {full - price}::BIGINT AS tokens, TRUE AS admitted FROM ordered WHERE rn = 1
  UNION ALL
  SELECT o.rule_value, o.rn, o.row_id, o.at_us,
    CASE WHEN least({full}, d.tokens + (o.at_us - d.at_us) * {rate}) >= {price}
      THEN least({full}, d.tokens + (o.at_us - d.at_us) * {rate}) - {price}
      ELSE least({full}, d.tokens + (o.at_us - d.at_us) * {rate}) END,
    least({full}, d.tokens + (o.at_us - d.at_us) * {rate}) >= {price}
  FROM decided d JOIN ordered o ON o.rule_value = d.rule_value AND o.rn = d.rn + 1
)"""


EVENT_BUCKET = DENSE + "," + _bucket("dense", 2, 5)


LINE_BUCKET = """
lined AS (
  SELECT event_id AS row_id, user_id::VARCHAR AS rule_value, epoch_us(ts) // 100000000000 * 1000000 AS at_us FROM events
),""" + _bucket("lined", 1, 1)


def _rates(series: str, now_us: int, window_us: int, direction: str = "") -> str:
    seconds = window_us // 1_000_000
    return f"""
SELECT rule_value, sum(n)::BIGINT AS count, greatest(max(n)::DOUBLE, sum(n) / {seconds}.0::DOUBLE) AS max_tps,
  sum(n) / {seconds}.0::DOUBLE AS average_tps,
  least(CASE WHEN count(*) FILTER (WHERE second < {seconds}) < {seconds} THEN 0.0 ELSE min(n) END::DOUBLE,
    sum(n) / {seconds}.0::DOUBLE) AS min_tps{direction}
FROM (
  SELECT rule_value, (at_us - first_us) // 1000000 AS second, count(*) AS n
  FROM (SELECT *, min(at_us) OVER (PARTITION BY rule_value) AS first_us FROM {series} WHERE at_us >= {now_us} - {window_us})
  GROUP BY ALL
) GROUP BY rule_value"""


USERS = """
users AS (
  SELECT user_id::VARCHAR AS userid, arg_max(event_type || '_' || user_id, ts) AS screen_name FROM events GROUP BY user_id
)"""

GEO_LEGACY = (
    BOXES
    + """,
geo_rules AS (
  SELECT s_suppkey AS rule_id, s_nationkey AS nation, west, south, east, north,
    CASE WHEN s_nationkey < 3 THEN west || ',' || south || ',' || east
      WHEN s_nationkey < 6 THEN box || ',7'
      WHEN s_nationkey < 9 THEN west || ',north,' || south || ',' || east
      WHEN s_nationkey < 14 THEN west || ',1' || south || ',' || east || ',' || north
      ELSE box END AS value,
  FROM boxes
),
geo_parts AS (
  SELECT *, CASE WHEN nation BETWEEN 9 AND 13 THEN '1' || south ELSE south::VARCHAR END AS lat1, west::VARCHAR AS lon1,
    north::VARCHAR AS lat2, east::VARCHAR AS lon2
  FROM geo_rules
),
geo_checked AS (
  SELECT rule_id, value,
    CASE WHEN nation < 3 THEN 'not enough values to unpack (expected 4, got 3)'
      WHEN nation < 6 THEN 'too many values to unpack (expected 4)'
      WHEN nation < 9 THEN 'could not convert string to float: ''north'''
      WHEN NOT coalesce(regexp_full_match(lat1, '-?[0-9]+'), FALSE) THEN 'could not convert string to float: ''' || lat1 || ''''
      WHEN NOT (try_cast(lat2 AS DOUBLE) BETWEEN -90 AND 90 AND try_cast(lon2 AS DOUBLE) BETWEEN -180 AND 180)
        THEN 'Lat/lon out of range: ' || lat2 || ', ' || lon2
      WHEN NOT (try_cast(lat1 AS DOUBLE) BETWEEN -90 AND 90 AND try_cast(lon1 AS DOUBLE) BETWEEN -180 AND 180)
        THEN 'Lat/lon out of range: ' || lat1 || ', ' || lon1
    END AS error
  FROM geo_parts
)"""
)

RECENT = (
    BENCH_WORDS
    + """,
keywords AS (SELECT DISTINCT word AS keyword FROM words WHERE rank <= {words}),
recent AS (
  SELECT * FROM (
    SELECT keyword, doc_id, row_number() OVER (PARTITION BY keyword ORDER BY doc_id DESC) AS rank
    FROM keywords, documents WHERE contains(lower(text), keyword))
  WHERE rank <= 100
),
volumes AS (
  SELECT keyword, CASE WHEN count(doc_id) <= 1 THEN 0.0
    ELSE count(doc_id) / ((max(doc_id) - min(doc_id)) * 37)::DOUBLE END::DOUBLE AS tweets_per_second
  FROM keywords LEFT JOIN recent USING (keyword) GROUP BY keyword
)"""
)

URL_VALUES = """
hosts AS (SELECT page_id, url, regexp_extract(url, 'https?://([^/]+)', 1) AS host FROM pages)"""

CONTENT_SETS = """
SELECT doc_id, CASE WHEN lower(lang) = lower(source) THEN lower(lang) ELSE lower(lang) || '|' || lower(source) END AS hashtags,
  source || '|' || lang AS user_ids, lower('Desk_' || source) || '|' || lower('Lang_' || lang) AS screen_names
FROM documents"""

LIMITS = """
limits AS (SELECT ts, json_extract_string(props, '$.k')::BIGINT AS v FROM events WHERE event_type = 'error')"""

ENRICHED = f"""
WITH {ENRICHED_PAIRS}
SELECT doc_id, strftime(TIMESTAMP '2024-01-01' + to_seconds(doc_id * 37), '%Y-%m-%dT%H:%M:%S+00:00') AS created_at_iso,
  count(rule_id) AS n_rules, arg_min(value, rule_id) AS first_value,
  CASE WHEN count(rule_id) = 0 THEN 'Not Found' END AS rule_tag
FROM documents LEFT JOIN pairs USING (doc_id) GROUP BY doc_id"""

KEYWORD_LONG = f"WITH {KEYWORD_PAIRS} SELECT doc_id, rule_id FROM pairs"
USERID_LONG = """
SELECT event_id, c_custkey::VARCHAR AS rule_id FROM events JOIN customer ON user_id = c_custkey"""
HASHTAG_LONG = "SELECT doc_id, upper(lang) || ' ' || source AS rule_id FROM documents"
WITHIN = f"""
WITH {BOXES}
SELECT c_custkey, c_name FROM customer
WHERE EXISTS (SELECT 1 FROM boxes WHERE c_nationkey * 14.0 - 175.0 BETWEEN west AND east
  AND c_acctbal / 125.0 BETWEEN south AND north)"""
RECENT_ROWS = f"WITH {RECENT.replace('{words}', '3')} SELECT keyword, doc_id, rank FROM recent"
LIMITED_ROWS = f"WITH RECURSIVE {EVENT_BUCKET} SELECT row_id, rule_value, admitted FROM decided"

ORACLE: dict[str, str] = {
    "match_keyword": f"""
        WITH {KEYWORD_PAIRS} SELECT doc_id, rule_id, 'bench' AS rule_tag, value AS rule_value FROM pairs""",
    "match_keyword_joins": KEYWORD_LONG,
    "match_nameless": NAMELESS,
    "match_nameless_joins": NAMELESS,
    "match_not_found": f"""
        WITH {KEYWORD_PAIRS}
        SELECT doc_id, count(rule_id) AS n_rules, CASE WHEN count(rule_id) = 0 THEN 'track' END AS rule_type,
          CASE WHEN count(rule_id) = 0 THEN 'Not Found' END AS rule_tag,
          CASE WHEN count(rule_id) = 0 THEN 'Not Found' END AS rule_value
        FROM documents LEFT JOIN pairs USING (doc_id) GROUP BY doc_id""",
    "match_userid": USERID_LONG,
    "match_userid_joins": USERID_LONG,
    "match_username": """
        SELECT conv_id || '/' || turn AS row_id, upper(role) AS rule_id FROM conversations""",
    "match_hashtag": HASHTAG_LONG,
    "match_hashtag_joins": HASHTAG_LONG,
    "match_locations": f"""
        WITH {BOXES},
        folded AS (
          SELECT arg_max(s_suppkey, s_suppkey)::VARCHAR AS rule_id,
            arg_max(s_name, s_suppkey) FILTER (WHERE s_nationkey < 5) AS description,
            arg_max(s_name, s_suppkey) AS rule_tag, arg_max(box, s_suppkey) AS rule_value
          FROM boxes)
        SELECT doc_id, folded.* FROM documents, folded""",
    "locations_fold": """
        SELECT arg_max(p_name, p_partkey) AS value, arg_max(p_type, p_partkey) FILTER (WHERE p_size < 10) AS description,
          arg_max(p_brand, p_partkey) AS rule_tag, arg_max(p_name, p_partkey) AS rule_value
        FROM part""",
    "collect_filter": f"WITH {KEYWORD_PAIRS} SELECT DISTINCT doc_id FROM pairs",
    "collect_locations": WITHIN,
    "collect_locations_grid": WITHIN,
    "keyword_content": "SELECT page_id, lower(concat_ws(' ', html, url, upper(url))) AS keyword FROM pages",
    "content_sets": CONTENT_SETS,
    "classify_messages": """
        SELECT CASE event_type WHEN 'click' THEN 'tweet' WHEN 'error' THEN 'limit' WHEN 'signup' THEN 'other'
            WHEN 'view' THEN 'keep-alive' ELSE 'malformed' END AS message_class,
          count(*) AS n,
          sum(CASE WHEN event_type = 'error' THEN json_extract_string(props, '$.k')::BIGINT END)::BIGINT AS sum_limit
        FROM events GROUP BY event_type""",
    "parse_json": """
        SELECT event_id, event_id::VARCHAR AS id_str, user_id::VARCHAR AS user_id, props AS text
        FROM events WHERE event_type = 'click'""",
    "created_at_iso": "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS created_at_iso FROM events",
    "event_time": """
        SELECT event_id, epoch_us(date_trunc('second', ts)) AS at_us FROM events WHERE event_type = 'click'""",
    "enrich_messages": ENRICHED,
    "enrich_stream": ENRICHED,
    "rule_normalize": f"WITH {PART_RULES} SELECT rule_id, norm_value FROM normalized",
    "rule_phrases": f"""
        WITH {PART_RULES},
        placed AS (SELECT norm_value, ((row_number() OVER (ORDER BY rule_id) - 1) // 400)::INT AS instance_id FROM normalized
          WHERE length(value) <= 60)
        SELECT instance_id, string_agg(DISTINCT norm_value, ',' ORDER BY norm_value) AS phrases FROM placed
        GROUP BY instance_id""",
    "rule_append": f"""
        WITH {TWO_SETS}, new AS (SELECT rule_id, tag, value || '!' AS value FROM b WHERE tag <> 'Brand#1')
        SELECT * FROM new UNION ALL SELECT * FROM a WHERE rule_id NOT IN (SELECT rule_id FROM new)""",
    "rule_union": f"""
        WITH {TWO_SETS} SELECT * FROM b UNION ALL SELECT * FROM a WHERE rule_id NOT IN (SELECT rule_id FROM b)""",
    "rule_difference": f"WITH {TWO_SETS} SELECT * FROM a WHERE rule_id NOT IN (SELECT rule_id FROM b)",
    "rule_remove": f"WITH {TWO_SETS} SELECT * FROM b WHERE rule_id NOT IN (SELECT rule_id FROM a)",
    "rule_intersection": f"WITH {TWO_SETS} SELECT * FROM b WHERE rule_id IN (SELECT rule_id FROM a)",
    "rule_member": f"WITH {TWO_SETS} SELECT *, rule_id IN (SELECT rule_id FROM b) AS is_member FROM a",
    "rule_equal": f"""
        WITH {TWO_SETS}
        SELECT 'union both ways' AS pair, TRUE AS is_equal
        UNION ALL
        SELECT 'left and right',
          NOT EXISTS (SELECT 1 FROM a FULL JOIN b USING (rule_id) WHERE a.value IS NULL OR b.value IS NULL)""",
    "rule_len": f"""
        WITH {PART_RULES}
        SELECT count(DISTINCT rule_id) AS n_rules, count(DISTINCT norm_value) AS n_values FROM normalized""",
    "rule_dedup_last": """
        SELECT p_name AS value, arg_max(p_brand, p_partkey) AS tag, min(p_partkey) AS seq FROM part GROUP BY p_name""",
    "rule_constraints": """
        SELECT 'track' AS rule_type, doc_id AS rule_id FROM documents WHERE length(text) <= 60
        UNION ALL SELECT 'follow', c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'""",
    "rule_rejects": """
        SELECT 'track' AS rule_type, doc_id AS rule_id FROM documents WHERE length(text) > 60
        UNION ALL SELECT 'follow', c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "rule_shard": f"""
        WITH {ALL_RULES},
        numbered AS (SELECT *, row_number() OVER (PARTITION BY rule_type ORDER BY rule_id) - 1 AS idx FROM all_rules)
        SELECT rule_type, rule_id, idx, (idx // cap)::INT AS instance_id FROM numbered""",
    "rule_table_round_trip": f"""
        WITH {ALL_RULES},
        numbered AS (SELECT *, row_number() OVER (PARTITION BY rule_type ORDER BY rule_id) - 1 AS idx FROM all_rules)
        SELECT rule_type, rule_id, idx, (idx // cap)::BIGINT AS instance_id FROM numbered""",
    "rule_shard_text": f"""
        WITH {ALL_RULES},
        named AS (SELECT rule_type, 'r' || rule_id AS rule_id, cap FROM all_rules),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY rule_type ORDER BY rule_id) - 1 AS idx FROM named)
        SELECT rule_type, rule_id, idx, (idx // cap)::INT AS instance_id FROM numbered""",
    "rule_instances": f"""
        WITH {ALL_RULES}
        SELECT rule_type, count(*) AS n_rules, ceil(count(*) / any_value(cap)::DOUBLE)::BIGINT AS n_instances
        FROM all_rules GROUP BY rule_type""",
    "rule_cap": f"WITH {ASSIGNED} SELECT * FROM capped",
    "rule_count_gauge": f"""
        WITH {ASSIGNED} SELECT rule_type, instance_id, count(*) AS rule_count FROM capped GROUP BY ALL""",
    "fix_follow": """
        SELECT * FROM (
          SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN regexp_extract('user ' || c_nationkey, '([0-9]{7,})', 1)
            ELSE regexp_extract(c_name || ' or ' || (c_custkey + 90000000), '([0-9]{7,})', 1) END AS value
          FROM customer)
        WHERE value <> ''""",
    "fix_track": f"""
        WITH {URL_VALUES}
        SELECT page_id, replace(CASE WHEN starts_with(url, 'https') THEN regexp_replace(
          'url_contains: "' || host || '" url_contains:' || host, 'url_contains:\\s?"?([\\w.]+)"?', '\\1', 'g')
          ELSE host END, '.', ' ') AS value
        FROM hosts""",
    "fix_locations": f"""
        WITH {BOXES}
        SELECT s_suppkey, west || ',' || south || ',' || east || ',' || north AS value FROM boxes WHERE s_nationkey > 2""",
    "rule_etl": f"""
        WITH {BOXES},
        cleaned AS (
          SELECT 'follow' AS rule_type, (c_nationkey + 7000000)::VARCHAR AS value, arg_max(c_mktsegment, c_custkey) AS tag,
            min(c_custkey) AS seq, 5000 AS cap FROM customer GROUP BY c_nationkey
          UNION ALL
          SELECT 'track', p_name, arg_max(p_brand, p_partkey), min(p_partkey), 400 FROM part GROUP BY p_name
          UNION ALL
          SELECT 'locations', box, arg_max(s_name, s_suppkey), min(s_suppkey), 25 FROM boxes GROUP BY box),
        numbered AS (SELECT *, row_number() OVER (PARTITION BY rule_type ORDER BY seq) - 1 AS idx FROM cleaned)
        SELECT rule_type, value, tag, idx, (idx // cap)::INT AS instance_id FROM numbered""",
    "author_ids": """
        SELECT id, count(*) AS n FROM (
          SELECT c_custkey::VARCHAR AS id FROM customer UNION ALL SELECT c_nationkey::VARCHAR FROM customer) GROUP BY id""",
    "vendor_ids": """
        SELECT c_custkey::VARCHAR AS id FROM customer UNION SELECT c_nationkey::VARCHAR FROM customer""",
    "recent_by_keyword": RECENT_ROWS,
    "recent_by_keyword_joins": RECENT_ROWS,
    "tweets_per_second": f"WITH {RECENT.replace('{words}', '3')} SELECT keyword, tweets_per_second FROM volumes",
    "track_length": "SELECT doc_id, strlen(text) > 60 AS too_long FROM documents",
    "user_lookup": f"""
        WITH {USERS}, by_name AS (SELECT lower(screen_name) AS name, max(userid) AS userid FROM users GROUP BY 1)
        SELECT '@CLICK_' || c_custkey AS value, userid, CASE WHEN userid IS NULL THEN 'error' ELSE 'ok' END AS status
        FROM customer LEFT JOIN by_name ON name = 'click_' || c_custkey""",
    "screen_name_lookup": f"""
        WITH {USERS}
        SELECT c_custkey::VARCHAR AS userid, screen_name, CASE WHEN screen_name IS NULL THEN 'error' ELSE 'ok' END AS status
        FROM customer LEFT JOIN users ON userid = c_custkey::VARCHAR""",
    "validate_geo_legacy": f"""
        WITH {GEO_LEGACY}
        SELECT rule_id, CASE WHEN error IS NULL THEN 'ok' ELSE 'error' END AS status, error,
          CASE WHEN error IS NULL THEN 200 ELSE 500 END::BIGINT AS code,
          CASE WHEN error IS NULL THEN 'legacy' END AS geo_type
        FROM geo_checked""",
    "validate_geojson": """
        WITH checked AS (
          SELECT s_suppkey AS rule_id, CASE
            WHEN s_nationkey = 20 THEN 'GeoJSON geometry type not supported: Feature'
            WHEN s_nationkey BETWEEN 10 AND 14 THEN 'Lat/lon out of range: -100.0, 30'
            WHEN s_nationkey >= 15 THEN 'Linear ring in coordinates is too short' END AS error
          FROM supplier)
        SELECT rule_id, CASE WHEN error IS NULL THEN 'ok' ELSE 'error' END AS status, error,
          CASE WHEN error IS NULL THEN 200 ELSE 500 END::BIGINT AS code,
          CASE WHEN error IS NULL THEN 'geo_json' END AS geo_type,
          CASE WHEN error IS NULL THEN 4 END::BIGINT AS n_positions
        FROM checked""",
    "validate_rules": f"""
        WITH {USERS}, by_name AS (SELECT lower(screen_name) AS name, max(userid) AS userid FROM users GROUP BY 1),
        {GEO_LEGACY}, {RECENT.replace('{words}', '1')}
        SELECT 'keyword' AS type, word AS value, 'ok' AS status, NULL::VARCHAR AS error, 200::BIGINT AS code,
          NULL::VARCHAR AS userid, tweets_per_second, NULL::VARCHAR AS geo_type
        FROM words JOIN volumes ON word = keyword WHERE rank <= 1
        UNION ALL
        SELECT 'hashtag', text, 'error', 'The byte length of the track phrase is over 60.', 400, NULL, 0.0, NULL
        FROM conversations WHERE strlen(text) > 60
        UNION ALL
        SELECT 'geo', value, CASE WHEN error IS NULL THEN 'ok' ELSE 'error' END, error,
          CASE WHEN error IS NULL THEN 200 ELSE 500 END, NULL, NULL, CASE WHEN error IS NULL THEN 'legacy' END
        FROM geo_checked
        UNION ALL
        SELECT 'username', '@click_' || c_custkey, CASE WHEN userid IS NULL THEN 'error' ELSE 'ok' END,
          CASE WHEN userid IS NULL THEN 'user not found: @click_' || c_custkey END,
          CASE WHEN userid IS NULL THEN 500 ELSE 200 END, userid, NULL, NULL
        FROM customer LEFT JOIN by_name ON name = 'click_' || c_custkey
        UNION ALL
        SELECT 'place', n_name, 'error', 'rule type not supported: place', 500, NULL, NULL, NULL FROM nation""",
    "rolling_rule_count": "WITH increments AS (SELECT event_type AS rule_id, ts FROM events)"
    + ROLLING.format(window=900, increments="increments"),
    "rolling_count_by_match": f"WITH {KEYWORD_PAIRS}, increments AS ("
    "SELECT rule_id, TIMESTAMP '2024-01-01' + to_seconds(doc_id * 37) AS ts FROM pairs)"
    + ROLLING.format(window=3600, increments="increments"),
    "rule_counters_zero": """
        SELECT c_custkey AS rule_id, count(event_id) AS n FROM customer LEFT JOIN events ON user_id = c_custkey
        GROUP BY c_custkey""",
    "rule_counters_reset": """
        SELECT strftime(max(ts), '%Y-%m-%d') AS rules_version, event_type AS rule_id, count(*) AS n FROM events
        WHERE ts::DATE = (SELECT max(ts)::DATE FROM events) GROUP BY event_type""",
    "limit_counter": f"""
        WITH {LIMITS}
        SELECT epoch_us(ts) // 900000000 * 900 AS window_start, count(v) AS n_limits, sum(v)::BIGINT AS sum_limit,
          max(v) AS max_limit, arg_max(v, ts) AS last_limit
        FROM limits GROUP BY 1""",
    "limit_counter_sliding": f"""
        WITH {LIMITS},
        slid AS (SELECT epoch_us(ts) // 1800000000 * 1800 - 1800 * unnest(range(4)) AS window_start, ts, v FROM limits)
        SELECT window_start, count(v) AS n_limits, sum(v)::BIGINT AS sum_limit, max(v) AS max_limit,
          arg_max(v, ts) AS last_limit
        FROM slid GROUP BY 1""",
    "rate_stats": "WITH series AS (SELECT event_type AS rule_value, epoch_us(ts) AS at_us FROM events), stats AS ("
    + _rates("series", 1_706_659_200_000_000, 20 * 86_400_000_000)
    + ") SELECT * FROM stats UNION ALL SELECT DISTINCT n_name, 0, 0.0, 0.0, 0.0 FROM nation",
    "rate_report": f"WITH RECURSIVE {EVENT_BUCKET}, admitted AS (SELECT * FROM decided WHERE admitted)"
    + _rates("decided", 170_665_920_000, 120_000_000, ", 'in' AS direction")
    + " UNION ALL "
    + _rates("admitted", 170_665_920_000, 120_000_000, ", 'out' AS direction"),
    "metrics_counts": """
        SELECT strftime(ts, '%Y-%m-%d') AS window_start, CASE event_type WHEN 'click' THEN 'collector.src.tweet_process.success'
            WHEN 'error' THEN 'collector.src.kafka.error' ELSE 'collector.src.tweet_to_kafka.success' END AS metric,
          user_id AS instance_id, count(*) AS n
        FROM events WHERE event_type IN ('click', 'error', 'view') GROUP BY ALL""",
    "log_metrics": """
        SELECT strftime(ts, '%Y-%m-%d %H') AS window_start,
          CASE event_type WHEN 'view' THEN 'src.twitter.keepalive' ELSE 'src.limit.messages.count' END AS metric, count(*) AS n
        FROM events WHERE event_type IN ('view', 'error') GROUP BY ALL""",
    "metrics_gauges": """
        SELECT 'collector.src.' || CASE event_type WHEN 'error' THEN 'limit.current_limited' ELSE event_type END AS metric,
          user_id AS instance_id, arg_max(value, (ts, value)) AS value
        FROM events GROUP BY ALL""",
    "limit_keys": f"WITH {ENRICHED_PAIRS} SELECT DISTINCT doc_id, lower(value) AS rule_value FROM pairs",
    "rate_limit": LIMITED_ROWS,
    "rate_limit_stream": LIMITED_ROWS,
    "rate_limit_messages": f"""
        WITH RECURSIVE {ENRICHED_PAIRS},
        keyed AS (SELECT DISTINCT doc_id AS row_id, lower(value) AS rule_value,
          epoch_us(TIMESTAMP '2024-01-01' + to_seconds(doc_id * 37)) // 100 AS at_us FROM pairs),
        {_bucket("keyed", 1, 2)},
        dropped AS (SELECT row_id FROM decided GROUP BY row_id HAVING NOT bool_or(admitted))
        SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT row_id FROM dropped)""",
    "state_expiry": """
        SELECT user_id AS rule_value, event_id FROM events WHERE ts > TIMESTAMP '2024-01-31' - INTERVAL 10 DAYS""",
    "state_expiry_keys": """
        SELECT user_id AS rule_value FROM events GROUP BY user_id
        HAVING max(ts) <= TIMESTAMP '2024-01-31' - INTERVAL 1 DAY""",
    "notify_filter": """
        SELECT event_id, 'track:3' AS data FROM events WHERE event_type = 'click' AND user_id = 3""",
    "notify_versions": """
        SELECT CASE event_type WHEN 'click' THEN 'track' WHEN 'view' THEN 'follow' ELSE 'other' END AS rule_type,
          user_id::VARCHAR AS instance_id, epoch_us(max(ts)) AS rules_version
        FROM events GROUP BY ALL""",
    "log_daily": """
        SELECT strftime(ts, '%Y.%m.%d') AS day, count(*) AS n, max(value) AS max_value FROM events
        WHERE event_type = 'error' GROUP BY 1""",
    "rolling_counts_stream": """
        WITH slid AS (
          SELECT event_type AS rule_id, epoch_us(ts) // 1800000000 * 1800 - 1800 * unnest(range(4)) AS window_start FROM events)
        SELECT window_start, rule_id, count(*) AS n FROM slid
        WHERE (window_start + 7200) * 1000000 <= (SELECT epoch_us(max(ts)) - 60000000 FROM events)
        GROUP BY ALL""",
    "limit_lines": f"WITH RECURSIVE {LINE_BUCKET} SELECT row_id AS event_id, rule_value, admitted FROM decided",
    "limit_lines_stream": f"WITH RECURSIVE {LINE_BUCKET} SELECT row_id AS event_id, rule_value, admitted FROM decided",
    "rule_log": f"""
        WITH {BENCH_RULES},
        turns AS (SELECT * FROM (VALUES (0, 0, 0), (1, 1, 0), (2, 2, 1), (3, 3, 2), (4, 1, 0)) AS t(turn, batch_id, version)),
        used AS (
          SELECT turn, batch_id, version, CASE WHEN version = 2 THEN lower(value) ELSE value END AS value
          FROM turns, rules WHERE version = 0 OR rule_id::BIGINT % 2 = 0)
        SELECT turn, batch_id, version, count(*) AS n_rules, min(value) AS first_value FROM used GROUP BY ALL""",
    "match_by_index": f"""
        WITH {BENCH_RULES},
        kept AS (
          SELECT rule_id, CASE WHEN rule_id::BIGINT % 7 = 1 AND rule_id::BIGINT % 5 > 0 THEN split_part(value, ' ', 1) ELSE value END AS value
          FROM rules WHERE rule_id::BIGINT % 5 > 0 OR rule_id::BIGINT % 3 = 2)
        SELECT doc_id, rule_id FROM documents, kept WHERE {ALL_TERMS.format(text="lower(text)")}""",
    "rule_json_round_trip": """
        SELECT p_partkey::VARCHAR AS rule_id, p_name AS value, CASE WHEN p_size > 20 THEN p_brand END AS tag, NULL::VARCHAR AS description FROM part""",
    "rule_delta": f"""
        WITH {TWO_SETS}, c AS (SELECT rule_id, tag, CASE WHEN rule_id % 3 > 0 THEN lower(value) ELSE value END AS value FROM b)
        SELECT rule_id, CASE WHEN a.value IS NULL THEN 'added' WHEN c.value IS NULL THEN 'removed' ELSE 'changed' END AS change
        FROM a FULL JOIN c USING (rule_id)
        WHERE a.value IS NULL OR c.value IS NULL OR a.value <> c.value OR a.tag <> c.tag""",
    "rule_same_tables": """
        SELECT 'shuffled' AS pair, TRUE AS is_equal UNION ALL SELECT 'left and right', FALSE""",
    "collect_locations_sizes": f"""
        WITH {BOXES},
        sized AS (
          SELECT CASE WHEN s_suppkey = 1 THEN -180 ELSE west END AS w,
            CASE WHEN s_suppkey = 1 THEN -90.0 WHEN s_nationkey % 3 = 0 THEN south ELSE abs(south) END::DOUBLE AS s,
            CASE WHEN s_suppkey = 1 THEN -179.0 WHEN s_nationkey % 3 = 0 THEN east ELSE (west + 5 || '.01')::DOUBLE END::DOUBLE AS e,
            CASE WHEN s_suppkey = 1 THEN -89.5 WHEN s_nationkey % 3 = 0 THEN north ELSE abs(south) + 0.01 END::DOUBLE AS n
          FROM boxes),
        areas AS (
          SELECT c_custkey, c_nationkey * 14.0 - 180.0 AS lon, c_acctbal / 125.0 AS lat,
            CASE WHEN c_custkey % 50 = 0 THEN 400.0 ELSE (c_custkey % 7) / 4.0 END AS size FROM customer)
        SELECT c_custkey FROM areas
        WHERE EXISTS (SELECT 1 FROM sized WHERE lon - size <= e AND lon + size >= w AND lat - size <= n AND lat + size >= s)""",
    "live_rule_counts": """
        SELECT c_custkey::VARCHAR AS rule_id, count(event_id) AS n
        FROM customer LEFT JOIN events ON user_id = c_custkey
          AND epoch_us(ts) // 3600000000 BETWEEN 1706659200000000 // 3600000000 - 240 AND 1706659200000000 // 3600000000
        GROUP BY c_custkey""",
    "live_rate_report": "WITH series AS (SELECT event_type AS rule_value, user_id, epoch_us(ts) // 1000000 * 1000000 AS at_us FROM events), "
    "admitted AS (SELECT * FROM series WHERE user_id % 3 > 0)"
    + _rates("series", 1_706_659_200_000_000, 20 * 86_400_000_000, ", 'in' AS direction")
    + " UNION ALL "
    + _rates("admitted", 1_706_659_200_000_000, 20 * 86_400_000_000, ", 'out' AS direction"),
    "event_counts_corrected": """
        SELECT event_type AS key, epoch_us(ts) // 3600000000 * 3600000000 AS window_us, count(*) AS n FROM events GROUP BY ALL""",
    "recent_by_keyword_live": RECENT_ROWS,
    "user_table_live": f"WITH {USERS} SELECT userid, screen_name FROM users",
    "replayed_batches": """
        SELECT strftime(ts, '%Y.%m.%d') AS part, count(*) AS n FROM events GROUP BY 1 UNION ALL SELECT 'lines', count(*) FROM events""",
    "metrics_live": """
        SELECT CASE event_type WHEN 'click' THEN 'collector.src.tweet_process.success' WHEN 'error' THEN 'collector.src.limit.messages.count'
          WHEN 'view' THEN 'collector.src.twitter.keepalive' ELSE 'collector.src.tweet_process.failure' END AS metric, count(*) AS n
        FROM events WHERE event_type <> 'signup' GROUP BY 1""",
    "enrich_events": """
        WITH lines AS (
          SELECT *, event_id % 5 AS k, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') AS iso,
            CASE event_type WHEN 'click' THEN 'r0' WHEN 'view' THEN 'r1' END AS rule FROM events)
        SELECT event_id, CASE k WHEN 0 THEN 'limit' WHEN 4 THEN 'other' ELSE 'tweet' END AS message_class,
          CASE WHEN k = 1 THEN 'created_at' END AS enrichment_error, k IN (0, 4) AS unchanged,
          CASE k WHEN 3 THEN '77' WHEN 1 THEN '9' WHEN 2 THEN '9' END AS meta_id, CASE WHEN k = 3 THEN user_id::VARCHAR END AS seen,
          CASE WHEN k IN (2, 3) THEN iso END AS created_at_iso, CASE WHEN k IN (2, 3) THEN rule END AS first_rule,
          CASE WHEN k IN (2, 3) AND rule IS NULL THEN 'Not Found' END AS rule_tag
        FROM lines""",
}
