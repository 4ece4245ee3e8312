"""SQL with the meaning of each query, over the plain tables."""

from __future__ import annotations

# The same character classes as in the cleaning contract.
_SP = r"\t-\r\x1c-\x20\x{85}\p{Z}"

_MESSAGES = """
messages AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, doc_id, source AS topic, lang AS label,
         CASE WHEN doc_id % 50 = 0 THEN NULL
              WHEN doc_id % 50 = 1 THEN ''
              WHEN doc_id % 10 = 2 THEN '#tag @user https://a.b/c www.d.e ' || text
              ELSE text END AS text,
         CASE WHEN doc_id % 40 = 3 THEN 'bad'
              ELSE strftime(TIMESTAMP '2024-01-01' + doc_id * INTERVAL 37 SECOND,
                            '%Y-%m-%dT%H:%M:%S') END AS event_time
  FROM documents)"""

_SCORED = """
scored AS (
  SELECT CAST(event_id AS VARCHAR) AS id, event_id,
         CASE WHEN event_id % 97 <> 0 THEN
           'topic_' || (CAST(json_extract_string(props, '$.k') AS BIGINT) % 10) END AS topic,
         props AS text, ts AS event_time_ts,
         CASE event_type WHEN 'purchase' THEN 'Positive' WHEN 'click' THEN 'Neutral'
              WHEN 'error' THEN 'Negative' WHEN 'signup' THEN 'Irrelevant'
              ELSE 'Unknown' END AS sentiment_label
  FROM events)"""


def _windowed(minutes: int, source: str = "scored") -> str:
    return f"""
windowed AS (
  SELECT window_start, window_start + INTERVAL {minutes} MINUTE AS window_end, topic,
         positive + neutral + negative AS total_mentions, positive, neutral, negative,
         CASE WHEN positive + neutral + negative = 0 THEN 0.0::DOUBLE
              ELSE (positive - negative) / (positive + neutral + negative) END AS sentiment_score
  FROM (SELECT time_bucket(INTERVAL {minutes} MINUTE, event_time_ts) AS window_start, topic,
               count(*) FILTER (sentiment_label = 'Positive') AS positive,
               count(*) FILTER (sentiment_label = 'Neutral') AS neutral,
               count(*) FILTER (sentiment_label = 'Negative') AS negative
        FROM {source} GROUP BY ALL))"""


_WINDOWED_OUT = """
SELECT window_start, window_end, topic, total_mentions, positive, neutral, negative,
       round(sentiment_score, 6) AS sentiment_score FROM windowed"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_WINDOWS_5 = _with(_SCORED, _windowed(5)) + _WINDOWED_OUT
_WINDOWS_60 = _with(_SCORED, _windowed(60)) + _WINDOWED_OUT


def _range(minutes: int, topic: str | None = None) -> str:
    condition = "" if topic is None else f" AND topic = '{topic}'"
    return f"""
ranged AS (
  SELECT * FROM windowed
  WHERE window_start >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL {minutes} MINUTE{condition})"""


def _over_range(minutes: int, topic: str | None = None) -> str:
    return _with(_SCORED, _windowed(5), _range(minutes, topic))


_SUMS = """
       CAST(coalesce(sum(total_mentions), 0) AS BIGINT) AS total_mentions,
       CAST(coalesce(sum(positive), 0) AS BIGINT) AS positive,
       CAST(coalesce(sum(neutral), 0) AS BIGINT) AS neutral,
       CAST(coalesce(sum(negative), 0) AS BIGINT) AS negative,
       round(CASE WHEN coalesce(sum(total_mentions), 0) = 0 THEN 0.0::DOUBLE
             ELSE (sum(positive) - sum(negative)) / sum(total_mentions) END, 3) AS net_score"""


def _trend(minutes_back: int, width: int) -> str:
    return f"""{_over_range(minutes_back)},
bins AS (SELECT time_bucket(INTERVAL {width} MINUTE, window_start) AS bin_start,
                avg(sentiment_score) AS mean_score, sum(total_mentions) AS total_mentions
         FROM ranged GROUP BY 1),
spine AS (SELECT unnest(generate_series(min(bin_start), max(bin_start),
                                        INTERVAL {width} MINUTE)) AS bin_start FROM bins)
SELECT bin_start, round(coalesce(mean_score, 0), 6) AS mean_score,
       CAST(coalesce(total_mentions, 0) AS BIGINT) AS total_mentions
FROM spine LEFT JOIN bins USING (bin_start)"""


# Fixed values in the two functions below: the patterns of the cleaning contract.
def _clean(column: str) -> str:
    url = rf"https?://[^{_SP}]+|www\.[^{_SP}]+|\.com[^{_SP}]+|youtu\.be/[^{_SP}]+"
    step = f"regexp_replace({column}, '{url}', '', 'g')"
    step = f"lower(regexp_replace({step}, '(@|#)[\\p{{L}}\\p{{N}}_]+', '', 'g'))"
    step = f"regexp_replace({step}, '[^a-zA-Z{_SP}]', '', 'g')"
    return f"coalesce(trim(regexp_replace({step}, '[{_SP}]+', ' ', 'g')), '')"


def _clean_train(column: str) -> str:
    ns = r"[^\t-\r ]"
    url = rf"https?://{ns}+|www\.{ns}+|S+\.com{ns}+|youtu\.be/{ns}+"
    step = f"regexp_replace({column}, '{url}', '', 'g')"
    step = f"lower(regexp_replace({step}, '(@|#)[a-zA-Z0-9_]+', '', 'g'))"
    return f"regexp_replace({step}, '[^a-zA-Z\\t-\\r ]', '', 'g')"


# Splitting drops empty parts at the end, so blanks there are cut first.
_TOKENS = rf"""
tokenized AS (
  SELECT id, string_split_regex(regexp_replace({_clean_train("text")}, '[\t-\r ]+$', ''),
                                '[\t-\r ]') AS tokens
  FROM messages WHERE text IS NOT NULL)"""


def _stop_words() -> str:
    from tallywind.functions.stopwords import ENGLISH

    return "[" + ", ".join("'" + word.replace("'", "''") + "'" for word in ENGLISH) + "]"


_VOCABULARY = f"""
WITH {_MESSAGES},
terms AS (
  SELECT doc_id, unnest(string_split({_clean("text")}, ' ')) AS term
  FROM messages WHERE text IS NOT NULL)
SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM terms
WHERE term <> '' AND NOT list_contains({_stop_words()}, term)
GROUP BY term HAVING count(DISTINCT doc_id) >= 5 ORDER BY tf DESC, term LIMIT 10000"""

_USERS = """
users AS (
  SELECT c_custkey AS id,
         CASE WHEN c_custkey % 23 <> 0 THEN 'user_' || c_custkey END AS username,
         c_name || CASE WHEN c_custkey % 10 = 0 THEN ' II' ELSE '' END AS name,
         'about ' || c_name AS description,
         CASE WHEN c_custkey % 4 <> 0 THEN 'city ' || (c_custkey % 9) END AS location,
         CASE WHEN c_custkey % 31 <> 0 THEN c_acctbal > 5000 END AS verified,
         CASE WHEN c_custkey % 17 <> 0 THEN CAST(floor(c_acctbal) AS BIGINT) END AS followers,
         CASE WHEN c_custkey % 17 <> 0 THEN c_custkey % 300 END AS following,
         CASE WHEN c_custkey % 17 <> 0 AND c_custkey % 19 <> 0 THEN c_custkey % 70 END AS posted
  FROM customer)"""

_POSTS = """
posts AS (
  SELECT doc_id, CASE WHEN doc_id % 50 <> 0 THEN text END AS text,
         TIMESTAMP '2024-01-01' + doc_id * INTERVAL 601 SECOND AS created_at,
         CASE WHEN doc_id % 29 <> 0 THEN lang END AS lang, source, n_chars,
         CASE WHEN doc_id % 41 <> 0 THEN doc_id * 7 % 2000 END AS author_id,
         string_split(text, ' ')[1:doc_id % 4] AS words
  FROM documents)"""

_FLAT = """
flat AS (
  SELECT doc_id AS tweet_id,
         translate(coalesce(text, ''), chr(10) || chr(13), '  ') AS text, created_at,
         coalesce(lang, '') AS language, source,
         CASE WHEN doc_id % 13 = 0 OR doc_id % 7 = 3 THEN 0 ELSE n_chars % 100 END AS like_count,
         CASE WHEN doc_id % 13 = 0 THEN 0 ELSE n_chars % 17 END AS retweet_count,
         CASE WHEN doc_id % 13 = 0 THEN 0 ELSE n_chars % 11 END AS reply_count,
         CASE WHEN doc_id % 13 = 0 THEN 0 ELSE n_chars % 5 END AS quote_count,
         CASE WHEN doc_id % 13 = 0 THEN 0 ELSE n_chars END AS impression_count,
         author_id AS user_id, coalesce(username, '') AS username, coalesce(name, '') AS user_name,
         coalesce(description, '') AS user_description, coalesce(location, '') AS user_location,
         coalesce(verified, false) AS user_verified, coalesce(followers, 0) AS user_followers,
         coalesce(following, 0) AS user_following, coalesce(posted, 0) AS user_tweet_count,
         CASE WHEN doc_id % 11 = 0 THEN ''
              ELSE array_to_string(list_filter(words, lambda w: w <> ''), ', ') END AS hashtags,
         CASE WHEN doc_id % 11 <> 0 AND doc_id % 3 = 0 THEN 'reader_' || doc_id || ', editor'
              ELSE '' END AS mentions,
         CASE WHEN doc_id % 11 <> 0 AND n_chars % 2 = 0 THEN 'https://x.example/' || doc_id
              ELSE '' END AS urls,
         doc_id % 5 IN (2, 4) AS is_retweet, doc_id % 5 = 3 AS is_reply,
         doc_id % 3 = 2 AS has_media
  FROM posts LEFT JOIN users ON author_id = users.id)"""

_KEYWORDS = """
keywords(keyword) AS (VALUES ('the'), ('de la'), ('EAU'), ('ung'))"""

_COLLECTED = """
collected AS (
  SELECT flat.*, keyword FROM flat JOIN posts ON doc_id = tweet_id
  JOIN keywords ON contains(lower(posts.text), lower(keyword))
  WHERE posts.created_at >= TIMESTAMP '2024-01-03')"""

_SLUG = """left(replace(replace(replace(replace({0}, ' ', '_'), '#', ''),
       'OR', '_'), 'AND', '_'), 50)"""

_FLAT_WITH = _with(_USERS, _POSTS, _FLAT)
_COLLECTED_WITH = _with(_USERS, _POSTS, _FLAT, _KEYWORDS, _COLLECTED)

_REPORT = f"""{_FLAT_WITH}
SELECT count(*) AS total_tweets, '2024-01-10 00:00:00' AS date_collected,
       count(DISTINCT username) AS unique_users,
       strftime(min(created_at), '%Y-%m-%d %H:%M:%S') || ' to ' ||
       strftime(max(created_at), '%Y-%m-%d %H:%M:%S') AS date_range_tweets,
       round(avg(like_count), 6) AS avg_likes, round(avg(retweet_count), 6) AS avg_retweets,
       count(*) FILTER (user_verified) AS verified_posts,
       round(100.0::DOUBLE * count(*) FILTER (is_retweet) / count(*), 6) AS retweet_percentage
FROM flat"""

_PREDICTIONS = """
predictions AS (
  SELECT doc_id AS id, lang AS label,
         CASE WHEN doc_id % 7 = 0 THEN 'en' WHEN doc_id % 11 = 0 THEN 'es'
              WHEN doc_id % 13 = 5 THEN 'unheard' WHEN doc_id % 17 <> 3 THEN lang END
           AS predicted,
         CAST(doc_id % 5 AS DOUBLE) AS prediction
  FROM documents)"""

_PARSED = f"""
WITH {_MESSAGES}
SELECT CASE WHEN doc_id % 30 <> 7 THEN id END AS id,
       CASE WHEN doc_id % 30 <> 7 THEN topic END AS topic,
       CASE WHEN doc_id % 30 <> 7 THEN text END AS text,
       CASE WHEN doc_id % 30 NOT IN (7, 8) THEN event_time END AS event_time
FROM messages"""

_ON_TIME = """
on_time AS (
  SELECT * FROM scored
  WHERE NOT (event_time_ts < TIMESTAMP '2024-01-10'
             AND sentiment_label IN ('Positive', 'Neutral')))"""

ORACLES: dict[str, str] = {
    "tumbling_5min": _WINDOWS_5,
    "tumbling_1hour": _WINDOWS_60,
    "scored_projection": f"""
WITH {_SCORED} SELECT id, topic, text, event_time_ts, sentiment_label FROM scored""",
    "results_filter": f"""{_over_range(2880, "topic_3")}
SELECT window_start, window_end, topic, total_mentions, positive, neutral, negative,
       round(sentiment_score, 6) AS sentiment_score FROM ranged""",
    "results_stored": f"""{_over_range(2880, "topic_3")}
SELECT window_start, window_end, topic, total_mentions, positive, neutral, negative,
       round(sentiment_score, 6) AS sentiment_score FROM ranged""",
    "kpi_summary": f"{_over_range(10080)} SELECT {_SUMS} FROM ranged",
    "kpi_all_ranges": f"""{_with(_SCORED, _windowed(5))},
ranges(minutes_back) AS (
  VALUES (15), (30), (45), (60), (120), (240), (480), (720), (1440), (2880), (10080))
SELECT CAST(minutes_back AS BIGINT) AS minutes_back, {_SUMS}
FROM ranges LEFT JOIN windowed
  ON window_start >= TIMESTAMP '2024-01-30 12:00:00' - minutes_back * INTERVAL 1 MINUTE
GROUP BY minutes_back""",
    "recent_stored": _WINDOWS_5 + " ORDER BY window_start DESC, topic NULLS LAST LIMIT 20",
    "kpi_stored_ranges": f"""{_with(_SCORED, _windowed(5))},
ranges(minutes_back) AS (
  VALUES (15), (30), (45), (60), (120), (240), (480), (720), (1440), (2880), (10080))
SELECT CAST(minutes_back AS BIGINT) AS minutes_back, {_SUMS}
FROM ranges LEFT JOIN windowed
  ON window_start >= TIMESTAMP '2024-01-30 12:00:00' - minutes_back * INTERVAL 1 MINUTE
GROUP BY minutes_back""",
    "topics_stored": f"""{_over_range(10080)}
SELECT topic, CAST(sum(total_mentions) AS BIGINT) AS total_mentions FROM ranged
WHERE topic IS NOT NULL GROUP BY topic ORDER BY total_mentions DESC, topic LIMIT 5""",
    "share_stored": f"""{_over_range(2880)},
shares AS (
  SELECT 'Positive' AS sentiment, sum(positive) AS mentions FROM ranged
  UNION ALL SELECT 'Neutral', sum(neutral) FROM ranged
  UNION ALL SELECT 'Negative', sum(negative) FROM ranged)
SELECT sentiment, CAST(mentions AS BIGINT) AS mentions,
       round(100 * mentions / (SELECT sum(mentions) FROM shares), 6) AS share_percent
FROM shares""",
    "trend_resample_5m": _trend(120, 5),
    "trend_resample_15m": _trend(1440, 15),
    "trend_resample_1h": _trend(10080, 60),
    "sentiment_share": f"""{_over_range(10080)},
shares AS (
  SELECT 'Positive' AS sentiment, sum(positive) AS mentions FROM ranged
  UNION ALL SELECT 'Neutral', sum(neutral) FROM ranged
  UNION ALL SELECT 'Negative', sum(negative) FROM ranged)
SELECT sentiment, CAST(mentions AS BIGINT) AS mentions,
       round(100 * mentions / (SELECT sum(mentions) FROM shares), 6) AS share_percent
FROM shares""",
    "top_topics": f"""{_over_range(10080)}
SELECT topic, CAST(sum(total_mentions) AS BIGINT) AS total_mentions FROM ranged
WHERE topic IS NOT NULL GROUP BY topic ORDER BY total_mentions DESC, topic LIMIT 5""",
    "recent_rows": f"""{_over_range(10080)}
SELECT window_start, window_end, topic, total_mentions, positive, neutral, negative,
       round(sentiment_score, 6) AS sentiment_score FROM ranged
ORDER BY window_start DESC, topic NULLS LAST LIMIT 20""",
    "empty_range": f"""{_over_range(10080, "no such topic")},
mentioned AS (SELECT coalesce(sum(total_mentions), 0)::BIGINT AS total_mentions FROM ranged)
SELECT 'kpi' AS panel, 1::BIGINT AS row_count, total_mentions FROM mentioned
UNION ALL SELECT 'trend', (SELECT count(*) FROM ranged), total_mentions FROM mentioned
UNION ALL SELECT 'share', 3, total_mentions FROM mentioned
UNION ALL SELECT 'top_topics', (SELECT count(DISTINCT topic) FROM ranged), total_mentions
  FROM mentioned
UNION ALL SELECT 'recent', (SELECT count(*) FROM ranged), total_mentions FROM mentioned""",
    "topic_list": f"""
WITH {_SCORED} SELECT DISTINCT topic FROM scored WHERE topic IS NOT NULL""",
    "clean_text": f"WITH {_MESSAGES} SELECT id, {_clean('text')} AS text FROM messages",
    "clean_text_train": f"""
WITH {_MESSAGES} SELECT id, {_clean_train('text')} AS text FROM messages""",
    "tokens": f"""
WITH {_MESSAGES}, {_TOKENS}
SELECT id, array_to_string(tokens, '|') AS tokens FROM tokenized""",
    "tokens_filtered": f"""
WITH {_MESSAGES}, {_TOKENS}
SELECT id, array_to_string(list_filter(tokens,
         lambda t: t <> '' AND NOT list_contains({_stop_words()}, t)), '|') AS tokens
FROM tokenized""",
    "vocabulary": _VOCABULARY,
    "vocabulary_top": _VOCABULARY.replace("LIMIT 10000", "LIMIT 500"),
    "publish_json": f"WITH {_MESSAGES} SELECT id, topic, text, event_time FROM messages",
    "stream_publish": f"WITH {_MESSAGES} SELECT id, topic, text, event_time FROM messages",
    "parse_messages": _PARSED,
    "parse_event_time": f"""
WITH {_MESSAGES}
SELECT id, event_time, TRY_CAST(event_time AS TIMESTAMP) AS event_time_ts FROM messages""",
    "label_case": f"""
WITH {_PREDICTIONS}
SELECT id, prediction,
       CASE prediction WHEN 0 THEN 'Negative' WHEN 1 THEN 'Positive' WHEN 2 THEN 'Neutral'
                       WHEN 3 THEN 'Irrelevant' ELSE 'Unknown' END AS sentiment_label
FROM predictions""",
    "null_profile": f"""
WITH {_MESSAGES},
cells AS (
  SELECT 'Topic' AS column_name, topic AS cell FROM messages
  UNION ALL SELECT 'Label', label FROM messages
  UNION ALL SELECT 'Text', text FROM messages)
SELECT column_name, count(*) AS row_count, count(*) - count(cell) AS null_count,
       count(*) FILTER (cell = '') AS empty_count
FROM cells GROUP BY column_name""",
    "drop_null_text": f"""
WITH {_MESSAGES} SELECT id, label, text FROM messages WHERE text IS NOT NULL""",
    "preview": f"""
WITH {_MESSAGES} SELECT doc_id AS id, topic, label, text, event_time FROM messages
ORDER BY doc_id LIMIT 10""",
    "csv_roundtrip": f"""
WITH {_MESSAGES}
SELECT doc_id AS id, topic, label, nullif(text, '') AS text FROM messages""",
    "csv_roundtrip_exact": f"""
WITH {_MESSAGES} SELECT doc_id AS id, topic, label, text FROM messages""",
    "csv_split": f"""
WITH {_MESSAGES} SELECT doc_id AS id, topic, label, text FROM messages""",
    "post_flatten": f"""{_FLAT_WITH}
SELECT * REPLACE (CAST(user_id AS VARCHAR) AS user_id) FROM flat""",
    "post_author_join": f"""{_FLAT_WITH}
SELECT tweet_id, CAST(user_id AS VARCHAR) AS user_id, username, user_name,
       replace(user_description, 'about ',
       'about' || chr(10)) AS user_description, user_location, user_verified, user_followers,
       user_following, user_tweet_count FROM flat""",
    "post_flags": f"""{_FLAT_WITH} SELECT tweet_id, is_retweet, is_reply, has_media FROM flat""",
    "post_search": f"""
WITH {_POSTS}
SELECT doc_id AS tweet_id, created_at, text FROM posts
WHERE contains(lower(text), 'tion') AND created_at >= TIMESTAMP '2024-01-03'
  AND created_at < TIMESTAMP '2024-01-06'
ORDER BY created_at DESC, doc_id DESC LIMIT 100""",
    "post_search_indexed": f"""
WITH {_POSTS}
SELECT doc_id AS tweet_id, created_at, text FROM posts
WHERE contains(lower(text), 'tion') AND created_at >= TIMESTAMP '2024-01-03'
  AND created_at < TIMESTAMP '2024-01-06'
ORDER BY created_at DESC, doc_id DESC LIMIT 100""",
    "collect_union": f"{_COLLECTED_WITH} SELECT tweet_id, created_at, keyword FROM collected",
    "collect_newest": f"""{_COLLECTED_WITH}
SELECT tweet_id, created_at, keyword FROM collected
QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY created_at DESC, tweet_id DESC) <= 50""",
    "collect_newest_2000": f"""{_COLLECTED_WITH}
SELECT tweet_id, created_at, keyword FROM collected
QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY created_at DESC, tweet_id DESC) <= 2000""",
    "collect_many": f"""
WITH {_POSTS},
many AS (
  SELECT a || b || c || d AS keyword
  FROM (SELECT unnest(string_split('BCDFLMNRST', '')) AS a),
       (SELECT unnest(string_split('aeio', '')) AS b),
       (SELECT unnest(string_split('lnrst', '')) AS c),
       (SELECT unnest(string_split('aent ', '')) AS d)),
recent AS (SELECT doc_id, lower(text) AS text FROM posts WHERE created_at >= TIMESTAMP '2024-01-03')
SELECT doc_id AS tweet_id, keyword FROM recent JOIN many ON contains(text, lower(keyword))""",
    "keyword_slug": f"""
WITH {_MESSAGES}
SELECT id, {_SLUG.format("('#' || topic || ' OR ' || label || ' AND ' || text)")} AS slug
FROM messages""",
    "count_by_language": f"""{_FLAT_WITH}
SELECT language, count(*) AS post_count FROM flat GROUP BY language""",
    "count_by_keyword": f"""{_COLLECTED_WITH}
SELECT keyword, count(*) AS post_count FROM collected GROUP BY keyword""",
    "top_users": f"""{_FLAT_WITH}
SELECT username, count(*) AS post_count FROM flat GROUP BY username
ORDER BY post_count DESC, username LIMIT 10""",
    "report_lists": f"""{_COLLECTED_WITH},
named AS (
  SELECT username, count(*) AS post_count FROM collected GROUP BY username
  ORDER BY post_count DESC, username LIMIT 10)
SELECT 'languages' AS list, language AS name, count(*) AS post_count
FROM collected GROUP BY language
UNION ALL SELECT 'top_users', username, post_count FROM named
UNION ALL SELECT 'top_keywords', keyword, count(*) FROM collected GROUP BY keyword""",
    "post_report": _REPORT,
    "report_json": _REPORT,
    "keyword_csv": f"""{_COLLECTED_WITH}
SELECT tweet_id, keyword, {_SLUG.format("keyword")} AS keyword_slug, text, user_description,
       like_count FROM collected""",
    "summary_csv": f"""{_COLLECTED_WITH}
SELECT tweet_id, keyword, created_at, hashtags, user_verified, is_reply, username
FROM collected""",
    "accuracy": f"""
WITH {_PREDICTIONS}
SELECT count(*) AS row_count,
       round(count(*) FILTER (label = predicted) / count(*), 6) AS accuracy FROM predictions""",
    "confusion_matrix": f"""
WITH {_PREDICTIONS}
SELECT label, count(*) FILTER (predicted = 'en') AS en, count(*) FILTER (predicted = 'fr') AS fr,
       count(*) FILTER (predicted = 'de') AS de, count(*) FILTER (predicted = 'es') AS es,
       count(*) FILTER (predicted IS NULL OR predicted NOT IN ('en', 'fr', 'de', 'es')) AS other
FROM predictions GROUP BY label""",
    "label_index": f"""
WITH {_MESSAGES}
SELECT row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS label_index, label,
       count(*) AS row_count
FROM messages WHERE text IS NOT NULL GROUP BY label""",
    "model_roundtrip": f"""
WITH {_MESSAGES}
SELECT count(text) AS row_count, count(text) AS same_prediction FROM messages""",
    "predict": f"""
WITH {_MESSAGES} SELECT id, label, true AS learned FROM messages WHERE text IS NOT NULL""",
    "evaluate_model": f"""
WITH {_MESSAGES}
SELECT label, count(*) AS row_count, true AS learned
FROM messages WHERE text IS NOT NULL AND doc_id % 5 = 0 GROUP BY GROUPING SETS (label, ())""",
    "stream_upsert_5min": _WINDOWS_5,
    "stream_upsert_1hour": _WINDOWS_60,
    "stream_restart": _WINDOWS_60,
    "stream_updates": f"""{_with(_SCORED, _windowed(1440))},
arrived AS (
  SELECT time_bucket(INTERVAL 1440 MINUTE, event_time_ts) AS day_start, topic AS of_topic,
         count(DISTINCT event_id % 3) AS versions
  FROM scored GROUP BY ALL)
SELECT window_start, window_end, topic, total_mentions, positive, neutral, negative,
       round(sentiment_score, 6) AS sentiment_score, versions
FROM windowed JOIN arrived ON window_start = day_start AND topic IS NOT DISTINCT FROM of_topic""",
    "stream_compacted": _with(_SCORED, _windowed(1440)) + _WINDOWED_OUT,
    "state_restart": f"""
WITH {_SCORED}, runs(run) AS (VALUES (0::BIGINT), (1), (2))
SELECT run,
       count(DISTINCT (time_bucket(INTERVAL 1440 MINUTE, event_time_ts), coalesce(topic, '')))
         AS windows,
       count(*) FILTER (sentiment_label IN ('Positive', 'Neutral', 'Negative')) AS mentions
FROM runs JOIN scored ON event_id % 3 <= run GROUP BY run""",
    "state_eviction": f"""{_with(_SCORED, _windowed(60))}
SELECT window_start, topic,
       window_end > (SELECT max(event_time_ts) - INTERVAL 2 HOUR FROM scored) AS is_open,
       true AS counts_agree
FROM windowed""",
    "stream_late_drop": _with(_SCORED, _ON_TIME, _windowed(60, "on_time")) + _WINDOWED_OUT,
    "stream_archive": f"""
WITH {_SCORED} SELECT id, topic, text, event_time_ts, sentiment_label FROM scored""",
    "archive_lookup": f"""
WITH {_SCORED} SELECT id, topic, text, event_time_ts, sentiment_label FROM scored
WHERE event_id % 997 = 0 AND event_id BETWEEN 0 AND 99999""",
    "stream_job": f"""
WITH {_SCORED}
SELECT 'archive' AS sink, count(*) AS row_count FROM scored
UNION ALL SELECT '5 minutes', count(*) FROM (
  SELECT DISTINCT time_bucket(INTERVAL 5 MINUTE, event_time_ts), topic FROM scored)
UNION ALL SELECT '1 hour', count(*) FROM (
  SELECT DISTINCT time_bucket(INTERVAL 60 MINUTE, event_time_ts), topic FROM scored)""",
    "stream_job_from_archive": _WINDOWS_60,
    "stream_ingest": f"""
WITH parsed AS ({_PARSED})
SELECT id, topic, {_clean('text')} AS text,
       TRY_CAST(event_time AS TIMESTAMP) AS event_time_ts FROM parsed""",
    "stream_score": f"""
WITH parsed AS ({_PARSED})
SELECT id, topic, {_clean('text')} AS text,
       TRY_CAST(event_time AS TIMESTAMP) AS event_time_ts, true AS agrees,
       CASE WHEN id IS NOT NULL THEN true END AS learned FROM parsed""",
}
