"""ANSI SQL for the registered queries, run by DuckDB over the same tables."""

from __future__ import annotations

import re
START = 1704067200
TWO_YEARS = 2 * 365 * 86400


def _day(seconds: str) -> str:
    return f"(DATE '1970-01-01' + CAST(floor({seconds} / 86400) AS INTEGER))"


def _name(day: str) -> str:
    return f"strftime({day}, '%d-%m-%Y')"


def _key(*columns: str) -> str:
    parts = [f"coalesce(CAST(length({c}) AS VARCHAR) || ':' || {c}, '-')" for c in columns]
    return f"concat_ws('|', {', '.join(parts)})"


def _words(c: str) -> str:
    blank = f"trim(coalesce({c}, ''))"
    return f"(CASE WHEN {blank} = '' THEN 0 ELSE len(regexp_split_to_array({blank}, '\\s+')) END)"


def _chars(c: str) -> str:
    return f"length(trim(coalesce({c}, '')))"


SENTINEL = "('[deleted]', '[removed]', '')"

_SUB_USABLE = (
    f"coalesce(selftext NOT IN {SENTINEL}, false) AND {_chars('title')} + {_chars('selftext')} >= 10 "
    f"AND {_words('title')} + {_words('selftext')} >= 2"
)
_COM_USABLE = (
    f"coalesce(body NOT IN {SENTINEL}, false) AND {_chars('body')} >= 30 AND {_words('body')} >= 5"
)


def _item(score: str, aspect: str = '"Camera"', quote: str = "''") -> str:
    return (
        "'{\"brand_name\": \"' || p_brand || '\", \"product_name\": \"' || p_name || "
        f"'\", \"aspect\": {aspect}, \"sentiment_score\": {score}, \"quote\": \"' || {quote} || '\"}}'"
    )


def _hits(source: str) -> str:
    return f"""
        SELECT w.comment_id, w.pos, l.* FROM (
          SELECT comment_id, unnest(words) AS token, generate_subscripts(words, 1) AS pos FROM (
            SELECT comment_id, regexp_split_to_array(lower(body), '[^\\pL\\pN]+') AS words FROM {source})) w
        JOIN lexicon l ON w.token = l.token"""


def _found(hits: str) -> str:
    return f"""
        SELECT comment_id, brand AS brand_name, coalesce(product, 'general') AS product_name,
          coalesce(aspect, 'general') AS aspect,
          coalesce(avg(CASE WHEN kind = 'polarity' THEN weight END), 0.5) AS sentiment_score
        FROM (
          SELECT comment_id, kind, weight,
            max(CASE WHEN kind = 'brand' THEN value END) OVER (PARTITION BY comment_id, stretch) AS brand,
            first(CASE WHEN kind = 'product' THEN value END IGNORE NULLS) OVER (PARTITION BY comment_id, stretch
              ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS product,
            last(CASE WHEN kind = 'aspect' THEN value END IGNORE NULLS) OVER (PARTITION BY comment_id, stretch
              ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS aspect
          FROM (SELECT *, count(CASE WHEN kind = 'brand' THEN 1 END) OVER (PARTITION BY comment_id ORDER BY pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stretch FROM {hits})
          WHERE stretch > 0)
        GROUP BY ALL"""


# Day on which a post is observed in the landing queries.
_LANDING_DAY = "'0' || (1 + CAST(left(partition_date, 2) AS INTEGER) % 2) || substr(partition_date, 3)"


# One view per adapter; a query gets the ones it names, and those they name.
VIEWS: dict[str, str] = {
    "subs": f"""
        SELECT *, {_name(_day('created_utc'))} AS partition_date FROM (
          SELECT CAST(doc_id AS VARCHAR) AS id, 't3_' || doc_id AS fullname_id, source AS subreddit,
            left(text, 40) AS title,
            CASE WHEN doc_id % 17 = 0 THEN '[deleted]' WHEN doc_id % 19 = 0 THEN '[removed]'
                 WHEN doc_id % 23 = 0 THEN '' WHEN doc_id % 29 = 0 THEN NULL ELSE text END AS selftext,
            {START} + (doc_id * 900) % {TWO_YEARS} AS created_utc,
            {START} + (doc_id * 900) % {TWO_YEARS} + n_chars AS updated_at,
            CAST(n_chars % 1000 AS INTEGER) AS score,
            CAST(doc_id % 100 AS DOUBLE) / 100 AS upvote_ratio,
            CAST(doc_id % 50 AS INTEGER) AS num_comments,
            CASE WHEN doc_id % 2 = 0 THEN 'top' ELSE 'controversial' END AS sort_type
          FROM documents)""",
    "comments": f"""
        SELECT *, 'file:/lake/reddit/' || sort_type || '/subreddit=src' || (conv_id % 20 + 1) || '/date='
            || partition_date || '/comments.jsonl' AS source_file
        FROM (
          SELECT conv_id, turn, conv_id || '-' || turn AS id,
            CASE WHEN conv_id % 11 = 0 THEN 't3_missing' ELSE 't3_' || conv_id END AS link_id,
            CASE WHEN turn > 0 THEN 't1_' || conv_id || '-' || (turn - 1)
                 WHEN conv_id % 11 = 0 THEN 't3_missing' ELSE 't3_' || conv_id END AS parent_id,
            role AS author,
            CASE WHEN (conv_id + turn) % 13 = 0 THEN '[deleted]' ELSE text END AS body,
            {START} + (conv_id * 3600 + turn * 60) % {TWO_YEARS} AS created_utc,
            {START} + (conv_id * 3600 + turn * 60) % {TWO_YEARS} + length(text) AS updated_at,
            CAST(length(text) % 200 - 50 AS INTEGER) AS score,
            CASE WHEN conv_id % 2 = 0 THEN 'top' ELSE 'controversial' END AS sort_type,
            {_name(_day(f'({START} + (conv_id * 3600 + turn * 60) % {TWO_YEARS})'))} AS partition_date
          FROM conversations)""",
    "subs_silver": f"SELECT *, {_SUB_USABLE} AS is_usable_for_sentiment FROM subs",
    "comments_silver": f"""
        SELECT c.*, s.subreddit, {_COM_USABLE} AS is_usable_for_sentiment
        FROM comments c LEFT JOIN subs s ON c.link_id = s.fullname_id""",
    "products": """
        SELECT p_brand AS brand_name, p_name || ' ' || p_partkey AS model, (p_partkey % 100) * 700.0::DOUBLE AS price,
          p_size / 5.0::DOUBLE AS avg_rating, p_size % 2 AS has_5g, p_type AS processor_brand, p_size % 8 AS num_cores,
          p_size / 10.0::DOUBLE AS processor_speed, p_size * 100 AS battery_capacity,
          p_size % 3 AS fast_charging_available, p_size * 2 AS fast_charging, p_size % 16 AS ram_capacity,
          p_size * 8 AS internal_memory, p_size / 8.0::DOUBLE AS screen_size, p_size + 60 AS refresh_rate,
          p_size % 4 AS num_rear_cameras, 'android' AS os, p_size AS primary_camera_rear,
          p_size % 20 AS primary_camera_front, p_size % 2 AS extended_memory_available,
          p_size * 40 AS resolution_height, p_size * 20 AS resolution_width, lower(p_brand) AS brand
        FROM part""",
    "catalogue": "SELECT DISTINCT p_brand AS brand_name, p_name AS model, lower(p_brand) AS brand FROM part",
    "with_part": "SELECT c.*, p.p_partkey, p.p_brand, p.p_name FROM comments c JOIN part p ON c.conv_id = p.p_partkey",
    "mentions": f"""
        SELECT *, sha256({_key('comment_id', 'brand_name', 'product_name', 'aspect', 'quote')}) AS analysis_id FROM (
          SELECT CASE WHEN conv_id % 13 = 0 THEN 'none' WHEN conv_id % 5 = 0 THEN CAST(conv_id + 1 AS VARCHAR)
                      ELSE CAST(conv_id AS VARCHAR) END AS submission_id,
            CASE WHEN conv_id % 7 = 3 THEN id || '-gone' ELSE id END AS comment_id,
            CASE WHEN turn % 3 = 0 THEN upper(p_brand) WHEN turn % 7 = 5 THEN 'Nobrand' ELSE p_brand END AS brand_name,
            CASE WHEN turn % 4 = 3 THEN 'general' WHEN turn % 4 = 1 THEN upper(p_name || ' ' || p_partkey)
                 ELSE p_name || ' ' || p_partkey END AS product_name,
            (['camera', 'battery', 'display', 'price', 'general'])[turn % 5 + 1] AS aspect,
            CASE WHEN conv_id % 31 = 0 THEN 1.5 ELSE CAST(length(body) % 101 AS DOUBLE) / 100 END AS sentiment_score,
            left(body, 200) AS quote,
            CASE WHEN conv_id % 37 <> 0 THEN make_timestamp(created_utc * 1000000) END AS analyzed_at,
            partition_date AS date_partition
          FROM with_part)""",
    "raw_mentions": """
        SELECT id AS comment_id,
          CASE conv_id % 6 WHEN 1 THEN lower(p_brand) WHEN 2 THEN replace(p_brand, 'Brand', 'Brnd') WHEN 3 THEN ''
               WHEN 4 THEN 'Zzyx' WHEN 5 THEN upper(p_brand) ELSE p_brand END AS brand_name,
          CASE (conv_id + turn) % 5 WHEN 1 THEN upper(p_name) WHEN 2 THEN substr(p_name, 2) WHEN 3 THEN 'General'
               WHEN 4 THEN replace(p_name, ' ', '') || 'x' ELSE p_name END AS product_name
        FROM with_part""",
    "responses": f"""
        SELECT id AS comment_id, body, CASE turn
            WHEN 0 THEN '[' || {_item('0.25')} || ']'
            WHEN 1 THEN '```json' || chr(10) || '[' || {_item('"0.75"', 'null')} || ']' || chr(10) || '```'
            WHEN 2 THEN {_item('0.5')}
            WHEN 3 THEN '[' || {_item('0.5')} || ', {{"brand_name": '
            WHEN 4 THEN ' ' || chr(9) || '[]'
            WHEN 5 THEN '[' || {_item('0.9', quote='p_name')} || ', 7, ' || {_item('"high"')} || ']'
            WHEN 6 THEN '```[' || {_item('null')} || ']```'
            WHEN 7 THEN '[' || {_item('0.5')} || '] I hope this helps'
            WHEN 8 THEN '[' || {_item('0.5')} || '][' || {_item('0.5')} || ']'
            WHEN 9 THEN '[' || {_item('0.5')} || ',]'
            WHEN 10 THEN '[' || replace({_item('0.1')}, '"quote"', '"aspect": "Battery", "quote"') || ']' END AS response
        FROM with_part""",
    "parsed": """
        SELECT comment_id, body, [e FOR e IN elements IF json_type(e) = 'OBJECT'] AS objects, elements FROM (
          SELECT comment_id, body, CAST(CASE WHEN starts_with(cleaned, '[') AND json_valid(cleaned) THEN cleaned
                                             ELSE '[]' END AS JSON[]) AS elements
          FROM (SELECT comment_id, body, regexp_replace(regexp_replace(regexp_replace(
                  regexp_replace(response, '^\\s+|\\s+$', '', 'g'), '^```(json)?', ''), '```$', ''),
                  '^\\s+|\\s+$', '', 'g') AS cleaned FROM responses))""",
    "items": """
        SELECT comment_id, body, json_extract_string(item, '$.brand_name') AS brand_name,
          json_extract_string(item, '$.product_name') AS product_name, CASE WHEN len(regexp_extract_all(CAST(item AS VARCHAR), '"aspect":')) > 1
            THEN list_last(regexp_extract_all(CAST(item AS VARCHAR), '"aspect": ?"([^"]*)"', 1))
            ELSE json_extract_string(item, '$.aspect') END AS aspect,
          json_extract_string(item, '$.sentiment_score') AS sentiment_score, json_extract_string(item, '$.quote') AS quote
        FROM (SELECT comment_id, body, unnest(objects) AS item FROM parsed)""",
    "context": """
        SELECT c.id AS comment_id, c.body, c.parent_id, s.id AS submission_id, s.title AS submission_title,
          s.selftext AS submission_selftext, s.subreddit, c.partition_date
        FROM comments_silver c JOIN subs s ON c.link_id = s.fullname_id WHERE c.is_usable_for_sentiment""",
    "lexicon": """
        SELECT token, CASE length(token) % 4 WHEN 0 THEN 'brand' WHEN 1 THEN 'product' WHEN 2 THEN 'aspect'
            ELSE 'polarity' END AS kind,
          CASE WHEN length(token) % 8 = 0 THEN replace(p_brand, 'Brand', 'Brnd') WHEN length(token) % 4 = 0 THEN p_brand
            WHEN length(token) % 8 = 1 THEN p_name || 'x' WHEN length(token) % 4 = 1 THEN p_name WHEN length(token) % 4 = 2 THEN CASE WHEN length(token) % 8 = 6 THEN 'camera' ELSE 'battery' END END AS value,
          CAST(length(token) % 11 AS DOUBLE) / 10 AS weight
        FROM (SELECT DISTINCT unnest(regexp_split_to_array(lower(text), '[^\\pL\\pN]+')) AS token FROM benchmark)
        LEFT JOIN part ON p_partkey = (length(token) - 1) % 4 + 1 WHERE token <> ''""",
    "bodies": "SELECT id AS comment_id, body FROM comments",
    "hits": _hits("bodies"),
    "lexicon_found": _found("hits"),
    "context_hits": _hits("context"),
    "context_found": _found("context_hits"),
    "with_link": """
        SELECT m.comment_id, m.submission_id, m.aspect, c.link_id FROM mentions m
        LEFT JOIN comments c ON m.comment_id = c.id""",
    "merged_metrics": """
        SELECT subreddit, coalesce(s.n, 0) AS submissions_count, coalesce(c.n, 0) AS comments_count,
          s.lo AS earliest_submission_created_utc, s.hi AS latest_submission_created_utc,
          c.lo AS earliest_comment_created_utc, c.hi AS latest_comment_created_utc
        FROM (SELECT subreddit, count(*) AS n, min(created_utc) AS lo, max(created_utc) AS hi FROM subs GROUP BY 1) s
        FULL JOIN (SELECT 'src' || (conv_id % 20 + 1) AS subreddit, count(*) AS n, min(created_utc) AS lo,
                     max(created_utc) AS hi FROM comments GROUP BY 1) c USING (subreddit)""",
    "run_total": """
        SELECT CAST(sum(submissions_count) AS BIGINT) AS total_submissions,
          CAST(sum(comments_count) AS BIGINT) AS total_comments, count(*) AS subreddits_processed,
          min(earliest_submission_created_utc) AS earliest_submission_created_utc,
          max(latest_submission_created_utc) AS latest_submission_created_utc,
          min(earliest_comment_created_utc) AS earliest_comment_created_utc,
          max(latest_comment_created_utc) AS latest_comment_created_utc,
          max(latest_submission_created_utc) - min(earliest_submission_created_utc) AS submission_span_seconds,
          max(latest_comment_created_utc) - min(earliest_comment_created_utc) AS comment_span_seconds
        FROM merged_metrics""",
    "ratios": """
        SELECT 'submissions' AS kind, count(*) AS total, count(*) FILTER (is_usable_for_sentiment) AS usable,
          coalesce(CAST(count(*) FILTER (is_usable_for_sentiment) AS DOUBLE) / nullif(count(*), 0), 0) AS ratio FROM subs_silver
        UNION ALL
        SELECT 'comments', count(*), count(*) FILTER (is_usable_for_sentiment),
          coalesce(CAST(count(*) FILTER (is_usable_for_sentiment) AS DOUBLE) / nullif(count(*), 0), 0) FROM comments_silver""",
    "listing": """
        SELECT subreddit, sort_type, coalesce(s.n, 0) AS submissions_count, coalesce(c.n, 0) AS comments_count,
          s.lo AS earliest_submission_created_utc, s.hi AS latest_submission_created_utc,
          c.lo AS earliest_comment_created_utc, c.hi AS latest_comment_created_utc
        FROM (SELECT subreddit, sort_type, count(*) AS n, min(created_utc) AS lo, max(created_utc) AS hi FROM subs
              GROUP BY 1, 2) s
        FULL JOIN (SELECT 'src' || (conv_id % 20 + 1) AS subreddit, sort_type, count(*) AS n, min(created_utc) AS lo,
                     max(created_utc) AS hi FROM comments GROUP BY 1, 2) c
          USING (subreddit, sort_type)""",
    "by_product": """
        SELECT p.*, m.sentiment_score, m.aspect FROM mentions m JOIN products p
        ON lower(m.brand_name) = p.brand AND m.product_name = p.model""",
    "second_look": """
        SELECT * REPLACE (updated_at + (CAST(id AS BIGINT) % 3 - 1) * 10 AS updated_at, score + 5000 AS score,
          '15' || substr(partition_date, 3) AS partition_date) FROM subs""",
    "bronze_state": f"""
        SELECT id, updated_at, score, subreddit, partition_date FROM second_look WHERE CAST(id AS BIGINT) % 3 = 2
        UNION ALL
        SELECT id, updated_at, score, subreddit, {_LANDING_DAY} FROM subs WHERE CAST(id AS BIGINT) % 3 <> 2""",
    "latest_events": """
        SELECT user_id, event_type, event_id, value, ts FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn FROM events)
        WHERE rn = 1""",
    "event_target": """
        SELECT * REPLACE (CASE WHEN user_id % 7 = 0 THEN -user_id ELSE user_id END AS user_id,
          CASE WHEN user_id % 17 <> 0 THEN ts END AS ts) FROM latest_events""",
    "event_source": """
        SELECT * REPLACE (event_id + 1000000 AS event_id, ts + to_days(CAST(event_id % 3 - 1 AS INTEGER)) AS ts)
        FROM latest_events""",
    "checkpoint_log": """
        SELECT 'user' || user_id AS subreddit,
          CASE WHEN user_id % 3 <> 0 THEN event_type END AS sort_type,
          CASE WHEN user_id % 3 <> 0 THEN 'all' END AS time_filter,
          event_id, CAST(floor(value) AS BIGINT) AS items_fetched,
          CASE WHEN event_id % 2 = 0 THEN 1 ELSE 2 END AS save
        FROM events""",
    "calendar": """
        SELECT DATE '2000-01-01' + CAST(i AS INTEGER) AS full_date FROM range(11500) t(i)""",
    "dim_date": """
        SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date, CAST(year(full_date) AS INTEGER) AS year,
          CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(month(full_date) AS INTEGER) AS month,
          strftime(full_date, '%b') AS month_name, CAST(dayofweek(full_date) AS INTEGER) AS day_of_week,
          strftime(full_date, '%a') AS day_name, CAST(weekofyear(full_date) AS INTEGER) AS week_of_year,
          dayofweek(full_date) IN (0, 6) AS is_weekend
        FROM calendar""",
    "dim_product": f"""
        SELECT row_number() OVER (ORDER BY md5({_key('brand_name', 'model')})) AS product_key, brand_name, model,
          round(price * 0.011, 6) AS price_usd, avg_rating, has_5g = 1 AS is_5g, processor_brand, num_cores,
          processor_speed, battery_capacity, fast_charging_available = 1 AS fast_charging_available, fast_charging,
          ram_capacity, internal_memory, screen_size, refresh_rate, num_rear_cameras, os, primary_camera_rear,
          primary_camera_front, extended_memory_available = 1 AS extended_memory_available, resolution_height,
          resolution_width
        FROM products""",
    "dim_submission": f"""
        SELECT row_number() OVER (ORDER BY md5({_key('id')})) AS submission_key, id AS reddit_submission_id, subreddit,
          title, selftext, strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%d %H:%M:%S') AS created_at,
          num_comments, upvote_ratio, score
        FROM subs""",
    "grid": """
        SELECT subreddit, sort_type, partition_date FROM (SELECT DISTINCT subreddit FROM subs)
        CROSS JOIN (VALUES ('controversial'), ('top')) v(sort_type)
        CROSS JOIN (SELECT DISTINCT partition_date FROM subs)""",
}

_LANDED = f"""
    SELECT id, fullname_id, subreddit, title, selftext, created_utc, updated_at, score, upvote_ratio, num_comments,
      sort_type AS source_sort_type, {_LANDING_DAY} AS partition_date, true AS others_missing FROM subs"""
_SIMILAR = "1 - CAST(levenshtein({a}, {b}) AS DOUBLE) / greatest(length({a}), length({b}), 1)"
_BY_SEGMENT = "CASE WHEN price < 20000 THEN 'Budget' WHEN price < 50000 THEN 'Midrange' ELSE 'Flagship' END AS price_segment"
_AVERAGE = "round(avg(sentiment_score), 6) AS avg_sentiment, count(*) AS mentions"
_OR = "split_part(m.link_id, '_', 2) = p.id OR m.submission_id = p.id"
_LISTING_METRICS = """
    SELECT subreddit, sort_type, metric, CAST(value AS DOUBLE) AS value, unit FROM (
      SELECT subreddit, sort_type, unnest([
        {'metric': 'SubmissionsFetched', 'value': submissions_count, 'unit': 'Count'},
        {'metric': 'CommentsFetched', 'value': comments_count, 'unit': 'Count'},
        {'metric': 'SubmissionTimeSpanSeconds', 'value': latest_submission_created_utc - earliest_submission_created_utc, 'unit': 'Seconds'},
        {'metric': 'EarliestSubmissionAge', 'value': earliest_submission_created_utc, 'unit': 'None'},
        {'metric': 'LatestSubmissionAge', 'value': latest_submission_created_utc, 'unit': 'None'},
        {'metric': 'CommentTimeSpanSeconds', 'value': latest_comment_created_utc - earliest_comment_created_utc, 'unit': 'Seconds'}
      ], recursive := true) FROM listing) WHERE value IS NOT NULL"""
_RUN_METRICS = """
    SELECT 'test' AS environment, 'bronze' AS job, 'ALL' AS process_date, 'run' AS run_id, scope, subreddit, metric,
      CAST(value AS DOUBLE) AS value, unit FROM (
      SELECT 'AGGREGATE' AS scope, NULL AS subreddit, unnest([
        {'metric': 'SubmissionsProcessed', 'value': total_submissions, 'unit': 'Count'},
        {'metric': 'CommentsProcessed', 'value': total_comments, 'unit': 'Count'},
        {'metric': 'SubredditsProcessed', 'value': subreddits_processed, 'unit': 'Count'},
        {'metric': 'SubmissionTimeSpanSeconds', 'value': submission_span_seconds, 'unit': 'Seconds'},
        {'metric': 'CommentTimeSpanSeconds', 'value': comment_span_seconds, 'unit': 'Seconds'}
      ], recursive := true) FROM run_total
      UNION ALL
      SELECT 'SUBREDDIT', subreddit, unnest([
        {'metric': 'SubmissionsCount', 'value': submissions_count, 'unit': 'Count'},
        {'metric': 'CommentsCount', 'value': comments_count, 'unit': 'Count'},
        {'metric': 'EarliestSubmissionCreatedUtc', 'value': earliest_submission_created_utc, 'unit': 'None'},
        {'metric': 'LatestSubmissionCreatedUtc', 'value': latest_submission_created_utc, 'unit': 'None'},
        {'metric': 'EarliestCommentCreatedUtc', 'value': earliest_comment_created_utc, 'unit': 'None'},
        {'metric': 'LatestCommentCreatedUtc', 'value': latest_comment_created_utc, 'unit': 'None'}
      ], recursive := true) FROM merged_metrics) WHERE value IS NOT NULL"""
_RAW_AWARDS = """
    SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 8 = 0 THEN ''
      ELSE least(lang || '=' || (doc_id % 9), source || '=0') || ',' || greatest(lang || '=' || (doc_id % 9), source || '=0')
      END AS awards FROM documents"""
_STATE = f"""
    SELECT partition_date, state, count(*) AS lines FROM (
      SELECT {_LANDING_DAY} AS partition_date, CASE WHEN CAST(id AS BIGINT) % 13 = 5 THEN 'malformed'
        WHEN CAST(id AS BIGINT) % 17 = 3 THEN 'no_id'
        WHEN CAST(id AS BIGINT) % 19 = 4 THEN 'kept_without_score' ELSE 'kept' END AS state FROM subs) GROUP BY 1, 2"""

# Names by edit distance: exact, else the closest above the cutoff, else as they are.
_LEV = f"""
    SELECT m.*, r.brand AS found_brand, CASE
        WHEN m.product_name = '' OR lower(m.product_name) = 'general' THEN 'general'
        ELSE coalesce(
          (SELECT max(struct_pack(b := c.brand, m := c.model)).m FROM catalogue c WHERE lower(c.model) = lower(m.product_name)),
          (SELECT max(struct_pack(r := {_SIMILAR.format(a='c.model', b='lower(m.product_name)')}, m := c.model)).m FROM catalogue c
           WHERE (c.brand = lower(r.brand) OR NOT r.known)
             AND {_SIMILAR.format(a='c.model', b='lower(m.product_name)')} >= 0.6),
          m.product_name) END AS found_product
    FROM {{source}} m JOIN (
      SELECT raw, brand, brand IN (SELECT brand FROM catalogue) AS known FROM (
        SELECT raw, CASE WHEN raw = '' THEN 'Unknown' ELSE coalesce(
          (SELECT max(c.brand) FROM catalogue c WHERE c.brand = lower(raw)),
          (SELECT max(struct_pack(r := {_SIMILAR.format(a='c.brand', b='lower(raw)')}, b := c.brand)).b FROM catalogue c
           WHERE {_SIMILAR.format(a='c.brand', b='lower(raw)')} >= 0.7), raw) END AS brand
        FROM (SELECT DISTINCT brand_name AS raw FROM {{source}}))) r ON m.brand_name = r.raw"""
VIEWS["found_names"] = "SELECT DISTINCT brand_name, product_name FROM context_found"
VIEWS["found_resolved"] = _LEV.format(source="found_names")
VIEWS["raw_resolved"] = _LEV.format(source="raw_mentions")

# The matching-blocks ratio: of two stretches the longest common block is taken (the first in the candidate, then in the text, among
# equals), then the stretches before it and those after it, until nothing is common. Pairs are distinct, so each is worked out once.
VIEWS["name_pairs"] = """
    SELECT DISTINCT c.brand AS candidate, lower(m.brand_name) AS name FROM catalogue c CROSS JOIN raw_mentions m
    UNION SELECT DISTINCT c.model, lower(m.product_name) FROM catalogue c CROSS JOIN raw_mentions m"""
VIEWS["name_ratios"] = """
    WITH RECURSIVE stretches AS (
        SELECT candidate, name, 0 AS c0, length(candidate) AS c1, 0 AS t0, length(name) AS t1, 0 AS common FROM name_pairs
        UNION ALL
        SELECT candidate, name, unnest([
            {'c0': c0, 'c1': -block.c, 't0': t0, 't1': -block.t, 'common': block.size},
            {'c0': -block.c + block.size, 'c1': c1, 't0': -block.t + block.size, 't1': t1, 'common': 0}], recursive := true)
        FROM (
            SELECT candidate, name, c0, c1, t0, t1, max({'size': size, 'c': -c, 't': -t}) AS block
            FROM stretches, range(c0, c1) a(c), range(t0, t1) b(t), range(1, least(c1 - c, t1 - t) + 1) s(size)
            WHERE substr(candidate, c + 1, size) = substr(name, t + 1, size)
            GROUP BY candidate, name, c0, c1, t0, t1
        )
    )
    SELECT candidate, name, 2.0::DOUBLE * sum(common) / (length(candidate) + length(name)) AS ratio FROM stretches GROUP BY candidate, name"""
VIEWS["brands_by_blocks"] = """
    SELECT raw, brand, brand IN (SELECT brand FROM catalogue) AS known FROM (
      SELECT raw, CASE WHEN raw = '' THEN 'Unknown' ELSE coalesce(
        (SELECT max(c.brand) FROM catalogue c WHERE c.brand = lower(raw)),
        (SELECT max(struct_pack(r := p.ratio, b := c.brand)).b FROM catalogue c JOIN name_ratios p ON p.candidate = c.brand
         WHERE p.name = lower(raw) AND p.ratio >= 0.7), raw) END AS brand
      FROM (SELECT DISTINCT brand_name AS raw FROM raw_mentions))"""
VIEWS["resolved_by_blocks"] = """
    SELECT m.*, r.brand AS found_brand, CASE
        WHEN m.product_name = '' OR lower(m.product_name) = 'general' THEN 'general'
        ELSE coalesce(
          (SELECT max(struct_pack(b := c.brand, m := c.model)).m FROM catalogue c WHERE lower(c.model) = lower(m.product_name)),
          (SELECT max(struct_pack(r := p.ratio, m := c.model)).m FROM catalogue c JOIN name_ratios p ON p.candidate = c.model
           WHERE (c.brand = lower(r.brand) OR NOT r.known) AND p.name = lower(m.product_name) AND p.ratio >= 0.6),
          m.product_name) END AS found_product
    FROM raw_mentions m JOIN brands_by_blocks r ON m.brand_name = r.raw"""


def _then(value: str, step: str) -> str:
    """The expression ``step`` over ``h``, the value so far."""
    return f"list_transform([{value}], lambda h: {step})[1]"


def _times(value: str, factor: str) -> str:
    return f"(({value}) * {factor}::UBIGINT % 4294967296)"


def _rotated(value: str, bits: int) -> str:
    return f"(({value}) * {2 ** bits}::UBIGINT % 4294967296 + ({value}) // {2 ** (32 - bits)})"


def murmur(columns: list[str], source: str = "mentions") -> str:
    """The rows with ``murmur``, a 32-bit Murmur3 (seed 42) over the UTF-8 bytes of the columns in turn, signed; nulls are skipped.

    Whole words of four bytes come first, then the bytes that are left, one by one as signed numbers.
    """
    # Fixed values of the hash.
    first, second, added, mixers = "3432918353", "461845907", "3864292196", ("2246822507", "3266489909")
    key = _times(_then(_times("x", first), _rotated("h", 15)), second)
    step = "(" + _then(f"xor(acc, {key})", _rotated("h", 13)) + f" * 5 + {added}::UBIGINT) % 4294967296"
    rows = f"(SELECT *, 42::UBIGINT AS _hash FROM {source})"
    for column in columns:
        code = f"hex(encode({column}))"
        bytes_ = f"(length({code}) // 2)"
        word = " || ".join(f"substr({code}, 8 * i + {p}, 2)" for p in (7, 5, 3, 1))
        words = f"list_transform(range({bytes_} // 4), lambda i: ('0x' || {word})::UBIGINT)"
        byte = f"('0x' || substr({code}, 2 * i + 1, 2))::UBIGINT"
        tail = (
            f"list_transform(range({bytes_} // 4 * 4, {bytes_}), lambda i: "
            f"CASE WHEN {byte} < 128 THEN {byte} ELSE {byte} + 4294967040::UBIGINT END)"
        )
        mixed = f"xor(list_reduce(list_concat({words}, {tail}), lambda acc, x: {step}, _hash), {bytes_}::UBIGINT)"
        mixed = _times(_then(mixed, "xor(h, h // 65536)"), mixers[0])
        mixed = _times(_then(mixed, "xor(h, h // 8192)"), mixers[1])
        mixed = _then(mixed, "xor(h, h // 65536)")
        rows = f"(SELECT * REPLACE (CASE WHEN {column} IS NULL THEN _hash ELSE {mixed} END AS _hash) FROM {rows})"
    return f"(SELECT *, CASE WHEN _hash < 2147483648 THEN _hash::BIGINT ELSE _hash::BIGINT - 4294967296 END AS murmur FROM {rows})"


SQL: dict[str, str] = {
    "landing_roundtrip": _LANDED,
    "landing_roundtrip_comments": f"""
        SELECT id, link_id, parent_id, author, body, created_utc, updated_at, score, sort_type AS source_sort_type,
          {_LANDING_DAY} AS partition_date FROM comments""",
    "landing_scan_date": f"SELECT * FROM ({_LANDED}) WHERE partition_date = '01-01-2024'",
    "landing_quarantine": _STATE,
    "landing_partitions": f"SELECT DISTINCT sort_type, subreddit, {_LANDING_DAY} AS partition_date FROM subs",
    "partition_scan": "SELECT id, subreddit, score, partition_date FROM subs WHERE partition_date = '05-01-2024'",
    "append_count": """SELECT partition_date, 2 * count(*) AS rows FROM subs GROUP BY 1""",
    "overwrite_partitions": """
        SELECT partition_date, count(*) AS rows, CAST(sum(score) AS BIGINT) AS score FROM (
          SELECT partition_date, CASE WHEN starts_with(partition_date, '1') THEN score + 1000 ELSE score END AS score
          FROM (SELECT *, starts_with(partition_date, '1') AND max(score) OVER (PARTITION BY partition_date) >= 200 AS replaced
                FROM subs) WHERE NOT replaced OR score >= 200) GROUP BY 1""",
    "ref_csv_roundtrip": "SELECT * FROM products",
    "path_extract": """
        SELECT id, 'src' || (conv_id % 20 + 1) AS subreddit, partition_date AS date, sort_type, '' AS absent FROM comments""",
    "word_count": f"SELECT doc_id, CAST({_words('text')} AS INTEGER) AS words, CAST({_chars('text')} AS INTEGER) AS chars FROM documents",
    "flag_submissions": "SELECT id, title, selftext, partition_date, is_usable_for_sentiment FROM subs_silver",
    "flag_comments": "SELECT id, body, is_usable_for_sentiment FROM comments_silver",
    "epoch_convert": f"""
        SELECT id, strftime(make_timestamp(created_utc * 1000000), '%Y-%m-%d %H:%M:%S') AS created_at,
          {_day('created_utc')} AS created_on FROM subs""",
    "short_id": """
        SELECT id, split_part(link_id, '_', 2) AS link, split_part(author, '_', 2) AS without_prefix,
          CASE WHEN starts_with(parent_id, 't3_') THEN substr(parent_id, 4) END AS submission, 't1_' || id AS fullname_id
        FROM comments""",
    "process_date": "SELECT o_orderkey, strftime(o_orderdate, '%d-%m-%Y') AS process_date FROM orders",
    "price_segments": f"SELECT model, {_BY_SEGMENT} FROM products",
    "canonicalise": f"""
        SELECT CAST(doc_id AS VARCHAR) AS id, 't3_' || doc_id AS fullname_id, source AS subreddit,
          CASE WHEN doc_id % 5 <> 0 THEN lang END AS author,
          CASE WHEN doc_id % 7 <> 0 THEN text ELSE '' END AS title, CASE WHEN doc_id % 11 <> 0 THEN text ELSE '' END AS selftext,
          {START} + doc_id AS created_utc, CAST({START} AS BIGINT) AS updated_at,
          CAST(CASE WHEN doc_id % 3 <> 0 THEN n_chars ELSE 0 END AS INTEGER) AS score,
          CAST(doc_id % 100 AS DOUBLE) / 100 AS upvote_ratio, 0 AS num_comments,
          doc_id % 2 = 0 AS is_self, doc_id % 2 = 0 AS locked,
          'https://reddit.com' || CASE WHEN doc_id % 6 <> 0 THEN '/r/' || source ELSE '' END AS permalink,
          CASE doc_id % 10 WHEN 1 THEN {START} + doc_id WHEN 2 THEN 1 END AS edited
        FROM documents""",
    "awards_map": _RAW_AWARDS,
    "canonical_comments": f"""
        SELECT conv_id || '-' || turn AS id, 't1_' || conv_id || '-' || turn AS fullname_id,
          CASE WHEN turn % 3 <> 0 THEN 'x' ELSE '' END || conv_id AS submission_id,
          CASE WHEN turn % 3 <> 0 THEN 't3_x' || conv_id END AS link_id,
          CASE WHEN turn % 4 <> 0 THEN text ELSE '' END AS body, {START} + conv_id AS created_utc,
          turn = 1 AS is_submitter, CAST(turn AS INTEGER) AS depth, 'https://reddit.com' AS permalink
        FROM conversations""",
    "analysis_id_murmur": f"""
        SELECT comment_id, CAST(murmur AS VARCHAR) AS analysis_id
        FROM {murmur(["comment_id", "brand_name", "product_name", "aspect"])}""",
    "analysis_id_sha": "SELECT comment_id, brand_name, product_name, aspect, analysis_id FROM mentions",
    "comment_subreddit": "SELECT id, link_id, subreddit FROM comments_silver",
    "comment_context": "SELECT * FROM context",
    "parent_body": """
        SELECT x.comment_id, x.parent_id, c.body AS parent_body FROM context x
        LEFT JOIN comments c ON x.parent_id = 't1_' || c.id""",
    "only_new": "SELECT comment_id, submission_id FROM context WHERE comment_id NOT IN (SELECT comment_id FROM mentions)",
    "fact_or_join": f"""
        SELECT m.comment_id, m.aspect, p.id AS matched, p.subreddit FROM with_link m LEFT JOIN subs p ON {_OR}""",
    "fact_priority_join": """
        SELECT m.comment_id, m.aspect, coalesce(p.id, q.id) AS matched, coalesce(p.subreddit, q.subreddit) AS subreddit
        FROM with_link m LEFT JOIN subs p ON split_part(m.link_id, '_', 2) = p.id
        LEFT JOIN subs q ON m.submission_id = q.id""",
    "merge_metrics": "SELECT * FROM merged_metrics",
    "coverage_grid": "SELECT * FROM grid",
    "prompt_build": f"""
        SELECT x.comment_id, 'Context:' || chr(10) || concat_ws(chr(10), 'Submission Title: ' || submission_title,
            CASE WHEN submission_selftext NOT IN {SENTINEL}
                 THEN 'Submission Context: ' || submission_selftext || '...' END,
            CASE WHEN c.body NOT IN {SENTINEL} THEN 'Parent Comment: ' || c.body END)
          || chr(10) || chr(10) || 'Target Comment to Analyze:' || chr(10) || '"' || x.body || '"' AS prompt
        FROM context x LEFT JOIN comments c ON x.parent_id = 't1_' || c.id""",
    "prompt_brands": f"""
        SELECT 'Find every opinion on a phone in the comment. Answer with a JSON array of objects with the fields brand_name, '
          || 'product_name (or general), aspect, sentiment_score (0.0 very negative to 1.0 very positive) and quote '
          || '(verbatim, at most 200 characters). Aspects: camera, battery, display, performance, price, software, '
          || 'build_quality, design, other. Judge the target comment alone; the post and the parent comment only tell '
          || 'what its words refer to. Known brands: ' || string_agg(brand, ', ' ORDER BY brand) AS system_text
        FROM (SELECT DISTINCT brand FROM products)""",
    "score_stub": """
        SELECT comment_id, 'Brand#1' AS brand_name, '' AS product_name, 'camera' AS aspect,
          round(CAST(length(body) % 11 AS DOUBLE) / 10, 6) AS sentiment_score FROM context""",
    "parse_responses": "SELECT comment_id, brand_name, product_name, aspect, sentiment_score, quote FROM items",
    "parse_responses_strict": """
        SELECT comment_id, brand_name, product_name, aspect, sentiment_score, quote FROM items
        WHERE comment_id NOT IN (
          SELECT comment_id FROM parsed WHERE len(objects) <> len(elements) UNION ALL
          SELECT comment_id FROM items WHERE aspect IS NULL OR TRY_CAST(sentiment_score AS DOUBLE) IS NULL)""",
    "mention_defaults": """
        SELECT comment_id, brand_name, product_name, lower(coalesce(aspect, 'general')) AS aspect,
          coalesce(TRY_CAST(sentiment_score AS DOUBLE), 0.5) AS sentiment_score,
          left(CASE WHEN quote <> '' THEN quote WHEN length(body) > 150 THEN left(body, 150) || '...' ELSE body END, 200) AS quote
        FROM items""",
    "lexicon_mentions": """
        SELECT comment_id, brand_name, product_name, aspect, round(sentiment_score, 6) AS sentiment_score FROM lexicon_found""",
    "resolve_exact": """
        SELECT m.comment_id, CASE WHEN m.brand_name = '' THEN 'Unknown' ELSE coalesce(b.brand, m.brand_name) END AS brand_name,
          CASE WHEN m.product_name = '' OR lower(m.product_name) = 'general' THEN 'general'
               ELSE coalesce(p.model, m.product_name) END AS product_name
        FROM raw_mentions m LEFT JOIN (SELECT DISTINCT brand FROM catalogue) b ON lower(m.brand_name) = b.brand
        LEFT JOIN (SELECT DISTINCT model FROM catalogue) p ON lower(m.product_name) = lower(p.model)""",
    "resolve_lev": "SELECT comment_id, found_brand AS brand_name, found_product AS product_name FROM raw_resolved",
    "resolve_brand_difflib": "SELECT raw AS raw_brand, brand AS brand_name FROM brands_by_blocks",
    "resolve_model_difflib": "SELECT comment_id, found_brand AS brand_name, found_product AS product_name FROM resolved_by_blocks",
    "brand_models": "SELECT DISTINCT brand, lower(model) AS model FROM catalogue",
    "submission_metrics": """
        SELECT subreddit, count(*) AS submissions_count, min(created_utc) AS earliest_submission_created_utc,
          max(created_utc) AS latest_submission_created_utc FROM subs GROUP BY 1""",
    "comment_metrics": """
        SELECT 'src' || (conv_id % 20 + 1) AS subreddit, count(*) AS comments_count,
          min(created_utc) AS earliest_comment_created_utc, max(created_utc) AS latest_comment_created_utc
        FROM comments GROUP BY 1""",
    "run_metrics": "SELECT * FROM run_total",
    "usable_ratio": "SELECT kind, total, usable, round(ratio, 6) AS ratio FROM ratios",
    "listing_summary": "SELECT * FROM listing",
    "listing_spans": _LISTING_METRICS,
    "metrics_long": _RUN_METRICS,
    "quality_metrics": """
        SELECT metric, round(CAST(value AS DOUBLE), 6) AS value, 'Count' AS unit FROM (
          SELECT CASE kind WHEN 'submissions' THEN 'Submissions' ELSE 'Comments' END || name AS metric, value FROM (
            SELECT kind, 'Total' AS name, CAST(total AS DOUBLE) AS value FROM ratios UNION ALL
            SELECT kind, 'UsableForSentiment', usable FROM ratios UNION ALL
            SELECT kind, 'UsableRatio', ratio FROM ratios))""",
    "sentiment_summary": """
        SELECT count(*) AS total_sentiment_records, count(DISTINCT comment_id) AS unique_comments_analyzed,
          count(DISTINCT brand_name) AS brands_mentioned, round(avg(sentiment_score), 6) AS avg_sentiment_score FROM mentions""",
    "reference_counts": "SELECT count(*) AS products, count(DISTINCT brand) AS brands FROM products",
    "sentiment_by_price": f"SELECT brand_name, {_BY_SEGMENT}, {_AVERAGE} FROM by_product GROUP BY 1, 2",
    "sentiment_by_segment": f"SELECT {_BY_SEGMENT}, {_AVERAGE} FROM by_product GROUP BY 1",
    "sentiment_by_5g": f"""
        SELECT CASE WHEN has_5g = 1 THEN '5G' ELSE '4G' END AS connectivity, {_AVERAGE} FROM by_product GROUP BY 1""",
    "aspect_by_spec": """
        SELECT p.brand_name, p.model, p.primary_camera_rear,
          round(avg(CASE WHEN m.aspect = 'camera' THEN m.sentiment_score END), 6) AS camera_sentiment,
          count(CASE WHEN m.aspect = 'camera' THEN 1 END) AS camera_mentions
        FROM products p LEFT JOIN mentions m ON p.brand = lower(m.brand_name) AND p.model = m.product_name
        WHERE p.primary_camera_rear >= 20 GROUP BY 1, 2, 3""",
    "aspect_by_figure": """
        SELECT p.primary_camera_rear,
          round(avg(CASE WHEN m.aspect = 'camera' THEN m.sentiment_score END), 6) AS camera_sentiment,
          count(CASE WHEN m.aspect = 'camera' THEN 1 END) AS camera_mentions
        FROM products p LEFT JOIN mentions m ON p.brand = lower(m.brand_name) AND p.model = m.product_name
        WHERE p.primary_camera_rear IS NOT NULL GROUP BY 1""",
    "distinct_groups": "SELECT DISTINCT subreddit FROM context",
    "latest_event": """
        SELECT user_id, event_type, event_id, value FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn FROM events)
        WHERE rn = 1""",
    "latest_per_link": """
        SELECT link_id, id, updated_at FROM (
          SELECT *, row_number() OVER (PARTITION BY link_id ORDER BY updated_at DESC, id) AS rn FROM comments) WHERE rn = 1""",
    "surrogate_keys": f"SELECT row_number() OVER (ORDER BY md5({_key('id')})) AS row_key, id FROM subs",
    "top_n_per_group": f"""
        SELECT subreddit, CAST(rn AS INTEGER) AS rank, id, score FROM (
          SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY score DESC, id) AS rn FROM subs
          WHERE created_utc >= {START + 86400}) WHERE rn <= 5""",
    "listing_top": f"""
        SELECT subreddit, 'top' AS sort_type, CAST(rn AS INTEGER) AS rank, id FROM (
          SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY score DESC, id) AS rn FROM subs
          WHERE created_utc >= {START + 86400}) WHERE rn <= 4""",
    "comments_per_submission": """
        SELECT link_id, CAST(rn AS INTEGER) AS rank, id FROM (
          SELECT *, row_number() OVER (PARTITION BY link_id ORDER BY score DESC, id) AS rn FROM comments) WHERE rn <= 3""",
    "comments_ranked": """
        SELECT link_id, CAST(row_number() OVER (PARTITION BY link_id ORDER BY score DESC, id) AS INTEGER) AS rank, id FROM comments""",
    "latest_dates": """
        SELECT partition_date FROM (SELECT DISTINCT partition_date FROM subs)
        ORDER BY strptime(partition_date, '%d-%m-%Y') DESC LIMIT 5""",
    "sample_rejects": """
        SELECT id, title, selftext, is_usable_for_sentiment FROM subs_silver WHERE NOT is_usable_for_sentiment
        ORDER BY id LIMIT 10""",
    "sample_reject_comments": """
        SELECT id, body, is_usable_for_sentiment FROM comments_silver WHERE NOT is_usable_for_sentiment ORDER BY id LIMIT 10""",
    "merge_latest_events": """
        SELECT coalesce(t.user_id, s.user_id) AS user_id, coalesce(t.event_type, s.event_type) AS event_type,
          CASE WHEN t.event_id IS NULL OR coalesce(s.ts > t.ts, false) THEN s.event_id ELSE t.event_id END AS event_id,
          CASE WHEN t.event_id IS NULL OR coalesce(s.ts > t.ts, false) THEN s.value ELSE t.value END AS value
        FROM event_target t FULL JOIN event_source s ON t.user_id = s.user_id AND t.event_type = s.event_type""",
    "bronze_job": f"""
        SELECT id, updated_at, score, subreddit, partition_date FROM bronze_state UNION ALL
        SELECT id, updated_at, score, NULL, {_LANDING_DAY} FROM comments""",
    "bronze_rows_after": """
        SELECT 'BronzeSubmissionsRows' AS metric, CAST(count(*) AS DOUBLE) AS rows FROM subs UNION ALL
        SELECT 'BronzeCommentsRows', CAST(count(*) AS DOUBLE) FROM comments""",
    "incremental_final_state": "SELECT * FROM bronze_state",
    "silver_job": "SELECT id, subreddit, partition_date, is_usable_for_sentiment FROM comments_silver",
    "silver_posts_job": """
        SELECT id, fullname_id, subreddit, title, selftext, created_utc, score, upvote_ratio, num_comments, partition_date,
          is_usable_for_sentiment FROM subs_silver""",
    "check_unique_analysis": "SELECT '' AS analysis_id, 0 AS copies WHERE false",
    "check_unique_silver": "SELECT id, 2 AS copies FROM subs WHERE score % 7 = 0",
    "mart_views": "SELECT subreddit, count(*) AS rows FROM subs GROUP BY 1",
    "staged_view": "SELECT subreddit, count(*) AS rows, max(score) AS best FROM subs GROUP BY 1",
    "replaced_table": "SELECT id, score + 1 AS score FROM subs WHERE score % 2 = 0",
    "seeded_once": "SELECT brand_name, model, price, brand FROM products",
    "table_columns": """
        SELECT v.name, v.kind, CAST(n AS INTEGER) AS posts FROM (VALUES ('submissions_silver', 'table'), ('comments_silver', 'table'),
          ('sentiment_analysis', 'table'), ('analysed_comments', 'table'), ('id', 'string'), ('fullname_id', 'string'),
          ('subreddit', 'string'), ('title', 'string'), ('selftext', 'string'), ('created_utc', 'bigint'), ('score', 'int'),
          ('upvote_ratio', 'double'), ('num_comments', 'int'), ('partition_date', 'string'),
          ('is_usable_for_sentiment', 'boolean')) v(name, kind), (SELECT count(*) AS n FROM subs)""",
    "checkpoint_lookup": """
        SELECT subreddit, sort_type, time_filter, event_id AS last_timestamp, items_fetched FROM (
          SELECT *, row_number() OVER (PARTITION BY subreddit, sort_type, time_filter ORDER BY save DESC, event_id DESC) AS rn
          FROM checkpoint_log)
        WHERE rn = 1 AND (subreddit = 'user3' AND sort_type IS NULL OR subreddit = 'user4' AND sort_type = 'click')""",
    "sentiment_job": """
        SELECT x.submission_id, x.comment_id, r.found_brand AS brand_name, r.found_product AS product_name, f.aspect, 'lexicon' AS model_version,
          round(f.sentiment_score, 6) AS sentiment_score,
          CASE WHEN length(x.body) > 150 THEN left(x.body, 150) || '...' ELSE x.body END AS quote,
          x.partition_date AS date_partition
        FROM context_found f JOIN context x ON f.comment_id = x.comment_id
        JOIN found_resolved r ON f.brand_name = r.brand_name AND f.product_name = r.product_name""",
    "checkpoint_upsert": """
        SELECT subreddit, sort_type, time_filter, event_id AS last_timestamp, items_fetched FROM (
          SELECT *, row_number() OVER (PARTITION BY subreddit, sort_type, time_filter ORDER BY save DESC, event_id DESC) AS rn
          FROM checkpoint_log) WHERE rn = 1""",
    "dim_date": """
        SELECT d.*, coalesce(o.n, 0) AS orders FROM dim_date d
        LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1) o ON d.full_date = o.day""",
    "dim_product": "SELECT * FROM dim_product",
    "dim_submission": "SELECT * FROM dim_submission",
    "fact_product_fk": """
        SELECT m.comment_id, m.brand_name, m.product_name, p.product_key FROM mentions m LEFT JOIN dim_product p
        ON lower(m.brand_name) = lower(p.brand_name) AND lower(m.product_name) = lower(p.model)""",
    "fact_mentions": f"""
        SELECT dp.product_key, ds.submission_key, dd.date_key, s.comment_id, s.brand_name, s.product_name, s.aspect,
          s.sentiment_score, c.score AS comment_score
        FROM mentions s
        LEFT JOIN dim_product dp ON lower(s.brand_name) = lower(dp.brand_name) AND lower(s.product_name) = lower(dp.model)
        LEFT JOIN comments c ON s.comment_id = c.id
        LEFT JOIN dim_submission ds ON split_part(c.link_id, '_', 2) = ds.reddit_submission_id
          OR s.submission_id = ds.reddit_submission_id
        LEFT JOIN dim_date dd ON {_day('c.created_utc')} = dd.full_date""",
    "layer_counts": """
        SELECT 'Bronze' AS layer, count(*) AS rows FROM subs UNION ALL SELECT 'Silver-core', count(*) FROM subs_silver""",
    "submission_flow": """
        SELECT 'Bronze' AS layer, count(*) AS submission_count, count(DISTINCT id) AS unique_submissions FROM subs UNION ALL
        SELECT 'Silver-core', count(*), count(DISTINCT id) FROM subs_silver""",
    "comment_flow": """
        SELECT 'Bronze' AS layer, count(*) AS comment_count, CAST(NULL AS BIGINT) AS usable_count,
          CAST(NULL AS BIGINT) AS analyzed_count FROM comments UNION ALL
        SELECT 'Silver-core', count(*), count(*) FILTER (is_usable_for_sentiment), NULL FROM comments_silver UNION ALL
        SELECT 'Silver-sentiment', NULL, NULL, count(DISTINCT comment_id) FROM mentions""",
    "check_no_drop": """
        SELECT partition_date, b AS bronze_rows, b - d AS silver_rows FROM (
          SELECT partition_date, count(*) AS b, count(*) FILTER (score % 10 = 7 AND starts_with(partition_date, '0')) AS d
          FROM subs GROUP BY 1) WHERE d > 0""",
    "check_flags": f"""
        SELECT id, reason FROM (
          SELECT id, CASE WHEN flag IS NULL THEN 'missing' WHEN flag AND (selftext IS NULL OR selftext IN {SENTINEL}) THEN 'sentinel'
            WHEN flag AND {_chars('selftext')} + {_chars('title')} < 10 THEN 'short' END AS reason
          FROM (SELECT *, CASE WHEN CAST(id AS BIGINT) % 41 = 0 THEN NULL WHEN CAST(id AS BIGINT) % 5 = 0 THEN true
                  ELSE is_usable_for_sentiment END AS flag FROM subs_silver)) WHERE reason IS NOT NULL""",
    "check_unusable_analysed": """
        SELECT id AS comment_id, partition_date FROM comments_silver
        WHERE NOT is_usable_for_sentiment AND id IN (SELECT comment_id FROM mentions)""",
    "check_missing_analysis": """
        SELECT id AS comment_id, partition_date FROM comments_silver
        WHERE is_usable_for_sentiment AND id NOT IN (SELECT comment_id FROM mentions)""",
    "check_brand_domain": """
        SELECT lower(brand_name) AS brand, count(*) AS mentions FROM mentions
        WHERE lower(brand_name) NOT IN (SELECT brand FROM products) GROUP BY 1""",
    "check_score_range": """
        SELECT comment_id, sentiment_score FROM mentions WHERE sentiment_score NOT BETWEEN 0 AND 1 OR analyzed_at IS NULL""",
    "check_ratio": """
        SELECT * FROM ratios WHERE ratio <= 0 OR ratio >= 1 UNION ALL
        SELECT 'usable', count(*), count(*), 1.0 FROM subs_silver WHERE is_usable_for_sentiment""",
    "check_coverage": """
        SELECT g.* FROM grid g LEFT JOIN (SELECT DISTINCT subreddit, sort_type, partition_date FROM subs) l
        USING (subreddit, sort_type, partition_date) WHERE l.subreddit IS NULL""",
    "check_unique": "SELECT link_id, count(*) AS copies FROM comments GROUP BY 1 HAVING count(*) > 1",
}


def _with_views(sql: str) -> str:
    """The query preceded by the views it needs."""
    wanted: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"(?:FROM|JOIN)\s+(\w+)", text):
            if name in VIEWS and name not in wanted:
                visit(VIEWS[name])
                wanted.append(name)

    visit(sql)
    views = ", ".join(f"{name} AS ({VIEWS[name].strip()})" for name in wanted)
    return f"WITH {views} {sql.strip()}" if views else sql.strip()


SQL["gold_job"] = SQL["fact_mentions"]
SQL["fact_or_join_unique"] = SQL["fact_or_join"]
SQL["fact_priority_join_unique"] = SQL["fact_priority_join"]


def oracle() -> dict[str, str]:
    return {name: _with_views(sql) for name, sql in SQL.items()}
