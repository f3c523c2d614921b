"""SQL forms of the views in ``reelgrove.sources.sample_views``, for checking results."""

VIEWS = {
    "users": """
        SELECT nullif(c_custkey, 0) AS user_id, CAST(floor(c_acctbal / 100) AS INTEGER) AS age,
               n_name AS country, c_mktsegment AS segment,
               concat('user_', CAST(c_custkey AS VARCHAR), '@example.invalid') AS email,
               concat('+66', CAST(c_custkey + 100000000 AS VARCHAR)) AS phone
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "items": """
        SELECT p_partkey AS content_id, p_name AS title, p_type AS genre, p_brand AS language,
               1990 + p_size % 36 AS release_year, p_size - 2 AS duration_min,
               concat_ws(' ', p_name, p_type, p_brand) AS synopsis
        FROM part""",
    "interactions": """
        SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS interaction_id,
               nullif(o_custkey, 0) AS user_id, l_partkey AS content_id, l_shipdate AS event_ts,
               CAST(l_quantity * 60 AS BIGINT) AS watch_seconds, l_returnflag AS device
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "silver_users": """
        SELECT user_id, age, country, segment, email, phone FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY age NULLS LAST,
                country NULLS LAST, segment NULLS LAST, email NULLS LAST) AS rn FROM users)
        WHERE rn = 1 AND user_id IS NOT NULL""",
    "silver_items": """
        SELECT content_id, title, genre, language, release_year, duration_min, synopsis FROM (
            SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY title NULLS LAST,
                genre NULLS LAST, language NULLS LAST, release_year NULLS LAST) AS rn FROM items)
        WHERE rn = 1 AND content_id IS NOT NULL AND duration_min > 0""",
    "silver_interactions": """
        SELECT * FROM interactions WHERE user_id IS NOT NULL AND content_id IS NOT NULL""",
    "gold_interactions": """
        SELECT i.*, t.genre, t.release_year, u.country, u.age,
               i.watch_seconds >= 51 * t.duration_min AS completed
        FROM silver_interactions i
        LEFT JOIN silver_items t ON i.content_id = t.content_id
        LEFT JOIN silver_users u ON i.user_id = u.user_id""",
    "user_item_totals": """
        SELECT user_id, content_id, CAST(sum(watch_seconds) AS BIGINT) AS watch_seconds
        FROM gold_interactions GROUP BY user_id, content_id""",
    "seeds": """
        SELECT user_id, content_id AS seed_content_id FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id
                ORDER BY watch_seconds DESC NULLS LAST, content_id) AS rn FROM user_item_totals)
        WHERE rn = 1""",
    "user_features": """
        SELECT b.*, s.seed_content_id FROM (
            SELECT user_id, count(*) AS watch_count_7d, avg(watch_seconds) AS avg_session_seconds,
                   quantile_disc(watch_seconds, 0.5) AS p50_session_seconds,
                   first(genre ORDER BY event_ts, content_id) FILTER (WHERE genre IS NOT NULL) AS fav_genre,
                   max(event_ts) AS last_active_ts
            FROM gold_interactions GROUP BY user_id) b
        LEFT JOIN seeds s ON b.user_id = s.user_id""",
    "item_features": """
        SELECT t.*, coalesce(p.popularity_7d, 0) AS popularity_7d,
               coalesce(p.completion_rate, 0) AS completion_rate
        FROM silver_items t LEFT JOIN (
            SELECT content_id, count(*) AS popularity_7d, avg(CAST(completed AS INTEGER)) AS completion_rate
            FROM gold_interactions GROUP BY content_id) p ON t.content_id = p.content_id""",
    "logged": """
        SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""",
    "served": """
        SELECT user_id, k AS content_id, ts AS served_at, value AS score
        FROM logged WHERE event_type = 'view'""",
    "watched": """
        SELECT event_id, user_id, k AS content_id, ts AS event_ts,
               CAST(trunc(value * 10) AS BIGINT) AS watch_seconds
        FROM logged WHERE event_type IN ('click', 'purchase')""",
}
