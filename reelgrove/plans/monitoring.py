"""Daily profiles and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelgrove.operators import monitoring as m
from reelgrove.plans.registry import query
from reelgrove.sources import sample_views as v
from reelgrove.sources.tables import read_table


def _profile_sql(column: str, text: str, numeric: bool) -> str:
    x = f"CAST({column} AS DOUBLE)"
    measures = (
        f"min({x}) AS min_value, max({x}) AS max_value, round(avg({x}), 6) AS mean_value, "
        f"round(stddev_samp({x}), 6) AS stddev_value, quantile_disc({x}, 0.25) AS p25, "
        f"quantile_disc({x}, 0.5) AS p50, quantile_disc({x}, 0.75) AS p75"
    )
    if not numeric:
        measures = ", ".join(
            f"CAST(NULL AS DOUBLE) AS {c}"
            for c in ("min_value", "max_value", "mean_value", "stddev_value", "p25", "p50", "p75")
        )
    return (
        f"SELECT CAST(ts AS DATE) AS day, '{text}' AS column_name, count(*) AS rows, "
        f"count(*) - count({column}) AS nulls, {measures}, "
        f"count(DISTINCT {column}) AS distinct_values FROM logged GROUP BY 1"
    )


@query("profile_daily", " UNION ALL ".join(
    [
        _profile_sql("value", "value", True),
        _profile_sql("k", "k", True),
        _profile_sql("event_type", "event_type", False),
    ]
))
def profile_daily(spark, folder):
    events = v._events(spark, folder)
    return m.profile_daily(events, "ts", ["value", "k"], ["event_type"])


@query("quality_counts", """
    SELECT CAST(ts AS DATE) AS day, count(*) AS rows, 'event_type' AS column_name,
           count(*) FILTER (WHERE event_type IS NULL) AS nulls,
           count(*) FILTER (WHERE event_type IS NOT NULL AND TRY_CAST(event_type AS INTEGER) IS NULL) AS type_errors
    FROM logged GROUP BY 1
    UNION ALL
    SELECT CAST(ts AS DATE), count(*), 'k_text',
           count(*) FILTER (WHERE k IS NULL),
           count(*) FILTER (WHERE k IS NOT NULL AND TRY_CAST(CAST(k AS VARCHAR) AS INTEGER) IS NULL)
    FROM logged GROUP BY 1""")
def quality_counts(spark, folder):
    events = read_table(spark, folder, "events").withColumn(
        "k_text", F.get_json_object("props", "$.k")
    )
    return m.quality_counts(events, "ts", {"event_type": "int", "k_text": "int"})


@query("drift_numeric", """
    WITH days AS (SELECT CAST(ts AS DATE) AS day, value AS x FROM events WHERE value IS NOT NULL),
    base AS (SELECT x FROM days WHERE day < (SELECT min(day) FROM days) + INTERVAL 7 DAYS),
    edges AS (SELECT list_distinct(quantile_disc(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM base),
    bins AS (SELECT CAST(unnest(range(0, (SELECT len(e) + 1 FROM edges))) AS BIGINT) AS bin),
    base_bin AS (SELECT len(list_filter(e, lambda t: t < x)) AS bin, count(*) AS n FROM base, edges GROUP BY 1),
    day_bin AS (SELECT day, len(list_filter(e, lambda t: t < x)) AS bin, count(*) AS n FROM days, edges GROUP BY 1, 2),
    totals AS (SELECT day, count(*) AS rows FROM days GROUP BY 1),
    shares AS (
        SELECT t.day, t.rows, greatest(coalesce(d.n, 0) / t.rows, 0.0001) AS p,
               greatest(coalesce(b.n, 0) / (SELECT count(*) FROM base), 0.0001) AS q
        FROM totals t CROSS JOIN bins LEFT JOIN day_bin d ON d.day = t.day AND d.bin = bins.bin
        LEFT JOIN base_bin b ON b.bin = bins.bin),
    psi AS (SELECT day, rows, round(sum((p - q) * ln(p / q)), 6) AS psi FROM shares GROUP BY 1, 2),
    grid AS (
        SELECT t.day, g.x, t.rows,
               coalesce(c.n, 0) AS n, coalesce(b.n, 0) AS b
        FROM totals t CROSS JOIN (SELECT DISTINCT x FROM days) g
        LEFT JOIN (SELECT day, x, count(*) AS n FROM days GROUP BY 1, 2) c ON c.day = t.day AND c.x = g.x
        LEFT JOIN (SELECT x, count(*) AS n FROM base GROUP BY 1) b ON b.x = g.x),
    steps AS (
        SELECT day, abs(sum(n) OVER w / rows - sum(b) OVER w / (SELECT count(*) FROM base)) AS gap
        FROM grid WINDOW w AS (PARTITION BY day ORDER BY x))
    SELECT psi.day, rows, psi, round(max(gap), 6) AS ks
    FROM psi JOIN steps ON psi.day = steps.day GROUP BY psi.day, rows, psi""")
def drift_numeric(spark, folder):
    events = read_table(spark, folder, "events")
    return m.drift_numeric(events, "ts", "value", m.baseline_days(events, "ts"))


def _categorical_sql(label: str, pairs: str) -> str:
    return f"""
    SELECT '{label}' AS compared_with, day, rows,
           round(sum((greatest(p, 0.0001) - greatest(q, 0.0001)) * ln(greatest(p, 0.0001) / greatest(q, 0.0001))), 6) AS psi,
           round(sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END
                     + CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) / 2, 6) AS js,
           round(sum((p - greatest(q, 0.0001)) * (p - greatest(q, 0.0001)) / greatest(q, 0.0001)) * rows, 6) AS chi_square
    FROM ({pairs}) GROUP BY day, rows"""


@query("drift_categorical", """
    WITH days AS (SELECT CAST(ts AS DATE) AS day, coalesce(event_type, '(missing)') AS c FROM events),
    totals AS (SELECT day, count(*) AS rows FROM days GROUP BY 1),
    counts AS (SELECT day, c, count(*) AS n FROM days GROUP BY 1, 2),
    base AS (SELECT c, count(*) AS n FROM days WHERE day < (SELECT min(day) FROM days) + INTERVAL 7 DAYS GROUP BY 1),
    kinds AS (SELECT DISTINCT c FROM days)
    """ + _categorical_sql("first_week", """
        SELECT t.day, t.rows, coalesce(d.n, 0) / t.rows AS p, coalesce(b.n, 0) / (SELECT sum(n) FROM base) AS q
        FROM totals t CROSS JOIN kinds k LEFT JOIN counts d ON d.day = t.day AND d.c = k.c
        LEFT JOIN base b ON b.c = k.c""") + " UNION ALL " + _categorical_sql("previous_day", """
        SELECT t.day, t.rows, coalesce(d.n, 0) / t.rows AS p, coalesce(b.n, 0) / y.rows AS q
        FROM totals t JOIN totals y ON y.day = t.day - 1 CROSS JOIN kinds k
        LEFT JOIN counts d ON d.day = t.day AND d.c = k.c
        LEFT JOIN counts b ON b.day = y.day AND b.c = k.c"""))
def drift_categorical(spark, folder):
    events = read_table(spark, folder, "events")
    first = m.drift_categorical(events, "ts", "event_type", m.baseline_days(events, "ts"))
    daily = m.drift_categorical(events, "ts", "event_type")
    return first.withColumn("compared_with", F.lit("first_week")).unionByName(
        daily.withColumn("compared_with", F.lit("previous_day"))
    )


@query("prediction_concentration", """
    WITH per_item AS (
        SELECT CAST(served_at AS DATE) AS day, content_id, count(*) AS n, sum(score) AS s FROM served GROUP BY 1, 2),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY n DESC, content_id) AS rn FROM per_item)
    SELECT day, CAST(sum(n) AS BIGINT) AS served, round(sum(s) / sum(n), 6) AS mean_score,
           sum(n) FILTER (WHERE rn <= 5) / sum(n) AS top_share
    FROM ranked GROUP BY day""")
def prediction_concentration(spark, folder):
    return m.prediction_concentration(v.served(spark, folder))
