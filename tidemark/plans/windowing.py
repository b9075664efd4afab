"""Reports on time, session and count windows, evictors and late rows."""

from pyspark.sql import functions as F

from tidemark.functions.text import counted_items
from tidemark.operators import aggs, watermarks, windows
from tidemark.operators.history import highest, lowest, running
from tidemark.plans.aggregates import K, one, with_k
from tidemark.plans.registry import report
from tidemark.runtime import cut_lineage

ORDER = ["ts", "event_id"]


@report(
    "window_rows_tumbling",
    """SELECT event_id, w AS window_start, w + INTERVAL '10 minutes' AS window_end, w + INTERVAL '10 minutes' - INTERVAL '1 millisecond' AS window_time
       FROM (SELECT event_id, time_bucket(INTERVAL '10 minutes', ts) AS w FROM events)""",
)
def window_rows_tumbling(t):
    out = windows.window_rows(t("events"), "tumble", "ts", "10 minutes")
    return out.select("event_id", "window_start", "window_end", "window_time")


@report(
    "window_rows_hopping",
    """SELECT event_id, w AS window_start, w + INTERVAL '10 minutes' AS window_end, w + INTERVAL '10 minutes' - INTERVAL '1 millisecond' AS window_time
       FROM (SELECT event_id, time_bucket(INTERVAL '5 minutes', ts) - to_minutes(CAST(5 * i AS BIGINT)) AS w FROM events, range(2) r(i))""",
)
def window_rows_hopping(t):
    out = windows.window_rows(t("events"), "hop", "ts", "10 minutes", "5 minutes")
    return out.select("event_id", "window_start", "window_end", "window_time")


CUMULATE = """SELECT event_id, k, s AS window_start, s + to_hours(CAST(i + 1 AS BIGINT)) AS window_end
    FROM (SELECT event_id, {k} AS k, ts, time_bucket(INTERVAL '6 hours', ts) AS s FROM events), range(6) r(i)
    WHERE ts < s + to_hours(CAST(i + 1 AS BIGINT))""".format(k=K)


@report(
    "window_rows_cumulating",
    f"SELECT event_id, window_start, window_end, window_end - INTERVAL '1 millisecond' AS window_time FROM ({CUMULATE})",
)
def window_rows_cumulating(t):
    out = windows.window_rows(t("events"), "cumulate", "ts", "6 hours", "1 hour")
    return out.select("event_id", "window_start", "window_end", "window_time")


@report(
    "cumulating_sums",
    f"""SELECT window_start, window_end, count(*) AS cnt, CAST(sum(k) AS BIGINT) AS total, max(k) AS highest
        FROM ({CUMULATE}) GROUP BY 1, 2""",
)
def cumulating_sums(t):
    folds = {"cnt": running(one()), "total": running("k"), "highest": highest("k")}
    return windows.cumulate_agg(with_k(t), "ts", "1 hour", "6 hours", folds)


@report(
    "user_sessions",
    f"""WITH g AS (SELECT *, {K} AS k, CASE WHEN ts > lag(ts) OVER w + INTERVAL '3 hours' THEN 1 ELSE 0 END AS opens
                   FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g)
        SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '3 hours' AS session_end, count(*) AS cnt,
               CAST(sum(k) AS BIGINT) AS total, arg_min(event_type, (ts, event_id)) AS first_type
        FROM s GROUP BY user_id, session""",
)
def user_sessions(t):
    folds = {"cnt": running(one()), "total": running("k"), "first": lowest(F.struct("ts", "event_id", "event_type"))}
    out = windows.session_agg(with_k(t), ["user_id"], "ts", "3 hours", folds)
    return out.withColumn("first_type", F.col("first.event_type")).drop("first")


@report(
    "word_count_windows",
    r"""WITH d AS (SELECT doc_id, regexp_split_to_array(lower(text), '\W+') AS words FROM documents),
        w AS (SELECT doc_id, CAST(pos AS BIGINT) AS pos, words[pos] AS token FROM d, LATERAL (SELECT unnest(range(1, len(words) + 1)) AS pos)),
        n AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY doc_id, pos) AS at_row FROM w WHERE token <> '')
        SELECT token, at_row, n, CAST(doc_sum AS BIGINT) AS doc_sum FROM (
          SELECT token, at_row, count(*) OVER f AS n, sum(doc_id) OVER f AS doc_sum FROM n
          WINDOW f AS (PARTITION BY token ORDER BY at_row ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
        WHERE at_row % 5 = 0""",
)
def word_count_windows(t):
    """A document holds a token so many times in a row, as the order of the rows is that of documents."""
    words = t("documents").select("doc_id", F.split(F.lower("text"), r"\W+").alias("words"))
    counted = cut_lineage(counted_items(words, "words", "token", "times").where("token <> ''"), "counts")
    folds = {"n": running(one()), "doc_sum": running("doc_id")}
    return windows.count_window_slide_repeated(counted, ["token"], ["doc_id"], "times", 10, 5, folds)


@report(
    "averages_of_three",
    f"""SELECT user_id, group_no, CAST(sum(k) // 3 AS BIGINT) AS average FROM (
          SELECT user_id, {K} AS k, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 3 AS group_no FROM events)
        GROUP BY 1, 2 HAVING count(*) = 3""",
)
def averages_of_three(t):
    out = windows.count_window(with_k(t), ["user_id"], ORDER, 3, {"total": running("k")})
    return out.select("user_id", "group_no", F.expr("total div 3").alias("average"))


@report(
    "last_rows_per_user",
    """SELECT event_id, user_id FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r <= 5""",
)
def last_rows_per_user(t):
    return windows.evict_count(t("events"), ["user_id"], ORDER, 5).select("event_id", "user_id")


@report(
    "rows_near_last_value",
    """SELECT event_id, e.user_id FROM events e JOIN (SELECT user_id, arg_max(value, (ts, event_id)) AS last FROM events GROUP BY 1) l
       ON e.user_id = l.user_id WHERE last - value < 10""",
)
def rows_near_last_value(t):
    return windows.evict_delta(t("events"), ["user_id"], ORDER, "value", 10.0).select("event_id", "user_id")


@report(
    "rows_of_last_day",
    """SELECT event_id, e.user_id FROM events e JOIN (SELECT user_id, max(ts) AS last FROM events GROUP BY 1) l
       ON e.user_id = l.user_id WHERE ts >= last - INTERVAL '1 day'""",
)
def rows_of_last_day(t):
    return windows.evict_time(t("events"), ["user_id"], "ts", "1 day").select("event_id", "user_id")


@report(
    "positions_in_window",
    """SELECT event_id, window_start, row_number() OVER (PARTITION BY event_type, window_start ORDER BY ts, event_id) AS position
       FROM (SELECT *, time_bucket(INTERVAL '1 day', ts) AS window_start FROM events)""",
)
def positions_in_window(t):
    out = windows.sort_in_window(t("events"), ["event_type"], "ts", "1 day", ORDER)
    return out.select("event_id", "window_start", "position")


@report(
    "top_speed",
    """WITH RECURSIVE e AS MATERIALIZED (SELECT user_id, event_id, ts, value, CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS distance,
                    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
       f(user_id, rn, distance) AS (
         SELECT user_id, rn, distance FROM e WHERE rn = 1
         UNION ALL
         SELECT n.user_id, n.rn, n.distance FROM (
           SELECT e.user_id, e.rn, e.distance, row_number() OVER (PARTITION BY e.user_id ORDER BY e.rn) AS r
           FROM f JOIN e ON e.user_id = f.user_id AND e.rn > f.rn AND e.distance - f.distance > 150) n WHERE n.r = 1)
       SELECT b.user_id, b.event_id, b.top_value, b.top_event FROM (
         SELECT x.user_id, x.event_id, y.value AS top_value, y.event_id AS top_event,
                row_number() OVER (PARTITION BY x.user_id, x.event_id ORDER BY y.value DESC, y.rn) AS r
         FROM f JOIN e x ON x.user_id = f.user_id AND x.rn = f.rn AND f.rn > 1
         JOIN e y ON y.user_id = x.user_id AND y.rn <= x.rn AND y.ts >= x.ts - INTERVAL '12 hours') b WHERE b.r = 1""",
)
def top_speed(t):
    driven = aggs.running_sum(t("events"), ["user_id"], F.col("value").cast("decimal(18,2)"), ORDER, "distance")
    driven = driven.withColumn("distance", F.col("distance").cast("double")).select("user_id", *ORDER, "value", "distance")
    driven = cut_lineage(driven, "driven")
    earliest = [-F.unix_micros(F.col("ts").cast("timestamp")), -F.col("event_id")]
    out = windows.delta_trigger_window(driven, ["user_id"], "ts", ORDER, "distance", 150.0, "12 hours", "value", earliest)
    return out.select("user_id", "event_id", "top_value", F.col("top_row.event_id").alias("top_event"))


ARRIVAL = "event_id + (event_id * 7919) % 101"
LATE = f"""SELECT event_id, ts, w + INTERVAL '10 minutes' AS window_end,
    coalesce(w + INTERVAL '10 minutes' - INTERVAL '1 millisecond' <= max(ts) OVER (ORDER BY {ARRIVAL}, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL '1 hour', false) AS is_late
    FROM (SELECT *, time_bucket(INTERVAL '10 minutes', ts) AS w FROM events)"""


def arriving(t):
    """The events in an order of arrival in which some come much later than others."""
    return t("events").withColumn("arrival", F.expr(ARRIVAL))


@report("late_rows", f"SELECT event_id, window_end FROM ({LATE}) WHERE is_late")
def late_rows(t):
    _, late = watermarks.split_late(arriving(t), "ts", "1 hour", "10 minutes", ["arrival", "event_id"])
    return late.select("event_id", "window_end")


@report("counts_without_late_rows", f"SELECT window_end, count(*) AS cnt FROM ({LATE}) WHERE NOT is_late GROUP BY 1")
def counts_without_late_rows(t):
    on_time, _ = watermarks.split_late(arriving(t), "ts", "1 hour", "10 minutes", ["arrival", "event_id"])
    return aggs.count_rows(on_time, ["window_end"])


@report(
    "marker_watermarks",
    f"""SELECT event_id, max(CASE WHEN event_type = 'signup' THEN ts END) OVER (ORDER BY {ARRIVAL}, event_id ROWS UNBOUNDED PRECEDING) AS watermark
        FROM events""",
)
def marker_watermarks(t):
    marker = F.col("event_type") == "signup"
    out = watermarks.punctuated_watermark(arriving(t), [], ["arrival", "event_id"], marker, "ts")
    return out.select("event_id", "watermark")


@report("rows_within_lag", "SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL '5 days'")
def rows_within_lag(t):
    now = F.expr("TIMESTAMP_NTZ '2024-01-20 00:00:00'")
    return watermarks.drop_older_than(t("events"), "ts", "5 days", now).select("event_id")
