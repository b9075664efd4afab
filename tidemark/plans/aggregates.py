"""Reports on grouped, distinct, running and ranked aggregates."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.functions.text import text_bar
from tidemark.operators import aggs, patterns, routing, windows
from tidemark.operators.history import lowest, running
from tidemark.operators.over import agg_over_rows, count_over_range, window_rank
from tidemark.plans.registry import Tables, report
from tidemark.sources.codecs import decode_json, encode_json



def one():
    return F.lit(1).cast("long")


def cents(column: str):
    return F.col(column).cast("decimal(18,2)")


def with_k(t: Tables):
    return decode_json(t("events"), "props", "k long")


K = "CAST(regexp_extract(props, '[0-9]+') AS BIGINT)"


@report(
    "hourly_purchases",
    """SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
              CAST(hour(time_bucket(INTERVAL '1 hour', ts)) AS INTEGER) AS hour_of_day, count(*) AS buy_cnt
       FROM events WHERE event_type = 'purchase' GROUP BY 1, 2""",
)
def hourly_purchases(t):
    return aggs.hourly_count(t("events"), "ts", F.col("event_type") == "purchase", "buy_cnt")


@report(
    "distinct_users_by_type",
    "SELECT event_type, count(DISTINCT user_id) AS uv FROM events GROUP BY 1",
)
def distinct_users_by_type(t):
    return aggs.count_distinct(t("events"), ["event_type"], "user_id")


@report(
    "sliding_pv_uv",
    """SELECT w AS window_start, w + INTERVAL '1 hour' AS window_end, count(*) AS pv, count(DISTINCT user_id) AS uv
       FROM (SELECT user_id, time_bucket(INTERVAL '10 minutes', ts) - to_minutes(CAST(10 * i AS BIGINT)) AS w
             FROM events, range(6) r(i)) GROUP BY 1, 2""",
)
def sliding_pv_uv(t):
    out = aggs.pv_uv(t("events"), "ts", "user_id", "1 hour", "10 minutes")
    return out


@report(
    "tumbling_pv_uv",
    """SELECT time_bucket(INTERVAL '6 hours', ts) AS window_start,
              time_bucket(INTERVAL '6 hours', ts) + INTERVAL '6 hours' AS window_end,
              count(*) AS pv, count(DISTINCT user_id) AS uv FROM events GROUP BY 1, 2""",
)
def tumbling_pv_uv(t):
    return aggs.pv_uv(t("events"), "ts", "user_id", "6 hours")


@report(
    "cumulative_uv",
    """WITH v AS (SELECT strftime(ts, '%Y-%m-%d') AS date_str, left(strftime(ts, '%H:%M'), 4) || '0' AS time_str, user_id FROM events),
       f AS (SELECT date_str, user_id, min(time_str) AS first FROM v GROUP BY 1, 2)
       SELECT b.date_str, b.time_str, count(f.user_id) AS uv
       FROM (SELECT DISTINCT date_str, time_str FROM v) b JOIN f ON f.date_str = b.date_str AND f.first <= b.time_str
       GROUP BY 1, 2""",
)
def cumulative_uv(t):
    return aggs.cumulative_uv(t("events"), "ts", "user_id")


@report(
    "top_users",
    "SELECT user_id, count(*) AS cnt FROM events GROUP BY 1 ORDER BY cnt DESC, user_id LIMIT 10",
)
def top_users(t):
    return aggs.top_n(t("events"), "user_id", F.count(F.lit(1)), "cnt", 10)


@report(
    "daily_top_users",
    """SELECT window_start, user_id, cnt, CAST(rank AS INTEGER) AS rank FROM (
         SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, user_id) AS rank FROM (
           SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, user_id, count(*) AS cnt FROM events GROUP BY 1, 2))
       WHERE rank <= 3""",
)
def daily_top_users(t):
    counts = windows.window_bounds(windows.tumble(t("events"), "ts", "1 day")).groupBy("window_start", "user_id")
    return window_rank(counts.agg(F.count(F.lit(1)).alias("cnt")), ["window_start"], "cnt", ["user_id"], 3)


@report(
    "top_row_per_user",
    """SELECT user_id, event_id, ts, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, ts, event_id) AS r FROM events) WHERE r = 1""",
)
def top_row_per_user(t):
    return aggs.max_by_row(t("events").drop("props"), ["user_id"], "value", ["ts", "event_id"])


@report(
    "sliding_sums_by_type",
    f"""SELECT event_type, w AS window_start, w + INTERVAL '2 hours' AS window_end, count(*) AS cnt, CAST(sum(k) AS BIGINT) AS total, min(k) AS lowest
        FROM (SELECT event_type, {K} AS k, time_bucket(INTERVAL '30 minutes', ts) - to_minutes(CAST(30 * i AS BIGINT)) AS w
              FROM events, range(4) r(i)) GROUP BY 1, 2, 3""",
)
def sliding_sums_by_type(t):
    folds = {"cnt": running(one()), "total": running("k"), "lowest": lowest("k")}
    return windows.hop_agg(with_k(t), "ts", "30 minutes", "2 hours", folds, ["event_type"])


@report(
    "window_sums",
    f"""SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end,
               CAST(sum({K}) AS BIGINT) AS total, max({K}) AS highest FROM events GROUP BY 1, 2""",
)
def window_sums(t):
    return aggs.global_window_agg(with_k(t), "ts", "1 day", {"total": F.sum("k"), "highest": F.max("k")})


@report(
    "window_summary",
    """SELECT user_id, count(*) AS cnt, min(ts) AS first_ts, max(ts) AS last_ts,
              time_bucket(INTERVAL '6 hours', ts) AS window_start,
              time_bucket(INTERVAL '6 hours', ts) + INTERVAL '6 hours' AS window_end
       FROM events GROUP BY 1, 5, 6""",
)
def window_summary(t):
    return aggs.window_summary(t("events"), ["user_id"], "ts", "6 hours")


@report(
    "longest_pauses",
    """SELECT user_id, window_start, count(*) AS cnt, max(pause) AS longest_us FROM (
         SELECT user_id, time_bucket(INTERVAL '1 day', ts) AS window_start,
                coalesce(date_diff('microsecond', lag(ts) OVER (PARTITION BY user_id, time_bucket(INTERVAL '1 day', ts) ORDER BY ts), ts), 0) AS pause FROM events)
       GROUP BY 1, 2""",
)
def longest_pauses(t):
    """The longest time without an event of a user's day, by a function over the sorted times."""

    def pauses(key, rows):
        times = rows.column("ts").to_numpy(zero_copy_only=False).astype("datetime64[us]").astype("int64")
        longest = int(np.diff(times).max()) if len(times) > 1 else 0
        return [(key[0], key[1], len(times), longest)]

    schema = "user_id long, window_start timestamp_ntz, cnt long, longest_us long"
    return aggs.apply_window(t("events"), ["user_id"], "ts", "1 day", pauses, schema, batched=True)


@report(
    "integer_average",
    "SELECT l_returnflag, CAST(sum(l_linenumber) // count(*) AS BIGINT) AS average FROM lineitem GROUP BY 1",
)
def integer_average(t):
    sums = t("lineitem").groupBy("l_returnflag").agg(F.sum("l_linenumber").alias("s"), F.count(F.lit(1)).alias("c"))
    return sums.select("l_returnflag", aggs.int_avg("s", "c").alias("average"))


@report(
    "first_row_with_sum",
    f"""SELECT user_id, arg_min(event_type, (ts, event_id)) AS event_type, CAST(sum({K}) AS BIGINT) AS k FROM events GROUP BY 1""",
)
def first_row_with_sum(t):
    return aggs.carry_first(with_k(t), ["user_id"], "k", ["event_type"], ["ts", "event_id"])


@report(
    "rounded_sums",
    """SELECT l_returnflag, CAST(round(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(6,2)) * CAST(l_tax AS DECIMAL(6,2))), 2) AS DOUBLE) AS price_total
       FROM lineitem GROUP BY 1 ORDER BY 2 DESC""",
)
def rounded_sums(t):
    product = F.col("l_extendedprice").cast("decimal(12,2)") * F.col("l_discount").cast("decimal(6,2)") * F.col("l_tax").cast("decimal(6,2)")
    out = aggs.sum_rounded_desc(t("lineitem"), "l_returnflag", product, "price_total")
    return out.withColumn("price_total", F.col("price_total").cast("double"))


@report(
    "sums_of_window_sums",
    f"""SELECT time_bucket(INTERVAL '6 hours', rowtime) AS window_start, time_bucket(INTERVAL '6 hours', rowtime) + INTERVAL '6 hours' AS window_end,
               CAST(sum(part) AS BIGINT) AS total, count(*) AS parts
        FROM (SELECT time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' - INTERVAL '1 millisecond' AS rowtime, sum({K}) AS part
              FROM events GROUP BY 1) GROUP BY 1, 2""",
)
def sums_of_window_sums(t):
    return aggs.window_sum_of_sums(with_k(t), "ts", F.col("k"), "1 hour", "6 hours", "total")


@report(
    "running_totals",
    f"""SELECT event_id, user_id, CAST(sum({K}) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM events""",
)
def running_totals(t):
    out = aggs.running_sum(with_k(t), ["user_id"], F.col("k"), ["ts", "event_id"])
    return out.select("event_id", "user_id", "total")


@report(
    "running_text_length",
    """SELECT conv_id, turn, CAST(sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total_length
       FROM conversations""",
)
def running_text_length(t):
    out = patterns.running_length(t("conversations"), ["conv_id"], "text", ["turn", "role", "text"])
    return out.select("conv_id", "turn", "total_length")


@report(
    "recent_event_counts",
    """SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '12 hours' PRECEDING AND CURRENT ROW) AS cnt
       FROM events""",
)
def recent_event_counts(t):
    return count_over_range(t("events"), ["user_id"], "ts", "12 hours").select("event_id", "user_id", "cnt")


@report(
    "moving_sums",
    f"""SELECT event_id, CAST(sum({K}) OVER w AS BIGINT) AS total, max({K}) OVER w AS highest FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
)
def moving_sums(t):
    out = agg_over_rows(with_k(t), ["user_id"], ["ts", "event_id"], 4, {"total": F.sum("k"), "highest": F.max("k")})
    return out.select("event_id", "total", "highest")


@report(
    "day_over_day",
    """WITH d AS (SELECT event_type, user_id, CAST(ts AS DATE) AS day, count(*) AS today FROM events GROUP BY 1, 2, 3)
       SELECT a.event_type, a.user_id, a.day, a.today, b.today AS previous_day
       FROM d a LEFT JOIN d b ON a.event_type = b.event_type AND a.user_id = b.user_id AND b.day = a.day - 1""",
)
def day_over_day(t):
    return patterns.compare_with_previous_day(t("events"), ["event_type", "user_id"], "ts", F.count(F.lit(1)))


@report(
    "rows_per_partition",
    "SELECT CAST(user_id % 8 AS INTEGER) AS partition, count(*) AS cnt FROM events GROUP BY 1",
)
def rows_per_partition(t):
    where = F.pmod("user_id", F.lit(8)).cast("int")
    return patterns.count_per_key_and_partition(t("events"), "user_id", where)[1]


@report("rows_per_key", "SELECT user_id, count(*) AS cnt FROM events GROUP BY 1")
def rows_per_key(t):
    return patterns.count_per_key_and_partition(t("events"), "user_id")[0]


@report(
    "rows_per_customer_having",
    "SELECT o_custkey, count(*) AS orders, max(o_orderdate) AS latest FROM orders GROUP BY 1 HAVING count(*) >= 12",
)
def rows_per_customer_having(t):
    wanted = {"orders": F.count(F.lit(1)), "latest": F.max("o_orderdate")}
    return routing.having(t("orders"), ["o_custkey"], wanted, "orders >= 12")


@report(
    "overall_totals",
    """SELECT count(*) AS orders, count(DISTINCT o_custkey) AS customers, max(o_totalprice) AS highest,
              CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders""",
)
def overall_totals(t):
    return routing.to_global(
        t("orders"),
        {
            "orders": F.count(F.lit(1)),
            "customers": F.countDistinct("o_custkey"),
            "highest": F.max("o_totalprice"),
            "total": F.sum(cents("o_totalprice")).cast("double"),
        },
    )


@report(
    "daily_bars",
    """WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS cnt FROM events GROUP BY 1)
       SELECT day, cnt, repeat('█', CAST(floor(cnt * 40.0 / (SELECT max(cnt) FROM d)) AS INTEGER)) AS bar FROM d""",
)
def daily_bars(t):
    days = t("events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("cnt"))
    highest = days.agg(F.max("cnt").alias("highest")).scalar()
    return days.withColumn("bar", text_bar(F.col("cnt"), 0, highest, 40))


@report(
    "json_fields",
    f"SELECT event_id, {K} AS k FROM events",
)
def json_fields(t):
    return with_k(t).select("event_id", "k")


@report(
    "json_documents",
    """SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS value FROM events""",
)
def json_documents(t):
    return encode_json(t("events"), columns=["event_id", "user_id", "event_type"])
