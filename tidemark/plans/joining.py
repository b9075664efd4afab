"""Reports on joins: lookups, windows, intervals, rules, and the chained event-time report."""

from pyspark.sql import functions as F

from tidemark.functions.text import case_map
from tidemark.functions.times import last_millisecond
from tidemark.operators import aggs, joins, routing
from tidemark.operators.over import count_over_range
from tidemark.plans.registry import report
from tidemark.sources.readers import small_rows

# Names of the top-level categories, by parent category id.
CATEGORY_NAMES = {
    0: "服饰鞋包",
    1: "家装家饰",
    2: "家电",
    3: "美妆",
    4: "母婴",
    5: "3C数码",
    6: "运动户外",
    7: "食品",
    8: "医药",
}
OTHER_CATEGORY = "其他"

CATEGORY_CASE = (
    "CASE p_size % 10 "
    + " ".join(f"WHEN {k} THEN '{v}'" for k, v in CATEGORY_NAMES.items())
    + f" ELSE '{OTHER_CATEGORY}' END"
)


@report(
    "category_ranking",
    f"""SELECT {CATEGORY_CASE} AS category_name, count(*) AS buy_cnt
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
)
def category_ranking(t):
    bought = t("lineitem").where("l_returnflag = 'R'").select("l_partkey")
    category = t("part").select("p_partkey", (F.col("p_size") % 10).alias("parent"))
    rich = joins.lookup_join(bought, category, "l_partkey", "p_partkey")
    named = rich.withColumn("category_name", case_map(F.col("parent"), CATEGORY_NAMES, OTHER_CATEGORY))
    return aggs.top_n(named, "category_name", F.count(F.lit(1)), "buy_cnt", 10)


BUILDING = "(SELECT * FROM customer WHERE c_mktsegment = 'BUILDING')"


@report(
    "orders_with_segment",
    f"SELECT o_orderkey, o_custkey, c_mktsegment, c_nationkey FROM orders LEFT JOIN {BUILDING} c ON o_custkey = c_custkey",
)
def orders_with_segment(t):
    segment = t("customer").where("c_mktsegment = 'BUILDING'")
    out = joins.lookup_join(t("orders"), segment, "o_custkey", "c_custkey")
    return out.select("o_orderkey", "o_custkey", "c_mktsegment", "c_nationkey")


@report(
    "orders_of_segment",
    f"SELECT o_orderkey, c_custkey, c_nationkey FROM orders JOIN {BUILDING} c ON o_custkey = c_custkey",
)
def orders_of_segment(t):
    segment = t("customer").where("c_mktsegment = 'BUILDING'")
    out = joins.lookup_join(t("orders"), segment, "o_custkey", "c_custkey", how="inner")
    return out.select("o_orderkey", "c_custkey", "c_nationkey")


@report(
    "orders_and_totals",
    """SELECT o_orderkey, o_totalprice, lines FROM orders,
       (SELECT l_orderkey, count(*) AS lines FROM lineitem GROUP BY 1) l WHERE o_orderkey = l_orderkey AND lines > 4""",
)
def orders_and_totals(t):
    lines = aggs.count_rows(t("lineitem"), ["l_orderkey"], "lines")
    condition = (F.col("o_orderkey") == F.col("l_orderkey")) & (F.col("lines") > 4)
    return joins.comma_join(t("orders"), lines, condition).select("o_orderkey", "o_totalprice", "lines")


def of_type(t, kind: str, prefix: str):
    return t("events").where(F.col("event_type") == kind).select(
        "user_id", F.col("ts").alias(f"{prefix}_ts"), F.col("event_id").alias(f"{prefix}_id")
    )


@report(
    "clicks_with_purchases",
    """SELECT c.user_id, time_bucket(INTERVAL '6 hours', c.ts) AS window_start, c.event_id AS click_id, p.event_id AS buy_id
       FROM events c JOIN events p ON c.user_id = p.user_id AND time_bucket(INTERVAL '6 hours', c.ts) = time_bucket(INTERVAL '6 hours', p.ts)
       WHERE c.event_type = 'click' AND p.event_type = 'purchase'""",
)
def clicks_with_purchases(t):
    out = joins.window_join(of_type(t, "click", "click"), of_type(t, "purchase", "buy"), ["user_id"], "click_ts", "buy_ts", "6 hours")
    return out.select("user_id", F.col("window.start").alias("window_start"), "click_id", "buy_id")


@report(
    "purchases_after_clicks",
    """SELECT p.user_id, p.event_id AS buy_id, c.event_id AS click_id FROM events p JOIN events c ON p.user_id = c.user_id
       WHERE c.event_type = 'click' AND p.event_type = 'purchase' AND p.ts BETWEEN c.ts AND c.ts + INTERVAL '12 hours'""",
)
def purchases_after_clicks(t):
    out = joins.interval_join(
        of_type(t, "purchase", "buy"), of_type(t, "click", "click"), ["user_id"], "buy_ts", "click_ts", "0 seconds", "12 hours"
    )
    return out.select("user_id", "buy_id", "click_id")


# The example rules, over the event types of the test data.
RULES = [("browse", "view", "click"), ("buy", "click", "purchase"), ("repeat", "view", "view"), ("trouble", "error", "signup")]
RULES_SQL = "(VALUES " + ", ".join(str(r) for r in RULES) + ") AS r(rule, first, second)"


def rules(t):
    return small_rows(t.spark, RULES, "rule string, first string, second string")


@report(
    "events_under_rules",
    f"""SELECT rule, event_type, event_type = first AS is_first, event_type = second AS is_second, count(*) AS cnt
        FROM events JOIN {RULES_SQL} ON event_type = first OR event_type = second GROUP BY 1, 2, 3, 4""",
)
def events_under_rules(t):
    joined = joins.rule_join(t("events"), rules(t), "event_type")
    return aggs.count_rows(joined, ["rule", "event_type", "is_first", "is_second"])


@report(
    "chained_windows",
    """WITH o AS (SELECT user_id, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '12 hours' PRECEDING AND CURRENT ROW) AS cnt FROM events),
       w AS (SELECT user_id, CASE CAST(sum(cnt) // count(*) AS BIGINT) WHEN 2 THEN 1 ELSE 0 END AS correct,
                    time_bucket(INTERVAL '1 day', ts) AS w_start, time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' - INTERVAL '1 millisecond' AS rowtime
             FROM o WHERE ts > TIMESTAMP '1970-01-01 00:00:01' GROUP BY user_id, w_start, rowtime),
       j AS (SELECT t2.rowtime, t2.correct FROM events t1 JOIN w t2 ON t1.user_id = t2.user_id
             AND t1.ts BETWEEN t2.rowtime AND t2.rowtime + INTERVAL '1 day')
       SELECT CAST(sum(correct) AS BIGINT) AS correct, time_bucket(INTERVAL '2 days', rowtime, TIMESTAMP '1970-01-01 00:00:00') AS window_start FROM j GROUP BY 2""",
)
def chained_windows(t):
    return chained(t("events"), t("events"), "user_id", "ts", "12 hours", "1 day", "2 days")


def chained(table1, table2, key: str, ts: str, over: str, tumble: str, final: str, expected: int = 2):
    """Counts over a range, windows of them, those joined to a second table, windows again."""
    counted = count_over_range(table1.select(key, ts), [key], ts, over)
    kept = counted.where(F.col(ts) > F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:01'"))
    sums = kept.groupBy(key, F.window(ts, tumble).alias("w")).agg(F.sum("cnt").alias("s"), F.count(F.lit(1)).alias("c"))
    correct = F.when(aggs.int_avg("s", "c") == expected, 1).otherwise(0)
    first = sums.select(key, correct.alias("correct"), last_millisecond(F.col("w.end")).alias("rowtime"))
    joined = joins.interval_join(
        routing.project(table2, [key, ts]), first, [key], ts, "rowtime", "0 seconds", tumble
    )
    out = joined.groupBy(F.window("rowtime", final).alias("w")).agg(F.sum("correct").alias("correct"))
    return out.select("correct", F.col("w.start").alias("window_start"))
