"""Reports run as streams over the same files; each must equal its table form."""

from pyspark.sql import functions as F

from tidemark.functions.text import case_map
from tidemark.operators import aggs, joins, watermarks
from tidemark.operators.routing import split_by_rules, union_all
from tidemark.plans.aggregates import K
from tidemark.plans.capture import keyed_changes, order_changes
from tidemark.plans.joining import CATEGORY_NAMES, OTHER_CATEGORY, rules
from tidemark.plans.keyed import ALERTS_SQL, CONSECUTIVE_SQL, MATCHES_SQL, TRANSITIONS, pairs
from tidemark.plans.registry import SQL, Tables, report
from tidemark.plans.windowing import ARRIVAL
from tidemark.runtime import fresh_dir, state_store
from tidemark.sinks import batches, merges
from tidemark.sources.codecs import decode_json
from tidemark.sources.readers import CachedDimension
from tidemark.streaming import processors as ps
from tidemark.streaming import runs

ORDER = ["ts", "event_id"]


def events(t: Tables):
    return runs.event_time(t.stream("events"))


def keyed_events(t: Tables, *columns: str, order=None):
    state_store(t.spark)
    return t.stream("events", order=order).select("user_id", *columns)


@report("streamed_hourly_purchases", SQL["hourly_purchases"])
def streamed_hourly_purchases(t):
    counted = aggs.hourly_count(
        watermarks.watermark(events(t), "ts", "5 seconds"), "ts", F.col("event_type") == "purchase", "buy_cnt"
    )
    return runs.zone_less(runs.upsert_to_table(counted, ["window_start"]), "window_start").select(
        "window_start", "hour_of_day", "buy_cnt"
    )


@report("streamed_top_users", SQL["top_users"])
def streamed_top_users(t):
    return runs.complete_to_table(aggs.top_n(t.stream("events"), "user_id", F.count(F.lit(1)), "cnt", 10))


@report("streamed_running_totals", f"SELECT user_id, CAST(sum({K}) AS BIGINT) AS total FROM events GROUP BY 1")
def streamed_running_totals(t):
    totals = aggs.running_sum(decode_json(t.stream("events"), "props", "k long"), ["user_id"], F.col("k"), [])
    return runs.upsert_to_table(totals, ["user_id"])


@report("streamed_totals_per_row", SQL["running_totals"])
def streamed_totals_per_row(t):
    rows = decode_json(keyed_events(t, *ORDER, "props"), "props", "k long")
    out = ps.keyed(rows, ["user_id"], ps.RunningTotal(ORDER, "k"), ps.widened(rows, total="long"))
    return runs.append_to_table(out.select("event_id", "user_id", "total"))


@report("streamed_recent_counts", SQL["recent_event_counts"])
def streamed_recent_counts(t):
    rows = keyed_events(t, *ORDER)
    out = ps.keyed(rows, ["user_id"], ps.RangeCount(ORDER, "ts", "12 hours"), ps.widened(rows, cnt="long"))
    return runs.append_to_table(out.select("event_id", "user_id", "cnt"))


@report(
    "streamed_count_windows",
    f"""SELECT user_id, at_row, n, CAST(total AS BIGINT) AS total FROM (
          SELECT user_id, rn AS at_row, count(*) OVER f AS n, sum(k) OVER f AS total
          FROM (SELECT user_id, {K} AS k, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
          WINDOW f AS (PARTITION BY user_id ORDER BY rn ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) WHERE at_row % 5 = 0""",
)
def streamed_count_windows(t):
    rows = decode_json(keyed_events(t, *ORDER, "props"), "props", "k long")
    schema = "user_id long, at_row long, n long, total long"
    return runs.append_to_table(ps.keyed(rows, ["user_id"], ps.SlidingCountWindow(ORDER, "k", 10, 5), schema))


@report(
    "streamed_averages",
    f"""SELECT user_id, CAST(sum(k) // 3 AS BIGINT) AS average FROM (
          SELECT user_id, {K} AS k, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 3 AS g FROM events)
        GROUP BY user_id, g HAVING count(*) = 3""",
)
def streamed_averages(t):
    rows = decode_json(keyed_events(t, *ORDER, "props"), "props", "k long")
    return runs.append_to_table(ps.keyed(rows, ["user_id"], ps.CountAverage(ORDER, "k", 3), "user_id long, average long"))


@report("streamed_alerts", ALERTS_SQL)
def streamed_alerts(t):
    rows = keyed_events(t, *ORDER, "event_type")
    out = ps.keyed(rows, ["user_id"], ps.MachineAlerts(ORDER, "event_type", TRANSITIONS), ps.widened(rows, state="string"))
    return runs.append_to_table(out.select("user_id", "event_id", "event_type", "state"))


@report("streamed_consecutive_actions", CONSECUTIVE_SQL)
def streamed_consecutive_actions(t):
    rows = keyed_events(t, *ORDER, "event_type")
    seen = ps.keyed(rows, ["user_id"], ps.PreviousAction(ORDER, "event_type"), ps.widened(rows, previous="string"))
    wanted = pairs(t)
    hits = seen.join(wanted, (seen["previous"] == wanted["first"]) & (seen["event_type"] == wanted["second"]))
    return runs.append_to_table(hits.select("user_id", "event_id", "first", "second"))


@report("streamed_rule_matches", MATCHES_SQL)
def streamed_rule_matches(t):
    tagged = joins.rule_join(keyed_events(t, "event_id", "event_type", order=("event_id",)), rules(t), "event_type")
    matcher = ps.SequenceMatch(["event_id"], "event_id").keyed_by("user_id", "rule")
    schema = "user_id long, rule string, first_id long, second_id long"
    return runs.append_to_table(ps.keyed(tagged, ["user_id", "rule"], matcher, schema))


@report("streamed_top_speed", SQL["top_speed"])
def streamed_top_speed(t):
    cents = F.round(F.col("value") * 100).cast("long")
    rows = keyed_events(t, *ORDER, "value").withColumn("cents", cents)
    driven = ps.keyed(rows, ["user_id"], ps.RunningTotal(ORDER, "cents", "distance"), ps.widened(rows, distance="long"))
    driven = driven.withColumn("distance", F.col("distance") / 100).drop("cents")
    trigger = ps.DeltaTrigger(ORDER, "ts", "distance", 150.0, "12 hours", "value", "event_id")
    schema = ps.widened(driven, top_best="double", top_item="long")
    out = ps.keyed(driven, ["user_id"], trigger, schema)
    return runs.append_to_table(
        out.select("user_id", "event_id", F.col("top_best").alias("top_value"), F.col("top_item").alias("top_event"))
    )


@report("streamed_category_ranking", SQL["category_ranking"])
def streamed_category_ranking(t):
    bought = t.stream("lineitem").where("l_returnflag = 'R'").select("l_partkey")
    category = t("part").select("p_partkey", (F.col("p_size") % 10).alias("parent"))
    rich = joins.lookup_join(bought, category, "l_partkey", "p_partkey")
    named = rich.withColumn("category_name", case_map(F.col("parent"), CATEGORY_NAMES, OTHER_CATEGORY))
    return runs.complete_to_table(aggs.top_n(named, "category_name", F.count(F.lit(1)), "buy_cnt", 10))


@report("streamed_orders_with_segment", SQL["orders_with_segment"])
def streamed_orders_with_segment(t):
    segment = t("customer").where("c_mktsegment = 'BUILDING'")
    out = joins.lookup_join(t.stream("orders"), segment, "o_custkey", "c_custkey")
    return runs.append_to_table(out.select("o_orderkey", "o_custkey", "c_mktsegment", "c_nationkey"))


def of_type(t, kind: str, prefix: str):
    rows = events(t).where(F.col("event_type") == kind)
    named = rows.select("user_id", F.col("ts").alias(f"{prefix}_ts"), F.col("event_id").alias(f"{prefix}_id"))
    return watermarks.watermark(named, f"{prefix}_ts", "1 hour")


@report("streamed_clicks_with_purchases", SQL["clicks_with_purchases"])
def streamed_clicks_with_purchases(t):
    out = joins.window_join(of_type(t, "click", "click"), of_type(t, "purchase", "buy"), ["user_id"], "click_ts", "buy_ts", "6 hours")
    rows = runs.append_to_table(out.select("user_id", F.col("window.start").alias("window_start"), "click_id", "buy_id"))
    return runs.zone_less(rows, "window_start")


@report("streamed_purchases_after_clicks", SQL["purchases_after_clicks"])
def streamed_purchases_after_clicks(t):
    out = joins.interval_join(
        of_type(t, "purchase", "buy"), of_type(t, "click", "click"), ["user_id"], "buy_ts", "click_ts", "0 seconds", "12 hours"
    )
    return runs.append_to_table(out.select("user_id", "buy_id", "click_id"))


@report("streamed_distinct_actions", SQL["distinct_actions"])
def streamed_distinct_actions(t):
    return runs.append_to_table(t.stream("events").select("user_id", "event_type").dropDuplicates())


@report(
    "streamed_visitors",
    """SELECT time_bucket(INTERVAL '6 hours', ts) + INTERVAL '6 hours' AS window_end, count(DISTINCT user_id) AS uv FROM events GROUP BY 1""",
)
def streamed_visitors(t):
    first = runs.distinct_per_window(events(t), "ts", "user_id", "6 hours", "1 hour")
    return runs.zone_less(runs.count_first_rows(runs.append_to_table(first)), "window_end")


@report("streamed_late_rows", SQL["late_rows"])
def streamed_late_rows(t):
    path = fresh_dir(t.spark, "late")
    arriving = t.stream("events", order=(F.expr(ARRIVAL), "event_id")).withColumn("arrival", F.expr(ARRIVAL))
    runs.drain(arriving, runs.late_rows_sink(path, "ts", "1 hour", "10 minutes", ["arrival", "event_id"]))
    _, late = runs.read_late_rows(t.spark, path)
    return late.select("event_id", "window_end")


@report("streamed_exactly_once", "SELECT o_orderkey, o_totalprice FROM orders")
def streamed_exactly_once(t):
    path, commits = fresh_dir(t.spark, "rows"), fresh_dir(t.spark, "commits")
    runs.drain(t.stream("orders").select("o_orderkey", "o_totalprice"), batches.exactly_once_sink(path, commits, "orders"))
    return batches.read_committed(t.spark, path, commits, "orders")


@report(
    "streamed_split",
    "SELECT 'even' AS output, event_id FROM events WHERE event_id % 2 = 0 UNION ALL SELECT 'odd', event_id FROM events WHERE event_id % 2 = 1",
)
def streamed_split(t):
    """Two outputs of one stream; each batch is computed once."""
    paths = {name: fresh_dir(t.spark, name) for name in ("even", "odd")}
    halves = {"even": F.expr("event_id % 2 = 0"), "odd": F.expr("event_id % 2 = 1")}

    def part(name):
        return lambda batch, batch_id: split_by_rules(batch, halves)[name].write.mode("overwrite").parquet(
            f"{paths[name]}/batch_id={batch_id}"
        )

    runs.drain(t.stream("events").select("event_id"), batches.several(part("even"), part("odd")))
    parts = [t.spark.read.parquet(p).select(F.lit(n).alias("output"), "event_id") for n, p in paths.items()]
    return parts[0].unionByName(parts[1])


@report("streamed_window_sums", SQL["window_sums"])
def streamed_window_sums(t):
    rows = watermarks.watermark(decode_json(events(t), "props", "k long"), "ts", "1 hour")
    sums = aggs.global_window_agg(rows, "ts", "1 day", {"total": F.sum("k"), "highest": F.max("k")})
    return runs.zone_less(runs.upsert_to_table(sums, ["window_start"]), "window_start", "window_end")


@report(
    "streamed_sessions",
    """WITH g AS (SELECT *, CASE WHEN ts > lag(ts) OVER w + INTERVAL '3 hours' THEN 1 ELSE 0 END AS opens
                  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
       s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g)
       SELECT user_id, min(ts) AS session_start, count(*) AS cnt FROM s GROUP BY user_id, session""",
)
def streamed_sessions(t):
    """Sessions still open when the input ends are not part of a stream's output; complete mode shows all."""
    grouped = events(t).groupBy("user_id", F.session_window("ts", "3 hours").alias("w")).agg(F.count(F.lit(1)).alias("cnt"))
    shown = runs.complete_to_table(grouped.select("user_id", F.col("w.start").alias("session_start"), "cnt"))
    return runs.zone_less(shown, "session_start")


@report("streamed_union", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O')")
def streamed_union(t):
    """Two streams of one table as one."""
    orders = t.stream("orders").select("o_orderkey", "o_orderstatus")
    return runs.append_to_table(union_all(orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus = 'O'")))


@report(
    "streamed_ascending_counts",
    "SELECT date_trunc('hour', ts) AS window_start, count(*) AS cnt FROM events GROUP BY 1",
)
def streamed_ascending_counts(t):
    """Event times that never go back need no delay; late hours revise their row."""
    rows = watermarks.watermark(events(t), "ts", "0 seconds")
    counts = rows.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("cnt"))
    return runs.zone_less(runs.upsert_to_table(counts.select(F.col("w.start").alias("window_start"), "cnt"), ["window_start"]), "window_start")


@report(
    "streamed_sliding_pv_uv",
    """SELECT time_bucket(INTERVAL '2 hours', ts) + INTERVAL '2 hours' * (k + 1) AS window_end, count(*) AS pv, count(DISTINCT user_id) AS uv
       FROM events, range(3) r(k) GROUP BY 1""",
)
def streamed_sliding_pv_uv(t):
    """Rows and distinct users of six hours, every two hours: state has a count per window and user, which leaves it with the window."""
    rows = watermarks.watermark(events(t), "ts", "1 hour")
    seen = rows.groupBy(F.window("ts", "6 hours", "2 hours").alias("window"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    kept = runs.upsert_to_table(seen.select(F.col("window.end").alias("window_end"), "user_id", "n"), ["window_end", "user_id"])
    counted = kept.groupBy("window_end").agg(F.sum("n").alias("pv"), F.count("user_id").alias("uv"))
    return runs.zone_less(counted, "window_end")


@report(
    "streamed_lookup_per_batch",
    "SELECT o_orderkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'",
)
def streamed_lookup_per_batch(t):
    """The dimension is read again for each batch."""
    path = fresh_dir(t.spark, "lookups")
    sink = runs.lookup_per_batch(
        lambda: t("customer").where("c_mktsegment = 'BUILDING'"),
        lambda batch, dimension: joins.lookup_join(batch, dimension, "o_custkey", "c_custkey", "inner").select("o_orderkey", "c_mktsegment"),
        batches.upsert_sink(path, ["o_orderkey"]),
    )
    runs.drain(t.stream("orders"), sink)
    return batches.read_upserted(t.spark, path, ["o_orderkey"])


# Every second customer moves once; the orders before and after see different segments.
VERSIONS_SQL = """(SELECT *, lead(valid_from) OVER (PARTITION BY c_custkey ORDER BY valid_from) AS valid_to FROM (
      SELECT c_custkey, c_mktsegment AS segment, TIMESTAMP '1900-01-01' AS valid_from FROM customer
      UNION ALL SELECT c_custkey, 'moved to ' || c_nationkey, TIMESTAMP '1995-01-01' + INTERVAL 1 DAY * (c_custkey % 500) FROM customer WHERE c_custkey % 2 = 0))"""
AS_OF_SQL = f"""SELECT o_orderkey, o_custkey, segment FROM orders
    LEFT JOIN {VERSIONS_SQL} ON o_custkey = c_custkey AND o_orderdate >= valid_from AND (valid_to IS NULL OR o_orderdate < valid_to)"""


def customer_versions(t):
    customers = t("customer")
    first = customers.select("c_custkey", F.col("c_mktsegment").alias("segment"), F.expr("TIMESTAMP_NTZ '1900-01-01 00:00:00'").alias("valid_from"))
    moved = customers.where("c_custkey % 2 = 0").select(
        "c_custkey", F.concat(F.lit("moved to "), F.col("c_nationkey").cast("string")).alias("segment"),
        F.expr("TIMESTAMP_NTZ '1995-01-01 00:00:00' + make_dt_interval(CAST(c_custkey % 500 AS INT))").alias("valid_from"),
    )
    return joins.with_validity(first.unionByName(moved), ["c_custkey"], "valid_from")


@report("orders_with_segment_of_their_time", AS_OF_SQL)
def orders_with_segment_of_their_time(t):
    return joins.as_of_join(t("orders"), customer_versions(t), "o_custkey", "c_custkey", "o_orderdate").select("o_orderkey", "o_custkey", "segment")


@report("streamed_orders_with_segment_of_their_time", AS_OF_SQL)
def streamed_orders_with_segment_of_their_time(t):
    """The dimension with its versions is kept for ten minutes and then read again; each batch sees one state of it."""
    path, dimension = fresh_dir(t.spark, "as-of"), CachedDimension(lambda: customer_versions(t), ttl_seconds=600)

    def join(batch, versions):
        return joins.as_of_join(batch, versions, "o_custkey", "c_custkey", "o_orderdate").select("o_orderkey", "o_custkey", "segment")

    runs.drain(t.stream("orders"), runs.lookup_per_batch(dimension.current, join, batches.upsert_sink(path, ["o_orderkey"])))
    return batches.read_upserted(t.spark, path, ["o_orderkey"])


@report("streamed_materialized_orders", SQL["materialized_orders"])
def streamed_materialized_orders(t):
    """Reads, updates and deletes merged by key from batch to batch; the table is compacted once and read behind the pointer."""
    path = fresh_dir(t.spark, "merged")
    keyed = keyed_changes(order_changes(t.stream("orders"))).withColumn("gone", F.col("type") == "delete").select("o_orderkey", "step", "gone", "after")
    runs.drain(keyed, merges.merge_changes_sink(path, ["o_orderkey"], ["step"], F.col("gone")))
    merges.compact_merged(t.spark, path, ["o_orderkey"], ["step"])
    current = merges.read_merged(t.spark, path, ["o_orderkey"], ["step"])
    return current.select("o_orderkey", F.try_element_at("after", F.lit("o_orderstatus")).alias("status"))
