"""Reports on streams with control rows, event-time timers and chained stages; each equals SQL over the whole table."""

from pyspark.sql import functions as F

from tidemark.operators import aggs, patterns, watermarks
from tidemark.plans.aggregates import K
from tidemark.plans.registry import SQL, report
from tidemark.plans.windowing import ARRIVAL
from tidemark.runtime import state_store
from tidemark.sources.codecs import decode_json
from tidemark.streaming import controls, event_time, runs, triggers
from tidemark.streaming import processors as ps

ORDER = ["ts", "event_id"]

# Every hundredth event also changes a rule: its type becomes the first element, the type below the second one.
FOLLOWS = "CASE event_type WHEN 'view' THEN 'click' WHEN 'click' THEN 'purchase' WHEN 'purchase' THEN 'view' WHEN 'signup' THEN 'view' ELSE 'click' END"

CHANGING_SQL = f"""WITH e AS (SELECT event_id, user_id, event_type, row_number() OVER (ORDER BY ts, event_id) AS pos FROM events),
   c AS (SELECT pos, 'r' || ((event_id // 100) % 3) AS rule, event_type AS first, {FOLLOWS} AS second FROM e WHERE event_id % 100 = 0),
   v AS (SELECT *, lead(pos) OVER (PARTITION BY rule ORDER BY pos) AS until FROM c),
   t AS (SELECT rule, user_id, event_id, e.pos, event_type = first AS is_first, event_type = second AS is_second FROM e JOIN v
         ON (event_type = first OR event_type = second) AND e.pos >= v.pos AND (until IS NULL OR e.pos < until)),
   m AS (SELECT rule, user_id, event_id AS first_id, is_first,
                min(CASE WHEN is_second THEN pos END) OVER (PARTITION BY rule, user_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_pos FROM t)
   SELECT rule, m.user_id, first_id, e.event_id AS second_id FROM m JOIN e ON e.pos = next_pos WHERE is_first"""


def rule_changes(events):
    changing = events.where("event_id % 100 = 0")
    name = F.concat(F.lit("r"), F.expr("(event_id div 100) % 3").cast("string"))
    return changing.select(*ORDER, name.alias("rule"), F.col("event_type").alias("first"), F.expr(FOLLOWS).alias("second"))


@report("changing_rules", CHANGING_SQL)
def changing_rules(t):
    items = t("events").select("user_id", "event_type", *ORDER)
    out = patterns.changing_rule_match(items, rule_changes(t("events")), ["user_id"], ORDER, "event_type")
    return out.select("rule", "user_id", F.col("event_id").alias("first_id"), F.col("matched.event_id").alias("second_id"))


@report("streamed_changing_rules", CHANGING_SQL)
def streamed_changing_rules(t):
    state_store(t.spark)
    events = t.stream("events")
    both = controls.with_control(events.select("user_id", "event_type", *ORDER), rule_changes(events), "user_id")
    processor = controls.ChangingRules(ORDER, "user_id", "event_type", "event_id")
    found = runs.append_to_table(controls.controlled(both, processor, processor.SCHEMA))
    return found.select("rule", F.col("key").cast("long").alias("user_id"), "first_id", "second_id")


@report(
    "streamed_totals_since_reset",
    f"""WITH e AS (SELECT event_id, user_id, ts, {K} AS k, count(*) FILTER (event_id % 250 = 0) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS epoch FROM events)
        SELECT event_id, user_id, CAST(sum(k) OVER (PARTITION BY user_id, epoch ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM e""",
)
def streamed_totals_since_reset(t):
    """Every 250th event clears the totals of all users."""
    state_store(t.spark)
    events = decode_json(t.stream("events"), "props", "k long")
    both = controls.with_control(events.select("user_id", "k", *ORDER), events.where("event_id % 250 = 0").select(*ORDER), "user_id")
    schema = ps.widened(both.drop("is_control"), total="long")
    out = runs.append_to_table(controls.controlled(both, controls.TotalsSinceReset(ORDER, "user_id", "k"), schema))
    return out.select("event_id", F.col("user_id").cast("long").alias("user_id"), "total")


@report(
    "streamed_marker_watermarks",
    f"""SELECT event_id, watermark, coalesce(ts < watermark, false) AS is_late FROM (
          SELECT event_id, ts, max(CASE WHEN event_type = 'signup' THEN ts END) OVER (ORDER BY {ARRIVAL}, event_id ROWS UNBOUNDED PRECEDING) AS watermark FROM events)""",
)
def streamed_marker_watermarks(t):
    """Sign-ups carry the watermark, in the order of arrival; rows of all users see it."""
    state_store(t.spark)
    order = ["arrival", "event_id"]
    arriving = t.stream("events", order=(F.expr(ARRIVAL), "event_id")).withColumn("arrival", F.expr(ARRIVAL)).select("user_id", "ts", "event_type", *order)
    markers = arriving.where("event_type = 'signup'").select("ts", *order)
    both = controls.with_control(arriving.drop("event_type"), markers, "user_id")
    schema = ps.widened(both.drop("is_control"), watermark="timestamp_ntz", is_late="boolean")
    return runs.append_to_table(controls.controlled(both, controls.MarkedTime(order, "ts"), schema)).select("event_id", "watermark", "is_late")


@report(
    "streamed_closed_sessions",
    f"""WITH g AS (SELECT *, {K} AS k, CASE WHEN ts > lag(ts) OVER w + INTERVAL '3 hours' THEN 1 ELSE 0 END AS opens
                   FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
        s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g)
        SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '3 hours' AS session_end, count(*) AS cnt, CAST(sum(k) AS BIGINT) AS total
        FROM s GROUP BY user_id, session""",
)
def streamed_closed_sessions(t):
    state_store(t.spark)
    rows = decode_json(runs.closed(runs.event_time(t.stream("events", closing="ts")), "ts", "1 hour"), "props", "k long")
    out = event_time.closing_sessions(rows, "user_id", "ts", "3 hours", "k")
    return runs.zone_less(runs.append_to_table(out), "session_start", "session_end")


@report("streamed_cumulative_uv", SQL["cumulative_uv"])
def streamed_cumulative_uv(t):
    state_store(t.spark)
    rows = watermarks.watermark(runs.event_time(t.stream("events")), "ts", "1 day")
    changed = event_time.first_labels(rows, "ts", "user_id", parts=8)
    return event_time.cumulated(runs.upsert_to_table(changed, ["date_str", "part", "time_str"]))


@report("streamed_chained_windows", SQL["chained_windows"])
def streamed_chained_windows(t):
    """Counts over twelve hours, days of them, the rows of the day after, and two days of these."""
    state_store(t.spark)

    def events():
        return runs.closed(runs.event_time(t.stream("events", closing="ts")), "ts", "1 hour").select("user_id", *ORDER)

    rows = events().where("ts > TIMESTAMP '1970-01-01 00:00:01'")
    counted = ps.keyed(rows, ["user_id"], ps.RangeCount(ORDER, "ts", "12 hours"), ps.widened(rows, cnt="long"), event_time="ts")
    correct = F.when(aggs.int_avg("sum(cnt)", "count(1)") == 2, 1).otherwise(0)
    out = event_time.chained_windows(counted, events(), "user_id", "ts", "1 day", "2 days", correct)
    return runs.zone_less(runs.append_to_table(out), "window_start")


@report(
    "streamed_purged_counts",
    f"""SELECT user_id, count(*) AS firings, CAST(sum(5) AS BIGINT) AS cnt, CAST(sum(total) AS BIGINT) AS total, min(total)::BIGINT AS lowest, max(total)::BIGINT AS highest FROM (
          SELECT user_id, rn, sum(k) OVER (PARTITION BY user_id ORDER BY rn ROWS 4 PRECEDING) AS total
          FROM (SELECT user_id, {K} AS k, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)) WHERE rn % 5 = 0 GROUP BY user_id""",
)
def streamed_purged_counts(t):
    """Every five rows of a user fire and are purged."""
    state_store(t.spark)
    rows = decode_json(t.stream("events"), "props", "k long")
    fired = runs.append_to_table(triggers.triggered_windows(rows, "user_id", "ts", ORDER, "k", None, triggers.purging(triggers.count(5))))
    return fired.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("firings"), F.sum("cnt").alias("cnt"), F.sum("total").alias("total"), F.min("total").alias("lowest"), F.max("total").alias("highest")
    )


@report(
    "streamed_daily_firings",
    f"""WITH e AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS window_start, ts, event_id, {K} AS k FROM events),
        r AS (SELECT user_id, window_start, row_number() OVER w AS cnt, CAST(sum(k) OVER w AS BIGINT) AS total FROM e WINDOW w AS (PARTITION BY user_id, window_start ORDER BY ts, event_id))
        SELECT *, 'count' AS cause FROM r WHERE cnt % 3 = 0
        UNION ALL SELECT user_id, window_start, count(*), CAST(sum(k) AS BIGINT), 'end' FROM e GROUP BY 1, 2""",
)
def streamed_daily_firings(t):
    """Days of a user fire at every third row, and at their end."""
    state_store(t.spark)
    rows = decode_json(runs.closed(runs.event_time(t.stream("events", closing="ts")), "ts", "1 hour"), "props", "k long")
    trigger = triggers.either(triggers.count(3), triggers.at_end())
    return runs.zone_less(runs.append_to_table(triggers.triggered_windows(rows, "user_id", "ts", ORDER, "k", "1 day", trigger)), "window_start")
