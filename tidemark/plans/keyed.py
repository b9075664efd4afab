"""Reports on state per key: machines, patterns, rules, repeats."""

from pyspark.sql import functions as F

from tidemark.operators import changes, patterns
from tidemark.plans.joining import RULES_SQL, rules
from tidemark.plans.registry import report
from tidemark.sources.readers import small_rows

ORDER = ["ts", "event_id"]

# An example machine over the event types of the test data.
TRANSITIONS = [
    ("Initial", "signup", "Registered"),
    ("Initial", "view", "Browsing"),
    ("Registered", "view", "Browsing"),
    ("Browsing", "click", "Interested"),
    ("Interested", "click", "Interested"),
    ("Interested", "purchase", "Terminal"),
]
MOVES_SQL = "(VALUES " + ", ".join(str(m) for m in TRANSITIONS) + ") AS m(state, event, next)"

ALERTS_SQL = f"""WITH RECURSIVE e AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
   m AS (SELECT state, event, CASE next WHEN 'Terminal' THEN 'Initial' ELSE next END AS next FROM {MOVES_SQL}),
   s(user_id, rn, event_id, event_type, state, next) AS (
     SELECT e.user_id, e.rn, e.event_id, e.event_type, 'Initial', m.next FROM e LEFT JOIN m ON m.state = 'Initial' AND m.event = e.event_type WHERE e.rn = 1
     UNION ALL
     SELECT e.user_id, e.rn, e.event_id, e.event_type, coalesce(s.next, s.state), m.next
     FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1
     LEFT JOIN m ON m.state = coalesce(s.next, s.state) AND m.event = e.event_type)
   SELECT user_id, event_id, event_type, state FROM s WHERE next IS NULL"""


@report("state_machine_alerts", ALERTS_SQL)
def state_machine_alerts(t):
    out = patterns.state_machine_alerts(t("events"), ["user_id"], ORDER, "event_type", TRANSITIONS)
    return out.select("user_id", "event_id", "event_type", "state")


# Example pairs of actions.
PAIRS = [("view", "click"), ("click", "purchase"), ("purchase", "purchase"), ("signup", "error")]
PAIRS_SQL = "(VALUES " + ", ".join(str(p) for p in PAIRS) + ") AS p(first, second)"

CONSECUTIVE_SQL = f"""SELECT user_id, event_id, first, second
    FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events)
    JOIN {PAIRS_SQL} ON previous = first AND event_type = second"""


def pairs(t):
    return small_rows(t.spark, PAIRS, "first string, second string")


@report("consecutive_actions", CONSECUTIVE_SQL)
def consecutive_actions(t):
    out = patterns.consecutive_pattern(t("events").drop("props"), ["user_id"], ORDER, "event_type", pairs(t))
    return out.select("user_id", "event_id", "first", "second")


MATCHES_SQL = f"""SELECT rule, user_id, first_id, second_id FROM (
    SELECT rule, user_id, event_id AS first_id, event_type = first AS is_first,
           min(CASE WHEN event_type = second THEN event_id END) OVER (PARTITION BY user_id, rule ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS second_id
    FROM events JOIN {RULES_SQL} ON event_type = first OR event_type = second)
    WHERE is_first AND second_id IS NOT NULL"""


@report("rule_matches", MATCHES_SQL)
def rule_matches(t):
    out = patterns.rule_sequence_match(t("events").drop("props"), rules(t), ["user_id"], ["event_id"], "event_type")
    return out.select("rule", "user_id", F.col("event_id").alias("first_id"), F.col("matched.event_id").alias("second_id"))


@report(
    "latest_order_per_customer",
    "SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
)
def latest_order_per_customer(t):
    out = changes.latest_per_key(t("orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return out.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")


@report("distinct_actions", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_actions(t):
    return patterns.dedupe(t("events").select("user_id", "event_type"), ["user_id", "event_type"])


@report(
    "first_actions",
    "SELECT user_id, event_type, event_id, ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1",
)
def first_actions(t):
    out = patterns.first_per_key(t("events").drop("props", "value"), ["user_id", "event_type"], ORDER)
    return out.select("user_id", "event_type", "event_id", "ts")
