"""Reports on change events, built from the orders: a first image, then updates and deletes."""

from pyspark.sql import functions as F

from tidemark.operators import changes
from tidemark.plans.registry import report

# Every order is read once; every third is then updated, every fifth then deleted.
STEPS_SQL = """(SELECT o_orderkey, o_custkey, o_orderstatus, 0 AS step, 'READ' AS op FROM orders
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, 1, 'UPDATE' FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, 2, 'DELETE' FROM orders WHERE o_orderkey % 5 = 0
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, 3, 'CREATE' FROM orders WHERE o_orderkey % 10 = 0)"""


def image(status):
    return F.to_json(F.struct("o_orderkey", "o_custkey", status.alias("o_orderstatus")))


def order_changes(orders):
    """Raw change rows: topic, operation and the JSON images of a row before and after."""
    key = F.col("o_orderkey")
    steps = F.array(
        F.struct(F.lit(0).alias("step"), F.lit("READ").alias("op")),
        F.when(key % 3 == 0, F.struct(F.lit(1).alias("step"), F.lit("UPDATE").alias("op"))),
        F.when(key % 5 == 0, F.struct(F.lit(2).alias("step"), F.lit("DELETE").alias("op"))),
        F.when(key % 10 == 0, F.struct(F.lit(3).alias("step"), F.lit("CREATE").alias("op"))),
    )
    rows = orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.explode(F.array_compact(steps)).alias("s"))
    old, new = F.col("o_orderstatus"), F.concat(F.lit("new-"), "o_orderstatus")
    op = F.col("s.op")
    updated = key % 3 == 0
    before = F.when(op == "UPDATE", image(old)).when(op == "DELETE", F.when(updated, image(new)).otherwise(image(old)))
    after = F.when(op.isin("READ", "CREATE"), image(old)).when(op == "UPDATE", image(new))
    return rows.select(
        F.col("s.step").alias("step"), F.lit("shop.sales.orders").alias("topic"), op.alias("op"),
        before.alias("before"), after.alias("after"),
    )


def normalized(t):
    return changes.normalize_change_event(order_changes(t("orders")))


def keyed_changes(raw):
    """Normalised changes with the key of the row they concern."""
    change = changes.normalize_change_event(raw)
    key = F.coalesce(F.try_element_at("after", F.lit("o_orderkey")), F.try_element_at("before", F.lit("o_orderkey")))
    return change.withColumn("o_orderkey", key.cast("long"))


@report(
    "change_events",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS id, step, 'sales' AS database, 'orders' AS "table",
               CASE op WHEN 'CREATE' THEN 'insert' ELSE lower(op) END AS type,
               CASE WHEN op = 'UPDATE' THEN o_orderstatus WHEN op = 'DELETE' THEN CASE WHEN o_orderkey % 3 = 0 THEN 'new-' ELSE '' END || o_orderstatus END AS old_status,
               CASE WHEN op = 'UPDATE' THEN 'new-' || o_orderstatus WHEN op <> 'DELETE' THEN o_orderstatus END AS new_status
        FROM {STEPS_SQL}""",
)
def change_events(t):
    out = normalized(t)
    return out.select(
        F.coalesce(F.try_element_at("after", F.lit("o_orderkey")), F.try_element_at("before", F.lit("o_orderkey"))).alias("id"),
        "step", "database", "table", "type",
        F.try_element_at("before", F.lit("o_orderstatus")).alias("old_status"),
        F.try_element_at("after", F.lit("o_orderstatus")).alias("new_status"),
    )


@report(
    "retractions",
    f"""SELECT added, status, count(*) AS cnt FROM (
          SELECT false AS added, CASE WHEN op = 'DELETE' AND o_orderkey % 3 = 0 THEN 'new-' ELSE '' END || o_orderstatus AS status FROM {STEPS_SQL} WHERE op IN ('UPDATE', 'DELETE')
          UNION ALL SELECT true, CASE WHEN op = 'UPDATE' THEN 'new-' ELSE '' END || o_orderstatus FROM {STEPS_SQL} WHERE op <> 'DELETE')
        GROUP BY 1, 2""",
)
def retractions(t):
    rows = changes.retract_stream(normalized(t)).withColumn("status", F.try_element_at("row", F.lit("o_orderstatus")))
    return rows.groupBy("added", "status").agg(F.count(F.lit(1)).alias("cnt"))


@report(
    "materialized_orders",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN '' WHEN o_orderkey % 3 = 0 THEN 'new-' ELSE '' END || o_orderstatus AS status
       FROM orders WHERE o_orderkey % 5 <> 0 OR o_orderkey % 10 = 0""",
)
def materialized_orders(t):
    keyed = keyed_changes(order_changes(t("orders")))
    current = changes.materialize_changes(keyed, ["o_orderkey"], ["step"], F.col("type") == "delete")
    return current.select("o_orderkey", F.try_element_at("after", F.lit("o_orderstatus")).alias("status"))
