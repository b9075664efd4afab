"""Reports on tokens, projections, routing, parsing and scalar expressions."""

from pyspark.sql import functions as F

from tidemark.functions import text, times
from tidemark.operators import aggs, routing, watermarks
from tidemark.plans.registry import Tables, report
from tidemark.runtime import fresh_dir
from tidemark.sinks import files
from tidemark.sources import codecs, readers

TOKENS = r"SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\W+')) AS token FROM documents"


def tokens(t: Tables, lower: bool = True):
    return routing.tokenize(t("documents").select("doc_id", "text"), "text", lower)


@report("word_count", f"SELECT token, CAST(count(*) AS BIGINT) AS frequency FROM ({TOKENS}) WHERE token <> '' GROUP BY 1")
def word_count(t):
    return aggs.group_sum(tokens(t), ["token"], "n", "frequency")


@report(
    "words_seen_twice",
    f"SELECT token, CAST(count(*) AS BIGINT) AS frequency FROM ({TOKENS}) WHERE token <> '' GROUP BY 1 HAVING count(*) = 2",
)
def words_seen_twice(t):
    return routing.having(tokens(t), ["token"], {"frequency": F.sum("n")}, "frequency = 2")


@report(
    "whitespace_tokens",
    r"SELECT token, count(*) AS cnt FROM (SELECT unnest(regexp_split_to_array(text, '[ \t\n\r\f\v]')) AS token FROM documents) GROUP BY 1",
)
def whitespace_tokens(t):
    pieces = routing.tokenize(t("documents").select("text"), "text", lower=False, pattern=r"[ \t\n\r\f\x0B]", keep_empty=True)
    return aggs.count_rows(pieces, ["token"])


@report(
    "rejected_words",
    f"SELECT 'rejected: ' || token AS message, count(*) AS cnt FROM ({TOKENS}) WHERE length(token) > 5 GROUP BY 1",
)
def rejected_words(t):
    _, rejected = routing.side_output(tokens(t), F.length("token") > 5, F.format_string("rejected: %s", "token"))
    return aggs.count_rows(rejected, ["message"])


@report(
    "kept_words",
    f"SELECT token, CAST(count(*) AS BIGINT) AS n FROM ({TOKENS}) WHERE token <> '' AND length(token) <= 5 GROUP BY 1",
)
def kept_words(t):
    kept, _ = routing.side_output(tokens(t), F.length("token") > 5, F.col("token"))
    return aggs.group_sum(kept, ["token"], "n", "n")


@report(
    "leading_words",
    r"""SELECT doc_id, lower(source) AS source, substring(text, 1, 10) AS beginning,
               array_to_string(regexp_extract_all(text, '\w+')[1:3], ' ') AS words FROM documents""",
)
def leading_words(t):
    docs = t("documents")
    return docs.select(
        "doc_id",
        F.lower("source").alias("source"),
        F.substring("text", 1, 10).alias("beginning"),
        F.array_join(text.first_items(text.word_list(F.col("text")), 3), " ").alias("words"),
    )


@report(
    "shortest_word_lists",
    r"""SELECT source, array_to_string(words, ' ') AS words FROM (
          SELECT *, row_number() OVER (PARTITION BY source ORDER BY len(words), words) AS r
          FROM (SELECT source, regexp_extract_all(text, '\w+') AS words FROM documents)) WHERE r = 1""",
)
def shortest_word_lists(t):
    listed = t("documents").select("source", text.size_then_items(text.word_list(F.col("text"))).alias("ranked"))
    least = listed.groupBy("source").agg(F.min("ranked").alias("ranked"))
    return least.select("source", F.array_join("ranked.items", " ").alias("words"))


def split_rules():
    return {
        "even": F.expr("event_id % 2 = 0"),
        "odd": F.expr("event_id % 2 = 1"),
        "large": F.expr("value > 100"),
    }


@report(
    "split_counts",
    """SELECT 'even' AS output, count(*) AS cnt FROM events WHERE event_id % 2 = 0
       UNION ALL SELECT 'odd', count(*) FROM events WHERE event_id % 2 = 1
       UNION ALL SELECT 'large', count(*) FROM events WHERE value > 100""",
)
def split_counts(t):
    outputs = routing.split_by_rules(t("events"), split_rules())
    return routing.union_all(*[aggs.count_rows(df, [F.lit(name).alias("output")]) for name, df in outputs.items()])


@report("split_selection", "SELECT event_id, value FROM events WHERE event_id % 2 = 0 OR value > 100")
def split_selection(t):
    return routing.select_split(t("events"), split_rules(), ["even", "large"]).select("event_id", "value")


@report(
    "connected_inputs",
    """SELECT event_id AS id, 'str_' || event_type AS label, 'left' AS side FROM events
       UNION ALL SELECT o_orderkey + 1, o_orderstatus, 'right' FROM orders""",
)
def connected_inputs(t):
    return routing.connect_map(
        t("events"), t("orders"),
        {"id": F.col("event_id"), "label": F.concat(F.lit("str_"), "event_type")},
        {"id": F.col("o_orderkey") + 1, "label": F.col("o_orderstatus")},
    )


@report(
    "rows_by_chosen_partition",
    "SELECT CAST(event_id % 2 AS INTEGER) AS partition, count(*) AS cnt FROM events GROUP BY 1",
)
def rows_by_chosen_partition(t):
    placed = routing.custom_partition(t("events").select("event_id"), F.pmod("event_id", F.lit(2)), 2)
    return aggs.count_rows(placed.select(F.spark_partition_id().alias("partition")), ["partition"])


@report("copies_per_partition", "SELECT n_nationkey, CAST(p AS INTEGER) AS partition FROM nation, range(4) r(p)")
def copies_per_partition(t):
    copies = routing.broadcast_rows(t("nation"), 4)
    return copies.select("n_nationkey", F.spark_partition_id().alias("partition"))


@report(
    "union_of_orders",
    """SELECT o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice > 300000
       UNION ALL SELECT o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_totalprice < 50000""",
)
def union_of_orders(t):
    orders = routing.project(t("orders"), ["o_custkey", "o_orderstatus", "o_totalprice"])
    return routing.union_all(
        routing.filter_rows(orders, "o_totalprice > 300000"), routing.filter_rows(orders, "o_totalprice < 50000")
    )


@report("renamed_fields", "SELECT event_id AS key, ts AS rowtime, props AS payload FROM events")
def renamed_fields(t):
    named = routing.rename_fields(t("events"), {"event_id": "key", "ts": "rowtime", "props": "payload"})
    return routing.project(named, ["key", "rowtime", "payload"])


@report("mapped_columns", "SELECT event_id + 1 AS next_id, 'str_' || event_type AS label, CAST(1 AS BIGINT) AS n FROM events")
def mapped_columns(t):
    mapped = routing.map_columns(
        t("events"),
        {"next_id": F.col("event_id") + 1, "label": F.concat(F.lit("str_"), "event_type"), "n": F.lit(1).cast("long")},
    )
    return routing.project(mapped, ["next_id", "label", "n"])


@report("largest_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 7")
def largest_orders(t):
    orders = routing.project(t("orders"), ["o_orderkey", "o_totalprice"])
    return routing.limit_rows(orders, [F.col("o_totalprice").desc(), "o_orderkey"], 7)


@report("customers_by_balance", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def customers_by_balance(t):
    return routing.sort_desc(routing.project(t("customer"), ["c_custkey", "c_acctbal"]), "c_acctbal", "c_custkey")


@report(
    "rows_clustered_by_day",
    "SELECT strftime(ts, '%Y%m%d') AS day, count(*) AS cnt, min(ts) AS first_ts FROM events GROUP BY 1",
)
def rows_clustered_by_day(t):
    clustered = routing.cluster_by_day(t("events").select("event_id", "ts"), "ts")
    return clustered.groupBy("day").agg(F.count(F.lit(1)).alias("cnt"), F.min("ts").alias("first_ts"))


@report(
    "parsed_tuples",
    "SELECT CAST(user_id AS INTEGER) AS car_id, value AS speed, epoch_us(ts) // 1000 AS ms FROM events",
)
def parsed_tuples(t):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    lines = t("events").select(F.format_string("(%d,%s,%d)", "user_id", F.col("value").cast("string"), millis).alias("line"))
    return routing.parse_tuple_text(lines, "line", {"car_id": "int", "speed": "double", "ms": "long"})


@report(
    "parsed_pairs",
    "SELECT event_type AS key, max(epoch_us(ts) // 1000) AS ms, count(*) AS cnt FROM events GROUP BY 1",
)
def parsed_pairs(t):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    lines = t("events").select(F.concat_ws(",", "event_type", millis.cast("string")).alias("line"))
    pairs = routing.parse_csv_pair(lines, "line")
    return pairs.groupBy("key").agg(F.max("ms").alias("ms"), F.count(F.lit(1)).alias("cnt"))


@report(
    "event_times",
    """SELECT event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS from_millis, make_timestamp((epoch_us(ts) // 1000000) * 1000000) AS from_seconds,
              strftime(ts, '%Y%m%d') AS day, strftime(ts, '%H:%M') AS minute, CAST(hour(ts) AS INTEGER) AS hour,
              ts + INTERVAL '90 seconds' AS later
       FROM events WHERE ts > TIMESTAMP '2024-01-02 00:00:00'""",
)
def event_times(t):
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    kept = routing.filter_rows(t("events"), "ts > TIMESTAMP_NTZ '2024-01-02 00:00:00'")
    return kept.select(
        "event_id",
        times.millis_to_ntz(millis).alias("from_millis"),
        times.seconds_to_ntz(F.floor(millis / 1000)).alias("from_seconds"),
        times.compact_day(F.col("ts")).alias("day"),
        F.date_format("ts", "HH:mm").alias("minute"),
        F.hour("ts").alias("hour"),
        (F.col("ts") + times.interval("90 seconds")).alias("later"),
    )


ADDRESS = "(c_custkey * 2654435 % 4294967296) - 2147483648"


@report(
    "dotted_addresses",
    f"""SELECT c_custkey, ((a >> 24) & 255) || '.' || ((a >> 16) & 255) || '.' || ((a >> 8) & 255) || '.' || (a & 255) AS address
        FROM (SELECT c_custkey, ({ADDRESS}) & 4294967295 AS a FROM customer)""",
)
def dotted_addresses(t):
    signed = F.expr(f"CAST({ADDRESS} AS INT)")
    return t("customer").select("c_custkey", text.dotted_ipv4(signed).alias("address"))


EVENT_LETTERS = {"signup": "a", "view": "b", "click": "c", "purchase": "d", "error": "e"}


@report(
    "binary_events",
    """SELECT CAST(user_id - 75 AS INTEGER) AS address,
              CASE event_type WHEN 'signup' THEN 'a' WHEN 'view' THEN 'b' WHEN 'click' THEN 'c' WHEN 'purchase' THEN 'd' ELSE 'e' END AS type,
              count(*) AS cnt FROM events GROUP BY 1, 2""",
)
def binary_events(t):
    rows = t("events").select(
        (F.col("user_id") - 75).cast("int").alias("address"), text.case_map(F.col("event_type"), EVENT_LETTERS, "e").alias("type")
    )
    wire = codecs.encode_event_binary(rows, "address", "type")
    return aggs.count_rows(codecs.decode_event_binary(wire, "value"), ["address", "type"])


@report(
    "reloaded_csv",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_custkey > 0",
)
def reloaded_csv(t):
    path = fresh_dir(t.spark, "csv")
    files.write_csv(t("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), path, sep=",")
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double"
    return readers.read_csv_typed(t.spark, path, schema, ids=["o_custkey"])


@report(
    "reloaded_tsv",
    "SELECT conv_id, turn, lower(role) AS role, substring(text, 1, 10) AS beginning, text AS comment, conv_id + turn AS total FROM conversations",
)
def reloaded_tsv(t):
    path = fresh_dir(t.spark, "tsv")
    numbers = F.format_string("[%d,%d]", "conv_id", "turn")
    source = t("conversations").select("conv_id", "turn", "role", text.escape_tsv(F.col("text")).alias("comment"), numbers.alias("children"))
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    source.write.csv(path, sep="\t", header=True, quote="\u0000", **keep)
    columns = {"conv_id": "bigint", "turn": "bigint", "role": "string", "comment": "string", "children": "array<bigint>"}
    select = {
        "conv_id": F.col("conv_id"),
        "turn": F.col("turn"),
        "role": F.lower("role"),
        "beginning": F.substring("comment", 1, 10),
        "comment": F.col("comment"),
        "total": F.get("children", F.lit(0)) + F.get("children", F.lit(1)),
    }
    return readers.read_tsv_with_names(t.spark, path, columns, select, escaped=True)


@report(
    "text_line_lengths",
    """SELECT CAST(length(line) AS INTEGER) AS length, count(*) AS cnt
       FROM (SELECT unnest(string_split(replace(html, chr(13), ' '), chr(10))) AS line FROM pages) GROUP BY 1""",
)
def text_line_lengths(t):
    path = fresh_dir(t.spark, "text")
    lines = F.split(F.translate("html", "\r", " "), "\n")
    files.write_text(t("pages").select(F.explode(lines).alias("line")), path)
    return aggs.count_rows(readers.read_text_lines(t.spark, path).select(F.length("value").alias("length")), ["length"])


@report("daily_buckets", "SELECT strftime(ts, '%Y-%m-%d') AS bucket, count(*) AS cnt FROM events GROUP BY 1")
def daily_buckets(t):
    path = fresh_dir(t.spark, "buckets")
    files.write_bucketed(t("events").select("event_id", "ts"), path, F.date_format("ts", "yyyy-MM-dd"), fmt="parquet")
    return aggs.count_rows(t.spark.read.parquet(path).select(F.col("bucket").cast("string").alias("bucket")), ["bucket"])


@report("tasks_per_user", "SELECT user_id, count(*) AS cnt, CAST(1 AS BIGINT) AS tasks FROM events GROUP BY 1")
def tasks_per_user(t):
    """Rows of a key are placed in one task."""
    placed = routing.key_by(t("events").select("user_id"), "user_id").withColumn("task", F.spark_partition_id())
    return placed.groupBy("user_id").agg(F.count(F.lit(1)).alias("cnt"), F.count_distinct("task").alias("tasks"))


@report("events_by_millis", "SELECT event_id, date_trunc('milliseconds', ts) AS at FROM events")
def events_by_millis(t):
    millis = t("events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    return watermarks.assign_event_time(millis, "ms", "at").select("event_id", F.col("at").cast("timestamp_ntz").alias("at"))
