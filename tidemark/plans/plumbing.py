"""Reports on sources, sinks and job options: what is written by one comes back through the other, over the given tables."""

import json

from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators import aggs, watermarks, windows
from tidemark.plans.aggregates import K, with_k
from tidemark.plans.capture import normalized
from tidemark.plans.registry import SQL, report
from tidemark.runtime import fresh_dir, run_with_restart, state_store, stream_options
from tidemark.sinks import batches, files
from tidemark.sources import codecs, readers
from tidemark.streaming import processors as ps
from tidemark.streaming import runs

ORDER = ["ts", "event_id"]


def name_of(path: str) -> str:
    """A table or view name that no other run has."""
    return "t_" + path.rsplit("-", 1)[1]


@report("inserted_orders", "SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS note FROM orders")
def inserted_orders(t):
    """Two inserts by column name into a table, which is then read by its name."""
    path = fresh_dir(t.spark, "inserted")
    table = name_of(path)
    t.spark.sql(f"CREATE TABLE {table} (o_orderkey BIGINT, o_orderstatus STRING, note STRING) USING parquet LOCATION '{path}'")
    orders = t("orders").select("o_orderstatus", "o_orderkey")
    for part in ("o_orderkey % 2 = 0", "o_orderkey % 2 <> 0"):
        files.insert_into(orders.where(part), table, ["o_orderstatus", "o_orderkey"])
    rows = readers.scan_table(t.spark, table).select("o_orderkey", "o_orderstatus", "note")
    found = readers.load_path(t.spark, path, rows.schema)
    t.spark.sql(f"DROP TABLE {table}")
    return found


@report("nations_by_view", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def nations_by_view(t):
    """Tables and named rows registered as views and joined in SQL."""
    view = name_of(fresh_dir(t.spark, "view"))
    readers.register_view(f"{view}_nation", t("nation"))
    rows = [tuple(r) for r in t("region").select("r_regionkey", "r_name").limit(1000).collect()]
    schema = t("region").select("r_regionkey", "r_name").schema
    readers.named_rows(t.spark, rows, schema, f"{view}_region")
    return t.spark.sql(f"SELECT n_name, r_name FROM {view}_nation JOIN {view}_region ON n_regionkey = r_regionkey")


@report("kafka_rows", f"SELECT CAST(user_id AS VARCHAR) AS key, event_id, event_type, {K} AS k FROM events")
def kafka_rows(t):
    """What the Kafka sink is given, read as the Kafka source gives it."""
    events = with_k(t).select("user_id", "event_id", "event_type", "k")
    sent = files.kafka_rows(events, F.to_json(F.struct("event_id", "event_type", "k")), F.col("user_id"))
    received = sent.select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.lit("events").alias("topic"),
        F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"), F.current_timestamp().alias("timestamp"),
    )
    parsed = codecs.parse_kafka(received, "event_id long, event_type string, k long", with_metadata=True)
    return parsed.where("topic = 'events'").select("key", "event_id", "event_type", "k")


@report("streamed_change_texts", SQL["change_events"])
def streamed_change_texts(t):
    """Change events as JSON lines, read as a stream."""
    path = fresh_dir(t.spark, "changes")
    # The step of the made-up change goes with its row images, as the text has no other place for it.
    step = F.create_map(F.lit("step"), F.col("step").cast("string"))
    with_step = normalized(t).select(
        "database", "table", "type", F.map_concat(F.coalesce("before", F.create_map().cast("map<string,string>")), step).alias("before"), "after"
    )
    files.write_text(codecs.encode_json(with_step, "value"), path)
    lines = readers.read_text_lines(t.spark, path, streaming=True)
    out = runs.append_to_table(codecs.read_change_events(lines))
    image = lambda side, name: F.try_element_at(side, F.lit(name))
    return out.select(
        F.coalesce(image("after", "o_orderkey"), image("before", "o_orderkey")).alias("id"), image("before", "step").cast("int").alias("step"),
        "database", "table", "type", image("before", "o_orderstatus").alias("old_status"), image("after", "o_orderstatus").alias("new_status"),
    )


@report("single_csv", "SELECT n_nationkey, n_name FROM nation")
def single_csv(t):
    path = fresh_dir(t.spark, "csv")
    files.write_csv_single(t("nation").select("n_nationkey", "n_name"), path)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t("nation").select("n_nationkey", "n_name").schema.fields)
    return t.spark.read.csv(path, schema=kinds, sep="|")


@report("streamed_daily_buckets", "SELECT strftime(ts, '%Y-%m-%d') AS bucket, count(*) AS cnt FROM events GROUP BY 1")
def streamed_daily_buckets(t):
    path = fresh_dir(t.spark, "buckets")
    rows = t.stream("events").select("event_id", "ts")
    files.write_bucketed(rows, path, F.date_format("ts", "yyyy-MM-dd"), fresh_dir(t.spark, "checkpoint")).awaitTermination()
    read = t.spark.read.schema("event_id long, bucket string").json(path)
    return read.groupBy("bucket").agg(F.count(F.lit(1)).alias("cnt"))


@report("streamed_appended_orders", "SELECT o_orderkey, 1::BIGINT AS documents FROM orders")
def streamed_appended_orders(t):
    """Rows under generated ids: each order under one, no id twice."""
    path = fresh_dir(t.spark, "appended")
    rows = t.stream("orders").select("o_orderkey")
    files.append_sink(rows, path, fresh_dir(t.spark, "checkpoint")).awaitTermination()
    read = readers.load_path(t.spark, path, t.spark.createDataFrame([], "o_orderkey long, document_id string").schema)
    return read.groupBy("o_orderkey").agg(F.count_distinct("document_id").alias("documents"))


class Flaky:
    """A client that takes nothing at its first call, and never a row or document of an order with a number of 97s."""

    def __init__(self):
        self.calls = 0

    def send(self, rows) -> None:
        self.calls += 1
        ids = [int(r["id"] if isinstance(r, dict) else r["o_orderkey"]) for r in rows]
        if self.calls == 1 or any(i % 97 == 0 for i in ids):
            raise batches.RetryableWriteError("not now")


@report("dead_letters", "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus FROM orders WHERE o_orderkey % 97 = 0")
def dead_letters(t):
    """Rows that a client takes in no form, after slices and rows were tried again."""
    path = fresh_dir(t.spark, "dead")
    sink = batches.retry_sink(Flaky, lambda client, rows: client.send(rows), "o_orderkey", path, threshold=50, attempts=2, delay_seconds=0)
    runs.drain(t.stream("orders").select("o_orderkey", "o_orderstatus"), sink)
    letters = t.spark.read.schema("id string, document string").parquet(path)
    return letters.select("id", F.get_json_object("document", "$.data.o_orderstatus").alias("o_orderstatus"))


class Counting:
    """A client that adds up what it gets, across tasks."""

    def __init__(self, rows, total):
        self.rows, self.total = rows, total

    def lpush(self, key, value) -> None:
        self.rows.add(1)
        self.total.add(int(value))

    def __call__(self, text: str) -> None:
        self.lpush(None, json.loads(text)["o_custkey"])

    def buffer(self, rows) -> None:
        for row in rows:
            self.lpush(None, row["o_custkey"])


@report(
    "client_totals",
    """SELECT sink, count(*) AS rows, CAST(sum(o_custkey) AS BIGINT) AS total FROM orders, (VALUES ('buffer'), ('callback'), ('list')) AS s(sink) GROUP BY sink""",
)
def client_totals(t):
    """What clients opened inside tasks were handed: pushed to lists, as JSON text, and in buffers."""
    context, found = t.spark.sparkContext, []
    for name, make in {
        "list": lambda client: batches.list_push_sink(client, "o_orderkey", "o_custkey"),
        "callback": lambda client: batches.json_callback_sink(client, ["o_custkey"]),
        "buffer": lambda client: batches.buffered_sink(client, lambda c, rows: c.buffer(rows), threshold=64),
    }.items():
        rows, total = context.accumulator(0), context.accumulator(0)
        runs.drain(t.stream("orders").select("o_orderkey", "o_custkey"), make(lambda r=rows, s=total: Counting(r, s)))
        found.append((name, rows.value, total.value))
    return readers.from_rows(t.spark, found, "sink string, rows long, total long")


@report(
    "observed_rows",
    f"SELECT count(*) AS rows, count(*) FILTER (event_id % 7 = 0) AS logged, round(avg({K}), 6) AS average FROM events",
)
def observed_rows(t):
    """Figures of rows that nobody keeps."""
    sampled, averaged = Observation("sampled"), Observation("averaged")
    files.discard_sink(aggs.accumulate_average(files.sampled_observe(with_k(t), sampled, "event_id", 7), averaged, "k"))
    row = (sampled.get["rows"], sampled.get["logged"], round(averaged.get["average"], 6))
    return readers.from_rows(t.spark, [row], "rows long, logged long, average double")


@report("processing_windows", "SELECT count(*) AS inside, count(*) AS ingested FROM events")
def processing_windows(t):
    """Rows in the window of the time they are processed at, and rows with a time of ingestion."""
    placed = watermarks.ingestion_time(windows.tumble_processing_time(t("events").select("event_id"), "10 minutes"))
    inside = (F.col("process_time") >= F.col("window.start")) & (F.col("process_time") < F.col("window.end"))
    since = F.col("ingested_at") >= F.lit("2020-01-01 00:00:00").cast("timestamp")
    return placed.agg(F.count(F.when(inside, 1)).alias("inside"), F.count(F.when(since, 1)).alias("ingested"))


@report("streamed_defined_table", f"SELECT date_trunc('hour', ts) AS window_start, count(*) AS with_time, CAST(sum(2 * {K}) AS BIGINT) AS doubled FROM events GROUP BY 1")
def streamed_defined_table(t):
    """A stream with a computed column, a processing time and a watermark, as its table says."""
    rows = codecs.decode_json(runs.event_time(t.stream("events")), "props", "k long")
    table = readers.define_stream_table(rows, {"doubled": F.col("k") * 2}, "ts", "5 seconds")
    sums = table.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count("proctime").alias("with_time"), F.sum("doubled").alias("doubled"))
    out = runs.upsert_to_table(sums.select(F.col("w.start").alias("window_start"), "with_time", "doubled"), ["window_start"])
    return runs.zone_less(out, "window_start")


@report("streamed_late_hours", "SELECT date_trunc('hour', ts) AS window_start, count(*) AS cnt FROM events GROUP BY 1")
def streamed_late_hours(t):
    """Hours that stay open for rows up to five minutes behind the bound."""
    rows = watermarks.allowed_lateness(runs.event_time(t.stream("events")), "ts", "5 seconds", "5 minutes")
    counts = rows.groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("cnt"))
    return runs.zone_less(runs.upsert_to_table(counts.select(F.col("w.start").alias("window_start"), "cnt"), ["window_start"]), "window_start")


@report("streamed_replayed_windows", SQL["window_sums"])
def streamed_replayed_windows(t):
    """Windows that are given out once, when a last row moves the watermark behind them."""
    rows = codecs.decode_json(runs.closed(runs.event_time(t.stream("events", closing="ts")), "ts", "1 hour"), "props", "k long")
    sums = aggs.global_window_agg(rows, "ts", "1 day", {"total": F.sum("k"), "highest": F.max("k")})
    return runs.zone_less(runs.append_to_table(sums), "window_start", "window_end")


@report(
    "streamed_record_checks",
    """SELECT event_id, user_id, coalesce(lag(event_type) OVER w <> 'view', false) AS wrong_before, row_number() OVER w AS seen
       FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def streamed_record_checks(t):
    """A record, a counter and a value of either kind in the state of a user."""
    state_store(t.spark)
    rows = t.stream("events").select("user_id", "event_type", *ORDER)
    check = ps.RecordCheck(ORDER, {"event_id": "long", "event_type": "string"}, "event_type", "view")
    out = ps.keyed(rows, ["user_id"], check, ps.widened(rows, wrong_before="boolean", seen="long"))
    return runs.append_to_table(out.select("event_id", "user_id", "wrong_before", "seen"))


@report("streamed_after_restart", "SELECT o_orderkey, o_orderstatus FROM orders")
def streamed_after_restart(t):
    """A batch fails after its rows were written; the named stream starts again from its checkpoint, and rows count once."""
    path, commits, checkpoint = (fresh_dir(t.spark, n) for n in ("rows", "commits", "checkpoint"))
    write, failed = batches.exactly_once_sink(path, commits, "orders"), []

    def sink(batch, batch_id):
        write(batch, batch_id)
        if not failed:
            failed.append(batch_id)
            raise ValueError("once, on purpose")

    name = name_of(checkpoint)
    start = lambda: stream_options(t.stream("orders").select("o_orderkey", "o_orderstatus").writeStream.foreachBatch(sink), checkpoint, name=name).start()
    query = run_with_restart(start, attempts=2, delay_seconds=0)
    if query.name != name or not failed:
        raise RuntimeError("the stream did not start again under its name")
    return batches.read_committed(t.spark, path, commits, "orders")
