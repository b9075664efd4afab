"""Reading, decoding and writing."""

import json
import struct

import pytest
from conftest import SMALL, rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.functions.text import escape_tsv
from tidemark.operators import aggs, changes
from tidemark.runtime import fresh_dir, shared_dir
from tidemark.sinks import batches, files
from tidemark.sources import codecs, readers


def test_text_and_views(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text("one\ntwo\n")
    lines = readers.register_view("some_lines", readers.read_text_lines(spark, str(path)))
    assert rows(readers.scan_table(spark, "some_lines")) == rows(lines) == [("one",), ("two",)]
    assert readers.read_text_lines(spark, str(tmp_path), streaming=True).isStreaming


def test_csv_drops_rows_without_id(spark, tmp_path):
    (tmp_path / "b.csv").write_text("1,2,3,pv,1511544070,2017-11-25\n0,2,3,buy,1,x\n,2,3,buy,1,x\n-4,2,3,buy,1,x\n7,1,1,buy,2,y\n")
    schema = "user_id long, item_id long, category_id long, behavior string, event_ts long, event_time string"
    out = readers.read_csv_typed(spark, str(tmp_path), schema, ids=["user_id"])
    assert rows(out.select("user_id", "behavior")) == [(1, "pv"), (7, "buy")]


def test_tsv_with_names_and_transform(spark, tmp_path):
    text = 'id\ttype\tauthor\tcomment\tchildren\n1\tcomment\tDerefr\t"Because we&#x27;re\t[]\n2\tcomment\tCalChris\t"&gt; It has\t[19468341,5]\n'
    (tmp_path / "c.tsv").write_text(text)
    columns = {"id": "bigint", "type": "string", "author": "string", "comment": "string", "children": "array<bigint>"}
    select = {
        "id": F.col("id"), "author": F.lower("author"), "comment": F.substring("comment", 1, 10), "children": F.col("children"),
        "tokens": F.slice(F.regexp_extract_all("comment", F.lit(r"\w+"), F.lit(0)), 1, 3),
    }
    out = readers.read_tsv_with_names(spark, str(tmp_path), columns, select)
    assert [tuple(r) for r in out.orderBy("id").collect()] == [
        (1, "derefr", '"Because w', [], ["Because", "we", "x27"]),
        (2, "calchris", '"&gt; It h', [19468341, 5], ["gt", "It", "has"]),
    ]


def test_keyed_sequence(spark):
    out = readers.keyed_sequence(spark, 10, 1000)
    assert rows(out.groupBy("key").sum("value")) == sorted(((k, 100) for k in range(1, 11)), key=repr)


def test_stream_table_definition(spark, events):
    stream = readers.load_stream(spark, SMALL, "events")
    out = readers.define_stream_table(stream, {"ts": F.col("ts").cast("timestamp")}, "ts", "5 seconds")
    assert out.isStreaming and "proctime" in out.columns


def test_dimension_is_loaded_again_after_its_ttl(spark):
    now, loads = [0.0], []

    def load():
        loads.append(now[0])
        return spark.range(len(loads))

    dim = readers.CachedDimension(load, ttl_seconds=600, clock=lambda: now[0])
    assert dim.current().count() == 1
    now[0] = 599.0
    assert dim.current().count() == 1
    now[0] = 600.0
    assert dim.current().count() == 2 and loads == [0.0, 600.0]


def test_json_round_trip(spark):
    df = readers.from_rows(spark, [(1, "click"), (2, None)], "userId long, action string")
    wire = codecs.encode_json(df)
    assert json.loads(wire.first()["value"]) == {"userId": 1, "action": "click"}
    assert rows(codecs.decode_json(wire, "value", df.schema)) == rows(df)
    bad = readers.from_rows(spark, [("{not json",)], "value string")
    assert rows(codecs.decode_json(bad, "value", "a long")) == [(None,)]


def test_binary_events(spark):
    pairs = [(0, 0), (1, 6), (-1, 2), (2147483647, 3), (-2147483648, 4)]
    df = readers.from_rows(spark, [(bytearray(struct.pack("<ii", a, t)),) for a, t in pairs], "value binary")
    out = codecs.decode_event_binary(df, "value")
    want = sorted(((a, "abcdefg"[t]) for a, t in pairs), key=repr)
    assert rows(out) == want
    wire = codecs.encode_event_binary(out, "address", "type")
    assert rows(wire) == rows(df)


def test_kafka_columns(spark):
    options = codecs.kafka_options("host:9092", "user_behavior", "group", max_offsets=100)
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "100"
    schema = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
    df = readers.from_rows(spark, [(bytearray(b"k"), bytearray(b'{"value":"7"}'), "t", 0, 5, None)], schema)
    assert rows(codecs.parse_kafka(df, "value string")) == [("7",)]
    assert codecs.parse_kafka(df, "value string", with_metadata=True).first().asDict() == {
        "key": "k", "topic": "t", "partition": 0, "offset": 5, "timestamp": None, "value": "7"
    }
    out = files.kafka_rows(readers.from_rows(spark, [(1, "x")], "id long, v string"), F.col("v"), F.col("id"))
    assert rows(out) == [("1", "x")]


def test_change_events_are_null_safe(spark):
    schema = "topic string, op string, before string, after string"
    data = [
        ("s.shop.push", "CREATE", None, '{"id":1,"url":null}'),
        ("s.shop.push", "READ", None, '{"id":2,"url":"u"}'),
        ("s.shop.push", "DELETE", '{"id":2,"url":"u"}', None),
        ("odd", "UPDATE", '{"id":3}', '{"id":3}'),
    ]
    out = changes.normalize_change_event(readers.from_rows(spark, data, schema))
    plain = lambda m: str(m and dict(sorted(m.items())))
    got = {(r["database"], r["table"], r["type"], plain(r["before"]), plain(r["after"])) for r in out.collect()}
    assert got == {
        ("shop", "push", "insert", "None", "{'id': '1', 'url': None}"),
        ("shop", "push", "read", "None", "{'id': '2', 'url': 'u'}"),
        ("shop", "push", "delete", "{'id': '2', 'url': 'u'}", "None"),
        (None, None, "update", "{'id': '3'}", "{'id': '3'}"),
    }
    wire = codecs.encode_json(out)
    assert rows(codecs.read_change_events(wire).select("type")) == [("delete",), ("insert",), ("read",), ("update",)]


def test_files(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("g"))
    files.write_csv_single(df, str(tmp_path / "csv"))
    parts = list((tmp_path / "csv").glob("part-*"))
    assert len(parts) == 1 and parts[0].read_text().count("|") == 100
    files.write_bucketed(df, str(tmp_path / "b"), F.col("g"))
    assert sorted(p.name for p in (tmp_path / "b").glob("bucket=*")) == ["bucket=0", "bucket=1", "bucket=2"]
    for _ in range(2):
        files.append_sink(df, str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).select("document_id").distinct().count() == 200
    files.discard_sink(df)
    files.write_console(df.limit(1))


def test_insert_by_column_name(spark, tmp_path):
    location = str(tmp_path / "t")
    spark.sql(f"CREATE TABLE clicks (name STRING, url STRING, n BIGINT) USING parquet LOCATION '{location}'")
    try:
        files.insert_into(readers.from_rows(spark, [("u", "n")], "a string, b string"), "clicks", ["url", "name"])
        assert rows(spark.table("clicks")) == [("n", "u", None)]
    finally:
        spark.sql("DROP TABLE clicks")


def test_observations(spark):
    seen = Observation("avg")
    aggs.accumulate_average(spark.range(11), seen, "id").collect()
    assert seen.get == {"average": 5.0, "rows": 11}
    logged = Observation("log")
    files.sampled_observe(spark.range(1000), logged, "id", 100).collect()
    assert logged.get == {"rows": 1000, "logged": 10}
    assert files.sampled_rows(spark.range(1000), "id", 100).count() == 10


def test_upserts_replace_by_key(spark):
    path, into = fresh_dir(spark, "u"), fresh_dir(spark, "c")
    sink = batches.upsert_sink(path, ["k"], ["o"])
    sink(readers.from_rows(spark, [(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, o int, v string"), 0)
    sink(readers.from_rows(spark, [(2, 0, "d"), (3, 1, "e")], "k int, o int, v string"), 1)
    sink(readers.from_rows(spark, [(2, 0, "d"), (3, 1, "e")], "k int, o int, v string"), 1)
    assert rows(batches.read_upserted(spark, path, ["k"]).select("k", "v")) == [(1, "b"), (2, "d"), (3, "e")]
    batches.compact_upserts(spark, path, ["k"], into)
    assert rows(batches.read_upserted(spark, into, ["k"]).select("k", "v")) == [(1, "b"), (2, "d"), (3, "e")]


def test_uncommitted_rows_are_not_seen(spark):
    path, commits = fresh_dir(spark, "x"), fresh_dir(spark, "y")
    sink = batches.exactly_once_sink(path, commits, "job")
    sink(spark.range(3), 0)
    sink(spark.range(99), 0)
    batches._write_batch(spark.range(50), path, 1)
    assert batches.read_committed(spark, path, commits, "job").count() == 3
    sink(spark.range(4), 1)
    assert batches.read_committed(spark, path, commits, "job").count() == 7


def test_retry_sends_only_failed_rows_again(spark, tmp_path):
    """Row 1 passes, row 2 at the second try, row 3 only when wrapped, row 4 never."""
    folder, dead = str(tmp_path), fresh_dir(spark, "dead")
    retry = batches.RetryableWriteError

    def send(folder, rows):
        import os
        import uuid

        for row in rows:
            if isinstance(row, dict):
                if row["id"] == "4":
                    raise retry("never")
            elif row["id"] in (3, 4):
                raise retry("only wrapped")
            elif row["id"] == 2 and not os.path.exists(f"{folder}/tried"):
                open(f"{folder}/tried", "w").close()
                raise retry("once")
        for row in rows:
            with open(f"{folder}/sent-{row['id']}-{uuid.uuid4().hex}", "w") as f:
                f.write("wrapped" if isinstance(row, dict) else "plain")

    df = readers.from_rows(spark, [(1, "x"), (2, "y"), (3, "z"), (4, "w")], "id long, v string").coalesce(1)
    batches.retry_sink(lambda: folder, send, "id", dead, threshold=2, attempts=2, delay_seconds=0)(df, 0)
    sent = sorted((p.name.split("-")[1], p.read_text()) for p in tmp_path.glob("sent-*"))
    assert sent == [("1", "plain"), ("2", "plain"), ("3", "wrapped")]
    assert rows(spark.read.parquet(dead).select("id", "document")) == [("4", '{"data": {"id": 4, "v": "w"}}')]

    def broken(client, rows):
        raise ValueError("no")

    with pytest.raises(Exception, match="no"):
        batches.retry_sink(lambda: None, broken, "id", fresh_dir(spark, "dead"), delay_seconds=0)(df, 0)


def test_upserts_need_an_order_for_repeated_keys(spark):
    df = readers.from_rows(spark, [(1, 1), (1, 2), (2, 3)], "k int, o int")
    with pytest.raises(Exception, match="several rows of one key"):
        batches.upsert_sink(fresh_dir(spark, "u"), ["k"])(df, 0)
    path = fresh_dir(spark, "u")
    batches.upsert_sink(path, ["k"], ["o"])(df, 0)
    assert rows(batches.read_upserted(spark, path, ["k"])) == [(1, 2), (2, 3)]


def test_tsv_keeps_all_characters(spark):
    texts = ["a\tb", "line\nbreak\r", "back\\slash \\t \\\\n", "\u00e9 \u6f22 \U0001f600", "\\", "plain", '"quoted" text']
    path = fresh_dir(spark, "tsv")
    source = readers.from_rows(spark, list(enumerate(texts)), "n bigint, comment string")
    source.withColumn("comment", escape_tsv(F.col("comment"))).write.csv(
        path, sep="\t", header=True, quote="\u0000", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    back = readers.read_tsv_with_names(spark, path, {"n": "bigint", "comment": "string"}, escaped=True)
    assert rows(back) == sorted(enumerate(texts), key=repr)


def test_small_rows_are_part_of_the_plan(spark):
    df = readers.small_rows(spark, [("a", 1), (None, 2)], "name string, n int")
    assert rows(df) == rows(readers.from_rows(spark, [("a", 1), (None, 2)], "name string, n int"))
    assert "ExistingRDD" not in df._jdf.queryExecution().toString()
    assert readers.small_rows(spark, [], "n int").count() == 0


def test_no_local_folder_on_a_cluster():
    class Session:
        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session)


def test_clients_inside_tasks(spark, tmp_path):
    folder = str(tmp_path)

    def open_client():
        import uuid

        class Client:
            def lpush(self, key, value):
                with open(f"{folder}/list-{key}-{uuid.uuid4().hex}", "w") as f:
                    f.write(str(value))

        return Client()

    def open_callback():
        import uuid

        def call(text):
            with open(f"{folder}/json-{uuid.uuid4().hex}", "w") as f:
                f.write(text)

        return call

    def send(client, buffer):
        import uuid

        with open(f"{folder}/size-{uuid.uuid4().hex}", "w") as f:
            f.write(str(len(buffer)))

    df = readers.from_rows(spark, [("a", 1), ("a", 2), ("b", 3)], "k string, v long")
    batches.list_push_sink(open_client, "k", "v")(df, 0)
    assert sorted(p.read_text() for p in tmp_path.glob("list-a-*")) == ["1", "2"]
    batches.json_callback_sink(open_callback)(df, 0)
    assert {json.loads(p.read_text())["v"] for p in tmp_path.glob("json-*")} == {1, 2, 3}
    batches.buffered_sink(lambda: None, send, threshold=4)(spark.range(10).coalesce(1), 0)
    assert sorted(p.read_text() for p in tmp_path.glob("size-*")) == ["2", "4", "4"]
