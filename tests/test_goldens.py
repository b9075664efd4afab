"""Small inputs with known results."""

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from tidemark.functions import text, times
from tidemark.operators import aggs, joins, patterns, routing, windows
from tidemark.operators.history import lowest, running
from tidemark.plans.joining import chained
from tidemark.sources.readers import from_rows, named_rows

# The opening of a well-known soliloquy, the usual word-count input.
LINES = """To be, or not to be,--that is the question:--
Whether 'tis nobler in the mind to suffer
The slings and arrows of outrageous fortune
Or to take arms against a sea of troubles,
And by opposing end them?--To die,--to sleep,--
No more; and by a sleep to say we end
The heartache, and the thousand natural shocks
That flesh is heir to,--'tis a consummation
Devoutly to be wish'd. To die,--to sleep;--
To sleep! perchance to dream:--ay, there's the rub;
For in that sleep of death what dreams may come,
When we have shuffled off this mortal coil,
Must give us pause: there's the respect
That makes calamity of so long life;
For who would bear the whips and scorns of time,
The oppressor's wrong, the proud man's contumely,
The pangs of despis'd love, the law's delay,
The insolence of office, and the spurns
That patient merit of the unworthy takes,
When he himself might his quietus make
With a bare bodkin? who would these fardels bear,
To grunt and sweat under a weary life,
But that the dread of something after death,--
The undiscover'd country, from whose bourn
No traveller returns,--puzzles the will,
And makes us rather bear those ills we have
Than fly to others that we know not of?
Thus conscience does make cowards of us all;
And thus the native hue of resolution
Is sicklied o'er with the pale cast of thought;
And enterprises of great pith and moment,
With this regard, their currents turn awry,
And lose the name of action.--Soft you now!
The fair Ophelia!--Nymph, in thy orisons
Be all my sins remember'd.""".split("\n")


def tokens(spark):
    lines = from_rows(spark, list(enumerate(LINES)), "line_no long, line string")
    words = lines.select("line_no", F.posexplode(F.split(F.lower("line"), r"\W+")).alias("pos", "token"))
    return words.where("token <> ''").withColumn("n", F.lit(1).cast("long"))


def test_count_windows_of_ten_by_five(spark):
    out = windows.count_window_slide(tokens(spark), ["token"], ["line_no", "pos"], 10, 5, {"n": running("n")})
    want = [
        ("a", 5), ("and", 10), ("and", 5), ("of", 10), ("of", 10), ("of", 5), ("s", 5), ("sleep", 5),
        ("that", 5), ("the", 10), ("the", 10), ("the", 10), ("the", 5), ("to", 10), ("to", 10), ("to", 5),
    ]
    assert rows(out.select("token", "n")) == sorted(want, key=repr)


def test_count_windows_of_two_by_one(spark):
    out = rows(windows.count_window_slide(tokens(spark), ["token"], ["line_no", "pos"], 2, 1, {"n": running("n")}).select("token", "n"))
    for pair in [("them", 1), ("to", 2), ("die", 1), ("sleep", 1), ("no", 1), ("more", 1), ("and", 2), ("by", 2), ("a", 2), ("end", 2)]:
        assert pair in out


def test_count_windows_with_odd_steps(spark):
    df = from_rows(spark, [(1, i) for i in range(1, 21)], "k long, i long")
    out = windows.count_window_slide(df, ["k"], ["i"], 5, 3, {"s": running("i")})
    assert rows(out.select("at_row", "s")) == sorted(
        ((f, sum(range(max(1, f - 4), f + 1))) for f in range(3, 21, 3)), key=repr
    )
    gaps = windows.count_window_slide(df, ["k"], ["i"], 2, 5, {"s": running("i")})
    assert rows(gaps.select("at_row", "s")) == sorted(((f, 2 * f - 1) for f in range(5, 21, 5)), key=repr)


def test_token_and_side_output_counts(spark):
    all_tokens = tokens(spark)
    assert all_tokens.count() == 287 and all_tokens.select("token").distinct().count() == 170
    kept, rejected = routing.side_output(all_tokens, F.length("token") > 5, F.format_string("rejected: %s", "token"))
    assert kept.count() + rejected.count() == 287
    messages = {r["message"] for r in rejected.collect()}
    assert {"rejected: question", "rejected: whether", "rejected: nobler", "rejected: suffer"} <= messages


def test_sessions_keep_the_first_time(spark):
    data = [("a", 1, 1), ("b", 1, 1), ("b", 3, 1), ("b", 5, 1), ("c", 6, 1), ("a", 10, 1), ("c", 11, 1)]
    df = from_rows(spark, data, "key string, ms long, n long").withColumn("ts", times.millis_to_ntz(F.col("ms")))
    out = windows.session_agg(df, ["key"], "ts", "3 milliseconds", {"ms": lowest("ms"), "n": running("n")})
    assert rows(out.select("key", "ms", "n")) == [("a", 1, 1), ("a", 10, 1), ("b", 1, 3), ("c", 11, 1), ("c", 6, 1)]


def test_averages_of_two(spark):
    df = from_rows(spark, [(1, o, v) for o, v in enumerate([3, 5, 7, 4, 2])], "k long, o long, v long")
    out = windows.count_window(df, ["k"], ["o"], 2, {"total": running("v")})
    assert rows(out.select("k", F.expr("total div 2"))) == [(1, 4), (1, 5)]


def test_rule_matches_of_shapes(spark):
    items = [
        ("red", "triangle"), ("red", "rectangle"), ("red", "square"), ("green", "triangle"), ("green", "rectangle"),
        ("green", "square"), ("blue", "rectangle"), ("blue", "square"), ("blue", "triangle"),
    ]
    table = [("stabilized", "triangle", "rectangle"), ("beautiful", "rectangle", "square"), ("ugly", "square", "triangle")]
    df = from_rows(spark, [(i, c, s) for i, (c, s) in enumerate(items)], "o long, color string, shape string")
    rules = from_rows(spark, table, "rule string, first string, second string")
    out = patterns.rule_sequence_match(df, rules, ["color"], ["o"], "shape")
    assert rows(out.select("color", "rule")) == [
        ("blue", "beautiful"), ("blue", "ugly"), ("green", "beautiful"), ("green", "stabilized"),
        ("red", "beautiful"), ("red", "stabilized"),
    ]


def test_union_all_of_orders(spark):
    schema = "user long, product string, amount int"
    a = from_rows(spark, [(1, "beer", 3), (1, "diaper", 4), (3, "rubber", 2)], schema)
    b = from_rows(spark, [(2, "pen", 3), (2, "rubber", 3), (4, "beer", 1)], schema)
    out = routing.union_all(routing.filter_rows(a, "amount > 2"), routing.filter_rows(b, "amount < 2"))
    assert rows(out.select("product", "amount")) == [("beer", 1), ("beer", 3), ("diaper", 4)]


def test_word_seen_twice(spark):
    df = from_rows(spark, [("hello", 1), ("spark", 1), ("hello", 1)], "word string, frequency int")
    out = routing.having(df, ["word"], {"frequency": F.sum("frequency")}, "frequency = 2")
    assert rows(out) == [("hello", 2)]


def test_named_rows_and_projection(spark):
    named_rows(spark, [(1, 11, "x"), (2, 22, "y"), (3, 33, "z")], "a int, b long, c string", "named")
    assert rows(routing.project(spark.table("named"), ["a", "c"])) == [(1, "x"), (2, "y"), (3, "z")]


def table(spark, keys, offset):
    base = dt.datetime(1970, 1, 1)
    data = [(1000 + k, base + dt.timedelta(seconds=5 * i + offset)) for i in range(12) for k in range(1, keys + 1)]
    return from_rows(spark, data, "key long, ts timestamp_ntz")


def test_chained_windows(spark):
    out = chained(table(spark, 5, 0), table(spark, 1, 10), "key", "ts", "5 seconds", "10 seconds", "20 seconds")
    start = dt.datetime(1970, 1, 1)
    assert rows(out.select("window_start", "correct")) == [
        (start, 4), (start + dt.timedelta(seconds=20), 4), (start + dt.timedelta(seconds=40), 4)
    ]


def test_window_row_time_and_cumulate(spark):
    df = from_rows(spark, [(dt.datetime(2024, 1, 1, 1, 30),)], "ts timestamp_ntz")
    row = windows.window_rows(df, "tumble", "ts", "1 hour").first()
    assert row["window_time"] == dt.datetime(2024, 1, 1, 1, 59, 59, 999000)
    ends = [r["window_end"].hour for r in windows.window_rows(df, "cumulate", "ts", "6 hours", "1 hour").collect()]
    assert sorted(ends) == [2, 3, 4, 5, 6]


def test_each_row_is_in_size_by_slide_windows(events):
    hopped = windows.hop(events, "ts", "10 minutes", "1 hour")
    assert hopped.count() == 6 * events.count()


def test_pv_uv_with_a_slide_that_does_not_divide_the_size(events):
    got = aggs.pv_uv(events, "ts", "user_id", "1 hour", "25 minutes")
    want = events.groupBy(F.window("ts", "1 hour", "25 minutes").alias("w")).agg(
        F.count("*").alias("pv"), F.countDistinct("user_id").alias("uv")
    ).select("w.start", "w.end", "pv", "uv")
    assert rows(got) == rows(want)


def test_hop_agg_equals_hop(events):
    got = windows.hop_agg(events, "ts", "25 minutes", "1 hour", {"n": running(F.lit(1))}, ["event_type"])
    want = windows.hop(events, "ts", "25 minutes", "1 hour").groupBy("event_type", "window").agg(F.count("*").alias("n"))
    assert rows(got) == rows(want.select("event_type", "window.start", "window.end", "n"))


def test_processing_time_window(events):
    out = windows.tumble_processing_time(events.limit(5), "1 day").select("window").distinct()
    row = out.first()["window"]
    assert row["start"] <= dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) < row["end"]


def test_window_join_pairs(spark):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    grades = from_rows(spark, [("tom", 1, at(0)), ("tom", 2, at(1)), ("ann", 3, at(3))], "name string, grade int, a timestamp_ntz")
    pays = from_rows(spark, [("tom", 10, at(1)), ("tom", 20, at(2)), ("ann", 30, at(2))], "name string, pay int, b timestamp_ntz")
    out = joins.window_join(grades, pays, ["name"], "a", "b", "2 seconds")
    assert rows(out.select("name", "grade", "pay")) == [("ann", 3, 30), ("tom", 1, 10), ("tom", 2, 10)]


def test_interval_join_bounds(spark):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    left = from_rows(spark, [(1, s, at(s)) for s in range(0, 40, 5)], "k int, l int, lts timestamp_ntz")
    right = from_rows(spark, [(1, 10, at(10)), (2, 10, at(10))], "k int, r int, rts timestamp_ntz")
    out = joins.interval_join(left, right, ["k"], "lts", "rts", "-5 seconds", "10 seconds")
    assert rows(out.select("l", "r")) == [(10, 10), (15, 10), (20, 10), (5, 10)]


def test_previous_day_has_gaps(spark):
    days = [dt.datetime(2024, 1, d) for d in (1, 1, 2, 4)]
    df = from_rows(spark, [("a", d) for d in days], "k string, ts timestamp_ntz")
    out = patterns.compare_with_previous_day(df, ["k"], "ts", F.count("*"))
    assert rows(out.select("today", "previous_day")) == [(1, 2), (1, None), (2, None)]


def test_max_by_row_takes_the_first_on_ties(spark):
    df = from_rows(spark, [(1, 0, 5), (1, 1, 9), (1, 2, 9)], "k int, o int, speed int")
    assert rows(aggs.max_by_row(df, ["k"], "speed", ["o"]).select("o", "speed")) == [(1, 9)]


def test_text_expressions(spark):
    df = from_rows(spark, [(-1, ["b"], 0), (16909060, ["a", "a"], 2), (2130706433, ["a"], 5)], "n int, a array<string>, v int")
    assert [r[0] for r in df.select(text.dotted_ipv4(F.col("n"))).collect()] == ["255.255.255.255", "1.2.3.4", "127.0.0.1"]
    assert [r["a"] for r in df.orderBy(text.size_then_items(F.col("a"))).collect()] == [["a"], ["b"], ["a", "a"]]
    assert [r[0] for r in df.select(text.text_bar(F.col("v"), 0, 4, 8)).collect()] == ["", "████", "████████"]


def test_time_expressions(spark):
    df = from_rows(spark, [(dt.datetime(2024, 3, 9, 7, 45, 1),)], "ts timestamp_ntz")
    out = df.select(times.ten_minute_label(F.col("ts")), times.day_label(F.col("ts")), times.compact_day(F.col("ts"))).first()
    assert tuple(out) == ("07:40", "2024-03-09", "20240309")
    assert times.micros("2500 milliseconds") == 2_500_000


def test_parsing(spark):
    lines = from_rows(spark, [("(0,55,15.277777777777777,1424951918630)",)], "line string")
    out = routing.parse_tuple_text(lines, "line", {"car": "int", "speed": "int", "distance": "double", "ms": "long"})
    assert rows(out) == [(0, 55, 15.277777777777777, 1424951918630)]
    assert rows(routing.parse_csv_pair(from_rows(spark, [("a,12",)], "line string"), "line")) == [("a", 12)]


def test_placement(spark):
    ids = spark.range(100)
    placed = routing.custom_partition(ids, F.pmod("id", F.lit(2)), 2).withColumn("p", F.spark_partition_id())
    assert placed.where("p <> id % 2").count() == 0
    assert routing.key_by(ids, "id").rdd.getNumPartitions() >= 1
    copies = routing.broadcast_rows(spark.range(3), 4).withColumn("p", F.spark_partition_id())
    assert copies.count() == 12 and copies.where("p <> partition").count() == 0
