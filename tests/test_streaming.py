"""Streams over files: all that is there, then compare with batch."""

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import DataFrame, functions as F
from functools import reduce

from candlewick.operators import candles as cd
from candlewick.plans.catalogue.registry import scratch_lake
from candlewick.schemas import QUOTE_IMAGE, TICK_IMAGE
from candlewick.sources.landing import quotes
from candlewick.streaming import decode, live

TICK = "symbol string, price double, volume double, timestamp timestamp, seq long"
START = dt.datetime(2024, 1, 1, 9, 30)


def _event(op, i, symbol="A", price=1.0, ms=1704101400000, side="after"):
    image = {"id": i, "symbol": symbol, "price": price, "volume": 2, "timestamp": ms}
    return json.dumps({"before": None, "after": None, "op": op, side: image})


def _lines(spark, tmp_path, name, lines):
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    return str(folder)


def test_decoding(spark):
    lines = [_event("c", 1), _event("r", 2), _event("u", 3), _event("d", 4, side="before"), "{broken", _event("c", 5, symbol="")]
    df = spark.createDataFrame([(x,) for x in lines], "payload string")
    good, broken = decode.split_broken(decode.json_envelopes(df, TICK_IMAGE))
    assert broken.count() == 1 and good.count() == 5
    rows = decode.tick_rows(good, keep=["after.id"]).collect()
    assert sorted(r.id for r in rows) == [1, 2, 5]
    assert rows[0].timestamp == dt.datetime(2024, 1, 1, 9, 30) and rows[0].volume == 2.0


def test_quote_rows_want_a_symbol(spark):
    image = {"id": 1, "current_price": 5.0, "timestamp": 1704101400123456}
    lines = [json.dumps({"op": op, "after": {**image, "symbol": s}}) for op, s in (("c", "A"), ("c", ""), ("r", "B"), ("c", None))]
    df = spark.createDataFrame([(x,) for x in lines], "payload string")
    rows = decode.quote_rows(decode.json_envelopes(df, QUOTE_IMAGE)).collect()
    assert [(r.symbol, r.current_price, r.high, r.timestamp.microsecond) for r in rows] == [("A", 5.0, None, 123456)]


def test_topic_form(spark):
    record = "db.public.quotes.Value"
    after = {record: {"symbol": {"string": "A"}, "current_price": {"double": 7.5}, "timestamp": {"long": 1704101400000000}}}
    lines = [json.dumps({"value": {"op": "c", "after": after}}), json.dumps({"value": {"op": "d", "after": None}}), "nope"]
    df = spark.createDataFrame([(x,) for x in lines], "payload string")
    good, broken = decode.split_broken(decode.topic_envelopes(df, record))
    rows = decode.quote_rows(good).collect()
    assert broken.count() == 1
    assert [(r.symbol, r.current_price, r.low, r.timestamp) for r in rows] == [("A", 7.5, None, START)]


def test_quotes(spark):
    lines = ['{"c": 5.5, "h": 6, "l": 5, "o": 5.2, "pc": 5.1, "d": 0.4, "dp": 7.8, "t": 1704101400}', '{"c": 0}', '{"h": 1}', '{"c": 2}', "x"]
    df = spark.createDataFrame([("A", x) for x in lines], "symbol string, payload string")
    now = F.lit("2030-01-01").cast("timestamp")
    rows = sorted(quotes(df, now=now).collect(), key=lambda r: r.current_price)
    assert [(r.current_price, r.timestamp) for r in rows] == [(2.0, dt.datetime(2030, 1, 1)), (5.5, START)]
    assert rows[1].previous_close == 5.1 and rows[1].percent_change == 7.8


def test_candle_ties_and_edges(spark):
    rows = [
        ("A", 2.0, 1.0, START, 2),
        ("A", 1.0, 1.0, START, 1),
        ("A", 9.0, 1.0, START + dt.timedelta(seconds=59), 3),
        ("A", 4.0, 1.0, START + dt.timedelta(seconds=59), 4),
        ("A", 7.0, 1.0, START + dt.timedelta(seconds=60), 5),
    ]
    out = sorted(cd.candles(spark.createDataFrame(rows, TICK)).collect(), key=lambda r: r.time_bucket)
    assert [tuple(r)[2:] for r in out] == [(1.0, 9.0, 1.0, 4.0, 4.0), (7.0, 7.0, 7.0, 7.0, 1.0)]


tick_rows = st.lists(
    st.tuples(st.sampled_from("AB"), st.integers(1, 50), st.integers(0, 180), st.integers(0, 3)), min_size=1, max_size=25
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(tick_rows)
def test_any_split_of_partials_gives_the_same_candles(spark, rows):
    data = [(s, float(p), 1.0, START + dt.timedelta(seconds=sec), i, part) for i, (s, p, sec, part) in enumerate(rows)]
    df = spark.createDataFrame(data, TICK + ", part int")
    states = reduce(DataFrame.unionByName, [cd.partials(df.filter(F.col("part") == i)) for i in range(4)])
    merged_twice = cd.read_candles(cd.merge_partials(states))
    assert sorted(merged_twice.collect()) == sorted(cd.candles(df).collect())


def test_late_ticks_reach_their_candle(spark, tmp_path):
    """A second run of the stream brings a tick of an old minute."""
    out, seen = str(tmp_path / "out"), str(tmp_path / "seen")
    base = 1704101400000

    def run():
        ticks = decode.tick_rows(
            decode.json_envelopes(decode.file_stream(spark, str(tmp_path / "in"))).drop(decode.CORRUPT),
            keep=[F.col("after.id").cast("long").alias("seq")],
        )
        live.start(ticks, live.partial_sink(out), seen).awaitTermination()

    _lines(spark, tmp_path, "1.txt", [_event("c", 2, price=5.0, ms=base + 1000), _event("c", 3, price=6.0, ms=base + 120000)])
    run()
    _lines(spark, tmp_path, "2.txt", [_event("c", 1, price=9.0, ms=base)])
    run()
    rows = sorted(live.stored_candles(spark.read.parquet(out)).collect(), key=lambda r: r.time_bucket)
    assert [(r.open, r.high, r.low, r.close, r.volume) for r in rows] == [(9.0, 9.0, 5.0, 5.0, 4.0), (6.0, 6.0, 6.0, 6.0, 2.0)]


def test_replayed_batch_counts_once(spark, tmp_path):
    rows = [("A", 1.0, 3.0, START, 1), ("A", 2.0, 4.0, START, 2)]
    df = spark.createDataFrame(rows, TICK)
    sink = live.partial_sink(str(tmp_path / "p"))
    for _ in range(2):
        sink(df, 7)
    assert [r.volume for r in live.stored_candles(spark.read.parquet(str(tmp_path / "p"))).collect()] == [7.0]


def test_tick_table(spark, tmp_path):
    df = spark.createDataFrame([("B", 1.0, 1.0, START, 1), ("A", 2.0, 1.0, START + dt.timedelta(days=31), 2)], TICK)
    live.tick_sink(str(tmp_path / "t"))(df, 0)
    back = spark.read.parquet(str(tmp_path / "t"))
    assert {(r.symbol, r.ym) for r in back.collect()} == {("B", 202401), ("A", 202402)}
    assert back.filter("ingested_at is null").count() == 0


def test_broken_messages(spark, tmp_path):
    lines = [_event("c", 1)] + ["{broken"] * 3
    df = decode.json_envelopes(spark.createDataFrame([(x,) for x in lines], "payload string"))
    seen = []
    sink = live.guarded_sink(lambda batch, i: seen.append(batch.count()), str(tmp_path / "r"), most_broken=3)
    sink(df, 0)
    assert seen == [1] and spark.read.parquet(str(tmp_path / "r")).count() == 3
    with pytest.raises(live.TooManyBroken):
        live.guarded_sink(lambda batch, i: None, str(tmp_path / "r"), most_broken=2)(df, 1)


def test_current_state(spark):
    lake = scratch_lake(spark)
    sink = live.state_sink(lake, "silver.state", "symbol", ["at"])

    def batch(*events):
        df = spark.createDataFrame([(x, i) for i, x in enumerate(events)], "payload string, at int")
        return decode.json_envelopes(df).drop(decode.CORRUPT)

    sink(batch(_event("c", 1, "A", 1.0), _event("c", 2, "B", 2.0), _event("u", 1, "A", 3.0)), 0)
    second = batch(_event("d", 2, "B", side="before"), _event("c", 3, "C", 4.0), _event("c", 9, "D"), _event("d", 9, "D", side="before"))
    for _ in range(2):  # a replay changes nothing
        sink(second, 1)
    assert {(r.symbol, r.price) for r in lake.read("silver.state").collect()} == {("A", 3.0), ("C", 4.0)}


def test_watermark_bounds_state(spark, tmp_path):
    path = str(tmp_path / "ticks")
    spark.createDataFrame([("A", 1.0, 1.0, START, 1), ("A", 3.0, 1.0, START, 2)], TICK).write.parquet(path)
    stream = spark.readStream.schema(TICK).parquet(path)
    got = []
    candles = live.windowed_candles(stream)
    query = candles.writeStream.outputMode("update").foreachBatch(lambda b, i: got.extend(b.collect()))
    query.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert [(r.open, r.close, r.volume) for r in got] == [(1.0, 3.0, 2.0)]
