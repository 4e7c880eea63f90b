"""Stored stream states: merging in the background, replays, range reads, changes in any order."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from candlewick.operators import candles as cd
from candlewick.streaming.store import CandleStore, StateStore

TICK = "symbol string, price double, volume double, timestamp timestamp, seq long"
CHANGE = "before struct<id:int,v:int>, after struct<id:int,v:int>, op string, at int"
START = dt.datetime(2024, 1, 1, 9, 30)


def _ticks(n, seed=1, months=4):
    rng = random.Random(seed)
    return [(rng.choice("AB"), float(rng.randrange(1, 50)), 1.0, START + dt.timedelta(days=rng.randrange(30 * months), minutes=rng.randrange(5)), i) for i in range(n)]


def _same(store, spark, rows):
    assert sorted(store.candles().collect()) == sorted(cd.candles(spark.createDataFrame(rows, TICK)).collect())


def test_merged_batches_give_the_same_candles_in_few_folders(spark, tmp_path):
    store = CandleStore(spark, str(tmp_path / "c"), fan=3)
    sink, rows = store.candle_sink(), _ticks(270)
    for i in range(27):
        sink(spark.createDataFrame(rows[10 * i : 10 * i + 10], TICK), i)
    _same(store, spark, rows)
    pieces = [p for p in (tmp_path / "c" / "pieces").iterdir()]
    assert len(pieces) <= 2 * 3 * 4 and len(store.live()) <= 3 + 2 * 3
    assert len(list((tmp_path / "c" / "manifests").glob("*.json"))) <= 2


def test_a_batch_written_again_counts_once(spark, tmp_path):
    store = CandleStore(spark, str(tmp_path / "c"), fan=2)
    sink, rows = store.candle_sink(), _ticks(60)
    for i in range(6):
        for _ in range(1 + i % 2):
            sink(spark.createDataFrame(rows[10 * i : 10 * i + 10], TICK), i)
    for old in (0, 3):  # runs hold them already
        sink(spark.createDataFrame(rows[10 * old : 10 * old + 10], TICK), old)
    _same(store, spark, rows)


@pytest.mark.parametrize("step", ["_write", "_commit", "_delete"])
def test_a_failure_while_merging_loses_nothing(spark, tmp_path, monkeypatch, step):
    store = CandleStore(spark, str(tmp_path / "c"), fan=2)
    sink, rows = store.candle_sink(), _ticks(80)
    failed = []

    def broken(self, *args):
        if (step != "_write" or args[1].startswith("r-")) and len(failed) < 2:
            failed.append(step)
            raise RuntimeError("lost")
        return original(self, *args)

    original = getattr(CandleStore, step)
    monkeypatch.setattr(CandleStore, step, broken)
    for i in range(8):
        for _ in range(3):  # the stream repeats a batch that failed
            try:
                sink(spark.createDataFrame(rows[10 * i : 10 * i + 10], TICK), i)
                break
            except RuntimeError:
                _same(store, spark, rows[: 10 * i + 10])
    assert failed
    _same(store, spark, rows)


def test_empty_batches_and_an_empty_store(spark, tmp_path):
    store = CandleStore(spark, str(tmp_path / "c"), fan=2)
    with pytest.raises(ValueError):
        store.candles()
    none = spark.createDataFrame([], TICK)
    for i in range(6):
        store.candle_sink()(none if i != 3 else spark.createDataFrame(_ticks(5), TICK), i)
    _same(store, spark, _ticks(5))


def test_a_range_reads_its_months_only(spark, tmp_path, capsys):
    store, rows = CandleStore(spark, str(tmp_path / "c")), _ticks(400)
    store.candle_sink()(spark.createDataFrame(rows, TICK), 0)
    found = store.candles("2024-02-10", "2024-03-05 12:00:30", "A")
    chosen = [r for r in rows if r[0] == "A" and dt.datetime(2024, 2, 10) <= r[3] <= dt.datetime(2024, 3, 5, 12, 0, 59)]
    assert sorted(found.collect()) == sorted(cd.candles(spark.createDataFrame(chosen, TICK)).collect())
    found.explain("formatted")
    plan = capsys.readouterr().out
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert ">= 202402" in filters and "<= 202403" in filters
    assert {f.split("ym=")[1][:6] for f in found.inputFiles()} <= {"202401", "202402", "202403", "202404", "202405"}


def test_raw_ticks_of_a_range_are_pruned_by_month(spark, tmp_path, capsys):
    from candlewick.streaming import live

    live.tick_sink(str(tmp_path / "t"))(spark.createDataFrame(_ticks(50), TICK), 0)
    cd.between(spark.read.parquet(str(tmp_path / "t")), "2024-02-01", "2024-02-20").explain("formatted")
    assert any("PartitionFilters" in line and "202402" in line for line in capsys.readouterr().out.splitlines())


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_in_any_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    events, alive = [], {}
    for at in range(200):
        key, op = rng.randrange(12), rng.choice("ccuud")
        events.append((((key, 0), None) if op == "d" else (None, (key, at))) + (op, at))
        alive.pop(key, None)
        if op != "d":
            alive[key] = at
    rng.shuffle(events)
    events.append((None, None, "u", 500))
    store = StateStore(spark, str(tmp_path / "s"), "id", ["at"], slots=3, fan=2)
    sink = store.change_sink()
    for i in range(5):
        for _ in range(2):
            sink(spark.createDataFrame(events[i::5], CHANGE), i)
    assert {(r.id, r.v) for r in store.current().collect()} == set(alive.items())


def test_a_late_older_change_does_not_bring_a_deleted_row_back(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"), "id", ["at"], fan=2)
    batches = [[(None, (1, 1), "c", 1)], [((1, 1), None, "d", 9)], [(None, (2, 2), "c", 3)], [(None, (1, 5), "u", 5)], [(None, (3, 1), "c", 2)]]
    for i, rows in enumerate(batches):
        store.change_sink()(spark.createDataFrame(rows, CHANGE), i)
    assert {r.id for r in store.current().collect()} == {2, 3}
    assert store.states().filter(F.col("op") == "d").count() == 1
