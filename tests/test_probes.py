"""Rows that once gave wrong results: missing values, repeated news, keys without complete rows, headers in another order."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlewick.operators import candles as cd, metrics, mlprep
from candlewick.operators.indicators import ema
from candlewick.plans import jobs, runner
from candlewick.plans.catalogue.registry import scratch_lake
from candlewick.sources.landing import landed_bars


def test_tick_without_sequence_number_opens_and_closes(spark):
    at = dt.datetime(2024, 1, 1, 9, 0, 5)
    ticks = spark.createDataFrame([("a", 5.0, 1.0, at, None)], "symbol string, price double, volume double, timestamp timestamp, seq long")
    row = cd.candles(ticks).first()
    assert (row.open, row.close, row.high, row.low) == (5.0, 5.0, 5.0, 5.0)


def test_missing_predictions_count_nowhere(spark):
    rows = [("t", 0, i, float(i), p) for i, p in enumerate([1.0, 0.5, None, 2.0, 4.0])] + [("t", 0, 9, None, 1.0)]
    schema = "ticker string, fold int, row int, actual double, predicted double"
    both = [r for r in rows if r[3] is not None and r[4] is not None]
    got = metrics.evaluate(spark.createDataFrame(rows, schema)).first().asDict()
    assert got == metrics.evaluate(spark.createDataFrame(both, schema)).first().asDict()
    assert got["n"] == 4
    assert got["ic"] == pytest.approx(metrics.spearman(spark.createDataFrame(rows, schema)).first().ic)


def test_average_over_a_missing_price_stands_still_and_decays(spark):
    rows = [("t", dt.date(2024, 1, d + 1), p) for d, p in enumerate([1.0, None, 4.0])]
    out = ema(spark.createDataFrame(rows, "ticker string, date date, close double"), [3]).orderBy("date").collect()
    assert [round(r.EMA_3, 9) for r in out] == [1.0, 1.0, 3.0]  # (0.25 * 1 + 0.5 * 4) / 0.75


def test_key_without_a_complete_row_is_an_error(spark):
    rows = [("a", dt.date(2024, 1, d), 1.0) for d in (1, 2)] + [("b", dt.date(2024, 1, d), None) for d in (1, 2)]
    df = spark.createDataFrame(rows, "ticker string, date date, x double")
    with pytest.raises(Exception, match="fewer than 2 rows for b"):
        mlprep.newest_window(df, ["x"], 2).collect()
    assert [r.ticker for r in mlprep.newest_window(df, ["x"], 2, short="drop").collect()] == ["a"]


def test_repeated_news_land_once(spark):
    lake = scratch_lake(spark)
    at = dt.datetime(2024, 1, 1)
    news = spark.createDataFrame([(at, "u", "b"), (at, "u", "a"), (at, "v", "c")], "date timestamp, source_url string, themes string")
    assert jobs.land_news(lake, news) == 2
    assert {(r.source_url, r.themes) for r in lake.read("bronze.news_raw").collect()} == {("u", "a"), ("v", "c")}


def test_landed_bars_go_by_header(spark, tmp_path):
    folder = tmp_path / "ticker=T"
    folder.mkdir()
    (folder / "a.csv").write_text("Date,Close,Open,High,Low,Volume\n2024-01-02,4,1,5,0.5,10\n")
    row = landed_bars(spark, str(tmp_path)).first()
    assert (row.open, row.close, row.high, row.low, row.ticker) == (1.0, 4.0, 5.0, 0.5, "T")


def test_averages_of_all_buckets(spark):
    df = spark.range(10_050).select((F.lit("2000-01-01").cast("timestamp") + F.make_dt_interval(days=F.col("id").cast("int"))).alias("t"), F.lit(1.0).alias("v"))
    assert cd.bucket_average(df, "t", "v").count() == 10_050


def test_rules_come_from_a_file(tmp_path):
    path = tmp_path / "rules.json"
    path.write_text('{"T": {"aliases": ["tea"]}}')
    assert runner.rules_from_file(str(path)) == {"T": {"aliases": ["tea"], "blacklist": []}}
