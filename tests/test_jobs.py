"""Versions, profiles, and the jobs from landing to features."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlewick.operators import profile as pf, shaping as sh, versions as vs
from candlewick.plans import jobs, runner
from candlewick.plans.catalogue.registry import scratch_lake
from candlewick.schemas import BARS, NEWS_RAW, PRICE_FEATURES

DAY = dt.date(2024, 1, 1)


def _versions(spark):
    rows = [(1, 1, False, "a"), (1, 2, True, "b"), (2, 1, True, "c")]
    return spark.createDataFrame(rows, "job_id int, version_id int, is_active boolean, config string")


def _set(df):
    return {tuple(r) for r in df.collect()}


def test_new_versions(spark):
    arriving = spark.createDataFrame([(1, "B"), (7, "z")], "job_id int, config string")
    out = vs.with_new_versions(_versions(spark), arriving, ["job_id"])
    assert _set(out.select("job_id", "version_id", "is_active", "config")) == {
        (1, 1, False, "a"),
        (1, 2, False, "b"),
        (1, 3, True, "B"),
        (2, 1, True, "c"),
        (7, 1, True, "z"),
    }


def test_activate(spark):
    chosen = spark.createDataFrame([(1, 1)], "job_id int, version_id int")
    out = vs.activated(_versions(spark), chosen, ["job_id"])
    assert _set(out.select("job_id", "version_id", "is_active")) == {(1, 1, True), (1, 2, False), (2, 1, True)}


def test_change_detection_treats_nulls_as_equal(spark):
    stored = spark.createDataFrame([("a", 1, None), ("b", 1, "x")], "name string, port int, props string")
    arriving = spark.createDataFrame([("a", 1, None), ("b", 1, None), ("c", 1, "x")], stored.schema)
    out = vs.changed(stored, arriving, ["name"], ["port", "props"])
    assert _set(out.select("name", "action")) == {("a", "Existed"), ("b", "Updated"), ("c", "Created")}


def test_keep_first_is_deterministic(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "z"), ("k", 1, "a")], "k string, t int, u string")
    assert _set(vs.keep_first(df, ["k"], ["t", "u"])) == {("k", 1, "a")}


def test_uniqueness(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", None), (3, None, None)], "id int, t string, empty string")
    got = {r.column_name: r.distinct_ratio for r in pf.uniqueness(df).collect()}
    assert got == {"id": 1.0, "t": 0.5, "empty": None}
    assert pf.primary_keys(df) == ["id"] and pf.primary_keys(df, ["t"]) == ["t"]
    assert {r.column_name for r in pf.key_candidates(df, approximate=True).collect()} == {"id"}


def test_profile_and_preview(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, `odd.name` string")
    got = {r.column_name: (r.data_type, r.null_count, r.distinct_count) for r in pf.profile(df).collect()}
    assert got == {"id": ("int", 0, 2), "odd.name": ("string", 1, 1)}
    shown = pf.preview(spark.range(40))
    assert (shown.columns, shown.row_count, shown.rows.count()) == (["id"], 15, 15)
    assert _set(pf.columns_of(df)) == {("id", "int"), ("odd.name", "string")}


def test_catalog_listing(spark):
    lake = scratch_lake(spark)
    lake.overwrite(spark.range(1), "gold.one")
    tables = pf.table_list(spark)
    counts = {r.schema_name: (r.tables, r.table_count) for r in pf.tables_per_schema(tables).collect()}
    assert counts[f"{lake.prefix}gold"] == (["one"], 1)


def test_available_columns_warn(spark, caplog):
    df = spark.createDataFrame([(1.0, 2.0)], "RSI double, other double")
    assert sh.available(df, ["MA_20", "RSI"]).columns == ["RSI"]
    assert "MA_20" in caplog.text


def _landed(spark):
    rows = [
        (DAY + dt.timedelta(days=i), 10.0 + i, 11.0 + i, 9.0 + i, 10.5 + i, 100.0, t) for t in ("NVDA", "MSFT", "IBM") for i in range(4)
    ]
    # The news of 2 January, 10:00 in New York, belongs to 3 January.
    news = [
        (dt.datetime(2024, 1, 2, 15), "https://a.com/nvidia-record-growth", "", "", "", ""),
        (dt.datetime(2024, 1, 2, 15), "https://a.com/nvidia-weak-quarter", "", "", "", ""),
        (dt.datetime(2024, 1, 2, 15), "https://a.com/microsoft-gains-again", "", "", "", ""),
    ]
    return spark.createDataFrame(rows, BARS), spark.createDataFrame(news, NEWS_RAW)


@pytest.mark.parametrize("partition_by", [(), ("date",)])
def test_full_run(spark, partition_by):
    bars, news = _landed(spark)
    run = runner.Run(scratch_lake(spark), jobs.Settings(partition_by=partition_by), bars=bars, news=news)
    for _ in range(2):  # the second run updates in place
        results = runner.run_jobs(runner.SEQUENCES["full"], run)
        assert results == {name: {"success": True} for name in ("bronze", "silver", "gold")}
    lake, tables = run.lake, run.settings.tables
    assert lake.count(tables.bars) == lake.count(tables.indicators) == lake.count(tables.features) == 12
    assert lake.count(tables.news) == 3
    features = lake.read(tables.features)
    assert set(PRICE_FEATURES) <= set(features.columns)
    rows = {(r.ticker, r.date): r for r in features.collect()}
    scored = rows[("NVDA", dt.date(2024, 1, 3))]
    assert (scored.sentiment_sum, scored.polarity_ratio) == (0.0, 0.5)
    other = rows[("IBM", dt.date(2024, 1, 3))]
    assert (other.sentiment_sum, other.polarity_ratio) == (0.0, 0.0)
    assert rows[("MSFT", dt.date(2024, 1, 3))].polarity_ratio == 1.0
    newest = rows[("MSFT", dt.date(2024, 1, 4))]
    assert newest.next_day_return is None and rows[("MSFT", dt.date(2024, 1, 3))].next_day_return == newest.Return


def test_company_names_map_back(spark):
    indicators = spark.createDataFrame([(DAY, "NVDA", 0.5)], "date date, ticker string, Return double")
    sentiment = spark.createDataFrame([(DAY, "Nvidia", 2.0, 1.0)], "date date, ticker string, sentiment_sum double, polarity_ratio double")
    assert jobs.gold_features(indicators, sentiment, jobs.Settings()).first().sentiment_sum == 2.0


def test_nothing_landed(spark):
    lake = scratch_lake(spark)
    assert jobs.land_bars(lake, None) == 0
    assert jobs.land_news(lake, spark.createDataFrame([], NEWS_RAW)) == 0
    assert not lake.exists("bronze.bars") and not lake.exists("bronze.news_raw")


def test_news_without_match_writes_nothing(spark):
    lake = scratch_lake(spark)
    _, news = _landed(spark)
    jobs.land_news(lake, news.filter("false").unionByName(news.limit(1).withColumn("source_url", F.lit("https://a.com/nothing-to-see-here"))))
    assert jobs.news_to_titles(lake) == 0
    assert not lake.exists("silver.news")


def test_runner_stops_at_the_first_failure(spark):
    def fail(run):
        raise RuntimeError("broken")

    known = {"a": lambda run: 3, "b": fail, "c": lambda run: 1}
    results = runner.run_jobs(["nope", "a", "b", "c"], runner.Run(scratch_lake(spark)), known)
    assert results == {
        "nope": {"success": False, "error": "unknown job"},
        "a": {"success": True, "rows": 3},
        "b": {"success": False, "error": "broken"},
    }


def test_jdbc_job_checks_its_input(spark):
    lake = scratch_lake(spark)
    with pytest.raises(ValueError):
        jobs.jdbc_to_layer(lake, None, [])
    with pytest.raises(ValueError):
        jobs.SourceTable("public", "a; drop")
    with pytest.raises(ValueError):
        jobs.jdbc_to_layer(lake, None, [jobs.SourceTable("public", "a")], layer="platinum")
