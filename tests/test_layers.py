"""Layer tables: create, overwrite, append, upsert."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlewick.plans.catalogue.registry import scratch_lake
from candlewick.sinks.files import export_csv, write_predictions
from candlewick.sinks.layers import DuplicateKeys, merge_statement, valid_name
from candlewick.sources.tables import Connection, ReadSplit, jdbc_options, local_rows, read_csv

KV = "k int, v string"


@pytest.fixture
def lake(spark):
    return scratch_lake(spark)


def _frame(spark, rows, schema=KV):
    return spark.createDataFrame(rows, schema)


def _content(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert_updates_and_inserts(spark, lake):
    lake.upsert(_frame(spark, [(1, "a"), (2, "b")]), "silver.t", ["k"])
    lake.upsert(_frame(spark, [(2, "B"), (3, "c")]), "silver.t", ["k"])
    assert _content(lake.read("silver.t")) == [(1, "a"), (2, "B"), (3, "c")]


def test_upsert_twice_changes_nothing(spark, lake):
    rows = [(1, "a"), (2, "b")]
    for _ in range(2):
        assert lake.write(_frame(spark, rows), "silver.t", "merge", ["k"]) == 2


def test_null_keys_insert_again(spark, lake):
    for _ in range(2):
        lake.upsert(_frame(spark, [(None, "x"), (1, "a")]), "silver.t", ["k"])
    assert _content(lake.read("silver.t")) == [(1, "a"), (None, "x"), (None, "x")]


@pytest.mark.parametrize("first", [True, False])
def test_duplicate_source_keys_raise(spark, lake, first):
    if not first:
        lake.upsert(_frame(spark, [(9, "z")]), "silver.t", ["k"])
    with pytest.raises(DuplicateKeys):
        lake.upsert(_frame(spark, [(1, "a"), (1, "b")]), "silver.t", ["k"])


def test_empty_source(spark, lake):
    lake.upsert(_frame(spark, [(1, "a")]), "silver.t", ["k"])
    lake.upsert(_frame(spark, []), "silver.t", ["k"])
    assert _content(lake.read("silver.t")) == [(1, "a")]


def test_missing_columns_keep_their_value(spark, lake):
    lake.upsert(_frame(spark, [(1, "a", 10), (2, "b", 20)], "k int, v string, w int"), "silver.t", ["k"])
    lake.upsert(_frame(spark, [(2, 99), (3, 30)], "k int, w int"), "silver.t", ["k"])
    assert _content(lake.read("silver.t")) == [(1, "a", 10), (2, "b", 99), (3, None, 30)]


def test_source_is_computed_once_and_staging_goes(spark, lake):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for frame in batches:
            seen.add(len(frame))
            yield frame

    df = _frame(spark, [(1, "a"), (2, "b")]).mapInPandas(count, KV)
    lake.upsert(df, "silver.t", ["k"])
    assert seen.value == 2
    lake.upsert(df, "silver.t", ["k"])
    assert seen.value == 4
    assert [t.name for t in spark.catalog.listTables(f"{lake.prefix}silver")] == ["t"]


def test_unknown_columns_raise(spark, lake):
    lake.upsert(_frame(spark, [(1, "a")]), "silver.t", ["k"])
    with pytest.raises(ValueError, match="not in the target"):
        lake.upsert(_frame(spark, [(1, "a", 1)], "k int, v string, extra int"), "silver.t", ["k"])


def test_upsert_into_the_null_partition_keeps_its_rows(spark, lake):
    schema, keys = "p string, k int, v string", ["p", "k"]
    lake.upsert(_frame(spark, [(None, 5, "n"), ("x", 1, "a")], schema), "gold.t", keys, ["p"])
    lake.upsert(_frame(spark, [(None, 6, "m"), ("x", 1, "A")], schema), "gold.t", keys)
    got = _content(lake.read("gold.t").select("p", "k", "v"))
    assert got == sorted([(None, 5, "n"), (None, 6, "m"), ("x", 1, "A")], key=str)


def test_partitioned_upsert_leaves_other_partitions_alone(spark, lake):
    schema, keys = "p string, k int, v string", ["p", "k"]
    lake.upsert(_frame(spark, [("x", 1, "a"), ("x", 2, "b"), ("y", 1, "c"), (None, 5, "n")], schema), "gold.t", keys, ["p"])
    files = set(_files(lake, "gold.t", "p=y"))
    lake.upsert(_frame(spark, [("x", 2, "B"), ("z", 1, "d")], schema), "gold.t", keys)
    got = _content(lake.read("gold.t").select("p", "k", "v"))
    assert got == sorted([("x", 1, "a"), ("x", 2, "B"), ("y", 1, "c"), ("z", 1, "d"), (None, 5, "n")], key=str)
    assert set(_files(lake, "gold.t", "p=y")) == files


def test_layout_computed_from_keys(spark, lake):
    def frame(*rows):
        return _frame(spark, list(rows)).withColumn("tens", F.floor(F.col("k") / 10))

    lake.upsert(frame((1, "a"), (2, "b"), (11, "c")), "gold.t", ["k"], ["tens"])
    files = set(_files(lake, "gold.t", "tens=1"))
    lake.upsert(frame((2, "B"), (25, "d")), "gold.t", ["k"], layout_from_keys=True)
    assert _content(lake.read("gold.t").select("k", "v")) == [(1, "a"), (11, "c"), (2, "B"), (25, "d")]
    assert set(_files(lake, "gold.t", "tens=1")) == files


def _files(lake, table, part):
    return [f for f in lake.read(table).inputFiles() if part in f]


def test_modes(spark, lake):
    one, two = _frame(spark, [(1, "a")]), _frame(spark, [(2, "b")])
    assert lake.write(one, "bronze.t", "merge", ["k"]) == 1  # the first write always creates
    assert lake.write(two, "bronze.t", "append") == 2
    assert lake.write(two, "bronze.t", "overwrite") == 1
    with pytest.raises(ValueError, match="keys"):
        lake.write(two, "bronze.t", "merge")
    with pytest.raises(ValueError, match="mode"):
        lake.write(two, "bronze.t", "replace")


def test_overwrite_from_itself(spark, lake):
    lake.overwrite(_frame(spark, [(1, "a"), (2, "b")]), "bronze.t")
    lake.overwrite(lake.read("bronze.t").filter("k = 2"), "bronze.t")
    assert _content(lake.read("bronze.t")) == [(2, "b")]


def test_overwrite_of_a_partitioned_table(spark, lake):
    lake.overwrite(_frame(spark, [(1, "a"), (2, "b")]), "bronze.t", ["v"])
    lake.overwrite(lake.read("bronze.t").unionByName(_frame(spark, [(3, "c")])).filter("k > 1"), "bronze.t", ["v"])
    assert _content(lake.read("bronze.t").select("k", "v")) == [(2, "b"), (3, "c")]
    lake.append(_frame(spark, [(4, "b")]), "bronze.t")
    assert lake.count("bronze.t") == 3
    lake.upsert(_frame(spark, [(2, "z")]), "bronze.t", ["k"])  # the key moves to another partition
    assert _content(lake.read("bronze.t").select("k", "v")) == [(2, "z"), (3, "c"), (4, "b")]


def test_append_matches_columns_by_name(spark, lake):
    lake.overwrite(_frame(spark, [(1, "a")]), "bronze.t")
    lake.append(_frame(spark, [("b", 2)], "v string, k int"), "bronze.t")
    assert _content(lake.read("bronze.t")) == [(1, "a"), (2, "b")]


def test_delete(spark, lake):
    lake.overwrite(_frame(spark, [(1, "a"), (2, "b")]), "bronze.t")
    lake.delete(_frame(spark, [(2,)], "k int"), "bronze.t", ["k"])
    assert _content(lake.read("bronze.t")) == [(1, "a")]


def test_recover_after_a_broken_swap(spark, lake):
    lake.overwrite(_frame(spark, [(1, "a")]), "bronze.t")
    name = lake.name("bronze.t")
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__old_abc")
    assert not lake.exists("bronze.t")
    lake.write(_frame(spark, [(2, "b")]), "bronze.t", "append")
    assert _content(lake.read("bronze.t")) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("bad", ["", "a;b", "a--b", "a b", "1a", "x/*", None])
def test_names(bad):
    with pytest.raises(ValueError):
        valid_name(bad)


def test_layer_names(lake):
    with pytest.raises(ValueError):
        lake.name("platinum.t")
    assert valid_name("  ok_1 ") == "ok_1"


def test_merge_statement_parses(spark):
    text = merge_statement("gold.t", "s", ["k", "v"], ["k"])
    assert "ON t.`k` = s.`k`" in text
    spark._jsparkSession.sessionState().sqlParser().parsePlan(text)


def test_view(spark, lake):
    lake.overwrite(_frame(spark, [(1, "a")]), "gold.t")
    lake.view("other_name", "gold.t")
    assert spark.table("other_name").count() == 1


def test_csv_dates(spark, tmp_path):
    path = str(tmp_path / "c")
    export_csv(_frame(spark, [("2024-01-02", 1), ("oops", 2)], "date string, n int"), path, single_file=True)
    assert [r.date for r in read_csv(spark, path).orderBy("n").collect()] == [dt.datetime(2024, 1, 2), None]


def test_prediction_files_append(spark, tmp_path):
    path = str(tmp_path / "p")
    df = _frame(spark, [("A", 0.1)], "stock string, predicted double")
    for run in ("r1", "r2"):
        write_predictions(df, path, run)
    assert spark.read.json(path).filter(F.col("stock") == "A").count() == 2


def test_jdbc_options():
    connection = Connection("h", 5432, "db", "u", "p", {"ssl": "true", "driver": "other"})
    options = jdbc_options(connection, "public.t", ReadSplit("id", 0, 100, 4))
    assert options["url"] == "jdbc:postgresql://h:5432/db" and options["driver"] == "other" and options["ssl"] == "true"
    assert options["numPartitions"] == "4" and options["partitionColumn"] == "id"
    assert "password" not in repr(connection)


def test_local_rows(spark):
    assert local_rows(spark, [(1, "a")], KV).first().v == "a"
