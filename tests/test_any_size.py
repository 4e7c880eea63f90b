"""Rules of any number, the ledger of scored titles, error rows, fold scalers, sketches, configs."""

import datetime as dt
import json
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from candlewick.operators import mlprep as ml, profile as pf, rules as rules_module, versions as vs
from candlewick.operators.rules import match_many, match_rules
from candlewick.operators.wordindex import WordIndex, inside_words, loose_ends
from candlewick.plans import jobs
from candlewick.plans.catalogue.registry import scratch_lake
from candlewick.operators.sentiment import lexicon_scored

RULES = "ticker string, aliases array<string>, blacklist array<string>"
HEADS = "extracted_title string, source_url string"


def _pairs(df):
    return sorted((r.extracted_title or "", r.ticker) for r in df.collect())


@pytest.mark.parametrize("whole_word", [False, True])
def test_an_index_of_rules_finds_what_one_test_per_rule_finds(spark, whole_word):
    heads = [("Nvidia and MICROSOFT agree", "u"), ("Microsoft wins", "http://x/soccer"), ("Microsoft soccer", "u"), ("C++ (MS) and c+", None), ("a ms b", "u"),
             ("a.b*c [x] \\Q y\\E", "u"), ("ünïcode ÄRGER", "u"), ("", "u"), (None, "u"), ("Nvidia and MICROSOFT agree", "u"), ("x" * 5_000 + " nvidia", "u")]
    rules = [("NVDA", ["nvidia", "NVIDIA corp"], None), ("MSFT", ["microsoft", "ms", "c+"], ["soccer", "football"]), ("ODD", ["a.b*c", "[x]", "\\Q y\\E"], []),
             ("UML", ["ärger", "ü"], ["none", None]), ("NO", [], None), ("NIL", None, None), ("BLANK", ["", None], None)]
    df = spark.createDataFrame(heads, HEADS)
    plain = {t: {"aliases": [x for x in a or [] if x], "blacklist": [x for x in b or [] if x]} for t, a, b in rules if [x for x in a or [] if x]}
    one = match_rules(df, plain, whole_word=whole_word)
    many = match_many(df, spark.createDataFrame(rules, RULES), whole_word=whole_word)
    assert _pairs(many) == _pairs(one) and len(_pairs(many)) > 6


def test_the_plan_does_not_grow_with_the_rules(spark):
    df = spark.createDataFrame([("some alias 17 here", "u"), ("alias 4999", "u")], HEADS)
    plans = []
    for n in (3, 5_000):
        rules = spark.range(n).select(F.concat(F.lit("T"), "id").alias("ticker"), F.array(F.concat(F.lit("alias "), "id")).alias("aliases"), F.lit(None).cast("array<string>").alias("blacklist"))
        found = match_many(df, rules)
        plans.append(len(found._jdf.queryExecution().analyzed().toString().splitlines()))
    assert plans[0] == plans[1]
    assert {r.ticker for r in found.collect()} == {"T1", "T17", "T4", "T49", "T499", "T4999"}


def test_neither_headlines_nor_their_grams_are_shuffled(spark):
    df = spark.createDataFrame([("some alias 17 here", "u"), ("alias 4999", "u")], HEADS)
    rules = spark.range(3).select(F.concat(F.lit("T"), "id").alias("ticker"), F.array(F.concat(F.lit("alias "), "id"), F.lit("here")).alias("aliases"), F.lit(None).cast("array<string>").alias("blacklist"))
    found = match_many(df, rules)
    assert _pairs(found) == [("some alias 17 here", t) for t in ("T0", "T1", "T2")]
    assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("earlier", [1, 16])
def test_a_ticker_with_any_number_of_aliases_and_parts_of_the_index_match_once(spark, monkeypatch, earlier):
    monkeypatch.setattr(rules_module, "EARLIER", earlier)
    monkeypatch.setattr(rules_module, "PART", 4)
    heads = [("one two three four fourteen letters", "u"), ("four", "banned"), ("one two three four fourteen letters", "u"), ("nothing", "u")]
    names = ["one", "two", "three", "four", "fourteen letters", "een letters"]
    rules = [("A", names, None), ("A", ["four"], ["banned"]), ("B", ["four"], ["one", "banned"]), ("B", ["four", "two"], None), (None, ["four"], None), ("C", ["two", "three"], ["u"])]
    got = match_many(spark.createDataFrame(heads, HEADS), spark.createDataFrame(rules, RULES))
    expected = []
    for title, url in heads:
        hit = {t for t, a, b in rules if any(x in title for x in a) and not any(w in title or w in url for w in b or [])}
        expected += [(title, str(t)) for t in hit]
    assert sorted((r.extracted_title, str(r.ticker)) for r in got.collect()) == sorted(expected)


def test_words_are_found_as_python_finds_them():
    """Words of one byte up to several windows, that overlap, repeat, share windows and end at the edges of texts."""
    rng, letters = np.random.default_rng(5), "ab _é¬𝒳"
    texts = ["".join(rng.choice(list(letters), n)) for n in [*range(30), 200, 3_000]] * 3 + [None]
    cut = lambda t, n, i=0: t[i : i + n]
    words = sorted({cut(t, n, i) for t in texts if t for n in (1, 2, 3, 5, 8, 9, 17, 40) for i in (0, len(t) // 2, max(0, len(t) - n))} | {"absent", "abababababababababx"})
    tables = (index := WordIndex(pa.array(words), pa.array(texts[:9]))).tables()
    for shown in (pa.array(texts), pa.array(["head", *texts]).slice(1)):
        found = {*zip(*(x.tolist() for x in index.find(shown, tables)), strict=True)}
        assert found == {(i, k) for i, t in enumerate(texts) if t for k, w in enumerate(words) if w in t}
    masks = pa.array([None if t is None else re.sub(r"\w", "w", re.sub(r"\W", "-", t)) for t in texts])
    inside = inside_words(pa.array(texts), masks)
    found = {*zip(*(x.tolist() for x in index.find(pa.array(texts), tables, inside)), strict=True)}
    assert found == {(i, k) for i, t in enumerate(texts) if t for k, w in enumerate(words) if re.search(rf"(?<!\w){re.escape(w)}(?!\w)", t)}
    assert loose_ends(pa.array(texts), inside).tolist() == [bool(re.search(r"(?<!\w)(?!\w)", t or "")) for t in texts]


@pytest.mark.parametrize("whole_word", [False, True])
def test_empty_banned_words_and_url_only_ones_refuse_as_in_single_tests(spark, whole_word):
    heads = [("nvidia", "u"), ("nvidia ¬ gains", "u"), ("¬ nvidia", None), ("nvidia", "see nvidia ban"), ("nvidia¬", "ban"), ("a¬b nvidia", "x¬"), ("nvidia", "")]
    rules = [("EMPTY", ["nvidia"], [""]), ("URL", ["nvidia"], ["ban", "other"]), ("BOTH", ["nvidia", "gains"], ["ban", ""])]
    df = spark.createDataFrame(heads, HEADS)
    one = match_rules(df, {t: {"aliases": a, "blacklist": b} for t, a, b in rules}, whole_word=whole_word)
    assert _pairs(match_many(df, spark.createDataFrame(rules, RULES), whole_word=whole_word)) == _pairs(one) != []


def test_tickers_of_many_headlines_are_returned_a_few_at_a_time(monkeypatch):
    monkeypatch.setattr(rules_module, "FOUND", 5)
    part = pa.table({"_rule": [f"T{i % 3}" for i in range(6)], "_alias": ["x", "y", "z"] * 2, "_banned": pa.array([[]] * 3 + [["no"]] * 3, pa.list_(pa.string()))})
    held = rules_module._compiled(part, pa.array([], pa.string()))
    title = pa.array(["x y z", "x", None, "", "y z no", "z y x x", "none", "xyz"])
    got = [*rules_module._accepted(held, held.index.tables(), title, pa.array(["u"] * 8), ())]
    assert max(len(a.flatten()) for a in got) < 8 and len(got) == 2
    assert [sorted(x) for a in got for x in a.to_pylist()] == [["T0", "T1", "T2"], ["T0"], [], [], ["T1", "T2"], ["T0", "T1", "T2"], [], ["T0", "T1", "T2"]]


def test_a_matching_rule_costs_no_further_look_at_the_headline(spark):
    """No join makes a row per headline and rule that a test of the text would then read."""
    df = spark.createDataFrame([("some alias here", "u")], HEADS)
    rules = spark.range(200).select(F.concat(F.lit("T"), "id").alias("ticker"), F.array(F.lit("alias")).alias("aliases"), F.array(F.concat(F.lit("x"), "id")).alias("blacklist"))
    found = match_many(df, rules)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "contains" not in plan.lower() and found.count() == 200


def test_no_rules_match_nothing(spark):
    assert match_many(spark.createDataFrame([("a", "u")], HEADS), spark.createDataFrame([], RULES)).count() == 0


def test_a_second_run_scores_no_old_title(spark):
    lake, seen = scratch_lake(spark), []

    def score(df):
        seen.append(sorted(r.extracted_title for r in df.select("extracted_title").collect()))
        return lexicon_scored(df)

    settings = jobs.Settings(score=score)
    day = dt.date(2024, 1, 2)
    news = "date date, ticker string, extracted_title string"
    lake.overwrite(spark.createDataFrame([(day, "NVDA", "strong growth"), (day, "NVDA", "weak"), (None, "NVDA", "undated gain")], news), "silver.news")
    jobs.news_to_sentiment(lake, settings)
    jobs.news_to_sentiment(lake, settings)
    lake.append(spark.createDataFrame([(day, "NVDA", "record gains"), (day + dt.timedelta(1), "AAPL", "probe")], news), "silver.news")
    jobs.news_to_sentiment(lake, settings)
    assert [s for s in seen if s] == [["strong growth", "undated gain", "weak"], ["probe", "record gains"]]
    whole = {tuple(r) for r in jobs.gold_sentiment(lake.read("silver.news"), jobs.Settings()).collect()}
    stored = lake.read(settings.tables.sentiment).select("date", "ticker", "sentiment_sum", "polarity_ratio")
    assert {tuple(r) for r in stored.collect()} == whole


def test_a_run_that_fails_before_the_ledger_is_made_up_for(spark, monkeypatch):
    lake, settings = scratch_lake(spark), jobs.Settings()
    day, news = dt.date(2024, 1, 2), "date date, ticker string, extracted_title string"
    lake.overwrite(spark.createDataFrame([(day, "NVDA", "strong")], news), "silver.news")
    monkeypatch.setattr(jobs, "_merge_daily", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        jobs.news_to_sentiment(lake, settings)
    monkeypatch.undo()
    assert jobs.news_to_sentiment(lake, settings) == 1 and jobs.news_to_sentiment(lake, settings) == 1


def test_every_ticker_gets_a_row(spark):
    rows = [(t, dt.date(2024, 1, 1) + dt.timedelta(k), float(k), float(k % 3)) for t, n in (("long", 60), ("short", 5), ("odd", 60), ("none", 60)) for k in range(n)]
    df = spark.createDataFrame(rows, "ticker string, date date, f double, g double")
    scalers = spark.createDataFrame([(t, 0.0, 2.0, 0.0, 1.0, 1.0 if t != "odd" else 3.0, 10.0) for t in ("long", "short", "odd")], "ticker string, low_f double, width_f double, low_g double, width_g double, low_next_day_return double, width_next_day_return double")

    def load():
        def model(batch):
            if (batch[:, -1, 0] > 100).any():
                raise ValueError("too large")
            return batch[:, -1, 1]

        return model

    found = {r.stock: r for r in ml.score_or_explain(df, ["f", "g"], scalers, load, "m", F.lit("2024-01-01").cast("timestamp")).collect()}
    assert found["long"].status == "ok" and found["long"].predicted_next_day_return == 21.0 and found["long"].error is None
    assert found["short"].error == "fewer than 45 rows for short" and found["short"].predicted_next_day_return is None
    assert found["none"].status == "failed" and found["odd"].status == "ok" and found["odd"].timestamp == dt.datetime(2024, 1, 1)

    def refusing():
        return lambda batch: (_ for _ in ()).throw(ValueError("no")) if len(batch) > 1 or batch[0, -1, 0] > 20 else np.array([1.0])

    refused = {r.stock: r.error for r in ml.score_or_explain(df, ["f", "g"], scalers, refusing, "m").collect()}
    assert refused["long"] == "no" and refused["short"].startswith("fewer")


@pytest.mark.parametrize("plan", [ml.WalkForward(40, 10, 15, 5), ml.WalkForward(40, 10, 15, 5, anchored=False), ml.WalkForward(7, 4, 5, 3, min_train=12), ml.WalkForward(20, 4, 5, 30, anchored=False), ml.WalkForward(5, 3, 10, 2)])
def test_fold_scalers_equal_those_of_copied_rows(spark, plan):
    rng = np.random.default_rng(3)
    rows = [(t, k, float(rng.integers(0, 9)), 1.0) for t, n in (("a", 97), ("b", 41), ("c", 40), ("d", 3)) for k in range(n)]
    df = spark.createDataFrame(rows, "ticker string, date int, x double, y double")
    train = ml.fold_rows(df, plan).filter("split = 'train'")
    expected = sorted(map(tuple, ml.fit_minmax(train, ["x", "y"], ["ticker", "fold"]).collect()))
    with_test = {(r.ticker, r.fold) for r in ml.fold_rows(df, plan).filter("split = 'test'").select("ticker", "fold").distinct().collect()}
    found = sorted(map(tuple, ml.fit_folds(df, ["x", "y"], plan).collect()))
    assert found == [e for e in expected if e[:2] in with_test] and {f[:2] for f in found} == with_test


def test_sketches_decide_all_but_the_columns_near_the_threshold(spark, monkeypatch):
    n = 20_000
    df = spark.range(n).select("id", (F.col("id") % 100).alias("few"), F.when(F.col("id") > 20, F.col("id")).otherwise(0).alias("almost"), (F.col("id") - F.col("id") % 2).alias("half"), F.lit(None).cast("string").alias("none"), F.array("id").alias("list"), (F.col("id") / 7).alias("number"))
    counted = []
    original = pf.uniqueness
    monkeypatch.setattr(pf, "uniqueness", lambda d, c=None, **k: counted.extend(c) or original(d, c, **k))
    assert {r.column_name for r in pf.key_candidates(df).collect()} == {"id", "almost", "list", "number"}
    assert set(counted) == {"id", "almost", "list", "number"}
    assert {r.column_name for r in pf.key_candidates(df, 0.9995).collect()} == {"id", "list", "number"}
    by_day = pf.column_sketches(df.withColumn("day", F.col("id") % 5), ["day"])
    whole = {r.column_name: r for r in pf.united(by_day).collect()}
    assert whole["few"].distinct_estimate in range(98, 103) and whole["none"].null_count == n and whole["none"].distinct_ratio is None
    assert abs(whole["half"].distinct_ratio - 0.5) < 0.02
    assert pf.key_candidates(df, sketches=by_day).count() == 4


def test_one_scan_without_copied_rows(spark, capsys):
    pf.united(pf.column_sketches(spark.range(10).withColumn("b", F.col("id")))).explain()
    plan = capsys.readouterr().out
    assert "Expand" not in plan and plan.count("Range") == 1


def test_config_spellings(spark):
    texts = ['{"b": 1, "a": [1, {"d": null, "c": "x"}]}', '{"a":[1,{"c":"x","d":null}],"b":1}', "not json", None]
    found = [r.c for r in spark.createDataFrame([(t,) for t in texts], "t string").select(vs.canonical_json(F.col("t")).alias("c")).collect()]
    assert found[0] == found[1] and json.loads(found[0]) == json.loads(texts[0]) and found[2:] == [None, None]


def test_updates_replace_the_row_in_use(spark):
    config = "name string, config string, status string, updated_at timestamp"
    old = dt.datetime(2020, 1, 1)
    stored = [("same", '{"a":1,"b":2}', "active", old), ("other", '{"a":1}', "active", old), ("gone", '{"a":1}', "deleted", old), ("other", '{"a":0}', "deleted", old), ("bad", "x{", None, old)]
    arriving = [("same", '{ "b":2, "a":1 }'), ("other", '{"a":2}'), ("gone", '{"a":1}'), ("new", None), ("bad", "x{"), (None, "{}")]
    now = F.lit("2024-01-01").cast("timestamp")
    table, actions = vs.with_updates(spark.createDataFrame(stored, config), spark.createDataFrame(arriving, "name string, config string"), ["name"], now=now)
    assert {r.name: r.action for r in actions.collect()} == {"same": "Existed", "other": "Updated", "gone": "Created", "new": "Created", "bad": "Existed", None: "Created"}
    rows = {(r.name, r.config, r.status, r.updated_at.year) for r in table.collect()}
    assert ("other", '{"a":1}', "deleted", 2024) in rows and ("other", '{"a":0}', "deleted", 2020) in rows and ("other", '{"a":2}', "active", 2024) in rows
    assert ("same", '{"a":1,"b":2}', "active", 2020) in rows and ("gone", '{"a":1}', "active", 2024) in rows and len(rows) == 9


def test_core_queries_load_without_a_library_of_the_text_operators(monkeypatch):
    import sys

    import __spark_entry__ as entry_module

    for name in [m for m in sys.modules if m.startswith("candlewick.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "ahocorasick", None)  # importing it raises ImportError
    names = entry_module.queries()
    assert "indicator_set" in names and not any(n.startswith("op2_") for n in names)
