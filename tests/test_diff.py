import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.operators.aggregates import distinct_by_flag, exact_percentile, spread
from kpiloom.operators.diff import Tolerance, _plain, keyed_diff, normalized, number, plain_cells, top_rows, zero_or_empty
from kpiloom.operators.joins import first_per_key
from kpiloom.plans import scoring


def results(spark, rows):
    """``(answer, {name: value})`` pairs as cells."""
    data = [(a, [(n, None if v is None else str(v)) for n, v in cells.items()]) for a, cells in rows]
    return spark.createDataFrame(data, "answer_id string, cells array<struct<name: string, value: string>>")


def verdicts(frame):
    return {r.answer_id: (r.correct, r.answer_score) for r in frame.collect()}


def test_names_and_aliases(spark):
    frame = results(spark, [
        ("alias", {"Region": "EU", "Recognized Revenue!": "12.34567"}),
        ("both", {"region": "x", "region_name": "EU", "recognized revenue": "1"}),
    ])
    rows = {r.answer_id: r for r in normalized(frame, ["region_name"], ["recognized_revenue"]).collect()}
    assert rows["alias"].region_name == "EU" and rows["both"].region_name == "EU"
    assert rows["both"].recognized_revenue == 1.0 and rows["alias"].recognized_revenue == 12.3457
    assert rows["both"]._has_recognized_revenue and rows["alias"]._has_recognized_revenue


def test_empty_and_zero_rows_go_only_beside_better_ones(spark):
    frame = results(spark, [
        ("mixed", {"k": "a", "v": "5"}), ("mixed", {"k": "b", "v": "0"}), ("mixed", {"k": "c", "v": None}),
        ("zeros", {"k": "a", "v": "0.0"}), ("zeros", {"k": "b", "v": "0"}), ("zeros", {"k": "c", "v": None}),
        ("nulls", {"k": "a", "v": None}), ("texts", {"k": "a", "v": "n/a"}),
    ])
    kept = normalized(frame, ["k"], ["v"]).groupBy("answer_id").agg(F.array_sort(F.collect_list("k")).alias("k"))
    assert {r.answer_id: r.k for r in kept.collect()} == {
        "mixed": ["a"], "zeros": ["a", "b"], "nulls": ["a"], "texts": ["a"]}


def test_keyed_verdicts(spark):
    schema = "answer_id string, k string, v double, w double"
    gold = spark.createDataFrame([
        ("same", "a", 100.0, 1.0), ("same", "b", 200.0, None),
        ("close", "a", 1000.0, 0.0), ("far", "a", 1000.0, 5.0), ("far", "b", 10.0, 5.0),
        ("missing", "a", 1.0, 1.0), ("missing", "b", 1.0, 1.0), ("absent", "a", 1.0, 1.0),
    ], schema)
    got = spark.createDataFrame([
        ("same", "a", 100.0, 1.0), ("same", "b", 200.0, 0.0),
        ("close", "a", 1000.9, 0.009), ("far", "a", 1002.0, 9.0), ("far", "b", 10.0, 9.0),
        ("missing", "a", 1.0, 1.0), ("extra", "a", 1.0, 1.0),
    ], schema)
    assert verdicts(keyed_diff(gold, got, ["k"], ["v", "w"])) == {
        "same": (True, 1.0), "close": (True, 1.0), "far": (False, 0.5),
        "missing": (False, 0.0), "absent": (False, 0.0), "extra": (False, 0.0),
    }


def test_repeated_key_agrees_only_if_all_its_rows_do(spark):
    schema = "answer_id string, k string, v double"
    gold = spark.createDataFrame([("a", "x", 10.0), ("b", "x", 10.0), ("c", None, 1.0)], schema)
    got = spark.createDataFrame(
        [("a", "x", 10.0), ("a", "x", 10.0), ("b", "x", 10.0), ("b", "x", 11.0), ("c", None, 1.0)], schema)
    assert verdicts(keyed_diff(gold, got, ["k"], ["v"])) == {"a": (True, 1.0), "b": (False, 0.0), "c": (True, 1.0)}


def test_scalar_and_custom_tolerance(spark):
    gold = spark.createDataFrame([("a", 10.0), ("b", 10.0)], "answer_id string, v double")
    got = spark.createDataFrame([("a", 10.4), ("b", 10.6)], "answer_id string, v double")
    assert verdicts(keyed_diff(gold, got, [], ["v"], Tolerance(0.0, 0.5))) == {"a": (True, 1.0), "b": (False, 0.0)}


def test_measure_the_answer_lacks_is_skipped(spark):
    gold = spark.createDataFrame([("a", "x", 1.0, 7.0)], "answer_id string, k string, v double, w double")
    got = normalized(results(spark, [("a", {"k": "x", "v": 1})]), ["k"], ["v", "w"])
    assert verdicts(keyed_diff(gold, got, ["k"], ["v", "w"])) == {"a": (True, 1.0)}


def test_top_rows_rank_by_measure(spark):
    frame = spark.createDataFrame([("a", str(i), float(i % 5)) for i in range(20)], "answer_id string, k string, v double")
    assert [r.k for r in top_rows(frame, "v", ["k"], 3).orderBy(F.desc("v"), "k").collect()] == ["14", "19", "4"]


def test_zero_or_empty(spark):
    asked = spark.createDataFrame([("none",), ("zero",), ("some",)], "answer_id string")
    rows = spark.createDataFrame([("zero", 0.005), ("zero", None), ("some", -3.0)], "answer_id string, v double")
    got = {r.answer_id: r.correct for r in zero_or_empty(asked, rows, "v").collect()}
    assert got == {"none": True, "zero": True, "some": False}


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.95, 1.0])
def test_exact_percentile_equals_numpy(spark, fraction):
    rng = random.Random(7)
    groups = {"hot": 4000, "one": 1, "two": 2, "ties": 500}
    data = [(g, float(rng.randint(-50, 50) if g == "ties" else rng.randint(-10, 10**6))) for g, n in groups.items()
            for _ in range(n)]
    data.append(("hot", None))
    frame = spark.createDataFrame(data, "g string, v double")
    got = {r.g: r.p for r in exact_percentile(frame, ["g"], "v", fraction, "p").collect()}
    for group in groups:
        want = np.percentile([v for g, v in data if g == group and v is not None], fraction * 100)
        assert got[group] == pytest.approx(want, abs=1e-9)


def test_distinct_by_flag_equals_brute_force(spark):
    rng = random.Random(3)
    data = [(rng.choice("ab"), rng.choice([None, *range(30)]), rng.choice(["X", "Y", None])) for _ in range(500)]
    frame = spark.createDataFrame(data, "k string, m long, t string")
    got = distinct_by_flag(frame, ["k"], "m", {"xs": F.col("t") == "X", "all": F.lit(True)})
    for r in got.collect():
        assert r.xs == len({m for k, m, t in data if k == r.k and t == "X" and m is not None})
        assert r.all == len({m for k, m, t in data if k == r.k and m is not None})


def test_first_per_key_limits_groups_before_the_shuffle(spark, plan):
    frame = spark.range(1000).selectExpr("id % 3 AS k", "id")
    first = first_per_key(frame, ["k"], "id")
    assert sorted((r.k, r.id) for r in first.collect()) == [(0, 0), (1, 1), (2, 2)]
    text = plan(first)
    assert text.count("WindowGroupLimit") >= 2 and "Partial" in text


def test_published_wave(spark):
    """Five published runs of one strategy, 10 questions each."""
    cost = [0.130065, 0.130446, 0.131292, 0.130065, 0.107441]
    frame = spark.createDataFrame([(c / 10,) for c in cost], "c double")
    row = frame.agg(*(v.alias(n) for n, v in spread(F.col("c")).items())).first()
    assert row["mean"] == pytest.approx(0.01258618, abs=1e-9)
    assert row["std"] == pytest.approx(0.0010309723745, abs=1e-8)
    assert row["se"] == pytest.approx(0.00046106486247, abs=1e-8)
    assert (row["min"], row["max"]) == (pytest.approx(0.0107441), pytest.approx(0.0131292))
    single = frame.limit(1).agg(*(v.alias(n) for n, v in spread(F.col("c")).items())).first()
    assert (single["std"], single["se"]) == (0.0, 0.0)


def test_repeated_golden_keys_must_all_be_answered(spark):
    gold = spark.createDataFrame([("a", "k", 1.0), ("a", "k", 9.0), ("b", "k", 1.0), ("b", "k", 9.0)], "answer_id string, k string, v double")
    got = spark.createDataFrame([("a", "k", 9.0), ("b", "k", 9.0), ("b", "k", 1.0)], gold.schema)
    rows = {r.answer_id: r.correct for r in keyed_diff(gold, got, ["k"], ["v"]).collect()}
    assert rows == {"a": False, "b": True}


def test_answers_empty_on_both_sides_are_correct(spark):
    gold = spark.createDataFrame([("a", "k", 1.0)], "answer_id string, k string, v double")
    answers = spark.createDataFrame([("a",), ("b",)], "answer_id string")
    rows = {r.answer_id: (r.correct, r.answer_score) for r in keyed_diff(gold, gold.where("false"), ["k"], ["v"], answers=answers).collect()}
    assert rows == {"a": (False, 0.0), "b": (True, 1.0)}


def test_not_a_number_is_missing(spark):
    rows = [("a", [("region_name", "x"), ("v", "NaN")]), ("a", [("region_name", "y"), ("v", "2")])]
    frame = spark.createDataFrame(rows, "answer_id string, cells array<struct<name string, value string>>")
    assert [r.region_name for r in normalized(frame, ["region_name"], ["v"]).collect()] == ["y"]


def test_literal_names_are_cleaned_in_the_plan(star, plan):
    """And not once per row."""
    text = plan(scoring.region_diff(star))
    assert "regexp_replace" not in text and "array_position" not in text


def test_plain_names_equal_those_cleaned_one_by_one(spark):
    names = ["Recognized  Revenue!", "__a", "_", "", " ", "b__", "\u00c4rger", "a\u0130b", None, "x\x01y", "\x01", "A-B_c", "\u03a3"]
    rows = [[n] for n in names] + [names, [], [n for n in names if n and "\x01" not in n], ["!!", "a", "!!", "!!"]]
    cells = [(str(i), [(n, None) for n in row]) for i, row in enumerate(rows)]
    frame = spark.createDataFrame(cells, "answer_id string, cells array<struct<name string, value string>>")
    slow = frame.select("answer_id", F.transform("cells", lambda c: _plain(c["name"])).alias("names"))
    assert sorted(plain_cells(frame).select("answer_id", "names").collect()) == sorted(slow.collect())


def test_numbers_are_what_a_cast_gives(spark):
    texts = ["1", " 2.5", "\t-3", "+.5", "1e3", "1d", "0x1p3", "inf", " -Infinity ", "+INF", "NaN", "nan", "India", "x1", "", "-", None, "1,5", "nano"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.nanvl(F.col("t").try_cast("double"), F.lit(None).cast("double"))
    assert [r.a == r.b for r in frame.select(number(F.col("t")).alias("a"), plain.alias("b")).collect()] == [True] * len(texts)
