"""Answers compared without anyone naming their key or measures."""

import pytest
from pyspark.sql import functions as F

from kpiloom.operators.infer import _rows, inferred_diff, profiles
from kpiloom.plans import scoring

SCHEMA = "answer_id string, cells array<struct<name string, value string>>"


def table(spark, answers):
    rows = [(a, [(n, None if v is None else str(v)) for n, v in row.items()]) for a, of in answers.items() for row in of]
    return spark.createDataFrame(rows, SCHEMA)


def verdicts(spark, gold, got):
    return {r.answer_id: (r.correct, round(r.answer_score, 6)) for r in inferred_diff(table(spark, gold), table(spark, got)).collect()}


CASES = {
    # Under display names, in another order, with a further column.
    "same": ([{"region_name": "x", "v": 1}, {"region_name": "y", "v": 2}], [{"V": "2.0", "Region": "y", "note": "b"}, {"V": 1.0004, "Region": "x", "note": "a"}], (True, 1.0)),
    "half": ([{"sku_code": "x", "v": 1}, {"sku_code": "y", "v": 2}], [{"sku_code": "x", "v": 1}, {"sku_code": "y", "v": 3}], (False, 0.5)),
    "missing key": ([{"name": "x", "v": 1}], [{"name": "x", "v": 1}, {"name": "y", "v": 1}], (False, 0.0)),
    # Numbers are no key, and text that is no identifier neither.
    "numeric id": ([{"id": 7, "v": 1}], [{"id": 7, "v": 1}], (True, 1.0)),
    "scalar": ([{"total": 10}], [{"Sum of it": 10.0}], (True, 1.0)),
    "scalar off": ([{"total": 10}], [{"total": 11}], (False, 0.0)),
    "measure lacking": ([{"code": "x", "v": 1, "w": 5}], [{"code": "x", "v": 1}], (True, 1.0)),
    "zero rows": ([{"code": "x", "v": 1}], [{"code": "x", "v": 1}, {"code": "z", "v": 0}], (True, 1.0)),
    "no numbers in a row": ([{"code": "x", "v": 1}], [{"code": "x", "v": 1}, {"code": "z", "v": None}], (True, 1.0)),
    "long": (
        [{"product_family": "a", "q1_revenue": 3, "q2_revenue": 4}, {"product_family": "b", "q1_revenue": 5, "q2_revenue": 0}],
        [{"Product Family": "a", "q": "Q1", "amount": 1}, {"Product Family": "a", "q": "1", "amount": 2}, {"Product Family": "a", "q": "fiscal_q2", "amount": 4},
         {"Product Family": "b", "q": "Q1", "amount": 5}, {"Product Family": "b", "q": "Q3", "amount": 50}],
        (True, 1.0),
    ),
    "long off": ([{"product_family": "a", "q1_revenue": 3, "q2_revenue": 4}], [{"product_family": "a", "fiscal_quarter": "1", "r": 3}, {"product_family": "a", "fiscal_quarter": "2", "r": 9}], (False, 0.0)),
    "nothing came": ([{"code": "x", "v": 1}], [], (False, 0.0)),
    "nothing was asked": ([], [{"code": "x", "v": 1}], (False, 0.0)),
    "same key twice": ([{"code": "x", "v": 1}], [{"code": "x", "v": 1}, {"code": "x", "v": 5}], (False, 0.0)),
}


def test_each_answer_by_its_own_shape(spark):
    """All in one job, though no two have the same columns."""
    got = verdicts(spark, {k: v[0] for k, v in CASES.items()}, {k: v[1] for k, v in CASES.items()})
    assert got == {k: v[2] for k, v in CASES.items()}


def test_a_column_is_of_numbers_if_no_value_is_other_text(spark):
    rows = _rows(table(spark, {"a": [{"x": "1", "y": "1", "z": None, "n": "NaN"}, {"x": None, "y": "b", "z": None, "n": "2"}]}))
    (found,) = profiles(rows).collect()
    assert {c["name"]: c["number"] for c in found["columns"]} == {"x": True, "y": False, "z": False, "n": False}


@pytest.mark.parametrize("side", ["gold", "got"])
def test_empty_tables(spark, side):
    full = table(spark, {"a": [{"code": "x", "v": 1}]})
    none = full.where(F.lit(False))
    sides = (none, full) if side == "gold" else (full, none)
    assert [(r.answer_id, r.correct) for r in inferred_diff(*sides).collect()] == [("a", False)]
    assert inferred_diff(none, none).count() == 0


@pytest.mark.parametrize("diff", [scoring.inferred_region_diff, scoring.inferred_quarter_diff])
def test_each_side_is_read_for_its_profile_and_for_its_values(star, plan, diff):
    text = plan(diff(star))
    assert text.count("FileScan parquet [l_") == 4


def test_answers_without_values_stay(spark):
    none = spark.createDataFrame([("empty", []), ("half", [])], SCHEMA)
    gold = table(spark, {"half": [{"code": "x", "v": 1}], "no measure": [{"code": "x", "note": "a"}]}).union(none)
    got = table(spark, {"half": [{"code": "x", "v": 1}], "no measure": [{"code": "x", "note": "b"}]}).union(none)
    found = {r.answer_id: (r.n_keys, r.n_unmatched, r.correct) for r in inferred_diff(gold, got).collect()}
    assert found == {"empty": (0, 0, False), "half": (1, 0, True), "no measure": (0, 0, False)}
