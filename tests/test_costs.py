import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kpiloom.plans import costs, scoring
from kpiloom.sources import answers as logs
from kpiloom.sources.sinks import append_runs, read_runs, replace_runs

USAGE = (
    "cloud string, sku_name string, usage_date date, usage_start_time timestamp_ntz, usage_end_time timestamp_ntz, "
    "usage_quantity decimal(14,4), billing_origin_product string, identity_metadata struct<run_as: string>, "
    "usage_metadata struct<agent: struct<surface: string>, warehouse_id: string>"
)
DAY = datetime(2024, 1, 10)


def usage(spark, rows):
    """``(principal, start, end, units)`` as agent usage."""
    data = [
        ("AWS", "AGENT_ANSWERS", s.date(), s, e, Decimal(str(u)), "AGENT", (p,), (("chat",), "wh"))
        for p, s, e, u in rows
    ]
    return spark.createDataFrame(data, USAGE)


def asked(spark, rows):
    """``(run, tier, start, finish)``; the principal is the tier's."""
    data = [(r, t, "space", "wh", f"sp_{t}", s, f) for r, t, s, f in rows]
    return spark.createDataFrame(
        data, "run_id string, tier string, space_id string, warehouse_id string, run_as_sp string, "
        "started_at timestamp_ntz, finished_at timestamp_ntz")


def test_window_attribution_equals_brute_force(spark, star):
    rng = random.Random(5)
    bills, runs = [], []
    for _ in range(150):
        start = DAY + timedelta(minutes=rng.randint(0, 60 * 60))
        end = rng.choice([None, start + timedelta(minutes=rng.choice([10, 60, 130]))])
        bills.append((f"sp_T{rng.randint(0, 2)}", start, end, rng.randint(1, 400) / 100))
    for i in range(25):
        start = DAY + timedelta(minutes=rng.randint(-300, 70 * 60))
        runs.append((f"r{i}", f"T{rng.randint(0, 3)}", start, start + timedelta(minutes=rng.randint(1, 400))))
    got = costs.attribute_by_window(asked(spark, runs), usage(spark, bills), logs.list_prices(star))
    got = {(r.run_id, r.tier): r.agent_units for r in got.collect()}

    hour = timedelta(hours=1)
    for run, tier, start, finish in runs:
        low = (start - timedelta(minutes=5)).replace(minute=0, second=0)
        high = finish + timedelta(minutes=5)
        high = high if high.minute == 0 else high.replace(minute=0) + hour
        want = sum(u for p, s, e, u in bills if p == f"sp_{tier}" and s < high and (e or s + hour) > low)
        assert got[run, tier] == pytest.approx(want, abs=1e-9), (run, tier)


def test_shares_add_up_to_the_bill_of_hours_with_questions(spark, star):
    prices, billed, answered = logs.list_prices(star), logs.billing_usage(star), logs.answers(star)
    shares = costs.attribute_by_share(answered, billed, prices)
    hours = answered.select("run_as_sp", costs.hour_floor(F.col("started_at")).alias("starts")).distinct()
    spend = costs.agent_spend(billed, prices).join(hours, ["run_as_sp", "starts"], "left_semi")
    total = spend.agg(F.sum("cost").cast("double")).first()[0]
    assert shares.agg(F.sum("agent_cost_usd")).first()[0] == pytest.approx(total, abs=1e-6)


def test_hour_without_questions_goes_to_nobody(spark, star):
    bills = usage(spark, [("sp_T0", DAY, None, 2), ("sp_T0", DAY + timedelta(hours=5), None, 50)])
    runs = asked(spark, [("a", "T0", DAY, DAY), ("a", "T0", DAY, DAY), ("b", "T0", DAY, DAY), ("c", "T1", DAY, DAY)])
    rows = {r.run_id: r.agent_units for r in costs.attribute_by_share(runs, bills, logs.list_prices(star)).collect()}
    assert rows == {"a": pytest.approx(4 / 3), "b": pytest.approx(2 / 3), "c": 0.0}


def test_price_changes_apply_from_their_start(spark, star):
    edge = datetime(2024, 1, 15)
    bills = usage(spark, [("sp_T0", edge - timedelta(hours=1), None, 1), ("sp_T0", edge, None, 1)])
    spend = costs.agent_spend(bills, logs.list_prices(star)).orderBy("starts").collect()
    assert [float(r.cost) for r in spend] == [0.07, 0.085]


def test_unsettled_billing_writes_nothing(spark, star, tmp_path):
    answered, nothing = logs.answers(star), logs.billing_usage(star).where("false")
    path = str(tmp_path / "cost")
    assert costs.write_tier_costs(answered, nothing, logs.list_prices(star), path) is False
    assert not (tmp_path / "cost").exists()
    assert costs.write_tier_costs(answered, logs.billing_usage(star), logs.list_prices(star), path) is True
    assert read_runs(spark, path).count() > 0


def test_replacing_runs_is_idempotent_and_leaves_others(spark, tmp_path):
    path = str(tmp_path / "runs")
    first = spark.createDataFrame([(f"r{i}", i) for i in range(40)], "run_id string, v long")
    second = spark.createDataFrame([("r3", 300), ("r3", 301), ("r99", 99)], "run_id string, v long")
    replace_runs(first, path)
    for _ in range(2):
        replace_runs(second, path)
        got = sorted((r.run_id, r.v) for r in read_runs(spark, path).collect())
        assert got == sorted([(f"r{i}", i) for i in range(40) if i != 3] + [("r3", 300), ("r3", 301), ("r99", 99)])


def test_scores_are_written_back_in_place(spark, star, tmp_path):
    path = str(tmp_path / "answers")
    answered = logs.answers(star)
    append_runs(answered, path)
    for _ in range(2):
        scoring.update_scores(spark, path)
        stored = read_runs(spark, path).select(*answered.columns)
        want = scoring.with_scores(answered, scoring.evaluated(answered))
        assert stored.count() == want.count()
        assert stored.exceptAll(want).isEmpty()
