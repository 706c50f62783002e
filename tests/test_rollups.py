"""Stored rollups against the facts they were made from."""

import random

import pytest
from pyspark.sql import functions as F

from kpiloom.plans.stored_rollups import Rollup, _at, latency_percentiles, rank_error, write_latencies


@pytest.fixture()
def facts(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), rng.choice(["x", "y", None]), rng.choice([None, -7, *range(90), 10**6 + rng.randrange(9)]), rng.randrange(200_000), i) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "k string, j string, member long, place long, v long")


@pytest.mark.parametrize("keys", [("k",), ("j",), ("k", "j"), ()])
def test_coarser_groups_count_exactly(spark, facts, tmp_path, keys):
    rows, frame = facts
    rollup = Rollup(str(tmp_path / "r"), ("k", "j"), ("v",), ("member", "place"))
    rollup.write(frame)
    names = ("k", "j")
    want = {}
    for row in rows:
        want.setdefault(tuple(row[names.index(k)] for k in keys), []).append(row)
    got = {tuple(r[k] for k in keys): (r.n_rows, r.v, r.member, r.place) for r in rollup.read(spark, keys).collect()}
    assert got == {
        key: (len(of), sum(r[4] for r in of), len({r[2] for r in of} - {None}), len({r[3] for r in of})) for key, of in want.items()
    }


def test_a_rollup_reads_no_facts_and_knows_its_keys(spark, facts, tmp_path, plan):
    rollup = Rollup(str(tmp_path / "r"), ("k",), (), ("member",))
    rollup.write(facts[1])
    assert "Expand" not in plan(rollup.read(spark, ("k",)))
    with pytest.raises(ValueError, match="stored by"):
        rollup.read(spark, ("j",))


def test_merged_percentiles_keep_their_rank(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f"r{i % 7}", "t" if i % 2 else "u", i, 0, int(rng.expovariate(0.001))) for i in range(20_000)]
    answers = spark.createDataFrame(rows, "run_id string, tier string, question_id long, attempt int, latency_ms long")
    write_latencies(answers, str(tmp_path / "l"))
    stored = spark.read.parquet(str(tmp_path / "l"))
    assert stored.count() == 14
    fractions = {"low": 0.01, "p50": 0.5, "p95": 0.95}
    for keys in (["tier"], ["run_id"], []):
        for r in latency_percentiles(stored, keys, fractions).collect():
            of = sorted(v[4] for v in rows if all(v[("run_id", "tier").index(k)] == r[k] for k in keys))
            assert r.n_questions == len(of)
            for name, f in fractions.items():
                below, upto = (sum(v < r[name] for v in of) / len(of), sum(v <= r[name] for v in of) / len(of))
                assert below - rank_error() <= f <= upto + rank_error()
    few = stored.limit(0)
    assert latency_percentiles(few, ["tier"], fractions).count() == 0
    one = spark.createDataFrame([(5.0,)], "v double").agg(F.kll_sketch_agg_double("v").alias("s"))
    assert one.select(_at("s", 0.5)).first()[0] == 5


def test_thinly_spread_keys_take_little_room(spark, tmp_path):
    """A group with some values far apart holds no wide bitmaps for them."""
    frame = spark.range(5000).selectExpr("id % 50 AS k", "id * 1000 - 7 AS place")
    rollup = Rollup(str(tmp_path / "r"), ("k",), (), ("place",))
    rollup.write(frame)
    stored = spark.read.parquet(str(tmp_path / "r" / "bitmaps"))
    assert stored.schema["bits"].dataType.simpleString() == "bigint" and stored.count() <= 5000
    assert rollup.read(spark, ()).first().place == 5000
    assert {r.place for r in rollup.read(spark, ("k",)).collect()} == {100}
