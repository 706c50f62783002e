"""How large the tasks are that write whole tables."""

import pytest

from kpiloom import session
from kpiloom.session import small_tasks
from kpiloom.sources.settled import settled, source_state
from kpiloom.sources.sinks import write_gold

SPLIT, PARTS = "spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions"


def test_settling_sorts_a_bounded_part_of_the_source_at_a_time(spark, star, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "TASK_BYTES", 5000)
    path = str(tmp_path / "lineitem.parquet")
    star.raw("lineitem").repartition(40).write.parquet(path)
    source = spark.read.parquet(path)
    size, before, seen = source_state(source, path)[1], [spark.conf.get(k) for k in (SPLIT, PARTS)], []

    def build(files):
        seen.append((int(spark.conf.get(SPLIT)), int(spark.conf.get(PARTS)), files))
        return source

    settled(source, path, "lineitem", build)
    (split, parts, files), = seen
    assert split == 5000 and parts * 5000 >= size > 4 * 5000
    assert [spark.conf.get(k) for k in (SPLIT, PARTS)] == before


def test_settings_come_back_after_an_error(spark):
    before = [spark.conf.get(k) for k in (SPLIT, PARTS)]
    with pytest.raises(KeyError), small_tasks(spark, 1 << 40):
        assert int(spark.conf.get(PARTS)) == (1 << 40) // session.TASK_BYTES
        raise KeyError
    assert [spark.conf.get(k) for k in (SPLIT, PARTS)] == before


def test_gold_is_ranged_in_tasks_that_follow_its_source(spark, tmp_path, many_partitions):
    rows = spark.range(20_000).selectExpr("id AS return_key", "id * 7919 % 1000 AS return_date_key")
    path = str(tmp_path / "fact_return")
    write_gold(rows, "fact_return", path, size=10 * session.TASK_BYTES)
    assert len(spark.read.parquet(path).inputFiles()) == 10 > int(spark.conf.get(PARTS))
