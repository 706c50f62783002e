"""What a run of many micro-batches writes, and what one that dies leaves."""

import pytest
from pyspark.sql import functions as F

from kpiloom.sources import files
from kpiloom.sources.versioned import BUCKET, VersionedTable
from kpiloom.streaming.medallion import Medallion

NAME, SCHEMA = "fact_subscription_event", "subscription_event_key long, member_key long, event_type string"


def landed(spark, lake, keys, member=1):
    rows = [(k, member, "RENEW" if k % 10 else "CLICK") for k in keys]
    lake.land(spark.createDataFrame(rows, SCHEMA).withColumn("event_date_key", F.lit(9)).repartition(6), NAME)
    lake.ingest(NAME)


@pytest.fixture()
def lake(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Medallion, "MAX_BYTES", 1)
    return Medallion(spark, str(tmp_path / "lake"))


def written(spark, lake):
    """Rows of all generations that were ever written and are still there."""
    path = lake.path("silver", NAME)
    return sum(spark.read.parquet(f"{path}/{n}").count() for n in files.names(spark, path) if n.startswith("generation-"))


def test_rows_are_not_written_again_for_every_batch(spark, lake, plan):
    landed(spark, lake, range(600))
    lake.refine(NAME)
    manifest = lake.silver(NAME).manifest()
    assert len(manifest.batches) >= 6 and not manifest.waiting and not manifest.waiting_batches
    assert lake.table("silver", NAME).count() == 540 <= written(spark, lake) < 2 * 540
    assert "Window" not in plan(lake.table("silver", NAME))


def test_one_batch_is_shuffled_and_written_once(spark, lake, monkeypatch):
    monkeypatch.setattr(Medallion, "MAX_BYTES", 1 << 40)
    written_at = []
    write = VersionedTable._write
    monkeypatch.setattr(VersionedTable, "_write", lambda self, placed: written_at.append(placed) or write(self, placed))
    landed(spark, lake, [*range(300), *range(300)])
    lake.refine(NAME)
    assert len(written_at) == 1 and BUCKET in written_at[0].columns
    assert lake.table("silver", NAME).count() == 270


def test_a_run_that_dies_before_settling_is_settled_by_the_next(spark, lake, monkeypatch):
    landed(spark, lake, range(100))
    first = lake.refine(NAME)
    landed(spark, lake, range(50, 200), member=0)

    def killed(self, one_per_key):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "settle", killed)
        with pytest.raises(KeyboardInterrupt):
            lake.refine(NAME)
        # Readers see the state before, in rows and counts.
        assert lake.table("silver", NAME).count() == 90 and lake.broken(NAME) == first
    second = lake.refine(NAME)
    assert second == {"n_rows": 150, "valid_subscription_event_key": 0, "known_event_type": 15}
    assert lake.broken(NAME)["n_rows"] == 250
    rows = {r.subscription_event_key: r.member_key for r in lake.table("silver", NAME).collect()}
    assert rows == {k: 1 if k < 50 else 0 for k in range(200) if k % 10}
    assert lake.refine(NAME) == {} and lake.table("silver", NAME).count() == 180
    table = lake.silver(NAME)
    table.tidy()
    assert lake.table("silver", NAME).count() == 180


def test_large_tables_land_in_four_files_without_a_shuffle(spark, star, tmp_path, monkeypatch):
    from kpiloom import catalog

    partitions = []
    monkeypatch.setattr(Medallion, "land", lambda self, frame, name: partitions.append((frame.rdd.getNumPartitions(), frame)))
    rows = spark.range(100, numPartitions=8)
    for least in (0, 1 << 40):
        monkeypatch.setattr(catalog, "TASK_BYTES", least)
        catalog._land_in_four(star, Medallion(spark, str(tmp_path)), NAME, rows, "lineitem")
    (large, moved), (small, dealt) = partitions
    assert large == small == 4
    texts = [f._jdf.queryExecution().executedPlan().toString() for f in (moved, dealt)]
    assert "Exchange" not in texts[0] and "Exchange" in texts[1]
