import pytest
from pyspark.sql import functions as F

from kpiloom.plans import kpis
from kpiloom.catalog import SETTINGS
from kpiloom.sources import files
from kpiloom.sources.sinks import append_runs, clustered, read_runs, replace_runs, runs_table, write_along_curve, write_gold
from kpiloom.sources.star import TABLE_KEYS, GoldStar, RetailStar
from kpiloom.sources.versioned import VersionedTable
from kpiloom.streaming.medallion import Medallion, quality_report

SCHEMA = "subscription_event_key long, member_key long, event_type string"


@pytest.fixture()
def lake(spark, tmp_path):
    return Medallion(spark, str(tmp_path / "lake"))


def events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("event_date_key", F.lit(9)).coalesce(1)


NAME = "fact_subscription_event"


@pytest.mark.parametrize("dedup", ["batch", "stateful", "watermark"])
def test_bad_rows_and_copies_are_dropped_over_restarts(spark, lake, dedup):
    lake.land(events(spark, [(1, 1, "RENEW"), (1, 1, "RENEW"), (2, 1, "CLICK"), (None, 2, "CANCEL"), (3, 2, None)]), NAME)
    lake.build(NAME, dedup)
    lake.land(events(spark, [(1, 1, "RENEW"), (4, 3, "CANCEL"), (4, 3, "CANCEL")]), NAME)
    gold = lake.build(NAME, dedup)
    assert sorted(r.subscription_event_key for r in gold.collect()) == [1, 4]
    assert lake.table("bronze", NAME).count() == 8
    # Nothing new has landed, so nothing changes.
    assert lake.build(NAME, dedup).count() == 2


@pytest.mark.parametrize("dedup", ["batch", "stateful"])
def test_broken_rows_are_counted_while_streaming(spark, lake, dedup):
    lake.land(events(spark, [(1, 1, "RENEW"), (2, 1, "CLICK"), (None, 2, "CANCEL"), (None, 2, None)]), NAME)
    lake.ingest(NAME)
    assert lake.refine(NAME, dedup) == {"n_rows": 4, "valid_subscription_event_key": 2, "known_event_type": 2}
    assert lake.refine(NAME, dedup) == {}


def test_hot_key_leaves_one_row_and_the_first_in_order(spark, lake):
    copies = spark.range(3000).selectExpr("7L AS subscription_event_key", "id AS member_key", "'RENEW' AS event_type", "9 AS event_date_key")
    lake.land(copies, NAME)
    rows = lake.build(NAME).collect()
    assert [(r.subscription_event_key, r.member_key) for r in rows] == [(7, 0)]


def test_new_columns_are_taken_on_at_the_next_start(spark, lake):
    lake.land(events(spark, [(1, 1, "RENEW")]), NAME)
    lake.build(NAME)
    lake.land(events(spark, [(2, 1, "RENEW")]).withColumn("channel", F.lit("web")), NAME)
    gold = {r.subscription_event_key: r.channel for r in lake.build(NAME).collect()}
    assert gold == {1: None, 2: "web"}


def test_quality_report_counts_each_rule(spark):
    frame = events(spark, [(1, 1, "RENEW"), (2, 1, "CLICK"), (None, 2, "CANCEL"), (None, 2, None)])
    rows = {r.expectation: (r.n_rows, r.n_kept, r.n_dropped) for r in quality_report(frame, NAME).collect()}
    assert rows == {"valid_subscription_event_key": (4, 1, 2), "known_event_type": (4, 1, 2)}


def test_all_ten_tables_reach_gold_and_answer_queries(spark, star, lake):
    for name, key in TABLE_KEYS.items():
        lake.land(star.table(name), name)
        gold = lake.build(name)
        assert gold.count() == gold.select(key).distinct().count() > 0, name
    gold = GoldStar(spark, f"{lake.root}/gold", star.calendar)
    assert gold.table("dim_date").schema["calendar_date"].dataType.simpleString() == "date"
    for query in (
        lambda s: kpis.campaign_churn(s, SETTINGS.retention),
        lambda s: kpis.active_members(s, SETTINGS.active_rule, SETTINGS.home_region),
        lambda s: kpis.members_in_region(s, SETTINGS.home_region),
    ):
        assert query(gold).collect() == query(star).collect()
    assert kpis.top_members_by_hardware_revenue(gold, SETTINGS.as_of).count() > 0


def test_clustered_files_hold_narrow_ranges(spark, star, tmp_path, plan, many_partitions):
    path = str(tmp_path / "gold" / "fact_order_line")
    write_gold(star.fact_order_line(), "fact_order_line", path)
    spans = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(
        F.min("recognition_date_key").alias("low"), F.max("recognition_date_key").alias("high")).orderBy("low").collect()
    assert len(spans) > 1
    assert all(a.high <= b.low for a, b in zip(spans, spans[1:]))
    gold = GoldStar(spark, str(tmp_path / "gold"), star.calendar)
    text = plan(kpis.revenue_last_fiscal_month(gold, SETTINGS.as_of))
    assert "GreaterThanOrEqual(recognition_date_key" in text and "EqualTo(line_status,FULFILLED)" in text


def test_one_hot_day_spreads_over_files(spark, tmp_path, many_partitions):
    hot = spark.range(20000).selectExpr("id AS return_key", "CASE WHEN id % 3 = 0 THEN id ELSE 5 END AS return_date_key")
    path = str(tmp_path / "fact_return")
    write_gold(hot, "fact_return", path)
    files = spark.read.parquet(path).where("return_date_key = 5").select(F.input_file_name()).distinct().count()
    assert files > 1


def test_silver_does_not_depend_on_how_files_fall_into_batches(spark, tmp_path, monkeypatch, plan):
    star = RetailStar(spark, "/root/testdata/sf0.001")
    lines = star.bronze_order_line().repartition(3)
    results = []
    for limit in (Medallion.MAX_BYTES, 1):
        monkeypatch.setattr(Medallion, "MAX_BYTES", limit)
        lake = Medallion(spark, str(tmp_path / f"lake-{limit}"))
        lake.land(lines, "fact_order_line")
        gold = lake.build("fact_order_line")
        results.append(sorted(map(tuple, gold.collect())))
        assert lake.broken("fact_order_line")["n_rows"] == lines.count()
    assert results[0] == results[1]
    assert len(lake.silver("fact_order_line").manifest().batches) > 1
    assert "Window" not in plan(lake.table("silver", "fact_order_line"))
    got = spark.createDataFrame(results[0], gold.schema).groupBy().sum("net_recognized_amount").first()[0]
    assert float(got) == pytest.approx(float(star.lines("net_recognized_amount").groupBy().sum().first()[0]))


@pytest.mark.parametrize("dedup", ["batch", "stateful"])
def test_counts_are_whole_with_a_short_progress_history(spark, lake, monkeypatch, dedup):
    """More batches than the query remembers, over two runs."""
    monkeypatch.setattr(Medallion, "MAX_BYTES", 1)
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "2")
    try:
        counts = []
        for run in range(2):
            rows = [(100 * run + i, i, "RENEW" if i % 3 else "CLICK") for i in range(30)]
            lake.land(spark.createDataFrame(rows, SCHEMA).withColumn("event_date_key", F.lit(9)).repartition(6), NAME)
            lake.ingest(NAME)
            counts.append(lake.refine(NAME, dedup))
    finally:
        spark.conf.unset(key)
    assert counts == [{"n_rows": 30, "valid_subscription_event_key": 0, "known_event_type": 10}] * 2
    if dedup == "batch":
        assert lake.broken(NAME) == {"n_rows": 60, "valid_subscription_event_key": 0, "known_event_type": 20}
    assert lake.table("silver", NAME).count() == 40


def test_a_retried_batch_changes_neither_rows_nor_counts(spark, lake):
    """The stream's own note of the batch is lost after silver has taken it."""
    lake.land(events(spark, [(1, 1, "RENEW"), (2, 1, "CLICK"), (3, 1, "CANCEL")]), NAME)
    lake.ingest(NAME)
    first = lake.refine(NAME)
    before = sorted(map(tuple, lake.table("silver", NAME).collect())), lake.broken(NAME)
    commits = lake.path("checkpoints", f"silver-{NAME}") + "/commits"
    for name in files.names(spark, commits):
        files.remove(spark, f"{commits}/{name}")
    assert first["n_rows"] == 3 and lake.refine(NAME) == {}
    assert (sorted(map(tuple, lake.table("silver", NAME).collect())), lake.broken(NAME)) == before


def test_a_batch_rewrites_only_the_buckets_it_falls_into(spark, lake, monkeypatch):
    monkeypatch.setattr("kpiloom.streaming.medallion.NEIGHBOURS", 10)
    lake.land(events(spark, [(i, 1, "RENEW") for i in range(400)]), NAME)
    lake.build(NAME)
    before = lake.silver(NAME).manifest().buckets
    lake.land(events(spark, [(5, 0, "CANCEL"), (401, 1, "RENEW")]), NAME)
    lake.build(NAME)
    after = lake.silver(NAME).manifest().buckets
    assert len(before) > 10 and 1 <= sum(before[b] != after[b] for b in before) <= 2
    rows = {r.subscription_event_key: r.member_key for r in lake.table("silver", NAME).collect()}
    assert len(rows) == 401 and rows[5] == 0


def runs(spark, values):
    return spark.createDataFrame([(r, v) for r, v in values], "run_id string, v long")


def test_a_job_killed_before_its_commit_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    replace_runs(runs(spark, [(f"r{i}", i) for i in range(20)]), path)
    old = sorted(map(tuple, read_runs(spark, path).collect()))

    def killed(self, manifest):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "_commit", killed)
        for change in (replace_runs, append_runs):
            with pytest.raises(KeyboardInterrupt):
                change(runs(spark, [("r3", 99), ("r99", 1)]), path)
            assert sorted(map(tuple, read_runs(spark, path).collect())) == old
    replace_runs(runs(spark, [("r3", 99), ("r99", 1)]), path)
    now = sorted(map(tuple, read_runs(spark, path).collect()))
    assert now == sorted([*((r, v) for r, v in old if r != "r3"), ("r3", 99), ("r99", 1)])
    table = runs_table(spark, path)
    table.tidy()
    assert sorted(map(tuple, read_runs(spark, path).collect())) == now
    left = {n for n in files.names(spark, path) if n.startswith("generation-")}
    assert left == table.manifest().generations


def test_replaced_rows_are_worked_out_once(spark, tmp_path):
    path, counted = str(tmp_path / "runs"), spark.sparkContext.accumulator(0)
    replace_runs(runs(spark, [("a", 1), ("b", 2)]), path)

    def counting(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    replace_runs(runs(spark, [("a", 5), ("c", 6)]).mapInArrow(counting, "run_id string, v long"), path)
    assert counted.value == 2
    assert sorted(map(tuple, read_runs(spark, path).collect())) == [("a", 5), ("b", 2), ("c", 6)]


def test_a_late_writer_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "runs")
    append_runs(runs(spark, [("a", 1)]), path)
    table = runs_table(spark, path)
    late = table.manifest()
    append_runs(runs(spark, [("b", 2)]), path)
    with pytest.raises(RuntimeError, match="meanwhile"):
        table._commit(late)
    assert read_runs(spark, path).count() == 2


def touched(spark, path, key, value):
    """Files whose footers cannot rule a value out."""
    spans = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.min(key).alias("low"), F.max(key).alias("high")).collect()
    return sum(s.low <= value <= s.high for s in spans), len(spans)


def test_files_along_a_curve_are_narrow_in_every_key(spark, tmp_path, many_partitions):
    """A third of all rows share one day."""
    rows = spark.range(40_000).selectExpr(
        "id AS return_key", "CASE WHEN id % 3 = 0 THEN 500 ELSE id * 7919 % 1000 END AS day", "id * 104729 % 997 AS product", "id * 1299709 % 503 AS member"
    )
    keys = ("day", "product", "member")
    curve, plain = str(tmp_path / "curve"), str(tmp_path / "plain")
    write_along_curve(rows, keys, "return_key", curve, file_bytes=12_000)
    count = touched(spark, curve, "day", 0)[1]
    clustered(rows, keys, "return_key").repartitionByRange(count, *keys).write.parquet(plain)
    assert count > 20 and spark.read.parquet(curve).exceptAll(rows).count() == 0 == rows.exceptAll(spark.read.parquet(curve)).count()
    for key in ("product", "member"):
        assert touched(spark, curve, key, 250)[0] < 0.7 * touched(spark, plain, key, 250)[0]
    assert touched(spark, curve, "day", 250)[0] < 0.5 * count


def test_a_curve_takes_nulls_and_empty_tables(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, 2), (2, 5, None), (3, None, None)], "id long, a long, b long")
    for i, frame in enumerate((rows, rows.where("false"))):
        path = str(tmp_path / str(i))
        write_along_curve(frame, ("a", "b"), "id", path)
        assert sorted(r.id for r in spark.read.schema(rows.schema).parquet(path).collect()) == sorted(r.id for r in frame.collect())
