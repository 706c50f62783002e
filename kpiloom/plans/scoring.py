"""Scoring of answers: matching results, judging text, gating whole runs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.table_functions import KpiSettings
from kpiloom.functions.text_rules import failure_type, rubric, rubric_columns
from kpiloom.operators.aggregates import safe_ratio
from kpiloom.operators.diff import Tolerance, cells, keyed_diff, normalized, top_rows, zero_or_empty
from kpiloom.operators.infer import inferred_diff
from kpiloom.operators.joins import first_per_key
from kpiloom.plans import kpis, metric_views
from kpiloom.plans.kpis import NET
from kpiloom.sources.answers import decode_sql
from kpiloom.sources.sinks import read_runs, replace_runs
from kpiloom.sources.star import Star

ANSWER_KEY = ["run_id", "tier", "question_id"]


# -- answers whose result is a set of rows ----------------------------------------


def delivered(star: Star, *columns: str) -> DataFrame:
    """Fulfilled lines with their copies, as a reader of the plain table sums them."""
    lines = star.bronze_lines(*dict.fromkeys((*columns, "line_status")))
    return lines.where(F.col("line_status") == "FULFILLED").select(*columns)


def _yearly(lines: DataFrame, star: Star, *keys: str) -> DataFrame:
    """Revenue per product and fiscal year, on the narrow keys facts carry."""
    dates = F.broadcast(star.dim_date().select("date_key", "fiscal_year", "fiscal_quarter"))
    dated = lines.join(dates, F.col("recognition_date_key") == F.col("date_key"))
    return dated.groupBy("product_key", "fiscal_year", *keys).agg(F.sum(NET).alias(NET))


def _answered(yearly: DataFrame, star: Star) -> DataFrame:
    """Sums with the answer they belong to: one per SKU and fiscal year."""
    skus = star.dim_product().select("product_key", "sku_code", "product_family")
    return yearly.join(skus, "product_key").withColumn("answer_id", F.concat_ws("|", "sku_code", "fiscal_year"))


def _by_region(lines: DataFrame, star: Star) -> DataFrame:
    geo = star.dim_geo().select("geo_key", "region_name")
    return _answered(_yearly(lines.join(geo, "geo_key"), star, "region_name"), star)


REGION_COLUMNS = ("product_key", "recognition_date_key", "geo_key", NET)


def copied_results(star: Star) -> DataFrame:
    """What a reader of the plain copy answers: no dedup, all line states.

    The rows come as an agent returns them, under display names and with a
    zero row for regions that only have unfulfilled lines.
    """
    summed = _by_region(star.bronze_lines(*REGION_COLUMNS), star)
    return summed.select(
        "answer_id", cells(**{"Region": F.col("region_name"), "Recognized  Revenue!": F.col(NET)}).alias("cells")
    )


def golden_results(star: Star) -> DataFrame:
    lines = star.fulfilled(*REGION_COLUMNS)
    return _by_region(lines, star).select(
        "answer_id", cells(region_name=F.col("region_name"), recognized_revenue=F.col(NET)).alias("cells")
    )


def _typed(results: DataFrame) -> DataFrame:
    return normalized(results, ["region_name"], ["recognized_revenue"])


def normalized_answers(star: Star) -> DataFrame:
    return _typed(copied_results(star)).select("answer_id", "region_name", "recognized_revenue")


def region_diff(star: Star) -> DataFrame:
    """Keyed comparison of every SKU-year's revenue by region."""
    gold, got = _typed(golden_results(star)), _typed(copied_results(star))
    return keyed_diff(gold, got, ["region_name"], ["recognized_revenue"])


def scalar_diff(star: Star) -> DataFrame:
    """One number per answer: the SKU-year's whole revenue."""

    def total(lines: DataFrame) -> DataFrame:
        return _answered(_yearly(lines, star), star).select("answer_id", F.col(NET).alias("revenue"))

    columns = ("product_key", "recognition_date_key", NET)
    gold = star.fulfilled(*columns)
    return keyed_diff(total(gold), total(delivered(star, *columns)), [], ["revenue"])


def ranking_diff(star: Star, n: int = 10) -> DataFrame:
    """The top SKUs of every fiscal year, ranked by revenue on both sides."""
    columns = ("product_key", "recognition_date_key", NET)

    def ranked(lines: DataFrame) -> DataFrame:
        yearly = _answered(_yearly(lines, star), star)
        named = yearly.select(F.col("fiscal_year").cast("string").alias("answer_id"), "sku_code", F.col(NET).alias("revenue"))
        return top_rows(named, "revenue", ["sku_code"], n)

    gold = star.fulfilled(*columns)
    return keyed_diff(ranked(gold), ranked(delivered(star, *columns)), ["sku_code"], ["revenue"])


def quarter_pivot_diff(star: Star) -> DataFrame:
    """Long answers (family, quarter, revenue) against wide golden rows."""
    columns = ("product_key", "recognition_date_key", NET)
    quarters = {1: "q1_revenue", 2: "q2_revenue"}

    def dated(lines: DataFrame) -> DataFrame:
        quarterly = _answered(_yearly(lines, star, "fiscal_quarter"), star)
        families = quarterly.withColumn("answer_id", F.col("fiscal_year").cast("string"))
        return families.where(F.col("fiscal_quarter").isin(*quarters))

    long = dated(delivered(star, *columns)).groupBy("answer_id", "product_family", "fiscal_quarter").agg(
        F.sum(NET).alias("revenue")
    )
    got = long.groupBy("answer_id", "product_family").pivot("fiscal_quarter", list(quarters)).agg(F.sum("revenue"))
    got = got.withColumnsRenamed({str(q): name for q, name in quarters.items()})
    gold = dated(
        star.fulfilled(*columns)
    ).groupBy("answer_id", "product_family").agg(
        *(F.sum(F.when(F.col("fiscal_quarter") == q, F.col(NET)).otherwise(0)).alias(n) for q, n in quarters.items())
    )
    return keyed_diff(gold, got, ["product_family"], list(quarters.values()))


def inferred_region_diff(star: Star) -> DataFrame:
    """``region_diff`` with neither the key nor the measure named."""
    return inferred_diff(golden_results(star), copied_results(star))


def inferred_quarter_diff(star: Star) -> DataFrame:
    """``quarter_pivot_diff`` as agents answer it: rows per quarter, which each
    family calls differently, against golden rows with a column per quarter."""
    columns = ("product_key", "recognition_date_key", NET)

    def dated(lines: DataFrame) -> DataFrame:
        quarterly = _answered(_yearly(lines, star, "fiscal_quarter"), star)
        families = quarterly.withColumn("answer_id", F.col("fiscal_year").cast("string"))
        return families.where(F.col("fiscal_quarter").isin(1, 2))

    sums = [F.sum(F.when(F.col("fiscal_quarter") == q, F.col(NET)).otherwise(0)).alias(f"q{q}") for q in (1, 2)]
    gold = dated(star.fulfilled(*columns)).groupBy("answer_id", "product_family").agg(*sums)
    gold = gold.select("answer_id", cells(product_family=F.col("product_family"), q1_revenue=F.col("q1"), q2_revenue=F.col("q2")).alias("cells"))
    long = dated(delivered(star, *columns)).groupBy("answer_id", "product_family", "fiscal_quarter").agg(F.sum(NET).alias("revenue"))
    kind = F.pmod(F.crc32(F.encode("product_family", "UTF-8")), F.lit(3))
    prefix = F.when(kind == 0, "").when(kind == 1, "Q").otherwise("fiscal_q")
    said = F.concat(prefix, F.col("fiscal_quarter").cast("string"))
    named = cells(**{"Product Family": F.col("product_family"), "Fiscal Quarter": said, "Revenue": F.col("revenue")})
    return inferred_diff(gold, long.select("answer_id", named.alias("cells")))


def idle_skus(star: Star, settings: KpiSettings) -> DataFrame:
    """Which SKUs rightly answer zero or nothing for the last fiscal month."""
    month = kpis.last_fiscal_month(star, settings.as_of)
    lines = star.fulfilled("product_key", NET, recognized=month)
    revenue = lines.groupBy("product_key").agg(F.sum(NET).alias(NET))
    skus = star.dim_product().select("product_key", F.col("sku_code").alias("answer_id"))
    return zero_or_empty(skus.select("answer_id"), revenue.join(skus, "product_key"), NET)


def views_against_golden(star: Star, settings: KpiSettings) -> DataFrame:
    """The metric views must give what the golden queries give.

    Money may differ by 0.02 and counts by 0.5. The ranking is compared
    whole, so ties at its cut cannot matter.
    """
    rich = metric_views.sales_rich(star, settings)
    stacked = metric_views.conformed(star, settings, settings.subscriptions_as_of)
    region = f"`Region Code` = '{settings.home_region}'"

    def check(name: str, gold: DataFrame, got: DataFrame, keys: list[str], value: str, absolute: float) -> DataFrame:
        tagged = [f.withColumn("answer_id", F.lit(name)) for f in (gold, got)]
        return keyed_diff(*tagged, keys, [value], Tolerance(0.0, absolute))

    checks = [
        check(
            "last_month_revenue",
            kpis.revenue_last_fiscal_month(star, settings.as_of),
            rich.query(measures=["Recognized Revenue"], where=["Is Last Fiscal Month"]).withColumnRenamed(
                "recognized_revenue", "total_recognized_revenue"
            ),
            [], "total_recognized_revenue", 0.02,
        ),
        check(
            "last_quarter_by_region",
            kpis.revenue_by_region_last_quarter(star, settings.as_of),
            rich.query(["Region"], ["Recognized Revenue"], ["Is Last Fiscal Quarter"]).withColumnRenamed(
                "region", "region_name"
            ),
            ["region_name"], "recognized_revenue", 0.02,
        ),
        check(
            "active_members",
            kpis.active_members(star, settings.active_rule, settings.home_region),
            stacked.query(measures=["Active Members"], where=[region, "Is Current Fiscal Year"]),
            [], "active_members", 0.5,
        ),
        check(
            "campaign_churn",
            kpis.campaign_churn(star, settings.retention, limit=None),
            stacked.query(
                ["Campaign Code"], ["Churn Rate"],
                # The golden query knows no campaign outside its dimension.
                ["Is Retention Push Window", "`Fact Family` = 'subscription'", "`Campaign Code` IS NOT NULL"],
            ),
            ["campaign_code"], "churn_rate", 1e-9,
        ),
    ]
    union = checks[0]
    for frame in checks[1:]:
        union = union.unionByName(frame)
    return union


# -- answers judged by their text ---------------------------------------------------


def latest_attempts(answers: DataFrame) -> DataFrame:
    return first_per_key(answers, ANSWER_KEY, F.desc("attempt"), F.desc("message_id"))


def classified(answers: DataFrame) -> DataFrame:
    """Every answer with its failure label."""
    label = failure_type(
        F.col("status"), decode_sql(F.col("generated_sql")), F.col("clarification_asked"), F.col("correct")
    )
    return answers.withColumn("failure_type", label)


OPEN_QUESTIONS = ("Q4", "Q7")


def rubric_scores(answers: DataFrame) -> DataFrame:
    return rubric(answers, *OPEN_QUESTIONS, decode_sql(F.col("generated_sql")))


def evaluated(answers: DataFrame) -> DataFrame:
    """Scores of the latest attempts; open questions by rubric, others as matched."""
    judged = rubric_columns(*OPEN_QUESTIONS, decode_sql(F.col("generated_sql")))
    verdicts = {name: F.coalesce(verdict, F.col(name)) for name, verdict in judged.items()}
    scored = classified(latest_attempts(answers).withColumns(verdicts))
    return scored.select(*ANSWER_KEY, "attempt", "message_id", "correct", "answer_score", "failure_type")


def with_scores(answers: DataFrame, scores: DataFrame) -> DataFrame:
    """Answers with their scores filled in, as a keyed update would.

    First-pass correctness changes on a scored first attempt only.
    """
    key = [*ANSWER_KEY, "attempt", "message_id"]
    new = scores.select(
        *key,
        F.col("correct").alias("_correct"),
        F.col("answer_score").alias("_score"),
        F.col("failure_type").alias("_failure"),
    ).withColumn("_scored", F.lit(True))
    joined = answers.join(new, key, "left")
    scored = F.col("_scored").isNotNull()
    first = scored & (F.col("attempt") == 0)
    updates = {
        "is_first_pass_correct": F.when(first, F.col("_correct")).otherwise(F.col("is_first_pass_correct")),
        "correct": F.when(scored, F.col("_correct")).otherwise(F.col("correct")),
        "answer_score": F.when(scored, F.col("_score")).otherwise(F.col("answer_score")),
        "failure_type": F.when(scored, F.col("_failure")).otherwise(F.col("failure_type")),
    }
    return joined.withColumns(updates).select(*answers.columns)


def update_scores(spark: SparkSession, path: str) -> None:
    """Score the answer table at ``path`` in place, all its runs in one job."""
    stored = read_runs(spark, path)
    replace_runs(with_scores(stored, evaluated(stored)), path)


def tier_accuracy(scores: DataFrame) -> DataFrame:
    return scores.groupBy("tier").agg(
        F.count(F.lit(1)).alias("n_answers"),
        F.count_if("correct").alias("n_correct"),
        safe_ratio(F.count_if("correct"), F.count(F.lit(1))).alias("accuracy"),
    )


@dataclass(frozen=True)
class Gate:
    """Bounds a run has to keep to count as uncontaminated."""

    control: str = "T0"
    control_most: float = 0.35
    full: str = "T4"
    full_least: float = 0.70
    floor: float = 0.50
    tiers_above_floor: int = 3


def contamination_gate(tco: DataFrame, gate: Gate = Gate()) -> DataFrame:
    """One verdict per run.

    FAIL when the control tier is too accurate on first passes; WARN when the
    full tier is too weak or too few tiers clear the quality floor.
    """

    def first_pass(tier: str):
        return F.max(F.when(F.col("tier") == tier, F.col("first_pass_accuracy")))

    runs = tco.groupBy("run_id").agg(
        first_pass(gate.control).alias("control_first_pass"),
        first_pass(gate.full).alias("full_first_pass"),
        F.count_if(F.col("eventual_accuracy") >= gate.floor).alias("n_above_floor"),
    )
    too_good = F.col("control_first_pass") > gate.control_most
    too_weak = F.col("full_first_pass") < gate.full_least
    sparse = F.col("n_above_floor") < gate.tiers_above_floor
    status = F.when(too_good, "FAIL").when(F.coalesce(too_weak, F.lit(False)) | sparse, "WARN").otherwise("PASS")
    return runs.withColumn("status", status)
