"""Set-based comparison of result sets with numeric tolerances.

One job compares any number of answers with their golden results. Results of
any shape come as rows of named text cells; ``normalized`` cleans them and
types the compared columns, ``keyed_diff`` folds both sides on the answer and
its row key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tolerance:
    """Equal when within either bound."""

    relative: float = 0.001
    absolute: float = 0.01


# Display names and the column each stands for.
COLUMN_ALIASES = {
    "region": "region_name",
    "campaign": "campaign_code",
    "churn_reduction": "churn_rate",
    "lifetime_hardware_revenue": "hardware_revenue_fytd",
    "lifetime_hardware_fytd_revenue": "hardware_revenue_fytd",
    "member": "member_id",
}
ZERO = 0.01


def _plain(name: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"), F.lit("_"))


# Stands between the names of a row while they are cleaned.
_MARK = "\x01"


def plain_cells(results: DataFrame) -> DataFrame:
    """Rows ``(answer_id, cells)`` as ``names``, each ``_plain``, and ``texts``.

    Names are cleaned in one text, without a lambda, and apart from the values:
    where they are literals, as ``cells`` makes them, Spark then does it once in the
    plan and not once per row.
    """
    raw = results.select("answer_id", F.col("cells.name").alias("names"), F.col("cells.value").alias("texts"))
    text = F.regexp_replace(F.lower(F.array_join("names", _MARK, _MARK)), f"[^a-z0-9{_MARK}]+", "_")
    plain = F.split(F.btrim(F.regexp_replace(text, f"_*{_MARK}_*", _MARK), F.lit("_")), _MARK)
    # A missing name or one that holds the mark makes the pieces too many.
    names = F.when(F.size(plain) == F.size("names"), plain).otherwise(F.transform("names", _plain))
    return raw.select("answer_id", names.alias("names"), "texts")


def number(text: Column) -> Column:
    """A text as the number it is; not-a-number counts as missing.

    A failed cast costs an exception, so only what starts like a number is cast.
    """
    starts = text.rlike(r"^[\x00-\x20]*([-+.0-9]|[iI][nN][fF]|[nN][aA][nN])")
    return F.when(starts, F.nanvl(text.try_cast("double"), F.lit(None).cast("double")))


def _rounded(number: Column) -> Column:
    return F.round(number, 4)


def _not_zero(number: Column) -> Column:
    """Beyond the zero bound once rounded to 4 places."""
    return F.coalesce(F.abs(number) >= ZERO + 0.00005, F.lit(False))


def cells(**named: Column) -> Column:
    """A result row as an array of named text cells."""
    return F.array(*(F.struct(F.lit(n).alias("name"), c.cast("string").alias("value")) for n, c in named.items()))


def normalized(results: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Result rows ``(answer_id, cells)`` as typed columns, cleaned.

    Names become snake case; a known alias stands in for a column the answer
    lacks. All rows of an answer have the same names, so that needs one row
    only. Two things need the whole answer. A column is numeric if any of its
    values is. And rows without a number go if the answer has rows with one,
    as do rows of zeros if it has others. Both come from boolean flags per
    answer, joined back. ``_has_...`` tells which measures the answer brought.
    """
    named = plain_cells(results).select(
        "answer_id", F.col("names").alias("_columns"), F.col("texts").alias("_values"), F.transform("texts", number).alias("_numbers")
    )

    def position(name: str) -> Column:
        """Where the column is; 0 when the row has neither it nor an alias."""
        place = F.array_position("_columns", F.lit(name))
        for alias in (a for a, target in COLUMN_ALIASES.items() if target == name):
            place = F.when(place > 0, place).otherwise(F.array_position("_columns", F.lit(alias)))
        return place.cast("int")

    def at(array: str, place: Column) -> Column:
        return F.get(F.col(array), place - 1)

    places = {name: position(name) for name in (*keys, *measures)}
    rows = named.select(
        "answer_id",
        "_columns",
        *(at("_values", places[k]).alias(k) for k in keys),
        *(_rounded(at("_numbers", places[k])).alias(f"_number_{k}") for k in keys),
        *(_rounded(at("_numbers", places[m])).alias(m) for m in measures),
        *((places[m] > 0).alias(f"_has_{m}") for m in measures),
        F.exists("_numbers", lambda n: n.isNotNull()).alias("_row_number"),
        F.exists("_numbers", _not_zero).alias("_row_nonzero"),
    )
    flags = rows.groupBy("answer_id").agg(
        F.max("_row_number").alias("_any_number"),
        F.max("_row_nonzero").alias("_any_nonzero"),
        *(F.max(F.col(f"_number_{k}").isNotNull()).alias(f"_numeric_{k}") for k in keys),
    )
    kept = F.when(F.col("_any_nonzero"), F.col("_row_nonzero")).when(F.col("_any_number"), F.col("_row_number"))
    typed = {
        k: F.when(F.col(f"_numeric_{k}"), F.col(f"_number_{k}").cast("string")).otherwise(F.col(k)) for k in keys
    }
    joined = rows.join(flags, "answer_id").where(kept.otherwise(F.lit(True)))
    return joined.select(
        "answer_id", *(c.alias(k) for k, c in typed.items()), *measures, *(f"_has_{m}" for m in measures)
    )


def top_rows(frame: DataFrame, measure: str, keys: list[str], n: int) -> DataFrame:
    """The ``n`` largest rows of each answer by measure, keys breaking ties."""
    order = Window.partitionBy("answer_id").orderBy(F.desc_nulls_last(measure), *keys)
    return frame.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop("_rank")


def within(got: Column, gold: Column, tolerance: Tolerance) -> Column:
    gap = F.abs(gold - got)
    return (gap <= tolerance.absolute) | (gap <= F.abs(gold) * tolerance.relative)


def keyed_diff(
    gold: DataFrame,
    got: DataFrame,
    keys: list[str],
    measures: list[str],
    tolerance: Tolerance = Tolerance(),
    answers: DataFrame | None = None,
) -> DataFrame:
    """Per answer: are both sides' rows the same, and which share agrees?

    A key on one side only makes the answer wrong with score 0. Otherwise the
    score is the share of agreeing keys in the first measure that has a
    disagreement. A measure the answer lacks (``_has_...``) is not held
    against it. Without keys this compares two single values. An answer of
    ``answers`` without rows on either side is correct.

    The sides are stacked and folded per key instead of joined: one shuffle,
    combined map-side, with no outer join for a hot answer to unbalance. A key
    that repeats agrees if its least values agree and its greatest ones.
    """
    on = ["answer_id", *keys]

    def side(frame: DataFrame, is_gold: bool) -> DataFrame:
        lacks = {m: ~F.col(f"_has_{m}") if f"_has_{m}" in frame.columns else F.lit(False) for m in measures}
        values = [F.coalesce(F.col(m).cast("double"), F.lit(0.0)).alias(m) for m in measures]
        return frame.select(
            *on, *values, *(lacks[m].alias(f"_lacks_{m}") for m in measures), F.lit(is_gold).alias("_gold")
        )

    is_gold = F.col("_gold")
    folds = []
    for m in measures:
        ours, theirs = F.when(is_gold, F.col(m)), F.when(~is_gold, F.col(m))
        folds += [
            F.min(ours).alias(f"gold_least_{m}"),
            F.max(ours).alias(f"gold_most_{m}"),
            F.min(theirs).alias(f"least_{m}"),
            F.max(theirs).alias(f"most_{m}"),
            F.max(F.when(~is_gold, F.col(f"_lacks_{m}"))).alias(f"lacks_{m}"),
        ]
    per_key = side(gold, True).unionByName(side(got, False)).groupBy(*on).agg(
        F.max(is_gold).alias("in_gold"), F.max(~is_gold).alias("in_got"), *folds
    )
    both = F.col("in_gold") & F.col("in_got")

    def agrees(m: str) -> Column:
        near = [within(F.col(f"{end}_{m}"), F.col(f"gold_{end}_{m}"), tolerance) for end in ("least", "most")]
        return F.col(f"lacks_{m}") | (near[0] & near[1])

    summary = per_key.groupBy("answer_id").agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(both).alias("n_both"),
        *(F.count_if(both & agrees(m)).alias(f"ok_{m}") for m in measures),
    )
    if answers is not None:
        counted = [c for c in summary.columns if c != "answer_id"]
        summary = answers.select("answer_id").distinct().join(summary, "answer_id", "left").fillna(0, counted)
    matched = F.col("n_keys") == F.col("n_both")
    shares = [F.try_divide(F.col(f"ok_{m}"), F.col("n_both")) for m in measures]
    failing = F.coalesce(*(F.when(s < 1, s) for s in shares), F.lit(1.0))
    score = F.when(matched, failing).otherwise(0.0)
    return summary.select(
        "answer_id",
        "n_keys",
        (F.col("n_keys") - F.col("n_both")).alias("n_unmatched"),
        (score == 1.0).alias("correct"),
        score.alias("answer_score"),
    )


def zero_or_empty(expected: DataFrame, results: DataFrame, measure: str, tolerance: float = ZERO) -> DataFrame:
    """Answers that should hold nothing: no rows at all, or only zeros."""
    worst = results.groupBy("answer_id").agg(F.max(F.abs(F.coalesce(measure, F.lit(0)))).alias("worst"))
    correct = F.coalesce(F.col("worst"), F.lit(0)) <= tolerance
    return expected.join(worst, "answer_id", "left").select("answer_id", correct.alias("correct"))
