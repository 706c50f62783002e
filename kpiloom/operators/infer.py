"""Comparison of result sets whose key and measures nobody has named.

For every answer a profile of its columns is worked out on both sides: their order,
and which are numbers. From these follow, for each answer on its own, the key (the
golden side's first column that both have, that holds text and sounds like an
identifier), the measures (the golden side's numbers that both have) and whether
the answer is long: one row per key and quarter instead of a column per quarter.

Everything is a fold over rows: profiles have a row per answer and column, and
values a row per answer, key and measure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.operators.diff import COLUMN_ALIASES, Tolerance, _not_zero, _rounded, number, plain_cells, within

# Parts of names that sound like identifiers, the names a quarter's
# column and its values go by, and the golden columns they stand for.
IDENTIFIERS = ("id", "code", "name", "family", "region", "handle")
QUARTER_NAMES = ("fiscal_quarter", "q")
QUARTERS = {"q1_revenue": ("1", "q1", "fiscal_q1"), "q2_revenue": ("2", "q2", "fiscal_q2")}
#: The measure of answers that are a single number.
ONLY = "value"


def _numbers() -> Column:
    return F.transform("texts", lambda t: _rounded(number(t))).alias("numbers")


def _rows(results: DataFrame) -> DataFrame:
    """Rows with plain names, values, and the numbers that they are."""
    aliases = F.create_map(*[F.lit(x) for pair in COLUMN_ALIASES.items() for x in pair])
    names = F.col("names")
    known = F.transform(names, lambda n: F.when(F.array_contains(names, aliases[n]), n).otherwise(F.coalesce(aliases[n], n)))
    aliased = F.arrays_overlap(names, F.array(*map(F.lit, COLUMN_ALIASES)))
    return plain_cells(results).select("answer_id", F.when(aliased, known).otherwise(names).alias("names"), "texts", _numbers())


def profiles(rows: DataFrame, sides: dict[str, Column] | None = None) -> DataFrame:
    """Per answer its columns in order, and whether any row has a number, or one
    that is not zero. A column is one of numbers if it has any and no other text.

    ``sides`` tells rows apart that have a profile each, side by side, by the prefix
    of its names. It is NULL for a side without any column.
    """
    sides = sides or {"": F.lit(True)}
    cells = rows.withColumns({f"_{side}": c for side, c in sides.items()}).select(
        "answer_id", *(f"_{side}" for side in sides), F.posexplode_outer(F.arrays_zip("names", "texts", "numbers")).alias("place", "c")
    )
    per_column = cells.groupBy("answer_id", *(f"_{side}" for side in sides), "place", F.col("c.names").alias("name")).agg(
        F.bool_or(F.col("c.numbers").isNotNull()).alias("any"),
        F.bool_and(F.col("c.numbers").isNotNull() | F.col("c.texts").isNull()).alias("only"),
        F.bool_or(_not_zero(F.col("c.numbers"))).alias("not_zero"),
    )
    column = F.struct(F.col("place").cast("int").alias("place"), "name", (F.col("any") & F.col("only")).alias("number"))
    folds = []
    for side in sides:
        there = F.col(f"_{side}") & F.col("place").isNotNull()
        listed = F.sort_array(F.collect_list(F.when(there, column)))
        folds += [
            F.when(F.size(listed) > 0, listed).alias(f"{side}columns"),
            F.bool_or(F.when(there, F.col("any"))).alias(f"{side}any_number"),
            F.bool_or(F.when(there, F.col("not_zero"))).alias(f"{side}any_not_zero"),
        ]
    return per_column.groupBy("answer_id").agg(*folds)


def _has(columns: Column, name: Column) -> Column:
    return F.exists(columns, lambda c: c["name"] == name)


def shapes(profile: DataFrame) -> DataFrame:
    """Per answer: key, measures, and for a long answer its quarter's and value's
    columns, beside what its profiles (``our_``, ``their_``) say of its numbers."""
    # Of an answer that one side has no rows for, the other side's columns do.
    ours, theirs = F.coalesce("our_columns", "their_columns"), F.coalesce("their_columns", "our_columns")
    both = profile.withColumns({"ours": ours, "theirs": theirs})
    shared = F.filter("ours", lambda c: _has(F.col("theirs"), c["name"]))
    named = lambda c: F.exists(F.array(*map(F.lit, IDENTIFIERS)), lambda part: F.contains(c["name"], part))
    key = F.get(F.filter(shared, lambda c: ~c["number"] & named(c)), F.lit(0))["name"]
    both = both.withColumn("key", key)
    measures = F.transform(F.filter(shared, lambda c: c["number"]), lambda c: c["name"])
    is_quarter = lambda c: F.contains(c["name"], F.lit("quarter")) | c["name"].isin(*QUARTER_NAMES)
    quarter = F.get(F.filter("theirs", is_quarter), F.lit(0))["name"]
    wide = F.lit(True)
    for name in QUARTERS:
        wide = wide & _has(F.col("ours"), F.lit(name)) & ~_has(F.col("theirs"), F.lit(name))
    both = both.withColumn("quarter", F.when(wide & F.col("key").isNotNull(), quarter))
    value = F.filter("theirs", lambda c: c["number"] & (c["name"] != F.col("key")) & (c["name"] != F.col("quarter")))
    # Without a key, an answer is its first number.
    first = lambda side: F.get(F.filter(side, lambda c: c["number"]), F.lit(0))["name"]
    return both.select(
        "answer_id",
        "key",
        measures.alias("measures"),
        "quarter",
        F.when(F.col("quarter").isNotNull(), F.get(value, F.lit(0))["name"]).alias("value"),
        first("ours").alias("our_number"),
        first("theirs").alias("their_number"),
        *(f"{side}_{flag}" for side in ("our", "their") for flag in ("any_number", "any_not_zero")),
    )


def _at(array: str, name: Column) -> Column:
    return F.get(F.col(array), F.array_position("names", name).cast("int") - 1)


def _values(rows: DataFrame, shape: DataFrame) -> DataFrame:
    """(answer_id, key, measure, our, their): what is compared of the rows that count.

    Of rows that don't, and of answers without a measure, a row without a measure
    is left, so that every answer stays.
    """
    gold = F.col("gold")
    own = lambda name: F.when(gold, F.col(f"our_{name}")).otherwise(F.col(f"their_{name}"))
    row_number = F.exists("numbers", lambda n: n.isNotNull())
    kept = F.when(own("any_not_zero"), F.exists("numbers", _not_zero)).when(own("any_number"), row_number).otherwise(F.lit(True))
    # Numbers follow from the texts, so the join need not carry them.
    joined = rows.drop("numbers").join(shape, "answer_id", "left").select("*", _numbers()).withColumn("counts", own("any_number").isNotNull() & kept)
    pair = lambda name, number: F.struct(name.alias("measure"), F.coalesce(number, F.lit(0.0)).alias("number"))
    pairs = F.transform("measures", lambda m: pair(m, _at("numbers", m)))
    pairs = F.when(F.col("key").isNull(), F.array(pair(F.lit(ONLY), _at("numbers", own("number"))))).otherwise(pairs)
    wide = F.array(*[pair(F.lit(m), _at("numbers", F.lit(m))) for m in QUARTERS])
    said = F.lower(_at("texts", F.col("quarter")))
    measure = F.lit(None).cast("string")
    for name, values in QUARTERS.items():
        measure = F.when(said.isin(*values), name).otherwise(measure)
    long = F.array(pair(measure, _at("numbers", F.col("value"))))
    pairs = F.when(F.col("quarter").isNotNull(), F.when(gold, wide).otherwise(long)).otherwise(pairs)
    key = F.coalesce(_at("texts", F.col("key")), F.when(F.col("key").isNull(), F.lit("")))
    exploded = joined.select("answer_id", "gold", key.alias("key"), F.explode_outer(F.when(F.col("counts"), pairs)).alias("p"))
    known = F.col("p.measure").isNotNull()
    values = exploded.select("answer_id", "gold", F.when(known, F.col("key")).alias("key"), "p.measure", F.when(known, F.col("p.number")).alias("number"))
    # A long answer's rows for a key and quarter add up.
    return values.groupBy("answer_id", "key", "measure").agg(
        F.sum(F.when(gold, F.col("number"))).alias("our"), F.sum(F.when(~gold, F.col("number"))).alias("their")
    )


def inferred_diff(gold: DataFrame, got: DataFrame, tolerance: Tolerance = Tolerance()) -> DataFrame:
    """Per answer whether both sides' rows agree, and which share of keys does.

    ``gold`` and ``got`` have rows (answer_id, cells). A key on one side only makes
    the answer wrong with score 0, as does an answer that the other side has no
    rows for; otherwise the score is that of the first measure, by name, with a
    disagreement.

    Both sides are stacked and read twice: for the profiles, and to fold the values
    once their answer's shape is joined to them. That join deals rows by answer,
    and the folds after it need no further shuffle.
    """
    rows = _rows(gold).withColumn("gold", F.lit(True)).unionByName(_rows(got).withColumn("gold", F.lit(False)))
    shape = shapes(profiles(rows, {"our_": F.col("gold"), "their_": ~F.col("gold")}))
    ok = within(F.coalesce("their", F.lit(0.0)), F.coalesce("our", F.lit(0.0)), tolerance)
    # The window holds the measures of one key, which are no more than its columns.
    # A key is matched if both sides have it under any measure.
    one_key = Window.partitionBy("answer_id", "key")
    known = F.col("measure").isNotNull()
    per_value = _values(rows, shape).withColumns({
        "ok": ok,
        "both": F.max(F.col("our").isNotNull()).over(one_key) & F.max(F.col("their").isNotNull()).over(one_key),
        "first": known & F.coalesce(F.col("measure") == F.min("measure").over(one_key), F.lit(False)),
    })
    per_measure = per_value.groupBy("answer_id", "measure").agg(
        F.count_if("first").alias("n_keys"),
        F.count_if(F.col("first") & F.col("both")).alias("n_both"),
        F.avg(F.when(known & F.col("both"), F.col("ok").cast("double"))).alias("share"),
    )
    failing = F.when(F.col("share") < 1, F.col("measure"))
    found = per_measure.groupBy("answer_id").agg(
        F.sum("n_keys").alias("n_keys"), F.sum("n_both").alias("n_both"), F.min_by("share", failing).alias("share")
    )
    score = F.when((F.col("n_keys") > 0) & (F.col("n_keys") == F.col("n_both")), F.coalesce("share", F.lit(1.0))).otherwise(0.0)
    return found.select(
        "answer_id", "n_keys", (F.col("n_keys") - F.col("n_both")).alias("n_unmatched"), (score == 1.0).alias("correct"), score.alias("answer_score")
    )
