"""Mixing sources to target weights by entropy balancing.

Sources in the order of their names weigh 3, 1, 2 and so on, and share
``SHARE`` of all words by weight; a target stops at ``MOST`` times its source's
size, and what is over goes to the others by weight until none is above.

Document rates come nearest to one, in relative entropy, among those between
nothing and ``MOST`` whose words meet each source's target. Their form is
known: min(MOST, exp(lambda * size / mean size)), with one lambda per source.
The lambdas solve the convex dual by Newton's iterations. Rates depend on a
document's source and size only, so an iteration is a grouped sum over (source,
size) with its count, where documents were combined before the first shuffle;
it takes a step for all sources at once, kept inside the bracket found so far.

Rates become copies: the whole part for certain, and one more for a part of the
documents. Those with a fraction are dealt into ``BUCKETS`` buckets by a hash,
by halving size, within a source; from large sizes to small, a bucket's
documents get their copy if that brings the words taken nearer to the words
wanted so far. A miss with large documents is made up by smaller ones.

Everything is DataFrame functions. A source with a third of all rows is combined
before it is shuffled, and its row of buckets is of fixed length. Nothing is
random: reruns agree.

A null text has size 0 and gives nothing; a null source is a source, the last
one; a repeated row is another document with the same copies as its twin; an
empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kpiloom.llm.common import stored

#: Weights of sources in order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix as a part of all words, and of a source or a document at most.
SHARE, MOST = 1.5, 2
BUCKETS = 64
#: Relative distance to the target at which a source's lambda is found.
CLOSE = 1e-9
ROUNDS = 60


def size_of(text: str) -> Column:
    """Words between ASCII white space; 0 for a null text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    With sources by the level at which they are full, MOST * size / weight, the
    full ones come first, and the rest share what those leave by weight. The
    windows hold a row per source.
    """
    order = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (order % len(WEIGHTS) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("full_at", MOST * F.col("source_size") / F.col("weight"))
    upto = W.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow)
    every = W.partitionBy()
    rows = rows.withColumns(
        {
            "words": SHARE * F.sum("source_size").over(every),
            "weights": F.sum("weight").over(every) - F.sum("weight").over(upto) + F.col("weight"),
            "filled": MOST * (F.sum("source_size").over(upto) - F.col("source_size")).cast("double"),
        }
    )
    level = (F.col("words") - F.col("filled")) / F.col("weights")
    # From the first source on that the level doesn't fill, the level stays.
    open_level = F.min(F.when(level <= F.col("full_at"), F.struct("full_at", level.alias("level")))).over(every)["level"]
    target = F.least(MOST * F.col("source_size").cast("double"), F.coalesce(F.col("weight") * open_level, MOST * F.col("source_size").cast("double")))
    return rows.select("source", "source_size", target.alias("target"))


def _rate(tilt: Column) -> Column:
    return F.least(F.lit(float(MOST)), F.exp(tilt))


def lambdas(shape: DataFrame, goal: DataFrame) -> DataFrame:
    """(source, lambda) for ``shape`` with (source, size, docs)."""
    means = shape.groupBy("source").agg((F.sum(F.col("size") * F.col("docs")) / F.sum("docs")).alias("mean"))
    state = goal.join(means.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        "source",
        "target",
        "source_size",
        "mean",
        F.lit(0.0).alias("lambda"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        # A source that is taken whole as often as it may be has no finite lambda.
        ((F.col("target") >= MOST * F.col("source_size") * (1 - CLOSE)) | (F.col("source_size") == 0)).alias("done"),
    )
    state = stored(state, "lambdas")
    for _ in range(ROUNDS):
        if state.where("not done").isEmpty():
            break
        open_ = state.where("not done").select(F.col("source").alias("of"), "lambda", "mean")
        x = F.col("size") / F.col("mean")
        rate = _rate(F.col("lambda") * x)
        words = F.col("size") * F.col("docs")
        free = F.col("lambda") * x < F.log(F.lit(float(MOST)))
        sums = (
            shape.join(open_, F.col("source").eqNullSafe(F.col("of")))
            .groupBy("of")
            .agg(F.sum(words * rate).alias("got"), F.sum(F.when(free, words * rate * x).otherwise(0.0)).alias("slope"))
            .withColumnRenamed("of", "in")
        )
        over = F.col("got") - F.col("target")
        joined = state.join(sums, F.col("source").eqNullSafe(F.col("in")), "left")
        low = F.when(over < 0, F.col("lambda")).otherwise(F.col("low"))
        high = F.when(over > 0, F.col("lambda")).otherwise(F.col("high"))
        step = F.when(F.col("slope") > 0, F.col("lambda") - over / F.col("slope"))
        joined = joined.withColumns({"newer_low": low, "newer_high": high, "step": step})
        inside = F.coalesce((F.col("step") > F.col("newer_low")) | F.col("newer_low").isNull(), F.lit(False)) & F.coalesce((F.col("step") < F.col("newer_high")) | F.col("newer_high").isNull(), F.lit(False))
        # Where Newton's step leaves the bracket: its middle, or twice as far out.
        middle = F.coalesce((F.col("newer_low") + F.col("newer_high")) / 2, 2 * F.col("newer_low") + 1, 2 * F.col("newer_high") - 1)
        close = F.abs(over) <= CLOSE * F.greatest(F.col("target"), F.lit(1.0))
        moved = F.when(close, F.col("lambda")).when(inside, F.col("step")).otherwise(middle)
        state = stored(
            joined.select(
                "source", "target", "source_size", "mean",
                F.when(F.col("done"), F.col("lambda")).otherwise(moved).alias("lambda"),
                F.when(F.col("done"), F.col("low")).otherwise(F.col("newer_low")).alias("low"),
                F.when(F.col("done"), F.col("high")).otherwise(F.col("newer_high")).alias("high"),
                (F.col("done") | close).alias("done"),
            ),
            "lambdas",
        )
    return state


def _bucket(*key: str) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")


def _dealt(groups: DataFrame) -> DataFrame:
    """(source, class, bucket, more): which buckets' documents get a copy more.

    A source's buckets are an array of 64 classes by ``BUCKETS`` at most,
    whatever its number of documents.
    """
    entries = F.sort_array(F.collect_list(F.struct((-F.col("class")).alias("c"), "bucket", "wanted", "words")))
    rows = groups.groupBy("source").agg(entries.alias("e"))
    start = F.struct(F.lit(0.0).alias("owed"), F.array().cast("array<boolean>").alias("more"))

    def deal(state: Column, x: Column) -> Column:
        owed = state["owed"] + x["wanted"]
        take = 2 * owed > x["words"]
        return F.struct((owed - F.when(take, x["words"]).otherwise(0.0)).alias("owed"), F.concat(state["more"], F.array(take)).alias("more"))

    rows = rows.withColumn("more", F.aggregate("e", start, deal, lambda s: s["more"]))
    flat = rows.select("source", F.explode(F.arrays_zip("e", "more")).alias("x"))
    return flat.select("source", (-F.col("x.e.c")).alias("class"), F.col("x.e.bucket").alias("bucket"), F.col("x.more").alias("more"))


def mixed(docs: DataFrame, payload: list[str], doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Every row's payload columns as ``row``, with size, source, source_size,
    target, rate and copies."""
    rows = docs.select(F.struct(*payload).alias("row"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size_of(text).alias("size"))
    rows = stored(rows, "sizes")
    shape = stored(rows.groupBy("source", "size").agg(F.count("*").alias("docs")), "size-counts")
    goal = stored(targets(shape.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))), "targets")
    solved = lambdas(shape, goal).select(F.col("source").alias("of"), "source_size", "target", "mean", "lambda")

    full = F.col("target") >= MOST * F.col("source_size") * (1 - CLOSE)
    rate = F.when(F.col("size") == 0, F.lit(0.0)).when(full, F.lit(float(MOST))).otherwise(_rate(F.col("lambda") * F.col("size") / F.col("mean")))
    rated = rows.join(solved, F.col("source").eqNullSafe(F.col("of")), "left").withColumn("rate", rate)
    klass = F.floor(F.log2(F.greatest("size", F.lit(1)))).cast("int")
    rated = rated.withColumns({"whole": F.floor("rate"), "class": klass, "bucket": _bucket("doc_id", "size")})
    fraction = F.col("rate") - F.col("whole")
    groups = (
        rated.where(fraction > 0)
        .groupBy("source", "class", "bucket")
        .agg(F.sum(fraction * F.col("size")).alias("wanted"), F.sum("size").cast("double").alias("words"))
    )
    # Sums of fractions depend on their order in the last bits only; cut them off.
    groups = groups.withColumn("wanted", F.round("wanted", 3))
    dealt = stored(_dealt(groups), "copies").toDF("in", "in_class", "in_bucket", "more")
    same = F.col("source").eqNullSafe(F.col("in")) & (F.col("class") == F.col("in_class")) & (F.col("bucket") == F.col("in_bucket"))
    more = F.when(F.coalesce("more", F.lit(False)) & (fraction > 0), 1).otherwise(0)
    return rated.join(dealt, same, "left").select("row", "size", "source", "source_size", "target", "rate", (F.col("whole") + more).cast("long").alias("copies"))


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")
