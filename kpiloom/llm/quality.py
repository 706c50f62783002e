"""Quality rules with thresholds that adapt to each language and source.

A fixed rule rejects what is too short or repeats itself. Every other rule
compares a document with its own group: for each (lang, source) a mergeable
quantile sketch of each measure, over the documents that pass the fixed rule,
gives the group's own limits.

Rates (of symbols, of repeated lines, of repeated words) are zero for most
documents, so their limits come from the documents that have any: a rate is usual
up to the greater of the ``TOP`` quantile and three quartile distances, on a
logarithmic scale, beyond the upper quartile. A document that is the only one of
its group to have any is an outlier. The mean length of words has limits on both
sides, three quartile distances beyond the quartiles on a logarithmic scale. No limit has a floor of its own but for the
width of a bucket, where quartiles are equal.

The sketch is a histogram of integer measures: it merges by adding counts, so
partial sketches are built before the shuffle and a source with a third of all
rows sends one small row per task and bucket. It has no random part, so reruns
agree.

Everything is DataFrame functions. Measures are worked out inside the row; no
window of words is ever shuffled.

A null text has no words and is rejected; null languages and sources are groups
of their own; a repeated row gets its verdict again and counts again in its
group; an empty table gives no rows; texts may be of any length; further columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kpiloom.llm.common import let, stored

MIN_WORDS = 50
#: A text fails if more than this percentage of its words lie in repeated windows.
MAX_REPEATED = 50
#: A rate is usual up to this quantile (numerator, denominator) of the rates above zero.
TOP = (19, 20)
#: Quartile distances beyond the quartiles that are still usual.
REACH = 3
#: Buckets of the sketch: thousandths of a rate, and hundredths of the logarithm
#: of a length. The sketch is exact to one of them.
UNIT, LENGTH_UNIT = 1000, 100

#: Bits of a window's place in its text, enough for the longest there can be.
PLACE = 32
SPACES = " \t\n\x0b\f\r"


def _repeated(hashes: Column) -> Column:
    """Words in windows that occur twice or more, given each 3-word window's hash.

    Hash and place share a long while sorting; the windows whose shortened hash
    has a twin are then compared by the whole hash, so shortening decides nothing.
    """

    def places(packed: Column) -> Column:
        short = lambda x: F.shiftrightunsigned(x, PLACE)
        twin = F.filter(
            packed,
            lambda x, i: ((i > 0) & (short(F.get(packed, i - 1)) == short(x))) | F.coalesce(short(F.get(packed, i + 1)) == short(x), F.lit(False)),
        )
        return F.transform(twin, lambda x: x.bitwiseAND(F.lit((1 << PLACE) - 1)))

    def whole(pairs: Column) -> Column:
        twin = F.filter(
            pairs,
            lambda x, i: ((i > 0) & (F.get(pairs, i - 1)["h"] == x["h"])) | F.coalesce(F.get(pairs, i + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(twin, lambda x: x["at"]))

    def covered(at: Column) -> Column:
        # Each window covers up to the next one's start, three words at most.
        steps = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    packed = F.sort_array(F.transform(hashes, lambda h, i: F.shiftleft(h, PLACE).bitwiseOR(i.cast("long"))))
    pairs = let(packed, lambda p: let(places(p), lambda at: F.sort_array(F.transform(at, lambda i: F.struct(F.get(hashes, i.cast("int")).alias("h"), i.alias("at"))))))
    return let(pairs, lambda p: let(whole(p), covered))


def _windows(words: Column) -> Column:
    """The hash of each run of three words."""
    at = F.when(F.size(words) >= 3, F.sequence(F.lit(0), F.size(words) - 3)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))


def measured(docs: DataFrame, payload: list[str], text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The payload columns as ``row``, the group's keys, the whole numbers
    n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, and
    the measures in thousandths."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(whole, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    # A line has a word if trimming white space leaves something.
    lines = F.filter(F.split(whole, "\n"), lambda s: F.trim(s, F.lit(SPACES)) != "")
    counted = docs.select(
        F.struct(*payload).alias("row"),
        F.col(lang).alias("lang"),
        F.col(source).alias("source"),
        let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), let(_windows(w), _repeated).alias("repeated"))).alias("words"),
        F.length(F.regexp_replace(whole, "[\\x20\\x09-\\x0D]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(whole, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda s: F.struct(F.size(s).cast("long").alias("n"), F.size(F.array_distinct(s)).cast("long").alias("different"))).alias("lines"),
    )
    return counted.select(
        "row", "lang", "source", "word_chars", "n_symbols",
        F.col("words.n").alias("n_words"),
        F.col("words.repeated").alias("n_repeat_words"),
        F.col("lines.n").alias("n_lines"),
        (F.col("lines.n") - F.col("lines.different")).alias("n_dup_lines"),
    )


def _rate(part: str, of: str) -> Column:
    return F.expr(f"{UNIT} * {part} div greatest({of}, 1)")


RATES = {
    "symbol_rate": ("n_symbols", "word_chars"),
    "line_rate": ("n_dup_lines", "n_lines"),
    "repeat_rate": ("n_repeat_words", "n_words"),
}


#: The measure with limits on both sides.
LENGTH = "word_length"


def _length() -> Column:
    """The mean length of words, in steps of a hundredth of its size; null without words."""
    mean = F.col("word_chars").cast("double") / F.nullif(F.col("n_words"), F.lit(0))
    return F.floor(LENGTH_UNIT * F.log(mean))


def failed() -> Column:
    """Whether the fixed rule rejects a document."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def sketches(rows: DataFrame) -> DataFrame:
    """Per (lang, source, measure): how many documents lie in each bucket. Two
    sketches of parts merge by adding."""
    measures = {m: _rate(*of) for m, of in RATES.items()} | {LENGTH: _length()}
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), v.alias("bucket")) for m, v in measures.items()]))
    rows = rows.where(~failed()).select("lang", "source", pairs.alias("p")).where("p.bucket is not null")
    return rows.groupBy("lang", "source", "p.measure", "p.bucket").agg(F.count("*").alias("n"))


def limits(sketch: DataFrame) -> DataFrame:
    """Per (lang, source) for each measure a struct: how many documents count for
    its limits, their quartiles q1 and q3, and the ``TOP`` quantile.

    A rate has at most ``UNIT`` buckets above zero, and lengths grow by a hundredth
    from one bucket to the next, so the window below holds a few thousand rows at
    most, whatever the group's size.
    """
    group = W.partitionBy("lang", "source", "measure")
    counted = sketch.where((F.col("measure") == LENGTH) | (F.col("bucket") > 0))
    upto = counted.withColumns({"upto": F.sum("n").over(group.orderBy("bucket")), "all": F.sum("n").over(group)})

    def quantile(part: int, of: int) -> Column:
        return F.min(F.when(of * F.col("upto") >= part * F.col("all"), F.col("bucket")))

    found = upto.groupBy("lang", "source", "measure").agg(
        F.struct(F.max("all").alias("n"), quantile(1, 4).alias("q1"), quantile(3, 4).alias("q3"), quantile(*TOP).alias("top")).alias("limit")
    )
    return found.groupBy("lang", "source").agg(*[F.max(F.when(F.col("measure") == m, F.col("limit"))).alias(f"of_{m}") for m in (*RATES, LENGTH)])


def _usual_rate(rate: Column, of: Column) -> Column:
    """A rate within the group's limits: up to q3 * (q3 / q1) ** 3 in whole numbers."""
    far = rate * of["q1"] * of["q1"] * of["q1"] <= of["q3"] * of["q3"] * of["q3"] * of["q3"]
    return F.coalesce((rate == 0) | ((of["n"] > 1) & ((rate <= of["top"]) | far)), F.lit(False))


def _usual_length(length: Column, of: Column) -> Column:
    reach = REACH * F.greatest(of["q3"] - of["q1"], F.lit(1))
    return F.coalesce(length.between(of["q1"] - reach, of["q3"] + reach), F.lit(False))


def verdicts(docs: DataFrame, payload: list[str], text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """``measured`` with base_failed and kept for every row.

    Measures are written once to the shared folder; the limits are a row per
    group, whose file size Spark knows when it picks the join.
    """
    rows = stored(measured(docs, payload, text, lang, source), "quality-measures")
    of_group = stored(limits(sketches(rows)), "quality-limits")
    of_group = of_group.withColumnsRenamed({"lang": "of_lang", "source": "of_source"})
    joined = rows.join(of_group, rows["lang"].eqNullSafe(of_group["of_lang"]) & rows["source"].eqNullSafe(of_group["of_source"]), "left")
    usual = _usual_length(_length(), F.col(f"of_{LENGTH}"))
    for m, of in RATES.items():
        usual = usual & _usual_rate(_rate(*of), F.col(f"of_{m}"))
    return joined.withColumn("base_failed", failed()).withColumn("kept", ~F.col("base_failed") & usual)


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
