"""Document fingerprints as invertible Bloom lookup sketches of paragraphs.

A text's paragraphs are its lines, cut further at some ends of sentences, which
the next sentence's first letter decides, so that an edit changes only the
paragraphs it touches. Each different paragraph's digest goes into one cell of
each of the sketch's ``TABLES`` tables. A cell holds how many digests it has, and
the exclusive or of them and of their checks. The cells of two versions are
subtracted, and what both hold is gone. A cell left with a single digest gives it
away; taking it out of its other cells frees further ones. When nothing is left
all digests that differ are known. Where cells remain, the pair is tried again
with ``GROWTH`` times the cells and new hashes, as often as it takes.

A fingerprint is the sketch of the first size as text. The likeness of two is the
share of paragraphs that both have among all that either has, and 1 for two
texts without any.

A text is compared with its edited form and with the next document. Documents are
dealt to parts by ranges of (id, hash of the text), so that the next one is in
the same part; the first document of a part goes to the part before it as well.
The ranges come from a sample of at most ``SAMPLED`` keys a part; they shape the
work, not the result.

Everything is DataFrame functions. A null text is empty; documents without an id
come first, and equal ids are ordered by their texts' hashes; a repeated row is
followed by its twin, and a single row by itself. Texts may be of any length. An
empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kpiloom.llm.common import SMALL, let, stored

#: Tables of a sketch, cells of each in a fingerprint, and their growth on failure.
TABLES, CELLS, GROWTH = 3, 8, 8
#: How often every table's cells are looked through before a pair is tried again.
PASSES = 4
#: Documents of a part, the most parts there can be, and sampled keys of a part.
PART, MOST_PARTS, SAMPLED = 2048, 1 << 15, 16
#: Ends of paragraphs.
ENDS = r"\n|(?<=[.!?])[ \t]+(?=[N-Zn-z0-4])"
SPACES = " \t\r"
#: A cell: the count, the digests' and the checks' exclusive or.
CELL = "struct<n: long, d: long, c: long>"


def digests(text: Column) -> Column:
    """The digests of the text's different paragraphs that are not blank."""
    pieces = F.filter(F.split(text, ENDS), lambda s: F.trim(s, F.lit(SPACES)) != "")
    return F.array_distinct(F.transform(pieces, lambda s: F.xxhash64(s)))


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(-1))


def _place(digest: Column, table: int | Column, level: int, cells: int) -> Column:
    """The digest's cell in a table; tables follow each other."""
    table = F.lit(table) if isinstance(table, int) else table
    return (table * cells + F.pmod(F.xxhash64(digest, table, F.lit(level)), F.lit(cells))).cast("int")


def sketch(found: Column) -> Column:
    """The cells of the first size, as an array of ``CELL``."""

    def filled(placed: Column) -> Column:
        empty = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("c"))

        def cell(i: Column, table: int) -> Column:
            mine = F.filter(placed, lambda x: x[f"p{table}"] == i)
            add = lambda s, x: F.struct((s["n"] + 1).alias("n"), s["d"].bitwiseXOR(x["d"]).alias("d"), s["c"].bitwiseXOR(x["c"]).alias("c"))
            return F.aggregate(mine, empty, add)

        def cells(table: int) -> Column:
            places = F.sequence(F.lit(table * CELLS), F.lit((table + 1) * CELLS - 1))
            return F.transform(places, lambda i: cell(i, table))

        return F.concat(*map(cells, range(TABLES)))

    placed = F.transform(found, lambda d: F.struct(d.alias("d"), _check(d).alias("c"), *[_place(d, t, 0, CELLS).alias(f"p{t}") for t in range(TABLES)]))
    return let(placed, filled)


def as_text(cells: Column) -> Column:
    """Cells as 'count.digests.checks' in hexadecimal digits, joined by commas; an
    empty cell is an empty string."""
    one = lambda x: F.when(x["n"] == 0, F.lit("")).otherwise(F.lower(F.concat_ws(".", F.hex(x["n"]), F.hex(x["d"]), F.hex(x["c"]))))
    return F.array_join(F.transform(cells, one), ",")


def _subtracted(versions: DataFrame, own: str, others: list[str], level: int, cells: int) -> DataFrame:
    """The cells, without empty ones, of each row's own sketch less that of each
    other version in ``ks``: a sketch of what two don't share is the difference of
    their sketches."""

    def signed(side: str, n: int) -> Column:
        return F.transform(side, lambda d: F.struct(d.alias("d"), F.lit(n).cast("long").alias("n")))

    pairs = versions.select("key", "ks", signed(own, 1).alias("left"), F.array(*[signed(o, -1) for o in others]).alias("others"))
    pairs = pairs.select("key", "left", "others", F.explode("ks").alias("k"))
    rows = pairs.select("key", "k", F.explode(F.concat("left", F.get("others", F.col("k")))).alias("x")).select("key", "k", "x.d", "x.n")
    rows = rows.withColumn("table", F.explode(F.array(*map(F.lit, range(TABLES)))))
    rows = rows.select("key", "k", _place(F.col("d"), F.col("table"), level, cells).alias("cell"), "n", "d", _check(F.col("d")).alias("c"))
    found = rows.groupBy("key", "k", "cell").agg(F.sum("n").alias("n"), F.bit_xor("d").alias("d"), F.bit_xor("c").alias("c"))
    return found.where("n != 0 or d != 0 or c != 0")


def _peeled(cells: DataFrame, level: int, size: int) -> DataFrame:
    """(key, k, cell, digest, n): recovered digests, with a negative cell and n of 1
    where only the left side has it and -1 where only the right has, and the cells
    that remain.

    Each step takes the single digests out of one table, where a digest has one
    cell only. Steps group by cells of a pair, whose rows are together already.
    """
    rows = cells.withColumn("digest", F.lit(None).cast("long"))
    for table in list(range(TABLES)) * PASSES:
        here = F.col("cell").between(table * size, (table + 1) * size - 1)
        single = here & (F.abs("n") == 1) & (F.col("c") == _check(F.col("d"))) & (F.col("cell") == _place(F.col("d"), table, level, size))

        def row(cell: Column, n: Column, digest: Column, d: Column = F.col("d"), c: Column = F.col("c")) -> Column:
            return F.struct(cell.cast("int").alias("cell"), n.alias("n"), d.alias("d"), c.alias("c"), digest.cast("long").alias("digest"))

        zero, none = F.lit(0).cast("long"), F.lit(None)
        taken = [row(_place(F.col("d"), t, level, size), -F.col("n"), none) for t in range(TABLES) if t != table]
        out = F.when(single, F.array(row(F.lit(-1), F.col("n"), F.col("d"), zero, zero), *taken)).otherwise(F.array(row(F.col("cell"), F.col("n"), F.col("digest"))))
        rows = rows.select("key", "k", F.explode(out).alias("r")).select("key", "k", "r.*")
        rows = rows.groupBy("key", "k", "cell", "digest").agg(F.sum("n").alias("n"), F.bit_xor("d").alias("d"), F.bit_xor("c").alias("c"))
        rows = rows.where("n != 0 or d != 0 or c != 0")
    return rows


def differences(versions: DataFrame, own: str, others: list[str], named: bool = False) -> DataFrame:
    """(key, k, n_left, n_right): how many digests only the own version has and
    only the other one, ``others[k]``, for those that differ; with ``named`` the
    digests as only_left and only_right too. ``versions`` has key, a long that
    tells rows apart, and arrays of different digests."""
    versions = versions.select("key", own, *others)
    todo = versions.withColumn("ks", F.array(*map(F.lit, range(len(others))))).repartition("key")
    level, size, done = 0, CELLS, None
    while True:
        rows = _peeled(_subtracted(todo, own, others, level, size), level, size)
        found = F.col("cell") < 0
        only = {"left": found & (F.col("n") > 0), "right": found & (F.col("n") < 0)}
        columns = [F.count_if(of).alias(f"n_{side}") for side, of in only.items()]
        if named:
            columns += [F.sort_array(F.collect_list(F.when(of, F.col("digest")))).alias(f"only_{side}") for side, of in only.items()]
        result = stored(rows.groupBy("key", "k").agg(F.count_if(~found).alias("remaining"), *columns), "differences")
        ended = result.where("remaining = 0").drop("remaining")
        done = ended if done is None else done.unionByName(ended)
        failed = stored(result.where("remaining > 0").groupBy("key").agg(F.collect_list("k").alias("ks")), "failed")
        count = failed.count()
        if not count:
            return done
        # Few rows are picked out before they are moved; else all are, once.
        few = count * 16 * (1 + len(others)) <= SMALL
        todo = versions.join(F.broadcast(failed), "key").repartition("key") if few else versions.repartition("key").join(failed, "key")
        level, size = level + 1, size * GROWTH


def likeness(left: Column, right: Column, differing: Column) -> Column:
    """Shared paragraphs among all, from both numbers of paragraphs and that of
    the digests only one side has."""
    both = left + right
    return F.when(both == 0, F.lit(1.0)).otherwise((both - differing) / (both + differing))


def _parts(rows: DataFrame) -> tuple[int, Column]:
    """The number of parts, and the first keys of all but part 0 as an array."""
    n = rows.count()
    parts = max(1, min(MOST_PARTS, -(-n // PART)))
    share = F.pmod(F.xxhash64("h", F.lit(5)), F.lit(1 << 30)) / (1 << 30)
    keys = rows.where(share * n < SAMPLED * parts).select("doc_id", "h", "h2").collect() if parts > 1 else []
    keys = sorted(set(map(tuple, keys)), key=lambda k: (k[0] is not None, *map(int, (k[0] or 0, *k[1:]))))
    step = max(1, -(-len(keys) // parts))
    first = [dict(zip(("doc_id", "h", "h2"), k)) for k in keys[step::step]]
    return len(first) + 1, F.from_json(F.lit(json.dumps(first)), "array<struct<doc_id: long, h: long, h2: long>>")


def with_next(rows: DataFrame) -> DataFrame:
    """doc_id and text, not null, of each row, and the next row's text as ``next``."""
    rows = rows.withColumns({"h": F.xxhash64("doc_id", "text"), "h2": F.xxhash64(F.lit(1), "text", "doc_id")})
    parts, first = _parts(rows)
    key = F.struct("doc_id", "h", "h2")
    # Binary search for the last part whose first key is not greater.
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(parts.bit_length()))])
    after = lambda at, s: F.when((at + s < parts) & (F.get(first, at + s - 1) <= key), at + s).otherwise(at)
    placed = rows.withColumn("part", F.aggregate(steps, F.lit(0), after))
    # Part 0 has no first key of its own: its least row follows the last part's rows.
    least = rows.where(F.get(first, F.lit(0)) > key if parts > 1 else F.lit(True)).agg(F.min(key).alias("k")).first()["k"]
    if least is None:
        least = (0, 0, 0)
    zero = F.struct(*[F.lit(v).cast("long").alias(c) for v, c in zip(least, ("doc_id", "h", "h2"))])
    head = F.when(F.col("part") == 0, key.eqNullSafe(zero)).otherwise(F.get(first, F.col("part") - 1).eqNullSafe(key))
    before = F.when(F.col("part") == 0, F.lit(parts - 1)).otherwise(F.col("part") - 1)
    place = lambda part, guest: F.struct(part.alias("part"), F.lit(guest).alias("guest"))
    places = F.when(head, F.array(place(F.col("part"), 0), place(before, 1))).otherwise(F.array(place(F.col("part"), 0)))
    dealt = placed.select("doc_id", "text", "h", "h2", F.explode(places).alias("at")).select("doc_id", "text", "h", "h2", "at.part", "at.guest")
    order = W.partitionBy("part").orderBy("guest", F.asc_nulls_first("doc_id"), "h", "h2")
    return dealt.withColumn("next", F.lead("text").over(order)).where("guest = 0").select("doc_id", "text", "next")


def compared(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited
    and near_next; the edited text is the text with its second half replaced by
    the start of the next document's text."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(rows).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next", F.lit(1), half))
    rows = rows.withColumn("edited", edited)
    versions = {"own": "text", "edit": "edited", "following": "next"}
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), *[digests(F.col(c)).alias(v) for v, c in versions.items()])
    rows = stored(rows.withColumn("key", F.monotonically_increasing_id()), "versions")

    found = differences(rows, "own", ["edit", "following"])
    differing = F.col("n_left") + F.col("n_right")
    found = found.groupBy("key").agg(*[F.max(F.when(F.col("k") == k, differing)).alias(name) for k, name in enumerate(("n_edited", "n_next"))])
    joined = rows.join(found, "key", "left")
    near = lambda other, n: likeness(F.size("own"), F.size(other), F.coalesce(n, F.lit(0)))
    return joined.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(sketch(F.col("own"))).alias("fingerprint"),
        as_text(sketch(F.col("edit"))).alias("edited_fingerprint"),
        near("edit", "n_edited").alias("near_edited"),
        near("following", "n_next").alias("near_next"),
    )


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
