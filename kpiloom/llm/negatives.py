"""Hard negatives by segment summaries.

Every vector is cut into segments, and of each segment its mean and deviation are
stored. With m, d and m', d' those of two vectors over a segment of n components,
the segment's part of their inner product lies within n * (m * m' -+ d * d'), so
the summaries bound the whole product from both sides. A pair is first bounded by
a few long segments, then, if it may still count, by more and shorter ones, and
only what is left is multiplied out.

Anchors meet rows in cells: both are dealt into groups of bounded size, each
anchor group goes to every row group, and a cell streams its rows past its
anchors. The best found so far in a cell raises the bar for what follows in it. A
cell gives at most the wanted number of rows per anchor, whose best are taken
over all cells. First come the positives, in cells of one label, then the
negatives of all windows that the positives' scores open.

Components become whole numbers, and so scores are exact: bounds get a margin for
rounding, products of short vectors are exact in a double, others are worked out
in 64-bit integers. A row takes no part without an id or a label, with a vector
that is null or holds a null or non-finite component, or of which the squared
length in whole numbers passes ``LONGEST``. Vectors of different lengths never
meet. Repeated rows are rows of their own, also beside their twin as an anchor.
An empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kpiloom.llm.common import stored

#: Segments at each level of refinement, the shorter ones within the longer.
LEVELS = (4, 16)
#: Positives of an anchor and negatives of a positive.
POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies between these percentages of its positive's.
LEAST, MOST = 30, 90
#: Squared lengths up to which all sums fit a long.
LONGEST = 1 << 62
#: Most anchors and rows of a cell, and the row groups that a small table has.
ANCHORS, ROWS, GROUPS = 2048, 1 << 18, 16
#: Rows compared with a cell's anchors at a time, and pairs multiplied out at a time.
STEP, PAIRS = 1024, 1 << 18
#: Bounds between which no score lies.
NEVER = np.int64(2**63 - 1), np.int64(-(2**63))


def _bounds(dim: int, parts: int) -> np.ndarray:
    """Where segments start, and the vector's end; of short vectors some coincide."""
    return np.unique(np.arange(parts + 1) * dim // parts)


def summary(x: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """For each segment of each row the mean and the deviation, both times the
    root of the segment's length, so that their products need no further factor."""
    if not x.shape[1]:
        return np.zeros((len(x), 0)), np.zeros((len(x), 0))
    edges = _bounds(x.shape[1], parts)
    sizes = np.diff(edges)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / sizes
    away = x - np.repeat(mean, sizes, axis=1)
    return mean * np.sqrt(sizes), np.sqrt(np.add.reduceat(away * away, edges[:-1], axis=1))


class Side:
    """Vectors of a cell's side with their summaries."""

    def __init__(self, table: pa.Table | pa.RecordBatch):
        self.row, self.id, self.label = (table.column(c).to_numpy() for c in ("row", "id", "label"))
        column = table.column("v")
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        flat = column.flatten().to_numpy(zero_copy_only=False)
        self.whole = flat.reshape(len(self.row), len(flat) // len(self.row))
        self.x = self.whole.astype(np.float64)
        self.norm = np.sqrt((self.x * self.x).sum(axis=1))
        self.levels = [summary(self.x, parts) for parts in LEVELS]


def _products(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the given pairs: all of them at once where most are asked for."""
    if len(a) * 8 > len(x) * len(y):
        return (x @ y.T)[a, b]
    out = np.empty(len(a), np.result_type(x, y))
    for s in range(0, len(a), PAIRS):
        out[s : s + PAIRS] = np.einsum("ij,ij->i", x[a[s : s + PAIRS]], y[b[s : s + PAIRS]])
    return out


def survivors(anchors: Side, rows: Side, allowed: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The allowed pairs whose score lies within the anchor's low and high, with
    their scores: by the bounds of longer, then shorter segments, then exactly."""
    a, b = np.nonzero(allowed & (low <= high)[:, None])
    for (m, d), (m2, d2) in zip(anchors.levels, rows.levels):
        middle, reach = _products(m, m2, a, b), _products(d, d2, a, b)
        slack = 1e-9 * anchors.norm[a] * rows.norm[b] + 0.5
        may = (middle + reach + slack >= low[a]) & (middle - reach - slack <= high[a])
        a, b = a[may], b[may]
    if not len(a):
        return a, b, np.empty(0, np.int64)
    exact = float(anchors.norm.max()) * float(rows.norm.max()) < 2**52
    score = _products(anchors.x, rows.x, a, b).astype(np.int64) if exact else _products(anchors.whole, rows.whole, a, b)
    within = (score >= low[a]) & (score <= high[a])
    return a[within], b[within], score[within]


class Best:
    """The best rows of each key: by score, then id, then row."""

    def __init__(self, keys: int, most: int):
        self.most = most
        self.least = np.full(keys, NEVER[1])
        self.key, self.score, self.id, self.row = (np.empty(0, np.int64) for _ in range(4))

    def add(self, key: np.ndarray, score: np.ndarray, id_: np.ndarray, row: np.ndarray) -> None:
        if not len(key):
            return
        key, score, id_, row = (np.concatenate(c) for c in zip((self.key, self.score, self.id, self.row), (key, score, id_, row)))
        order = np.lexsort((row, id_, -score, key))
        key = key[order]
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        rank = np.arange(len(key)) - np.repeat(starts, np.diff(np.r_[starts, len(key)]))
        kept = rank < self.most
        self.key, order = key[kept], order[kept]
        self.score, self.id, self.row = score[order], id_[order], row[order]
        last = rank[kept] == self.most - 1
        self.least[self.key[last]] = self.score[last]


def _positives(anchors: Side, best: Best, rows: Side) -> None:
    allowed = (anchors.label[:, None] == rows.label) & (anchors.row[:, None] != rows.row)
    a, b, score = survivors(anchors, rows, allowed, best.least, np.full(len(anchors.row), NEVER[0]))
    best.add(a, score, rows.id[b], rows.row[b])


def window(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest whole score of a positive's negatives; none lies
    between them if the positive's score is negative."""
    # In parts, so that a hundredfold never leaves a long.
    tens, ones = positive // 100, positive % 100
    return tens * LEAST - -(ones * LEAST) // 100, tens * MOST + ones * MOST // 100


def _negatives(anchors: Side, windows: tuple[np.ndarray, np.ndarray], best: Best, rows: Side) -> None:
    low, high = windows
    bar = np.maximum(low, best.least.reshape(low.shape))
    allowed = anchors.label[:, None] != rows.label
    a, b, score = survivors(anchors, rows, allowed, bar.min(axis=1), high.max(axis=1))
    for k in range(low.shape[1]):
        mine = (score >= bar[a, k]) & (score <= high[a, k])
        best.add(a[mine] * low.shape[1] + k, score[mine], rows.id[b[mine]], rows.row[b[mine]])


CELL = ("label_key", "dim", "r", "c")


def _cells(batches):
    """(cell, its anchors' batches, some of its rows) from batches sorted by cell,
    anchors first."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy() for k in (*CELL, "is_row")]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for s, e in zip(edges[:-1], edges[1:]):
            cell, is_row = tuple(c[s] for c in cols[:-1]), bool(cols[-1][s])
            if cell != last:
                held, last = [], cell
            if is_row:
                if held:
                    yield cell, held, batch.slice(s, e - s)
            else:
                held.append(batch.slice(s, e - s))


def _out(anchors: Side, best: Best, ranks: int) -> pa.RecordBatch:
    of = best.key // ranks
    columns = [anchors.row[of], anchors.id[of], best.key % ranks, best.score, best.id, best.row]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["anchor", "anchor_id", "rank", "score", "id", "row"])


def _search(batches, negatives: bool):
    last, anchors, best, windows = None, None, None, None
    ranks = POSITIVES if negatives else 1
    for cell, held, batch in _cells(batches):
        if cell != last:
            if best is not None:
                yield _out(anchors, best, ranks)
            table, last = pa.Table.from_batches(held), cell
            anchors = Side(table)
            best = Best(len(anchors.row) * ranks, NEGATIVES if negatives else POSITIVES)
            if negatives:
                found = [np.array(v, np.int64) for v in table.column("positives").to_pylist()]
                low, high = (np.full((len(found), ranks), x) for x in NEVER)
                for i, v in enumerate(found):
                    low[i, : len(v)], high[i, : len(v)] = window(v)
                windows = low, high
        for s in range(0, batch.num_rows, STEP):
            rows = Side(batch.slice(s, STEP))
            if negatives:
                _negatives(anchors, windows, best, rows)
            else:
                _positives(anchors, best, rows)
    if best is not None:
        yield _out(anchors, best, ranks)


def _find_positives(batches):
    return _search(batches, False)


def _find_negatives(batches):
    return _search(batches, True)


def _met(anchors: DataFrame, rows: DataFrame, label_key: Column, groups: int, find) -> DataFrame:
    """What ``find`` gives for each anchor in each cell. Cells hold rows of one
    ``label_key`` and one length only, and a bounded number of either side."""
    keys = ["label_key", "dim"]
    anchors, rows = anchors.withColumn("label_key", label_key), rows.withColumn("label_key", label_key)
    asked = anchors.groupBy(*keys).agg(F.count("*").alias("n_anchors"))
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n_rows")).join(asked, keys)
    r = F.greatest(F.lit(groups), F.ceil(F.col("n_rows") / ROWS)).cast("int")
    c = F.ceil(F.col("n_anchors") / ANCHORS).cast("int")
    sizes = stored(sizes.select(*keys, r.alias("rs"), c.alias("cs")), "cells")

    def dealt(side: DataFrame, own: str, other: str) -> DataFrame:
        side = side.join(sizes, keys)
        mine = F.pmod(F.xxhash64("row", F.lit(own)), F.col(f"{own}s")).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)).alias(other)
        return side.select(*keys, mine, every, *[x for x in side.columns if x not in (*keys, "rs", "cs")])

    right = dealt(rows, "r", "c").withColumns({"is_row": F.lit(1), "positives": F.lit(None).cast("array<long>")})
    left = dealt(anchors, "c", "r").withColumn("is_row", F.lit(0))
    cells = left.unionByName(right).repartition(*CELL).sortWithinPartitions(*CELL, "is_row")
    return cells.mapInArrow(find, "anchor long, anchor_id long, rank long, score long, id long, row long")


def whole(vector: Column) -> Column:
    """floor(256 * x) of each component."""
    return F.transform(vector, lambda x: F.floor(256 * x.cast("double")))


def usable(vector: Column, label: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    # Scaled down first, so that squares stay finite.
    length = F.aggregate(vector, F.lit(0.0), lambda s, x: s + (256 * F.abs(x) + 1) * ((256 * F.abs(x) + 1) / LONGEST))
    return vector.isNotNull() & label.isNotNull() & F.coalesce(fine, F.lit(False)) & F.coalesce(length < 1, F.lit(False))


def hard_negatives(vectors: DataFrame, anchor: Column, vec_id: str = "vec_id", embedding: str = "embedding", label: Column | None = None) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` tells which rows are anchors; ``label``, the column of that name
    unless given, is a whole number.
    """
    label = F.col("label") if label is None else label
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"), label.cast("long").alias("label"), anchor.alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v"), F.col("label")))
    rows = rows.select("id", "label", "asks", whole(F.col("v")).alias("v"), F.size("v").alias("dim"), F.monotonically_increasing_id().alias("row"))
    # Written, so that every read gives a row the same key.
    rows = stored(rows, "whole-vectors")
    asking = rows.where("asks").drop("asks")
    rows = rows.drop("asks")

    none = asking.withColumn("positives", F.lit(None).cast("array<long>"))
    found = _met(none, rows, F.col("label"), 4, _find_positives)
    place = F.row_number().over(W.partitionBy("anchor").orderBy(F.desc("score"), "id", "row"))
    positives = found.withColumn("k", place - 1).where(F.col("k") < POSITIVES)
    positives = stored(positives.select("anchor", "anchor_id", "k", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    scores = F.transform(F.sort_array(F.collect_list(F.struct("k", "positive_score"))), lambda x: x["positive_score"])
    windows = positives.groupBy(F.col("anchor").alias("row")).agg(scores.alias("positives"))
    found = _met(asking.join(windows, "row"), rows, F.lit(0).cast("long"), GROUPS, _find_negatives)
    place = F.row_number().over(W.partitionBy("anchor", "rank").orderBy(F.desc("score"), "id", "row"))
    best = found.withColumn("place", place).where(F.col("place") <= NEGATIVES)
    best = best.select("anchor", F.col("rank").cast("int").alias("k"), F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return positives.join(best, ["anchor", "k"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
