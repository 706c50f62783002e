"""Near-duplicate vectors by a forest of random-projection trees.

Each of ``TREES`` trees splits its rows by random projections at their median,
again and again, until a node has ``LEAF`` rows at most. Rows near a split go to
both sides, so that close vectors seldom part, and a pair counts as found if any
tree keeps it together. Within leaves all pairs are compared exactly.

Trees grow a few levels at a time. The splits of a node are fitted to a sample
of about ``SAMPLE`` of its rows and then applied to all of them, so every row is
indexed and a tree is as deep as its data needs. Of ``TRIED`` projections the
one with the fewest rows near its median splits a node. A node that none can
part, since its vectors are almost the same, is a leaf whatever its size, and is
compared in blocks of ``LEAF`` rows, pairs of blocks in tasks of their own.

A pair that several trees keep together is counted once, in the first leaf they
share. Tasks return numbers of links and a spanning set of them, never pairs.

Only vectors with the same label and length are compared. Equal ones go through
the forest as one. Vectors that are null, empty, zero or hold null or non-finite
components, and those without a label or an id, link with nothing. Rows with the
same id, label and vector count once and are returned once for each row; a row
without an id has a null component and is kept. Only the named columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import ragged, stored
from kpiloom.llm.components import components
from kpiloom.llm.minhash import groups, spanning

THRESHOLD = 0.98
TREES = 4
LEAF = 512
#: Rows to which the splits of a node are fitted, about.
SAMPLE = 4096
#: Levels of splits between two writes of the forest, and projections tried for a split.
LEVELS, TRIED = 4, 4
#: Reach of a split to either side, as a part of the spread of the projected
#: difference between two vectors that are just linked.
SPILL = 0.8
#: The greatest part of a node that may go to both sides.
MOST_SPILLED = 0.25


def _vectors(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that neither squares overflow nor small values vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _direction(node: int, place: int, tried: int, dim: int) -> np.ndarray:
    u = np.random.default_rng([node & (2**63 - 1), place, tried]).standard_normal(dim)
    return u / np.sqrt(u @ u)


def _margin(dim: int) -> float:
    return SPILL * math.sqrt(2 * (1 - THRESHOLD) / dim)


def _fit(table: pa.Table) -> pa.Table:
    """The splits below a node, from a sample of it: places as in a heap, with
    the projection's number and the threshold, null where a leaf begins."""
    node, total = table.column("node")[0].as_py(), table.column("rows")[0].as_py()
    x = _unit(_vectors(table.column("v")))
    margin, scale = _margin(x.shape[1]), total / len(x)
    parts = {1: np.arange(len(x))}
    tried, cuts = [0] * 2**LEVELS, [None] * 2**LEVELS
    for place in range(1, 2**LEVELS):
        part = parts.get(place, ())
        if len(part) * scale <= LEAF:
            continue
        best = None
        for k in range(TRIED):
            projected = x[part] @ _direction(node, place, k, x.shape[1])
            away = projected - np.median(projected)
            spilled = float((np.abs(away) <= margin).mean())
            if best is None or spilled < best[0]:
                best = spilled, k, float(np.median(projected)), away
        spilled, tried[place], cut, away = best
        if spilled <= MOST_SPILLED:
            cuts[place] = cut
            parts[2 * place], parts[2 * place + 1] = part[away <= margin], part[away >= -margin]
    return pa.table({"node": pa.array([node], pa.int64()), "tried": pa.array([tried], pa.list_(pa.int32())), "cuts": pa.array([cuts], pa.list_(pa.float64()))})


def _descend(batches):
    """Each row under the places below its node that it falls in, and whether
    these are leaves."""
    for batch in batches:
        if not batch.num_rows:
            continue
        nodes = batch.column("node").to_numpy()
        take, below, leaf = [], [], []
        for node in np.unique(nodes):
            rows = np.flatnonzero(nodes == node)
            x = _unit(_vectors(batch.column("v").take(pa.array(rows))))
            cuts, tried = (batch.column(c)[int(rows[0])].as_py() for c in ("cuts", "tried"))
            margin, parts = _margin(x.shape[1]), {1: np.arange(len(rows))}
            for place in range(1, 2 ** (LEVELS + 1)):
                at = parts.pop(place, None)
                if at is None:
                    continue
                inner = place < 2**LEVELS
                if inner and cuts[place] is not None:
                    away = x[at] @ _direction(int(node), place, tried[place], x.shape[1]) - cuts[place]
                    parts[2 * place], parts[2 * place + 1] = at[away <= margin], at[away >= -margin]
                else:
                    take.append(rows[at])
                    below.append(np.full(len(at), place))
                    leaf.append(np.full(len(at), inner))
        rows = pa.array(np.concatenate(take))
        arrays = [batch.column(c).take(rows) for c in ("id", "n", "v", "tree", "node")]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.concatenate(below)), pa.array(np.concatenate(leaf))], ["id", "n", "v", "tree", "node", "place", "leaf"])


def leaves(rows: DataFrame) -> DataFrame:
    """Every row under every leaf that it falls in, with the leaf's number of rows."""
    done = None
    while True:
        sizes = rows.groupBy("node").agg(F.count("*").alias("rows"))
        sized = rows.join(sizes, "node").withColumn("leaf", F.col("leaf") | (F.col("rows") <= LEAF))
        sized = stored(sized.select("id", "n", "v", "tree", "node", "leaf", "rows"), "forest")
        ended = sized.where("leaf").drop("leaf")
        done = ended if done is None else done.unionByName(ended)
        growing = sized.where("not leaf")
        if growing.isEmpty():
            return done
        chance = F.pmod(F.xxhash64("id", "node", F.lit(7)), F.lit(1 << 20)) / (1 << 20)
        sample = growing.where(chance * F.col("rows") < SAMPLE).select("node", "v", "rows")
        fitted = sample.groupBy("node").applyInArrow(_fit, "node long, tried array<int>, cuts array<double>")
        fallen = growing.drop("leaf", "rows").join(fitted, "node")
        fallen = fallen.mapInArrow(_descend, "id long, n long, v array<double>, tree int, node long, place long, leaf boolean")
        rows = fallen.select("id", "n", "v", "tree", F.xxhash64("node", "place").alias("node"), "leaf")


def _compare(batches):
    """Links within a block, or between two blocks, of a leaf."""
    for table in groups(batches, ("leaf", "low", "high")):
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        leaf = table.column("leaf")[0].as_py()
        block, ids, n = (table.column(c).to_numpy() for c in ("block", "id", "n"))
        left = np.flatnonzero(block == low)
        right = left if low == high else np.flatnonzero(block == high)
        if not len(left) or not len(right):
            continue
        x = _unit(_vectors(table.column("v")))
        linked = np.zeros((len(ids), len(ids)), bool)
        linked[np.ix_(left, right)] = x[left] @ x[right].T >= THRESHOLD
        linked |= linked.T
        np.fill_diagonal(linked, False)
        a, b = np.nonzero(np.triu(linked))
        if not len(a):
            continue
        # The leaves are in one order for all rows: a pair counts in the first it shares.
        of_row = [np.array(v) for v in table.column("leaves").to_pylist()]
        width = max(map(len, of_row))
        earlier = np.full((len(ids), width), -1, np.int64)
        for i, v in enumerate(of_row):
            v = v[v < leaf]
            earlier[i, : len(v)] = v
        counted = np.ones(len(a), bool)
        for k in range(width):
            mine = earlier[a, k]
            counted &= ~((mine[:, None] == earlier[b]) & (mine[:, None] >= 0)).any(axis=1)
        a_, b_ = a[counted], b[counted]
        links = np.bincount(a_, n[b_], len(ids)) + np.bincount(b_, n[a_], len(ids))
        root = np.full(len(ids), -1, np.int64)
        place = {i: k for k, i in enumerate(ids.tolist())}
        for i, r in zip(*spanning(ids, linked)):
            root[place[i]] = r
        some = np.flatnonzero(root >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(root[some]), pa.array(links[some].astype(np.int64))], ["id", "root", "links"])


def usable(vector, label):
    """Whether a vector can link at all."""
    return (
        vector.isNotNull()
        & label.isNotNull()
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept for every row."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"), F.col(label).alias("label"))
    ok = F.coalesce(usable(F.col("v"), F.col("label")), F.lit(False)) & F.col("id").isNotNull()
    same = F.xxhash64("label", F.size("v"), "v")
    rows = rows.select("id", F.when(ok, F.col("v")).alias("v"), F.when(ok, F.col("label")).alias("label"), F.when(ok, same).alias("same"))
    # One row for equal vectors: the least id, and how many ids there are.
    merged = rows.where("same is not null").groupBy("same", "label", "v").agg(F.min("id").alias("first"), F.count_distinct("id").alias("n"))
    merged = stored(merged, "vectors")
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    roots = merged.select(F.col("first").alias("id"), "n", "v", "label", trees)
    # Nodes are numbered by tree first, so that their order is the trees'.
    roots = roots.select("id", "n", "v", "tree", F.xxhash64("label", F.size("v"), "tree").alias("node"), F.lit(False).alias("leaf"))
    found = leaves(roots)
    number = F.col("tree").cast("long") * (1 << 56) + F.col("node").bitwiseAND((1 << 56) - 1)
    found = stored(found.select("id", "n", "v", "rows", number.alias("leaf")), "leaves")

    of_row = found.groupBy("id").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))
    blocks = F.ceil(F.col("rows") / LEAF).cast("int")
    blocked = found.join(of_row, "id").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    pairs = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select("leaf", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "id", "n", "v", "leaves")
    keys = ["leaf", "low", "high"]
    links = stored(pairs.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_compare, "id long, root long, links long"), "vector-links")

    reach = components(links.select("id", "root"))
    counts = links.groupBy("id").agg(F.sum("links").alias("links"))
    named = merged.select("same", "label", "v", "first", "n").join(counts.withColumnRenamed("id", "first"), "first", "left").join(reach.withColumnRenamed("id", "first"), "first", "left")
    named = named.select("same", "label", "v", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "first").alias("component"))
    out = rows.join(named, ["same", "label", "v"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias("vec_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
