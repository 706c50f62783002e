"""Near-duplicate documents by SuperMinHash, banding and exact confirmation.

A document's set is its distinct 5-word shingles. Each element spreads its ranks
over the signature's places by its own random permutation, so the ranks of one
element are correlated and fill the signature evenly; rounds stop as soon as no
later rank can lower any place.

Documents with equal sets form a class, which goes on as one. Classes that share
a band of their signatures are candidates. A band's members are linked to its
least member only, so that a band of any size gives as many rows as members; the
components of these links bound which documents can be linked at all. Each
candidate's whole set is then brought to its component once and compared there
by counting common shingles. A large component is cut into blocks, and pairs of
blocks are compared in tasks of their own. Tasks return a spanning set of the
confirmed links, whose components are the result. All pairs that share a band
are therefore confirmed or refused on full sets, with no limit on partners.

A band holds ``ROWS`` places. Callers choose the threshold with the bands that
suit it: ``BANDS`` for ``THRESHOLD``, ``bands_for`` for another. Two documents at
the threshold miss each other in all bands with a probability of about 5e-5.

A null or empty text, or one without words, has an empty set and links with
nothing; neither does a row without an id, whose component is null and which is
kept. A repeated row gets its twin's result. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import MIX_A, hashes_of, mixed, ragged, slices, stored, window_hashes, words_of
from kpiloom.llm.components import components

WIDTH = 5
#: Links of op9 have 100 * intersection >= THRESHOLD * union.
THRESHOLD = 85
BANDS, ROWS = 21, 6
#: The most that two documents at the threshold may miss each other by chance.
MISSED = 5e-5
#: Elements whose permutations are laid out at a time.
LAID_OUT = 50_000
#: Shingles and documents of a block.
BLOCK_SHINGLES, BLOCK_DOCS = 400_000, 512


def bands_for(threshold: int) -> int:
    """The bands with which two documents at the threshold are missed with a
    probability of ``MISSED`` at most. A rank has room for 254 places."""
    bands = math.ceil(math.log(MISSED) / math.log1p(-((threshold / 100) ** ROWS)))
    if bands * ROWS > 254:
        raise ValueError(f"a threshold of {threshold} needs {bands} bands")
    return bands


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """The sorted hashes of the text's distinct shingles; with fewer words than
    the width, of all its words as one."""
    hashes = hashes_of(words_of(text, True))
    if 0 < len(hashes) < width:
        return window_hashes(hashes, len(hashes)) ^ np.uint64(len(hashes))
    return np.unique(window_hashes(hashes, width))


def _signatures(sets: list[np.ndarray], places: int) -> np.ndarray:
    """A row of ``places`` ranks per set. A rank has its round in the top byte
    and a random number below, so later rounds never win a place."""
    out = np.full((len(sets), places), np.iinfo(np.uint64).max, np.uint64)
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = out.reshape(-1)
    order = np.broadcast_to(np.arange(places, dtype=np.uint8), (len(element), places)) if len(element) else None
    for j in range(places):
        if not len(element):
            break
        random = mixed(element + np.uint64((j + 1) * int(MIX_A) % 2**64))
        # The next step of the element's shuffle: its place j gets one of the places left.
        k = j + ((random >> np.uint64(40)) % np.uint64(places - j)).astype(np.int64)
        rows = np.arange(len(element))
        place = order[rows, k].astype(np.int64)
        rank = np.uint64(j << 56) | (random & np.uint64((1 << 40) - 1))
        np.minimum.at(flat, owner * places + place, rank)
        # A set is done when all its places hold ranks of rounds so far.
        going = (out >> np.uint64(56)).max(axis=1) > j
        left = going[owner]
        if not left.all() or j == 0:
            moved = order[rows, j].copy()
            element, owner, k, moved, place = element[left], owner[left], k[left], moved[left], place[left]
            order = order[left]
            rows = np.arange(len(element))
        else:
            moved = order[rows, j].copy()
        order[rows, k] = moved
        order[rows, j] = place
    return out


def signatures(sets: list[np.ndarray], places: int = BANDS * ROWS) -> np.ndarray:
    """SuperMinHash signatures, laid out for a bounded number of elements at a time."""
    parts, start = [], 0
    while start < len(sets):
        end, size = start, 0
        while end < len(sets) and (end == start or size + len(sets[end]) <= LAID_OUT):
            size += len(sets[end])
            end += 1
        parts.append(_signatures(sets[start:end], places))
        start = end
    return np.concatenate(parts) if parts else np.empty((0, places), np.uint64)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One hash per band of each signature; equal bands have equal hashes."""
    bands = signature.shape[1] // ROWS
    keys = np.zeros((len(signature), bands), np.uint64)
    for r in range(ROWS):
        keys = mixed(keys ^ signature[:, r * bands : (r + 1) * bands])
    return mixed(keys + np.arange(bands, dtype=np.uint64))


def _signer(bands: int):
    def sign(batches):
        for batch in slices(batches):
            sets = [shingles(t) for t in batch.column("text").to_pylist()]
            some = [i for i, s in enumerate(sets) if len(s)]
            signed = band_keys(signatures([sets[i] for i in some], bands * ROWS))
            keys = [np.empty(0, np.uint64)] * len(sets)
            for i, k in zip(some, signed):
                keys[i] = k
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    ragged(keys, pa.int64()),
                ],
                ["id", "n_shingles", "digest", "bands"],
            )

    return sign


def _sets(batches):
    for batch in slices(batches):
        sets = [shingles(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("component"), batch.column("blocks"), batch.column("id"), ragged(sets, pa.int64())], ["component", "blocks", "id", "shingles"])


def groups(batches, keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """The runs of equal keys in batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        change[0] = first != last
        edges = [*np.flatnonzero(change).tolist(), batch.num_rows]
        if edges[0] > 0 or not change[0]:
            held.append(batch.slice(0, edges[0]))
        for s, e in zip(edges[:-1], edges[1:]):
            if held:
                yield pa.Table.from_batches(held)
            held = [batch.slice(s, e - s)]
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def common_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of ``a`` shares with each of ``b``."""
    if len(a) == len(b) == 1:
        return np.array([[len(np.intersect1d(a[0], b[0], assume_unique=True))]])
    sides = []
    for sets in (a, b):
        sides.append((np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])))
    both = np.intersect1d(np.unique(sides[0][0]), np.unique(sides[1][0]), assume_unique=True)
    out = np.zeros((len(a), len(b)), np.float32)
    step = 4096
    placed = []
    for flat, owner in sides:
        at = np.searchsorted(both, flat)
        hit = (at < len(both)) & (both[np.minimum(at, len(both) - 1)] == flat) if len(both) else np.zeros(len(flat), bool)
        order = np.argsort(at[hit], kind="stable")
        placed.append((at[hit][order], owner[hit][order]))
    for start in range(0, len(both), step):
        m = []
        for (at, owner), sets in zip(placed, (a, b)):
            s, e = np.searchsorted(at, [start, start + step])
            x = np.zeros((len(sets), step), np.float32)
            x[owner[s:e], at[s:e] - start] = 1
            m.append(x)
        out += m[0] @ m[1].T
    return out.astype(np.int64)


def spanning(ids: np.ndarray, linked: np.ndarray) -> tuple[list[int], list[int]]:
    """Each node's id with the least id reachable, for nodes that have a link."""
    a, b = [], []
    todo = np.ones(len(ids), bool)
    for start in np.argsort(ids, kind="stable"):
        if not todo[start]:
            continue
        reached, edge = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
        reached[start] = edge[start] = True
        while edge.any():
            edge = linked[edge].any(axis=0) & ~reached
            reached |= edge
        todo &= ~reached
        members = np.flatnonzero(reached)
        if len(members) > 1:
            a += ids[members].tolist()
            b += [int(ids[start])] * len(members)
    return a, b


def _confirmer(threshold: int):
    def confirm(batches):
        """Links within a block, or between two blocks, of a component."""
        for table in groups(batches, ("component", "low", "high")):
            low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
            ids, block = table.column("id").to_numpy(), table.column("block").to_numpy()
            flat = table.column("shingles").combine_chunks()
            ends = flat.offsets.to_numpy()
            values = flat.values.to_numpy().view(np.uint64)
            sets = [values[s:e] for s, e in zip(ends[:-1], ends[1:])]
            left = np.flatnonzero(block == low)
            right = left if low == high else np.flatnonzero(block == high)
            if len(left) + len(right) < 2 or not len(left) or not len(right):
                continue
            shared = common_counts([sets[i] for i in left], [sets[i] for i in right])
            sizes = np.array([len(s) for s in sets])
            either = sizes[left][:, None] + sizes[right][None, :] - shared
            ok = 100 * shared >= threshold * either
            linked = np.zeros((len(ids), len(ids)), bool)
            linked[np.ix_(left, right)] = ok
            linked |= linked.T
            a, b = spanning(ids, linked)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return confirm


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, bands: int = BANDS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row; links have
    100 * intersection >= threshold * union."""
    docs = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    signed = stored(docs.mapInArrow(_signer(bands), "id long, n_shingles long, digest binary, bands array<long>"), "signatures")
    classes = signed.where("id is not null and digest is not null").groupBy("digest").agg(F.min("id").alias("first"), F.min("bands").alias("bands"), F.min("n_shingles").alias("n"))
    classes = stored(classes, "classes")

    banded = classes.select(F.col("first").alias("id"), F.explode("bands").alias("band"))
    least = banded.groupBy("band").agg(F.min("id").alias("least"), F.count("*").alias("n")).where("n > 1").select("band", "least")
    near = components(banded.join(least, "band").where("id != least").select("id", "least"))

    sized = near.join(classes.select(F.col("first").alias("id"), "n"), "id").groupBy("component").agg(F.sum("n").alias("all"), F.count("*").alias("members"))
    blocks = F.greatest(F.ceil(F.col("all") / BLOCK_SHINGLES), F.ceil(F.col("members") / BLOCK_DOCS)).cast("int")
    members = near.join(sized.select("component", blocks.alias("blocks")), "component")
    texts = docs.join(members, "id").select("component", "blocks", "id", "text")
    sets = texts.mapInArrow(_sets, "component long, blocks int, id long, shingles array<long>")
    sets = sets.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = sets.select("component", "id", "shingles", "block", other)
    pairs = pairs.select("component", "id", "shingles", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    keys = ["component", "low", "high"]
    links = pairs.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_confirmer(threshold), "a long, b long")
    found = components(links)

    firsts = classes.select("digest", "first").join(found.withColumnRenamed("id", "first"), "first", "left")
    firsts = firsts.select("digest", F.coalesce("component", "first").alias("component"))
    named = signed.join(firsts, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return named.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
