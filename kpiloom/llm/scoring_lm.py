"""Language-model scores from a log-frequency Bloom filter.

Training documents give counts of words and of word pairs. A count c is
quantised to q = 1 + floor(log(c) / log(STEP)), and the q entries (gram, 1) ...
(gram, q) go into a Bloom filter: probing upwards until the first miss gives the
quantised count back. Words and pairs that occur once are in it as well.

A token's probability mixes both: WEIGHT * c(pair) / c(first) + (1 - WEIGHT) *
p(word), with the word's probability smoothed by adding a half; after a first word
that was never seen it is p(word) alone.

The filter is made of shards: a bucket of grams, which is a range of their hashes,
is counted and put into its shard in one task, with as many bits as it needs. What
is broadcast is bounded by ``PASS_BYTES``. A larger filter takes more passes over
the documents; each notes, a byte per token, the levels of the grams that its
shards hold, and the last one adds up the score. No entry is left out, whatever
the size.

The exact score by single words needs every word's exact count. Words that make
up a ``HEAD``-th of all tokens or more, of which there can be ``HEAD`` at most,
are broadcast; all other words of a document are joined with their counts.

Words are known by a 64-bit hash. Counts travel as blocks of hashes by bucket
and are merged per bucket; a frequent word is one entry of a block, so no
bucket grows with it.

A null text is an empty one, with its end as only token; a null id trains; a
repeated row trains and is scored again; an empty table gives no rows; further
columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import hashes_of, mixed, ragged, slices, stored, words_of

#: Growth of one step of a quantised count.
STEP = 1.5
#: Weight of pairs against single words.
WEIGHT = 0.2
#: Entries' bits and probes in the filter.
BITS, PROBES = 11, 6
#: The most bytes of shards that one pass over the documents holds.
PASS_BYTES = 144 << 20
#: The most words that can be broadcast with their counts.
HEAD = 100_000
#: Tokens whose grams a task counts before it passes them on.
CHUNK = 1_500_000
#: Entries that a bucket of grams is made for, and bytes of text for each.
BUCKET, BYTES_PER_TOKEN = 500_000, 5
SALTS = (np.uint64(0x51ED270B27A1F6C3), np.uint64(0x2545F4914F6CDD1D))
_END = np.array([0x1D8AF066F0A1A2B3], np.uint64)


def tokens(text: str | None) -> np.ndarray:
    """Hashes of the text's lower-cased words and of its end."""
    return np.concatenate([hashes_of(words_of(text, True)), _END])


def pairs_of(t: np.ndarray) -> np.ndarray:
    """The hash of each token with the one before it; before the first is an end."""
    return mixed(np.concatenate([_END, t[:-1]]) * np.uint64(0x9E3779B97F4A7C15) + t)


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def _counter(buckets: int):
    """Blocks of (kind, bucket, hashes, counts); kind 0 is words, 1 is pairs."""

    def blocks(kept: list[np.ndarray]):
        for kind, grams in enumerate((kept, map(pairs_of, kept))):
            keys, counts = np.unique(np.concatenate(list(grams)), return_counts=True)
            # Keys are sorted, and a bucket is a range of them.
            edges = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1)).tolist()
            rows = [(b, s, e) for b, (s, e) in enumerate(zip(edges[:-1], edges[1:])) if e > s]
            counts = counts.astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([kind] * len(rows), pa.int32()),
                    pa.array([b for b, *_ in rows], pa.int32()),
                    pa.array([keys[s:e].tobytes() for _, s, e in rows], pa.binary()),
                    pa.array([counts[s:e].tobytes() for _, s, e in rows], pa.binary()),
                ],
                ["kind", "bucket", "keys", "counts"],
            )

    def count(batches):
        kept, size = [], 0
        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                if not is_held_out(doc_id):
                    kept.append(tokens(text))
                    size += len(kept[-1])
                if size >= CHUNK:
                    yield from blocks(kept)
                    kept, size = [], 0
        if kept:
            yield from blocks(kept)

    return count


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def levels_of(n: np.ndarray) -> np.ndarray:
    return (1 + np.floor(np.log(n) / np.log(STEP) + 1e-9)).astype(np.int64)


def count_at(level: np.ndarray) -> np.ndarray:
    """The middle of the counts with that level; 0 for level 0."""
    low = np.ceil(STEP ** (level - 1.0) - 1e-9)
    high = np.ceil(STEP ** np.asarray(level, float) - 1e-9) - 1
    return np.where(level > 0, (low + np.maximum(low, high)) / 2, 0.0)


def _places(entries: np.ndarray, bits) -> list[np.ndarray]:
    """The entries' bits in shards of that many bits."""
    first, step = mixed(entries) >> np.uint64(1), entries >> np.uint64(20)
    return [(first + np.uint64(i) * step) % bits for i in range(PROBES)]


def _entries(kind: int, hashes: np.ndarray, level) -> np.ndarray:
    return mixed((hashes ^ SALTS[kind]) + np.asarray(level, np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shard_of(kind: int, hashes: np.ndarray, n: np.ndarray) -> bytes:
    """A filter of the grams' levels, with ``BITS`` bits for each entry."""
    level = levels_of(n)
    size = 8 * max(1, -(-int(level.sum()) * BITS // 8))
    held = np.zeros(size, bool)
    for q in range(1, int(level.max()) + 1):
        for place in _places(_entries(kind, hashes[level >= q], q), np.uint64(size)):
            held[place.astype(np.int64)] = True
    return np.packbits(held).tobytes()


_SHARDS = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary()), ("total", pa.int64()), ("grams", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_SHARDS_SQL = "kind int, bucket int, bits binary, total long, grams long, keys binary, counts binary"


def _merge(table: pa.Table) -> pa.Table:
    """A bucket's grams counted over all blocks, and their shard. Words are handed
    on with their counts; of pairs only the shard is left."""
    kind, bucket = (table.column(c)[0].as_py() for c in ("kind", "bucket"))
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
    counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), "<u4")
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    n, keys = np.add.reduceat(counts[order].astype(np.int64), new), keys[new]
    words = (keys.tobytes(), n.tobytes()) if kind == 0 else (None, None)
    row = kind, bucket, shard_of(kind, keys, n), int(n.sum()), len(keys), *words
    return pa.Table.from_pylist([dict(zip(_SHARDS.names, row))], _SHARDS)


def _unpack(batches):
    for batch in batches:
        for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(keys, np.int64)), pa.array(np.frombuffer(counts, np.int64))], ["hash", "n"])


def filter_shards(docs: DataFrame) -> tuple[DataFrame, int]:
    """A row for each bucket of words and of pairs, and the number of buckets.

    Every chunk of tokens hands on a gram once, so buckets are made for as many
    entries as the texts have tokens, at ``BYTES_PER_TOKEN`` each; shorter tokens
    only make buckets larger in proportion."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // (BYTES_PER_TOKEN * BUCKET)))
    blocks = docs.mapInArrow(_counter(buckets), "kind int, bucket int, keys binary, counts binary")
    return stored(blocks.groupBy("kind", "bucket").applyInArrow(_merge, _SHARDS_SQL), "filter"), buckets


def passes(largest: dict[int, int], buckets: int) -> list[list[tuple[int, int, int]]]:
    """Ranges (kind, first, end) of buckets for each pass, by the largest shard of
    a kind; shards of a kind hardly differ in size."""
    out, left = [[]], PASS_BYTES
    for kind in (0, 1):
        first, most = 0, max(1, largest.get(kind, 1))
        while first < buckets:
            fit = left // most
            if not fit and out[-1]:
                out.append([])
                left = PASS_BYTES
                continue
            end = min(buckets, first + max(1, fit))
            out[-1].append((kind, first, end))
            left -= (end - first) * most
            first = end
    return out


class Shards:
    """Some of the filter's shards, and the levels of grams that lie in them."""

    def __init__(self, held, buckets: int, size: int):
        """``held`` gives (kind, bucket, bits), ``size`` is their bytes."""
        self.buckets = buckets
        self.base, self.bits_of = (np.full((2, buckets), -1, np.int64), np.ones((2, buckets), np.uint64))
        self.bits, end = np.zeros(size, np.uint8), 0
        for kind, bucket, bits in held:
            self.base[kind, bucket], self.bits_of[kind, bucket] = end, 8 * len(bits)
            self.bits[end : end + len(bits)] = np.frombuffer(bits, np.uint8)
            end += len(bits)

    def levels(self, kind: int, hashes: np.ndarray) -> np.ndarray:
        """Probes level after level, each time only what all levels before held."""
        level = np.zeros(len(hashes), np.int64)
        bucket = bucket_of(hashes, self.buckets)
        at = np.flatnonzero(self.base[kind][bucket] >= 0)
        base, size = self.base[kind][bucket[at]], self.bits_of[kind][bucket[at]]
        q = 1
        while len(at):
            entries = _entries(kind, hashes[at], q)
            first, step = mixed(entries) >> np.uint64(1), entries >> np.uint64(20)
            for i in range(PROBES):
                place = ((first + np.uint64(i) * step) % size).astype(np.int64)
                hit = self.bits[base + (place >> 3)] >> (7 - (place & 7)).astype(np.uint8) & 1 > 0
                at, base, size, first, step = at[hit], base[hit], size[hit], first[hit], step[hit]
            level[at] = q
            q += 1
        return level


class Head:
    """The frequent words' hashes and counts, and what all words' counts share."""

    def __init__(self, rows: list[tuple[int, int]], total: int, distinct: int):
        hashes = np.array([h for h, _ in rows], np.int64).view(np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.over = total + 0.5 * (distinct + 1)
        self.logs = np.log10((np.array([n for _, n in rows], float)[order] + 0.5) / self.over)

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word is in the head, and whether it is."""
        if not len(self.hashes):
            return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return at, self.hashes[at] == words


def _scorer(held, head, first: bool, last: bool):
    """One pass. ``levels`` has a byte per token for its word and then one per
    token for its pair, 0 as long as no shard held the gram."""

    def score(batches):
        shards, common = held.value, head.value
        for batch in slices(batches):
            texts = [tokens(t) for t in batch.column("text").to_pylist()]
            if not texts:
                continue
            flat = np.concatenate(texts)
            ends = np.cumsum([len(t) for t in texts])
            starts = ends - [len(t) for t in texts]
            word, of_word = np.unique(flat, return_inverse=True)
            pair, of_pair = np.unique(np.concatenate([pairs_of(t) for t in texts]), return_inverse=True)
            levels = np.stack([shards.levels(0, word)[of_word], shards.levels(1, pair)[of_pair]]).astype(np.uint8)
            arrays = [batch.column(c) for c in ("row", "doc_id")]
            if first:
                at, found = common.find(word)
                base = np.where(found, common.logs[at] if len(common.logs) else 0.0, 0.0)[of_word]
                rare = [np.unique(w[~found[w]], return_counts=True) for w in (of_word[s:e] for s, e in zip(starts, ends))]
                arrays += [
                    pa.array(ends - starts, pa.int64()),
                    pa.array(np.add.reduceat(found[of_word].astype(np.int64), starts)),
                    pa.array(np.add.reduceat(base, starts)),
                    ragged([word[w] for w, _ in rare], pa.int64()),
                    ragged([n for _, n in rare], pa.int64()),
                ]
            else:
                arrays += [batch.column(c) for c in _FIRST]
                levels |= np.concatenate([np.frombuffer(x, np.uint8).reshape(2, -1) for x in batch.column("levels").to_pylist()], axis=1)
            if last:
                c_word, c_pair = count_at(levels[0]), count_at(levels[1])
                before = np.empty_like(c_word)
                before[1:] = c_word[:-1]
                before[starts] = c_word[ends - 1]  # an end comes before the first word
                share = np.minimum(c_pair / np.maximum(before, 1.0), 1.0)
                single = (c_word + 0.5) / common.over
                # After a word that was never seen, single words have all the weight.
                logs = np.log10(np.where(before > 0, WEIGHT * share + (1 - WEIGHT) * single, single))
                arrays.append(pa.array(np.add.reduceat(logs, starts)))
                names = ["row", "doc_id", *_FIRST, "score"]
            else:
                arrays += [batch.column("text"), pa.array([levels[:, s:e].tobytes() for s, e in zip(starts, ends)], pa.binary())]
                names = ["row", "doc_id", *_FIRST, "text", "levels"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return score


_FIRST = ("n_tokens", "n_common", "common", "rare", "rare_n")
_ROWS = "row long, doc_id long, n_tokens long, n_common long, common double, rare array<long>, rare_n array<long>, "


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    shards, buckets = filter_shards(docs)
    of_kind = {r.kind: r for r in shards.groupBy("kind").agg(F.sum("total").alias("total"), F.sum("grams").alias("grams"), F.max(F.octet_length("bits")).alias("most")).collect()}
    total, distinct = (of_kind[0].total, of_kind[0].grams) if 0 in of_kind else (0, 0)
    words = shards.where("kind = 0").select("keys", "counts").mapInArrow(_unpack, "hash long, n long")
    common = words.where(F.col("n") * HEAD >= total)
    head = Head([tuple(r) for r in common.collect()], total, distinct)

    rows = docs.withColumn("row", F.xxhash64("doc_id", "text"))
    parts = passes({k: r.most for k, r in of_kind.items()}, buckets)
    common_words = sc.broadcast(head)
    for part in parts:
        wanted = F.lit(False)
        for kind, start, end in part:
            wanted = wanted | ((F.col("kind") == kind) & F.col("bucket").between(start, end - 1))
        mine = shards.where(wanted).select("kind", "bucket", "bits")
        size = mine.agg(F.coalesce(F.sum(F.octet_length("bits")), F.lit(0))).first()[0]
        some = Shards(mine.toLocalIterator(), buckets, size)
        last = part is parts[-1]
        sent = sc.broadcast(some)
        scorer = _scorer(sent, common_words, part is parts[0], last)
        rows = stored(rows.mapInArrow(scorer, _ROWS + ("score double" if last else "text string, levels binary")), "scored")
        # The rows are written, so no task needs these shards again.
        sent.destroy()

    over = F.lit(float(head.over))
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select("row", F.col("r.rare").alias("hash"), F.col("r.rare_n").alias("times"))
    # A repeated row would add its rare words once more: its twin's are the same.
    seen = F.col("n").isNotNull()
    share = F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + 0.5) / over)
    rare = rare.join(words.where(F.col("n") * HEAD < total), "hash", "left")
    sums = rare.groupBy("row").agg(F.sum(share).alias("rare_sum"), F.sum(F.when(seen, F.col("times")).otherwise(0)).alias("rare_known"))
    twins = rows.groupBy("row").agg(F.count("*").alias("twins"))
    sums = sums.join(twins, "row").select("row", (F.col("rare_sum") / F.col("twins")).alias("rare_sum"), F.expr("rare_known div twins").alias("rare_known"))
    return rows.join(sums, "row", "left").select(
        "doc_id",
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("n_common") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("common") + F.coalesce("rare_sum", F.lit(0.0))).alias("base_score"),
        "score",
    )
