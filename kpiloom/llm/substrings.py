"""Repeated passages, found by joins of picked phrases' hashes.

A passage of ``WINDOW`` words that occurs twice is removed wherever it occurs.

1. Phrases. Of every ``WINDOW`` - ``PHRASE`` + 1 consecutive phrases of ``PHRASE``
   words, the one with the least hash is picked. The pick depends on the words
   alone, so two equal windows pick the same phrase at the same place. About one
   phrase in twelve is picked; those picked twice or more recur.
2. Automata. Each part of the documents compiles the recurring phrases picked in
   it into an Aho-Corasick automaton over word numbers and streams its texts
   through it. The join has found by then which texts hold them, so the automata
   place them and find no others. They are as large as their part's own phrases,
   never as the corpus'.
3. Confirmation. Each window belongs to the one phrase picked from it, so the
   windows of a located phrase form a run, its context. Contexts that occur twice
   recur with all their windows. For phrases with a context that occurs once, the
   windows of each different context are counted, and those that occur in two
   recur.

Counts are combined before the shuffle; the joins that bring them back are plain
ones, which adaptive execution splits for a passage that many documents share.

A null text has no words; rows without an id or with the same one are told apart
by their text; a repeated row is another document, so a text of ``WINDOW`` words
or more that occurs twice as a row is removed from both. Only the named columns
are read.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import beside, hashes_of, mixed, ragged, slices, stored, window_hashes, words_of

WINDOW, PHRASE = 35, 12
#: Phrases of a window of which one is picked.
CHOICE = WINDOW - PHRASE + 1
#: Bits of a phrase's place while picking, enough for the longest text there can
#: be; places decide between equal hashes only.
PLACE = np.uint64(32)


def owners(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of the phrase picked from each window of a text, and the hashes
    of all its phrases."""
    if len(hashes) < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    phrase = window_hashes(hashes, PHRASE)
    low = (phrase >> PLACE << PLACE) | np.arange(len(phrase), dtype=np.uint64)
    size = 1
    while 2 * size <= CHOICE:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = CHOICE - size
    if rest:
        low = np.minimum(low[:-rest], low[rest:])
    return (low & ((np.uint64(1) << PLACE) - np.uint64(1))).astype(np.int64), phrase


def picked(hashes: np.ndarray) -> np.ndarray:
    place, phrase = owners(hashes)
    return phrase[np.unique(place)]


def _pick(batches):
    for batch in slices(batches):
        found = [picked(hashes_of(words_of(t, False))) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("row"), ragged(found, pa.int64())], ["row", "phrases"])


def _numbers(hashes: np.ndarray) -> tuple[int, ...]:
    """Words as the automaton's letters. Two words may share a number; what the
    automaton locates is confirmed by whole hashes."""
    return tuple((hashes & np.uint64(0x7FFFFFFF)).tolist())


def _locate(batches):
    """A row per located phrase: where its windows start, the context's hash and
    the hashes of the windows."""
    for batch in slices(batches):
        texts = [hashes_of(words_of(t, False)) for t in batch.column("text").to_pylist()]
        owned = [owners(h) for h in texts]
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        known: set[int] = set()
        for hashes, (place, phrase), wanted in zip(texts, owned, batch.column("phrases").to_pylist()):
            for p in np.flatnonzero(np.isin(phrase, np.array(wanted, np.int64).view(np.uint64))).tolist():
                key = int(phrase[p])
                if key not in known:
                    known.add(key)
                    automaton.add_word(_numbers(hashes[p : p + PHRASE]), len(known))
        if known:
            automaton.make_automaton()
        row, first, anchor, context, windows = [], [], [], [], []
        for i, (hashes, (place, phrase)) in enumerate(zip(texts, owned)):
            if not known or not len(place):
                continue
            located = np.zeros(len(phrase), bool)
            located[[end - PHRASE + 1 for end, _ in automaton.iter(_numbers(hashes))]] = True
            starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            ends = np.append(starts[1:], len(place))
            inside = np.arange(len(place)) - np.repeat(starts, ends - starts)
            mine = located[place[starts]]
            starts, ends = starts[mine], ends[mine]
            if not len(starts):
                continue
            window = window_hashes(hashes, WINDOW)
            p = place[starts]
            # Every window of the run and its place in it go into the context's hash.
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(window + mixed(inside.astype(np.uint64))), dtype=np.uint64)])
            run = sums[ends] - sums[starts]
            row += [i] * len(starts)
            first.append(starts.astype(np.int32))
            anchor.append(phrase[p])
            context.append(mixed(run ^ mixed((p - starts).astype(np.uint64) << np.uint64(32) | (ends - starts).astype(np.uint64))))
            windows += [window[s:e] for s, e in zip(starts.tolist(), ends.tolist())]
        if row:
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").take(pa.array(row, pa.int64())),
                    pa.array(np.concatenate(first)),
                    pa.array(np.concatenate(anchor).view(np.int64)),
                    pa.array(np.concatenate(context).view(np.int64)),
                    ragged(windows, pa.int64()),
                ],
                ["row", "first", "anchor", "context", "windows"],
            )


_RUNS = pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32())]))


def _joined(batches):
    """A row's runs of window starts, those that touch as one."""
    for batch in slices(batches):
        out = []
        for runs in batch.column("runs").to_pylist():
            merged: list[list[int]] = []
            for first, n in sorted((x["first"], x["n"]) for x in runs):
                if merged and first <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], first + n)
                else:
                    merged.append([first, first + n])
            out.append([{"first": s, "n": e - s} for s, e in merged])
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, _RUNS)], ["row", "runs"])


def _remove(batches):
    for batch in slices(batches):
        totals, removed, texts = [], [], []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            words = words_of(text, False)
            cover = np.zeros(len(words) + 1, np.int64)
            at = np.array([x["first"] for x in runs or ()], np.int64)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + np.array([x["n"] + WINDOW - 1 for x in runs or ()], np.int64), -1)
            gone = np.cumsum(cover)[:-1] > 0
            totals.append(len(words))
            removed.append(int(gone.sum()))
            kept = words if not len(at) else [w for w, g in zip(words, gone.tolist()) if not g]
            texts.append(b" ".join(kept))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()), pa.array([hashlib.sha256(t).hexdigest() for t in texts])],
            ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256"],
        )


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_text and kept_sha256 for every row."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    docs = docs.withColumn("row", F.xxhash64("doc_id", "text"))

    picks = stored(docs.select("row", "text").mapInArrow(_pick, "row long, phrases array<long>").where("size(phrases) > 0"), "phrases")
    each = picks.select("row", F.explode("phrases").alias("phrase"))
    recurring = each.groupBy("phrase").agg(F.count("*").alias("n")).where("n > 1").select("phrase")
    of_row = each.join(recurring, "phrase").groupBy("row").agg(F.collect_set("phrase").alias("phrases"))

    near = beside(docs.select("row", "text"), of_row, "phrases")
    located = stored(near.mapInArrow(_locate, "row long, first int, anchor long, context long, windows array<long>"), "contexts")

    # Equal contexts have equal windows, so any of them will do.
    contexts = located.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min("windows").alias("windows"))
    contexts = stored(contexts, "different-contexts")
    single = contexts.groupBy("anchor").agg(F.min("n").alias("least")).where("least = 1").select("anchor")
    windows = contexts.join(single, "anchor").select("n", F.explode("windows").alias("window"))
    recurring = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")

    both = located.join(contexts.select("anchor", "context", "n"), ["anchor", "context"])
    whole = both.where("n > 1").select("row", F.struct("first", F.size("windows").alias("n")).alias("run"))
    each = both.where("n = 1").select("row", "first", F.posexplode("windows").alias("i", "window")).join(recurring, "window")
    some = each.select("row", F.struct((F.col("first") + F.col("i")).alias("first"), F.lit(1).alias("n")).alias("run"))
    runs = whole.union(some).groupBy("row").agg(F.collect_list("run").alias("runs"))
    runs = runs.mapInArrow(_joined, "row long, runs array<struct<first: int, n: int>>")
    marked = beside(docs.select("doc_id", "row", "text"), runs, "runs", "left")
    return marked.mapInArrow(_remove, "doc_id long, n_words long, n_removed long, kept_text binary, kept_sha256 string")


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_words", "n_removed", "kept_sha256")
