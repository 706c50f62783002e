"""Best-fit decreasing packing of tokenised documents into sequences.

Only lengths decide a packing, and a length is at most the capacity. So the
pieces are counted by length (``capacity`` rows at most reach the driver), the
counts are packed by best-fit decreasing over a segment tree of remaining
capacities, and the plan, a few runs per length, is joined back to the pieces
by their rank among those of their length. The packing is that of one
best-fit-decreasing run over all pieces, however many there are.

Ranks are taken in small parts of a length, with the counts of the parts before
added, so a length that a third of all pieces share is no single task's work.

A null text is an empty one and gives one piece with the end token alone; a null
id is passed on; a repeated row is packed again; an empty table gives no rows;
further columns are not read.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kpiloom.llm.common import ragged, slices, stored

CAPACITY = 2048
END = 0
#: Pieces of one length that are ranked together.
RANKED = 20_000
#: Words whose ids a task remembers before it forgets them all, and those encoded at a time.
REMEMBERED, ENCODED = 400_000, 20_000
#: Marks after a word's last letter, which the tokenizer always parts from it.
MARKS = ".,;:!?"


def plain(text: str) -> bool:
    """Whether all white space is single blanks and line ends between words, and
    nothing can be a special token. A blank or line end then always starts a
    piece of the tokenizer's own splitting."""
    words = text.split()
    gaps = text.count(" ") + text.count("\n")
    return len(words) == gaps + 1 and sum(map(len, words)) + gaps == len(text) and "<|" not in text


class Encoder:
    """Token ids as little-endian 32-bit bytes, remembered by word: those that
    follow a blank and those that begin a line."""

    def __init__(self, path: str, ranks: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Words that come up for the first time are most of the work. The same
        # vocabulary as ranks gives the same ids in a quarter of the time.
        self.ranked = None
        if ranks:
            with open(ranks, "rb") as lines:
                merged = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranked = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merged, special_tokens={})
        self.line = self._whole("\n")
        self.after, self.first = {}, {"": b""}
        #: Ids of the marks that have come up, which are few.
        self.marks: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _word_ids(self, text: str) -> np.ndarray:
        if self.ranked is None:
            return self._ids(text)
        return self.ranked.encode_to_numpy(text, disallowed_special=()).astype("<u4")

    def _whole(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def _learn(self, known: dict[str, bytes], words: set[str], blank: str) -> None:
        marked = [(w, stem) for w in words if (stem := w.rstrip(MARKS)) != w and stem[-1:].isalpha()]
        words.difference_update([w for w, _ in marked])
        words.update([stem for _, stem in marked if stem not in known])
        words = list(words)
        # Words on lines of their own: the line ends' ids part them again.
        end = np.frombuffer(self.line, "<u4")[0]
        for i in range(0, len(words), ENCODED):
            some = words[i : i + ENCODED]
            ids = self._word_ids("\n".join([blank + w for w in some]))
            edges = [-1, *np.flatnonzero(ids == end).tolist(), len(ids)]
            for word, s, e in zip(some, edges[:-1], edges[1:], strict=False):
                known[word] = ids[s + 1 : e].tobytes()
        for word, stem in marked:
            tail = word[len(stem) :]
            if tail not in self.marks:
                self.marks[tail] = self._whole(tail)
            known[word] = known[stem] + self.marks[tail]

    def __call__(self, texts: list[str]) -> list[bytes]:
        if len(self.after) + len(self.first) > REMEMBERED:
            self.after, self.first, self.marks = {}, {"": b""}, {}
        split = [[line.split(" ") for line in t.split("\n")] if plain(t) else None for t in texts]
        lines = [line for text in split if text for line in text]
        self._learn(self.first, {line[0] for line in lines}.difference(self.first), "")
        self._learn(self.after, set().union(*[line[1:] for line in lines]).difference(self.after), " ")
        first, after = self.first, self.after.__getitem__
        return [
            self._whole(text) if lines is None else self.line.join([first[line[0]] + b"".join(map(after, line[1:])) for line in lines])
            for text, lines in zip(texts, split)
        ]


_ENCODERS: dict[tuple[str, str | None], Encoder] = {}


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: the first takes the remainder."""
    first = (n - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _cutter(path: str, ranks: str | None, capacity: int, with_ids: bool):
    def cut(batches):
        if (path, ranks) not in _ENCODERS:
            _ENCODERS[path, ranks] = Encoder(path, ranks)
        encoder = _ENCODERS[path, ranks]
        end = np.array([END], "<u4").tobytes()
        for batch in slices(batches):
            rows: list[tuple[int, int, int, int, int]] = []
            ids = []
            for i, raw in enumerate(encoder([t or "" for t in batch.column("text").to_pylist()])):
                raw += end
                for piece, (start, length) in enumerate(cuts(len(raw) // 4, capacity)):
                    part = raw[4 * start : 4 * (start + length)]
                    rows.append((i, piece, start, length, zlib.crc32(part)))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            at, *cols = zip(*rows) if rows else [()] * 5
            arrays = [batch.column("row").take(pa.array(at, pa.int64())), pa.array(cols[0], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[1:]]]
            names = ["row", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays, names = [*arrays, ragged(ids, pa.int32())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return cut


def pieces(docs: DataFrame, tokenizer: str, payload: list[str], text: str = "text", capacity: int = CAPACITY, with_ids: bool = False, ranks: str | None = None) -> DataFrame:
    """A row per piece of at most ``capacity`` ids: the payload columns as
    ``row``, piece, start, length, ids_crc32, and the ids if wanted. ``ranks``
    is the tokenizer's vocabulary as a file of ranks, where there is one."""
    rows = docs.select(F.struct(*payload).alias("row"), F.col(text).alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(_cutter(tokenizer, ranks, capacity, with_ids), schema + ", ids array<int>" * with_ids)


class OpenBins:
    """A segment tree over remaining capacities: which of them open bins have."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = bytearray(2 * self.size)
        #: By remaining capacity: (first bin, bins) with that much left.
        self.bins: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def add(self, left: int, first: int, count: int) -> None:
        if left and count:
            self.bins[left].append((first, count))
            self._mark(left)

    def take(self, left: int) -> tuple[int, int]:
        group = self.bins[left].pop()
        self._mark(left)
        return group

    def _mark(self, left: int) -> None:
        i = left + self.size
        self.any[i] = bool(self.bins[left])
        while i := i // 2:
            self.any[i] = self.any[2 * i] | self.any[2 * i + 1]

    def tightest(self, length: int) -> int:
        """The least remaining capacity that holds ``length``; 0 if none does."""
        i = length + self.size
        while not self.any[i]:
            while i & 1:  # up, while a right child
                i //= 2
            if not i:
                return 0
            i += 1
        while i < self.size:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        return i - self.size


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing of ``counts`` pieces by length.

    Runs (length, low, high, bin, each, offset): the pieces of that length with
    ranks from low to high go, ``each`` to a bin, into the bins from ``bin`` on,
    the first at ``offset``. A bin that takes one piece of a length is from then
    on the tightest one for the next, until it holds no more of them, which is
    why a run fills its bins one after the other.
    """
    bins, opened, runs = OpenBins(capacity), 0, []
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = bins.tightest(length)
            each = (room or capacity) // length
            wanted = -(-left // each)
            if room:
                first, count = bins.take(room)
                if count > wanted:
                    bins.add(room, first + wanted, count - wanted)
                    count = wanted
            else:
                room, first, count = capacity, opened, wanted
                opened += wanted
            placed = min(left, each * count)
            runs.append((length, rank, rank + placed - 1, first, each, capacity - room))
            full, over = divmod(placed, each)
            bins.add(room - each * length, first, full)
            bins.add(room - over * length, first + full, int(over > 0))
            rank, left = rank + placed, left - placed
    return runs


def _ranked(rows: DataFrame, parts: int) -> DataFrame:
    """``rank`` from 0 among the rows of a length, in parts of a length."""
    rows = rows.withColumn("part", F.pmod(F.xxhash64("row", "piece"), F.lit(parts)).cast("int"))
    sizes = rows.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(W.partitionBy("length").orderBy("part")) - F.col("n")).drop("n")
    inside = F.row_number().over(W.partitionBy("length", "part").orderBy("row", "piece")) - 1
    return rows.withColumn("inside", inside).join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("inside"))


def packed(docs: DataFrame, tokenizer: str, payload: list[str], text: str = "text", capacity: int = CAPACITY, with_ids: bool = False, ranks: str | None = None) -> DataFrame:
    """The pieces with sequence_id and the offset of each in its sequence."""
    spark = docs.sparkSession
    rows = stored(pieces(docs, tokenizer, payload, text, capacity, with_ids, ranks), "pieces")
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = plan(counts, capacity)
    schema = "of_length long, low long, high long, bin long, each long, at long"
    # A run uses up a length or a group of bins with equal room, and makes two
    # groups at most: a few runs for each length there can be.
    runs = F.broadcast(spark.createDataFrame(runs, schema))
    ranked = _ranked(rows, max(1, sum(counts.values()) // RANKED))
    place = F.col("rank") - F.col("low")
    return (
        ranked.join(runs, (F.col("length") == F.col("of_length")) & F.col("rank").between(F.col("low"), F.col("high")))
        .withColumn("sequence_id", F.expr("bin + (rank - low) div each"))
        .withColumn("offset", F.col("at") + place % F.col("each") * F.col("length"))
        .select(*rows.columns, "sequence_id", "offset")
    )


def sequences(rows: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces that were packed with their ids; a sequence
    holds no more ids than the capacity."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return rows.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("row.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
