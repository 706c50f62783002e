"""Line dedup by a deletion-neighbourhood join.

A line goes if an earlier one, in the order of (doc_id, line number), is the
same or near. Of two lines of which the longer has ``LEAST_WORDS`` words or more,
near means one word added, taken away or replaced. One word is too much of two
shorter lines, which may also be of a script without blanks: for them it is one
character, blanks between words counted as one, if the longer has
``LEAST_CHARS`` characters or more. So an edit is an eighth of the longer line
at most, and shorter lines go only if an earlier one is the same.

A line is a sequence of words or of characters or, where it may be near lines of
either kind, both. Two sequences are one edit apart if they are equal once one
item is deleted from one of them, or from both at the same place. So each gives
the hashes of all its deletions of one item and of itself, and equal hashes are
joined. Before that, two filters that lose nothing: an edit leaves the first or
the last ``EDGE`` words, or half of the characters, as they are, and all but one
of a sequence's ``BLOCKS`` parts; only lines that share these with another line
give deletions.

Each hash keeps its earliest line only, a minimum combined before the shuffle,
so a hash of any number of lines costs a row per line. The earliest neighbour is
confirmed on the words themselves.

A null text has no lines; blank lines are kept; a row without an id comes before
all others, and rows without one, or with the same one, are told apart by their
text; a repeated row counts once and gets its twin's result. Further columns
are passed on but not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import BASE, beside, hashes_of, mixed, narrow, ragged, slices, stored

LEAST_WORDS = 8
LEAST_CHARS = 8
#: Words at either end, one of which an edit leaves alone.
EDGE = LEAST_WORDS // 2
#: Parts of a line, all but one of which an edit leaves alone.
BLOCKS = 4
#: Columns of a line's edges: of its words, and of its characters' halves.
EDGES = ("head", "tail", "half", "half2", "less", "less2")
_M = 2**64
#: Sets hashes of characters apart from those of words.
_CHARS = np.uint64(0x8E9D5A3B17C604F1)
_INVERSE = pow(BASE, -1, _M)


def _powers(n: int, base: int = BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(4096), _powers(4096, _INVERSE)


def _ups(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _UP, _DOWN
    if n > len(_UP):
        _UP, _DOWN = _powers(2 * n), _powers(2 * n, _INVERSE)
    return _UP, _DOWN


class Rolling:
    """Hashes of parts of a line: the sum of word times power over the part,
    moved to the power 0."""

    def __init__(self, hashes: np.ndarray):
        self.n = len(hashes)
        self.up, self.down = _ups(self.n + 2)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * self.up[: self.n], dtype=np.uint64)])

    def part(self, start: int, end: int) -> np.ndarray:
        return (self.sums[end : end + 1] - self.sums[start : start + 1]) * self.down[start : start + 1]

    def deletions(self) -> np.ndarray:
        """The hash of the line without its word i, for each i."""
        after = (self.sums[-1] - self.sums[1:]) * self.down[1]
        return self.sums[:-1] + after


def _key(values: np.ndarray, salt: int) -> np.ndarray:
    return mixed(values ^ np.uint64(salt * 0x9E3779B97F4A7C15 % _M))


def block_keys(items: list[bytes] | str) -> tuple[list[int], list[int]]:
    """Keys of which two sequences one edit apart share at least one: the sequence
    without one of its parts, by the parts of its own length and, for an item that
    will be deleted, by those of the shorter sequence."""
    n, out = len(items), ([], [])
    for keys, length in zip(out, (n, n - 1)):
        for part in range(BLOCKS):
            start, end = length * part // BLOCKS, length * (part + 1) // BLOCKS + n - length
            left, right = items[:start], items[end:]
            if isinstance(items, str):
                kept = f"{left}\n{right}".encode("utf-8", "surrogatepass")
            else:
                kept = b" ".join(left) + b"\n" + b" ".join(right)
            keys.append(_long(xxhash.xxh3_64_intdigest(kept, 2 * (BLOCKS * length + part) + isinstance(items, str))))
    return out


def deletion_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of the line's deletions with their places, for replaced words."""
    out = Rolling(hashes).deletions()
    return mixed(out + mixed(np.arange(len(out), dtype=np.uint64)))


def shorter_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of the line's deletions wherever the word was, one each."""
    return np.unique(_key(Rolling(hashes).deletions(), 3))


def whole_key(hashes: np.ndarray) -> np.ndarray:
    return _key(Rolling(hashes).part(0, len(hashes)), 3)


def one_edit(a: list[bytes] | str, b: list[bytes] | str) -> bool:
    """Whether the sequences are at most one item's edit apart."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def line_words(text: str | None) -> list[list[bytes]]:
    return [s.split() for s in text.encode("utf-8", "surrogatepass").split(b"\n")] if text else []


def chars_of(words: list[bytes]) -> str:
    return b" ".join(words).decode("utf-8", "surrogatepass")


def item_hashes(items: list[bytes] | str) -> np.ndarray:
    """Hashes of words, or of characters."""
    if not isinstance(items, str):
        return hashes_of(items)
    codes = np.frombuffer(items.encode("utf-32-le", "surrogatepass"), "<u4")
    return mixed(codes.astype(np.uint64) + _CHARS)


def sequences(words: list[bytes]) -> list[tuple[list[bytes] | str, int]]:
    """The line as words, as characters or both, with the least length of the
    longer of two near ones; the shorter may have one item less."""
    out = [(words, LEAST_WORDS)] if len(words) >= LEAST_WORDS - 1 else []
    if len(words) < LEAST_WORDS and len(chars := chars_of(words)) >= LEAST_CHARS - 1:
        out.append((chars, LEAST_CHARS))
    return out


def near(a: list[bytes], b: list[bytes]) -> bool:
    """Whether lines of these words are one edit apart, in words or characters."""
    if max(len(a), len(b)) >= LEAST_WORDS:
        return one_edit(a, b)
    a, b = chars_of(a), chars_of(b)
    return max(len(a), len(b)) >= LEAST_CHARS and one_edit(a, b)


def _edges(words: list[bytes]) -> list[int | None]:
    """Hashes of which near lines share one: of the first and last words, and of
    the halves of the characters, by their number and by that of a shorter line."""
    out: list[int | None] = [None] * len(EDGES)
    for items, least in sequences(words):
        if items is words:
            out[:2] = [_long(xxhash.xxh3_64_intdigest(b" ".join(w), seed)) for seed, w in enumerate((words[:EDGE], words[-EDGE:]))]
            continue
        n = len(items)
        for i, k in enumerate((n, n - 1)):
            if k >= least - 1:
                halves = items[: k // 2], items[n - (k - k // 2) :]
                out[2 + 2 * i : 4 + 2 * i] = [_long(xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"), 2 * k + side)) for side, w in enumerate(halves)]
    return out


def _long(value: int) -> int:
    return value - _M if value >> 63 else value


def _lines(batches):
    """A row per line that has words: where it is, its two hashes and its edges'."""
    for batch in slices(batches):
        rows = []
        for i, text in enumerate(batch.column("text").to_pylist()):
            for j, words in enumerate(line_words(text)):
                if words:
                    whole = xxhash.xxh3_128_intdigest(b" ".join(words))
                    rows.append((i, j, _long(whole >> 64), _long(whole % _M), *_edges(words)))
        at, number, *cols = zip(*rows) if rows else [()] * (4 + len(EDGES))
        at = pa.array(at, pa.int64())
        arrays = [batch.column("doc_id").take(at), batch.column("row").take(at), pa.array(number, pa.int32()), *[pa.array(c, pa.int64()) for c in cols]]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "row", "number", "line", "line2", *EDGES])


def _wanted(batches):
    """The wanted lines of a document, with the keys of their parts."""
    for batch in slices(batches):
        line, rank, found, own, less = [], [], [], [], []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            lines = text.encode("utf-8", "surrogatepass").split(b"\n")
            for x in wanted:
                words = lines[x["rank"]["number"]].split()
                keys = [block_keys(items) for items, _ in sequences(words)]
                line.append(x["line"])
                rank.append(x["rank"])
                found.append(b" ".join(words))
                own.append([k for mine, _ in keys for k in mine])
                less.append([k for _, shorter in keys for k in shorter])
        long = pa.list_(pa.int64())
        arrays = [pa.array(line, _LINE), pa.array(rank, _RANK), pa.array(found, pa.binary()), pa.array(own, long), pa.array(less, long)]
        yield pa.RecordBatch.from_arrays(arrays, ["line", "rank", "words", "own", "less"])


def _keys(batches):
    """A row per key of a line: its kind, and the line's hashes and rank."""
    for batch in slices(batches):
        kinds, keys, at = [], [], []
        may = [batch.column(c).to_pylist() for c in ("same", "longer", "shorter")]
        for i, (words, same, longer, shorter) in enumerate(zip(batch.column("words").to_pylist(), *may)):
            for items, least in sequences(words.split(b" ")):
                hashes, parts = item_hashes(items), []
                if shorter:
                    parts.append((SHORTER, whole_key(hashes)))
                if same and len(items) >= least:
                    parts.append((SAME, deletion_keys(hashes)))
                if longer and len(items) >= least:
                    parts.append((LONGER, shorter_keys(hashes)))
                for kind, part in parts:
                    kinds.append(np.full(len(part), kind, np.int32))
                    keys.append(part)
                    at.append(np.full(len(part), i))
        if keys:
            at = pa.array(np.concatenate(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(kinds)), pa.array(np.concatenate(keys).view(np.int64)), batch.column("line").take(at), batch.column("rank").take(at)],
                ["kind", "key", "line", "rank"],
            )


#: Kinds of keys: deletions with their place, deletions, the whole line.
SAME, LONGER, SHORTER = range(3)
#: The order of lines: documents without an id first, then by id, line and text's hash.
_RANK = pa.struct([("doc_id", pa.int64()), ("number", pa.int32()), ("row", pa.int64())])
_RANK_SQL = "struct<doc_id: long, number: int, row: long>"
#: Both halves of a line's hash.
_LINE = pa.struct([("h", pa.int64()), ("h2", pa.int64())])
_LINE_SQL = "struct<h: long, h2: long>"


def _confirmed(batches):
    for batch in slices(batches):
        ok = [near(a.split(b" "), b.split(b" ")) for a, b in zip(batch.column("words").to_pylist(), batch.column("other").to_pylist())]
        yield batch.select(["line"]).filter(pa.array(ok, pa.bool_()))


def _rewritten(batches):
    for batch in slices(batches):
        texts, counts, gone = [], [], []
        for text, drop in zip(batch.column("text").to_pylist(), batch.column("drop").to_pylist()):
            drop = set(drop or ())
            lines = text.split("\n") if text is not None else []
            counts.append(len(lines))
            gone.append(len(drop))
            texts.append("\n".join(s for i, s in enumerate(lines) if i not in drop) if drop else text)
        yield pa.RecordBatch.from_arrays(
            [batch.column("payload"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())],
            ["payload", "n_lines", "n_removed", "kept_text"],
        )


def removed_lines(docs: DataFrame) -> DataFrame:
    """(row, number) of the lines that go; ``docs`` has doc_id, row and text."""
    every = stored(docs.select("doc_id", "row", "text").mapInArrow(_lines, f"doc_id long, row long, number int, line long, line2 long, {', '.join(f'{e} long' for e in EDGES)}"), "lines")
    rank = F.struct("doc_id", "number", "row")
    # Equal lines have equal edges, so any of them will do.
    first = every.groupBy("line", "line2").agg(F.min(F.struct("doc_id", "number", "row", *EDGES)).alias("f"))
    first = stored(first.select("line", "line2", F.struct("f.doc_id", "f.number", "f.row").alias("rank"), *[f"f.{e}" for e in EDGES]), "first-lines")

    first = first.withColumn("line", F.struct(F.col("line").alias("h"), F.col("line2").alias("h2"))).drop("line2")
    ends = first.select("line", F.explode(F.array_compact(F.array(*EDGES))).alias("edge"))
    shared = ends.groupBy("edge").agg(F.min("line.h").alias("least"), F.max("line.h").alias("most")).where("least != most").select("edge")
    live = ends.join(shared, "edge").select("line").distinct()
    wanted = first.select("line", "rank").join(live, "line").select(F.col("rank.row").alias("row"), F.struct("line", "rank").alias("w"))
    wanted = wanted.groupBy("row").agg(F.collect_list("w").alias("wanted"))
    near = beside(docs.select("row", "text"), wanted, "wanted")
    near = stored(near.mapInArrow(_wanted, f"line {_LINE_SQL}, rank {_RANK_SQL}, words binary, own array<long>, less array<long>"), "near-lines")
    near = near.join(_alike(near), "line").select("line", "rank", "words", "same", "longer", "shorter")

    # Replaced words: deletions at the same place. Added words: a deletion of
    # the longer line is the shorter line. A key's earliest line of either kind:
    keys = stored(near.mapInArrow(_keys, f"kind int, key long, line {_LINE_SQL}, rank {_RANK_SQL}"), "line-keys")
    keys = keys.withColumn("space", F.col("kind") == SAME)
    # Most keys have one line only and go no further.
    shared = keys.groupBy("space", "key").agg(F.min("line.h").alias("least"), F.max("line.h").alias("most")).where("least != most")
    keys = keys.join(narrow(shared.select("space", "key"), "shared-keys"), ["space", "key"])
    at = F.struct("rank", "line")
    least = keys.groupBy("space", "key").agg(F.min(F.when(F.col("kind") != SHORTER, at)).alias("long"), F.min(F.when(F.col("kind") != LONGER, at)).alias("short"))
    other = F.when(F.col("kind") == SHORTER, F.col("long")).otherwise(F.col("short"))
    found = keys.join(least, ["space", "key"]).select("line", "rank", other.alias("earliest")).where(F.col("earliest.rank") < F.col("rank"))
    found = found.groupBy("line").agg(F.min("earliest").alias("earliest"))
    words = near.select("line", "words").distinct()
    pairs = found.join(words, "line").join(words.toDF("of", "other"), F.col("earliest.line") == F.col("of")).select("line", "words", "other")
    near_dups = pairs.mapInArrow(_confirmed, f"line {_LINE_SQL}").distinct()

    decided = first.select("line", F.col("rank").alias("first_rank")).join(near_dups.withColumn("near", F.lit(True)), "line", "left")
    decided = decided.select(F.col("line.h").alias("line"), F.col("line.h2").alias("line2"), "first_rank", "near")
    marked = every.drop(*EDGES).join(decided, ["line", "line2"])
    return marked.where(F.coalesce("near", F.lit(False)) | (rank != F.col("first_rank"))).select("row", "number")


def _alike(near: DataFrame) -> DataFrame:
    """The lines that share a part's key with another, and how: ``same`` as one of
    their own length, ``longer`` or ``shorter`` than it by one."""
    sides = [F.explode(side).alias("block") for side in ("own", "less")]
    own, less = (near.select("line", side, F.lit(mine).alias("mine")) for side, mine in zip(sides, (True, False)))
    blocks = own.union(less)
    mine = F.when(F.col("mine"), F.col("line.h"))
    of = blocks.groupBy("block").agg(F.min(mine).alias("least"), F.max(mine).alias("most"), F.bool_or(~F.col("mine")).alias("has_less"))
    of = of.where("least != most or (least is not null and has_less)")
    met = blocks.join(of, "block").groupBy("line")
    found = met.agg(
        F.bool_or(F.col("mine") & (F.col("least") != F.col("most"))).alias("same"),
        F.bool_or(~F.col("mine")).alias("longer"),
        F.bool_or(F.col("mine") & F.col("has_less")).alias("shorter"),
    )
    return found.where("same or longer or shorter")


def without_repeated_lines(docs: DataFrame, payload: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row the payload columns as ``payload``, n_lines, n_removed and kept_text."""
    rows = docs.select(F.struct(*payload).alias("payload"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))
    gone = removed_lines(rows).groupBy("row").agg(F.collect_set("number").alias("drop"))
    kind = rows.schema["payload"].dataType.simpleString()
    marked = beside(rows.select("payload", "row", "text"), gone, "drop", "left")
    return marked.mapInArrow(_rewritten, f"payload {kind}, n_lines long, n_removed long, kept_text string")


def digest(rows: DataFrame) -> DataFrame:
    return rows.select("payload.doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))
