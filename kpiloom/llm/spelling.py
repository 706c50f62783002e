"""Spelling variants found by k-d trees over letter counts.

A word becomes a point: how often it holds each letter. One replaced letter takes
one from a letter's count and adds one to another's, an inserted letter adds one,
so near words lie at an L1 distance of two at most, and of exactly two or one by
whether their lengths are equal or one apart. For each pair of lengths, the tree
of the one is asked for what lies near the words of the other: a box of which the
counts cannot be reached by one letter less and one more is left out. What a
search returns is verified on the order of the letters.

A length's tree is fitted to about ``SAMPLE`` of its words, with leaves for about
``LEAF`` of all of them each, as far as the sample allows. Its leaves deal all
words of that length to tasks: a word is at home in one leaf and asks all leaves
whose boxes it can reach. A leaf of more than ``BLOCK`` words, such as one of
anagrams, is cut into blocks which are asked one by one. Within a block the tree
goes on down to a few words. So every pair of near words is found once, and no
task holds more than a block at a time.

Counts are taken over whole texts of all documents. A null text has no words. A
document without an id counts like one with an empty id; a repeated row counts
again; an empty table gives no rows; further columns are not read. Words of any
length are compared.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import slices, stored
from kpiloom.llm.minhash import groups

#: Words have this many letters and occurrences or more.
LEAST_LETTERS, LEAST_COUNT = 6, 5
#: A word's form occurs at least this many times as often.
FORM = 5
#: Of a document's runs, one in this many loses a letter.
ERRORS = 199
RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: Letters of the tree's dimensions: a-z, and À-ÿ.
FIRST, LETTERS = (ord("a"), 0xC0), 26 + 64
#: Words to which a length's tree is fitted, and the words of a leaf, about.
SAMPLE, LEAF = 8192, 2048
#: Leaves that a length's tree can have, and words of a block and of a box in it.
LEAVES, BLOCK, BOX = 1024, 4096, 128
#: Different words that a task counts before it hands them on.
COUNTED = 200_000
#: Pairs of words compared at a time, and the count up to which letters are told apart.
COMPARED, COUNTS = 1 << 19, 6


def runs(doc_id: str, text: str | None) -> Counter:
    """How often each word of at least ``LEAST_LETTERS`` letters comes from the text."""
    if not text:
        return Counter()
    # bytes.lower() knows A-Z only.
    lower = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    out: Counter = Counter()
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in Counter(RUN.findall(lower)).items():
        if len(run) < LEAST_LETTERS:
            continue
        h = zlib.crc32(run.encode(), start)
        if h % ERRORS == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST_LETTERS:
                continue
        out[run] += n
    return out


def _counted(batches):
    """Counts of words over the documents of a task, in parts of bounded size."""
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in slices(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            held.update(runs("" if doc_id is None else str(doc_id), text))
            if len(held) >= COUNTED:
                yield out()
                held.clear()
    yield out()


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of words that occur often enough."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    parts = rows.mapInArrow(_counted, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def points(found: list[str]) -> np.ndarray:
    """Letter counts, a row per word."""
    out = np.zeros((len(found), LETTERS), np.int32)
    codes = np.frombuffer("".join(found).encode("utf-32-le"), np.uint32).astype(np.int64)
    place = np.where(codes < FIRST[1], codes - FIRST[0], codes - FIRST[1] + 26)
    np.add.at(out, (np.repeat(np.arange(len(found)), [len(w) for w in found]), place), 1)
    return out


def split(x: np.ndarray) -> tuple[int, int] | None:
    """The letter, and the greatest count of the lower side, that part the points
    most evenly; none if they are all the same."""
    best = None
    for letter in np.argsort(-x.var(axis=0), kind="stable")[:4].tolist():
        column = x[:, letter]
        if column.min() == column.max():
            continue
        values, counts = np.unique(column, return_counts=True)
        below = np.cumsum(counts)[:-1]
        k = int(np.argmin(np.abs(2 * below - len(x))))
        uneven = abs(2 * int(below[k]) - len(x))
        if best is None or uneven < best[0]:
            best = uneven, letter, int(values[k])
    return best and best[1:]


def fit(x: np.ndarray, least: int, most: int) -> list[tuple[int, int, int, int]]:
    """A tree as a list of nodes (letter, cut, lower, upper): counts up to the cut
    go to node ``lower``, others to ``upper``; a leaf has letter -1. Parts of more
    than ``least`` points are split, the largest first, up to ``most`` leaves."""
    nodes = [(-1, 0, -1, -1)]
    parts, leaves = {0: np.arange(len(x))}, 1
    while leaves < most and parts:
        node = max(parts, key=lambda k: len(parts[k]))
        part = parts.pop(node)
        if len(part) <= least:
            break
        found = split(x[part])
        if found is None:
            continue
        letter, cut = found
        down = x[part, letter] <= cut
        nodes[node] = letter, cut, len(nodes), len(nodes) + 1
        parts[len(nodes)], parts[len(nodes) + 1] = part[down], part[~down]
        nodes += [(-1, 0, -1, -1)] * 2
        leaves += 1
    return nodes


def reached(nodes: list[tuple[int, int, int, int]], x: np.ndarray, less: int, more: int):
    """(leaf, points) of the leaves whose boxes a point can reach by taking away
    at most ``less`` letters and adding at most ``more``; with none of either, the
    leaf that holds it."""
    todo = [(0, np.arange(len(x)), np.zeros(len(x), np.int32), np.zeros(len(x), np.int32), {})]
    while todo:
        node, at, taken, added, box = todo.pop()
        letter, cut, lower, upper = nodes[node]
        if letter < 0:
            yield node, at
            continue
        low, high = box.get(letter, (0, 1 << 30))
        v = x[at, letter]
        # What the letter cost so far, which the narrower box replaces.
        before_taken, before_added = np.maximum(v - high, 0), np.maximum(low - v, 0)
        for child, lo, hi in ((lower, low, cut), (upper, cut + 1, high)):
            t, a = taken - before_taken + np.maximum(v - hi, 0), added - before_added + np.maximum(lo - v, 0)
            ok = (t <= less) & (a <= more)
            if ok.any():
                todo.append((child, at[ok], t[ok], a[ok], {**box, letter: (lo, hi)}))


def one_letter(a: str, b: str) -> bool:
    """Whether exactly one letter is replaced in ``a``, or added to it, to give ``b``."""
    if a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def _trees(table: pa.Table) -> pa.Table:
    found, words = table.column("word").to_pylist(), table.column("words")[0].as_py()
    leaves = min(LEAVES, -(-words // LEAF))
    nodes = fit(points(found), -(-len(found) // leaves), leaves)
    flat = [v for node in nodes for v in node]
    return pa.table({"length": table.column("length")[:1], "tree": pa.array([flat], pa.list_(pa.int32()))})


def _nodes(flat: list[int]) -> list[tuple[int, int, int, int]]:
    return list(zip(*[iter(flat)] * 4))


def _dealt(batches):
    """Each word under its home leaf or, as a question, under all that it reaches."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths, asks = batch.column("length").to_numpy(), batch.column("asks").to_numpy()
        take, leaf = [], []
        for length, ask in {(int(a), int(b)) for a, b in zip(lengths, asks)}:
            rows = np.flatnonzero((lengths == length) & (asks == ask))
            nodes = _nodes(batch.column("tree")[int(rows[0])].as_py())
            x = points(batch.column("word").take(pa.array(rows)).to_pylist())
            # asks is 0 at home, 1 for the same length and 2 for one letter more.
            for node, at in reached(nodes, x, int(ask == 1), int(ask > 0)):
                take.append(rows[at])
                leaf.append(np.full(len(at), node, np.int32))
        rows = pa.array(np.concatenate(take))
        yield pa.RecordBatch.from_arrays([*[batch.column(c).take(rows) for c in ("length", "word", "asks")], pa.array(np.concatenate(leaf))], ["length", "word", "asks", "leaf"])


def steps(x: np.ndarray) -> np.ndarray:
    """Counts as zeros and ones: a column for each letter having at least 1, 2, ...
    up to ``COUNTS``. The inner product of two rows is what both words have, letter
    by letter, so it gives their L1 distance; letters beyond count as if gone from
    both, which brings no pair further apart."""
    return (x[:, :, None] > np.arange(COUNTS)).reshape(len(x), -1).astype(np.float32)


def search(home: list[str], asked: list[tuple[str, int]]):
    """Pairs (question, word at home) one letter apart, by the tree of the home words."""
    x = points(home)
    nodes = fit(x, BOX, len(home))
    boxes = {node: at for node, at in reached(nodes, x, 0, 0)}
    used = steps(x).any(axis=0)
    x = steps(x)[:, used]
    x_sum = x.sum(axis=1)
    for kind in (1, 2):
        mine = [w for w, k in asked if k == kind]
        if not mine:
            continue
        y = points(mine)
        unary = steps(y)
        # Letters that no word at home has count in the sum alone.
        y_sum, unary = unary.sum(axis=1), unary[:, used]
        for node, at in reached(nodes, y, int(kind == 1), 1):
            near = boxes.get(node, ())
            if not len(near):
                continue
            step = max(1, COMPARED // len(near))
            for s in range(0, len(at), step):
                part = at[s : s + step]
                apart = y_sum[part][:, None] + x_sum[near] - 2 * (unary[part] @ x[near].T)
                for i, j in zip(*(v.tolist() for v in np.nonzero(apart <= (2 if kind == 1 else 1)))):
                    a, b = mine[part[i]], home[near[j]]
                    if one_letter(a, b):
                        yield a, b


def _searched(batches):
    """Near pairs of a block: (word, other), in both directions where the lengths differ."""
    for table in groups(batches, ("length", "leaf", "block")):
        found, asks = table.column("word").to_pylist(), table.column("asks").to_pylist()
        home = [w for w, k in zip(found, asks) if k == 0]
        if not home:
            continue
        a, b = [], []
        for word, other in search(home, [(w, k) for w, k in zip(found, asks) if k]):
            a.append(word)
            b.append(other)
            if len(word) != len(other):
                a.append(other)
                b.append(word)
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], ["word", "other"])


def near_words(found: DataFrame) -> DataFrame:
    """(word, other) of all words one letter apart, both ways; ``found`` has
    different words in the column ``word``."""
    sized = found.select("word", F.length("word").alias("length"))
    counts = sized.groupBy("length").agg(F.count("*").alias("words"))
    chance = F.pmod(F.xxhash64("word", F.lit(3)), F.lit(1 << 20)) / (1 << 20)
    sample = sized.join(counts, "length").where(chance * F.col("words") < SAMPLE).select("length", "word", "words")
    trees = stored(sample.groupBy("length").applyInArrow(_trees, "length int, tree array<int>"), "letter-trees")

    # At home; asking the own length; asking the next one.
    kinds = F.explode(F.array(*[F.struct((F.col("length") + step).alias("length"), F.lit(k).alias("asks")) for k, step in enumerate((0, 0, 1))]))
    asked = sized.select("word", kinds.alias("k")).select("word", "k.length", "k.asks")
    dealt = asked.join(trees, "length").mapInArrow(_dealt, "length int, word string, asks int, leaf int")
    dealt = stored(dealt, "letter-leaves")
    leaves = dealt.groupBy("length", "leaf").agg(F.ceil(F.sum((F.col("asks") == 0).cast("int")) / BLOCK).cast("int").alias("blocks")).where("blocks > 0")
    own = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    blocks = F.explode(F.when(F.col("asks") == 0, F.array(own)).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))).alias("block")
    keys = ["length", "leaf", "block"]
    blocked = dealt.join(leaves, ["length", "leaf"]).select("length", "leaf", blocks, "word", "asks")
    return blocked.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_searched, "word string, other string")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) by following (word, form) to the end: each step doubles the
    way that is known. A form occurs more often than its word, so ways end."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = stored(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if longer.where("moved").isEmpty():
            return longer.drop("moved")
        now = longer.drop("moved")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    found = stored(words(docs, doc_id, text), "words")
    near = stored(near_words(found), "near-words")
    other = found.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    first = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("form")))
    best = near.join(other, "other").groupBy("word").agg(F.count("*").alias("n_near"), first.alias("first"))
    rows = found.join(best, "word", "left")
    much = -F.col("first.minus") >= FORM * F.col("n")
    rows = stored(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(much, F.col("first.form")).alias("form"), F.when(much, -F.col("first.minus")).alias("form_n")), "word-forms")
    ends = roots(rows.where("form is not null"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
