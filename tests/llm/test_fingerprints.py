"""Fingerprints against a plain reading of their rules."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kpiloom.llm import fingerprints
from kpiloom.llm.fingerprints import CELLS, TABLES, as_text, compared, differences, digests, sketch, with_next


def pieces(text):
    return {p for p in re.split(fingerprints.ENDS, text) if p.strip(fingerprints.SPACES)}


def like(a, b):
    a, b = pieces(a), pieces(b)
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.fixture()
def rows(prose):
    rng = random.Random(2)
    out = []
    for i in range(60):
        lines = [". ".join(prose(1000 * i + j, rng.randint(1, 12)) for j in range(rng.randint(1, 4))) + "." for _ in range(rng.randint(1, 12))]
        out.append((i * 7 % 61, "\n".join(lines)))
    long = "\n".join(prose(k, 6) for k in range(3000))
    out += [(200, long), (201, long + "\nmore"), (202, "é" * 5), (203, "𝄞𝄞a. Now 中文"), (204, None), (205, ""), (206, " \n\t\n"), (300, "one. Two\nthree")]
    random.Random(3).shuffle(out)
    return out


def wanted(rows):
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: r[0])
    for k, (i, t) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        yield i, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(like(t, edited), 12), round(like(t, after), 12)


def result(frame):
    return [(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 12), round(r.near_next, 12)) for r in compared(frame).collect()]


@pytest.mark.parametrize("part", [2048, 3])
def test_likeness_by_brute_force(documents, rows, monkeypatch, part):
    monkeypatch.setattr(fingerprints, "PART", part)
    assert Counter(result(documents(rows))) == Counter(wanted(rows))


def test_ties_nulls_and_repeated_rows(documents, monkeypatch):
    monkeypatch.setattr(fingerprints, "PART", 2)
    rows = [(None, "x\ny"), (None, "z"), (1, "a\nb"), (1, "a\nb"), (1, "a\nb"), (1, "c\nd"), (2, None), (2, None)]
    got = [tuple(r) for r in with_next(documents(rows).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))).collect()]
    assert Counter((i, t) for i, t, _ in got) == Counter((i, t or "") for i, t in rows)
    assert Counter(n for *_, n in got) == Counter(t or "" for _, t in rows)
    assert [n for i, t, n in got if t == "a\nb"].count("a\nb") == 2 and len(result(documents(rows))) == len(rows)
    assert not compared(documents([])).collect()
    ((i, n, _, edited, after),) = result(documents([(5, "ab\ncd")]))
    assert (i, n, after) == (5, 5, 1.0) and edited < 1


def test_equal_texts_have_equal_fingerprints(documents, rows):
    copies = rows + [(1000 + i, t) for i, t in rows]
    by_text, texts = {}, {}
    for r in compared(documents(copies)).collect():
        by_text.setdefault(dict(copies)[r.doc_id] or "", set()).add(r.fingerprint)
        texts.setdefault(r.fingerprint, set()).add(frozenset(pieces(dict(copies)[r.doc_id] or "")))
    assert all(len(v) == 1 for v in by_text.values()) and all(len(v) == 1 for v in texts.values())


def test_subtracted_fingerprints_give_the_differing_paragraphs(spark):
    """The text of two fingerprints is all that is needed."""
    texts = "a\nb\nc\nd\ne", "b\nx\nc\nd\ne\ny"
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(digests(F.col("t")).alias("d"))
    (d1, f1), (d2, f2) = [(set(r.d), r.f) for r in frame.select("d", as_text(sketch(F.col("d"))).alias("f")).collect()]
    signed = lambda x: int(x, 16) - (int(x, 16) >> 63 << 64)
    cells = [[[int(v.split(".")[0], 16), *map(signed, v.split(".")[1:])] if v else [0, 0, 0] for v in f.split(",")] for f in (f1, f2)]
    assert len(cells[0]) == len(cells[1]) == TABLES * CELLS
    left = [[a[0] - b[0], a[1] ^ b[1], a[2] ^ b[2]] for a, b in zip(*cells)]
    checks = {r.d: r.c for r in frame.select(F.explode("d").alias("d")).select("d", fingerprints._check(F.col("d")).alias("c")).collect()}
    only = {1: set(), -1: set()}
    while True:
        single = next(((n, d, c) for n, d, c in left if abs(n) == 1 and checks.get(d) == c), None)
        if single is None:
            break
        n, d, c = single
        only[n].add(d)
        places = [r[0] for r in spark.range(1).select(F.explode(F.array(*[fingerprints._place(F.lit(d), t, 0, CELLS) for t in range(TABLES)]))).collect()]
        for p in places:
            left[p] = [left[p][0] - n, left[p][1] ^ d, left[p][2] ^ c]
    assert not any(map(any, left)) and only == {1: d1 - d2, -1: d2 - d1}


@pytest.mark.parametrize("small", [0, 1 << 20])
def test_failures_are_tried_again_until_all_digests_are_known(spark, many_partitions, monkeypatch, small):
    monkeypatch.setattr(fingerprints, "SMALL", small)
    rng = random.Random(1)
    rows, want = [], {}
    for key in range(40):
        both = rng.sample(range(10**9), rng.randint(0, 50))
        left, right, last = (rng.sample(range(10**9, 2 * 10**9), rng.choice([0, 1, 3, 20, 200, 1500])) for _ in range(3))
        rows.append((key, both + left, right + both, last))
        if left or right:
            want[key, 0] = sorted(left), sorted(right)
        if both + left != last:
            want[key, 1] = sorted(both + left), sorted(last)
    frame = spark.createDataFrame(rows, "key long, own array<long>, a array<long>, b array<long>")
    got = {(r.key, r.k): (r.only_left, r.only_right) for r in differences(frame, "own", ["a", "b"], named=True).collect()}
    assert got == want


def test_everything_is_native(documents, rows, plan):
    text = plan(compared(documents(rows)))
    assert not re.search("Python|Pandas|Arrow", text)
