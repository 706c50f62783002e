"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kpiloom.llm import spelling


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def wanted(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    out, form = {}, {}
    for w in words:
        mine = sorted((-words[v], v) for v in words if near(w, v))
        out[w] = len(mine)
        if mine and -mine[0][0] >= 5 * words[w]:
            form[w] = mine[0][1]
    result = set()
    for w in words:
        root = w
        while root in form:
            root = form[root]
        result.add((w, form.get(w), root, words[w], out[w], words.get(form.get(w))))
    return result


@pytest.fixture()
def rows(prose):
    rng = random.Random(4)
    letters = "abcdeéÉß÷"
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 9))) for _ in range(60)]
    for w in words[:]:
        for _ in range(4):
            i, kind = rng.randrange(len(w)), rng.randrange(3)
            words.append(w[:i] + ("" if kind == 0 else rng.choice(letters)) + w[i + (kind < 2) :])
    words += ["abcdef", "abcdfe", "fedcba", "abcdeg", "xabcdef", "abcdefg", "ab" * 300, "ab" * 299 + "a"]
    weighted = [w for w in words for _ in range(rng.choice([1, 5, 6, 30, 160]))]
    rng.shuffle(weighted)
    out = [(i, " ".join(weighted[i::40])) for i in range(40)]
    # A chain of forms: each five times as frequent as the one before.
    out.append((100, " ".join(w for w, n in (("chainaa", 5), ("chainab", 25), ("chainbb", 125), ("chaincb", 700)) for _ in range(n))))
    out += [(101, None), (102, ""), (None, "Nothing-nothing " * 9), (103, "TIEDAA tiedab tiedac " * 5 + "tiedad " * 5), (104, prose(1, 4000))]
    return [*out, out[0], out[0]]


def test_variants_by_brute_force(spark, documents, rows):
    got = [tuple(r) for r in spelling.variants(documents(rows)).collect()]
    assert len(got) == len(set(got)) and set(got) == wanted(rows)


def test_small_leaves_and_blocks_give_the_same(spark, documents, rows, monkeypatch, many_partitions):
    for name, value in {"SAMPLE": 40, "LEAF": 3, "BLOCK": 7, "BOX": 2, "COUNTED": 50, "COMPARED": 5, "COUNTS": 1}.items():
        monkeypatch.setattr(spelling, name, value)
    assert {tuple(r) for r in spelling.variants(documents(rows)).collect()} == wanted(rows)


def test_empty_table(documents):
    assert not spelling.variants(documents([])).collect()
    assert not spelling.variants(documents([(1, "few words, each once")])).collect()


@given(st.lists(st.text(alphabet="abcé", min_size=3, max_size=6), max_size=60, unique=True))
@settings(max_examples=150, deadline=None)
def test_search_finds_every_near_word_once(words):
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    found = Counter()
    for n, home in by_length.items():
        found.update(spelling.search(home, [(w, 1) for w in home] + [(w, 2) for w in by_length.get(n - 1, [])]))
    assert found == Counter((a, b) for a in words for b in words if near(a, b) and len(a) <= len(b))


def test_boxes_hold_their_words_and_prune():
    rng = np.random.default_rng(1)
    words = sorted({"".join(chr(97 + c) for c in rng.integers(0, 20, 8)) for _ in range(3000)})
    x = spelling.points(words)
    assert (x.sum(axis=1) == 8).all()
    nodes = spelling.fit(x, 64, 1024)
    home = list(spelling.reached(nodes, x, 0, 0))
    assert sorted(np.concatenate([at for _, at in home]).tolist()) == list(range(len(words)))
    assert max(len(at) for _, at in home) <= 64
    asked = sum(len(at) for _, at in spelling.reached(nodes, x, 1, 1))
    assert asked < len(words) * len(home) / 3
