"""Operators that compare documents, lines or vectors, against brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from kpiloom.llm import lines, minhash, quality, scoring_lm, substrings, vectors
from kpiloom.llm.components import components


def reached(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    return [root(i) for i in range(n)]


def changed(text, seed, n):
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(1000)}"
    return " ".join(words)


@pytest.fixture()
def corpus(prose):
    """Copies, near copies of one text, shared passages, repeated rows, odd texts."""
    base = prose(1, 150)
    rows = [(i, prose(100 + i, 60 + i)) for i in range(30)]
    rows += [(100 + i, base) for i in range(40)]
    rows += [(200 + i, changed(base, i, 1 + i % 4)) for i in range(60)]
    rows += [(300 + i, f"{prose(500 + i, 30)}\n{prose(3, 50)}\n{prose(600 + i, 25)}") for i in range(10)]
    rows += [(400, None), (401, ""), (402, " \n\t"), (403, "one two"), (404, "One TWO"), (405, "one two three"), (406, prose(9, 6000))]
    rows += [(None, base), (None, prose(4, 80)), (410, prose(5, 80)), (410, prose(5, 80)), (411, "a " * 200), (412, "é É x " * 30)]
    line = prose(6, 20)
    rows += [(500, line), (501, changed(line, 2, 1)), (502, " ".join(line.split()[1:])), (503, line + " more"), (504, line.replace(" ", "  ")), (505, "short line"), (506, "short line")]
    return rows


def test_near_duplicates_by_brute_force(documents, corpus):
    got = Counter(tuple(r) for r in minhash.near_duplicates(documents(corpus)).collect())
    sets = []
    for _, text in corpus:
        words = (text or "").encode().lower().split()
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    n = len(corpus)
    links = [(i, j) for i in range(n) for j in range(i) if corpus[i][0] is not None and corpus[j][0] is not None and (both := len(sets[i] & sets[j])) and 100 * both >= 85 * len(sets[i] | sets[j])]
    links += [(i, j) for i in range(n) for j in range(i) if corpus[i][0] == corpus[j][0] is not None]
    root, least = reached(n, links), {}
    for i, (doc_id, _) in enumerate(corpus):
        if doc_id is not None:
            least[root[i]] = min(least.get(root[i], doc_id), doc_id)
    want = Counter()
    for i, (doc_id, _) in enumerate(corpus):
        component = None if doc_id is None else least[root[i]]
        want[doc_id, len(sets[i]), component, doc_id is None or doc_id == component] += 1
    assert got == want


def test_large_components_are_compared_in_blocks(documents, corpus, monkeypatch):
    whole = Counter(tuple(r) for r in minhash.near_duplicates(documents(corpus)).collect())
    monkeypatch.setattr(minhash, "BLOCK_DOCS", 7)
    assert Counter(tuple(r) for r in minhash.near_duplicates(documents(corpus)).collect()) == whole


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    elements = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    for shared in (100, 500, 900):
        a, b = elements[:1000], elements[1000 - shared : 2000 - shared]
        x, y = minhash.signatures([a, b])
        assert abs((x == y).mean() - shared / (2000 - shared)) < 0.13
    assert (minhash.signatures([elements[:1]])[0] >> np.uint64(56)).tolist().count(0) == 1


def test_chain_of_links_is_one_component(spark):
    pairs = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(500)] + [(7, 7), (2, 1)]
    random.Random(1).shuffle(pairs)
    got = dict(components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert got == {i: 0 for i in range(301)} | {1000 + i: 1000 for i in range(500)}


def test_passages_by_brute_force(documents, corpus):
    got = Counter(tuple(r) for r in substrings.digest(substrings.without_repeats(documents(corpus))).collect())
    texts = [(d, (t or "").encode().split()) for d, t in corpus]
    count = Counter(tuple(w[i : i + 35]) for _, w in texts for i in range(len(w) - 34))
    want = Counter()
    for doc_id, words in texts:
        gone = [False] * len(words)
        for i in range(len(words) - 34):
            if count[tuple(words[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        want[doc_id, len(words), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    assert got == want


def test_places_of_the_longest_texts():
    hashes = np.random.default_rng(3).integers(0, 2**63, (1 << 24) + 200, dtype=np.uint64)
    place, phrase = substrings.owners(hashes)
    at = np.arange(len(place))
    assert ((place >= at) & (place < at + substrings.CHOICE)).all() and len(phrase) > place[-1] > 1 << 24
    # A Spark string has less than 2**31 bytes, so fewer windows than this.
    assert quality.PLACE >= 31


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_lines_by_brute_force(documents, corpus):
    got = Counter(tuple(r) for r in lines.digest(lines.without_repeated_lines(documents(corpus), ["doc_id"])).collect())
    order = sorted({(d is not None, d, t) for d, t in corpus}, key=lambda x: (x[0], x[1] or 0))
    # Rows without an id come in the order of their hash; here no line is in two of them.
    placed = [((present, d or 0, j), tuple(s.encode().split())) for present, d, t in order for j, s in enumerate((t or "").split("\n")) if s.split()]
    first = {}
    for at, words in placed:
        first[words] = min(first.get(words, at), at)
    near = set()
    long_lines = [w for w in first if len(w) >= lines.LEAST_WORDS]
    for a in long_lines:
        if any(first[b] < first[a] and abs(len(a) - len(b)) <= 1 and edits(a, b) <= 1 for b in long_lines):
            near.add(a)
    want = Counter()
    for doc_id, text in corpus:
        rows = text.split("\n") if text is not None else []
        if text == "":
            rows = [""]
        kept = [s for j, s in enumerate(rows) if not (w := tuple(s.encode().split())) or (first[w] == (doc_id is not None, doc_id or 0, j) and w not in near)]
        want[doc_id, len(rows), len(rows) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    assert got == want
    assert near


def test_short_lines_by_brute_force(documents):
    rng = random.Random(8)
    bases = ["Copyright 2021 Foo Inc. All rights reserved", "one two", "one three", "a b c d e f g", "这是一个没有空格的句子", "ประเทศไทย", "x" * 300, "é" * 9]
    rows = []
    for base in bases * 6:
        line = list(base)
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(line))
            line[at : at + 1] = rng.choice(["", "z", "二", line[at] + "q"])
        rows.append("".join(line))
    words = "al be ga de ep ze et".split()
    rows += [" ".join(words), " ".join([*words[:3], "new", *words[3:]]), " ".join(words[1:]), "p q r s t u v w x", "p q r s t u v w", "p q r s t u v", "abcdefgh", "a b c d e f g h"]
    corpus = [(i, s) for i, s in enumerate(rows)]
    got = {r.payload.doc_id for r in lines.without_repeated_lines(documents(corpus), ["doc_id"]).where("n_removed > 0").collect()}

    def near(a, b):
        if max(len(a.split()), len(b.split())) >= 8:
            return edits(a.split(), b.split()) <= 1
        a, b = " ".join(a.split()), " ".join(b.split())
        return abs(len(a) - len(b)) <= 1 and max(len(a), len(b)) >= 8 and edits(a, b) <= 1

    want = {i for i, a in enumerate(rows) if any(a.split() == b.split() or near(a, b) for b in rows[:i]) and a.split()}
    assert got == want
    two = [(1, "Copyright 2021 Foo Inc. All rights reserved"), (2, "Copyright 2022 Foo Inc. All rights reserved"), (3, "al be ga de ep ze et"), (4, "al be ga new de ep ze et")]
    assert [r.n_removed for r in sorted(lines.without_repeated_lines(documents(two), ["doc_id"]).collect(), key=lambda r: r.payload.doc_id)] == [0, 1, 0, 1]


def test_one_edit():
    words = [b"a", b"b", b"c"]
    assert lines.one_edit(words, words) and lines.one_edit(words, [b"a", b"x", b"c"]) and lines.one_edit(words, [b"b", b"c"])
    assert not lines.one_edit(words, [b"x", b"y", b"c"]) and not lines.one_edit(words, [b"b", b"a", b"c"]) and not lines.one_edit(words, [b"a"])


@pytest.fixture()
def points():
    """Clusters, copies of one vector, a scaled copy, and vectors that can't link."""
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 16))
    near = x[0] + 0.05 * rng.standard_normal((120, 16))
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    rows += [(1000 + i, v.tolist(), 0) for i, v in enumerate(near)]
    rows += [(2000 + i, x[1].tolist(), 1) for i in range(40)] + [(2100, (x[1] * 1e30).tolist(), 1), (2101, x[1].tolist(), None), (2102, x[1].tolist(), 2)]
    rows += [(3000, None, 1), (3001, [0.0] * 16, 1), (3002, [float("nan")] * 16, 1), (3003, [None] * 16, 1), (3004, [float("inf")] * 16, 1), (3005, [], 1), (3006, [1.0, 2.0], 1), (3007, [2.0, 4.0], 1)]
    return rows + [(None, x[1].tolist(), 1), rows[5]]


@pytest.mark.parametrize("leaf", [vectors.LEAF, 24])
def test_vectors_by_brute_force(spark, points, monkeypatch, leaf):
    monkeypatch.setattr(vectors, "LEAF", leaf)
    frame = spark.createDataFrame(points, "vec_id long, embedding array<double>, label int")
    got = vectors.near_duplicates(frame).collect()
    assert len(got) == len(points)
    usable = [p for p in {(p[0], tuple(p[1] or ()), p[2]) for p in points} if p[0] is not None and p[1] and p[2] is not None and all(c is not None and math.isfinite(c) for c in p[1]) and any(p[1])]

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))

    links = [(i, j) for i, a in enumerate(usable) for j, b in enumerate(usable[:i]) if a[2] == b[2] and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= 0.98]
    degree, root, least = Counter(), reached(len(usable), links), {}
    for i, j in links:
        degree[usable[i][0]] += 1
        degree[usable[j][0]] += 1
    for i, p in enumerate(usable):
        least[root[i]] = min(least.get(root[i], p[0]), p[0])
    component = {p[0]: least[root[i]] for i, p in enumerate(usable)}
    wrong = [r for r in got if (r.n_links, r.component_id) != (degree[r.vec_id], component.get(r.vec_id, r.vec_id))]
    # The forest may part a pair; with small leaves a tenth of the links at most.
    assert len(wrong) <= (0 if leaf > 24 else 40), wrong[:5]
    assert sum(r.n_links for r in got) >= 0.9 * 2 * len(links)
    assert all(r.kept == (r.vec_id is None or r.vec_id == r.component_id) for r in got)


def test_scores_by_brute_force(documents, corpus):
    rows = corpus + [(600 + i, corpus[i][1]) for i in range(30)]
    got = scoring_lm.scores(documents(rows)).collect()
    tokens = [(d, [*(t or "").encode().lower().split(), None]) for d, t in rows]
    held = {d for d, _ in rows if d is not None and zlib.crc32(str(d).encode()) % 5 == 1}
    count = Counter(w for d, t in tokens for w in t if d not in held)
    total, distinct = sum(count.values()), len(count)
    want = defaultdict(list)
    for d, t in tokens:
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in t)
        want[d].append((d in held, len(t), sum(count[w] > 0 for w in t), total, pytest.approx(base, rel=1e-9)))
    for r in got:
        assert tuple(r)[1:6] in want[r.doc_id]
        assert r.score < 0
    assert len(got) == len(rows)


def test_held_out_texts_like_the_corpus_score_better_with_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = scoring_lm.scores(docs).where("held_out").groupBy().sum("base_score", "score").first()
    assert held[1] > held[0]


def test_filter_gives_quantised_counts():
    rng = np.random.default_rng(4)
    grams = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    counts = np.maximum(1, (rng.pareto(1, 5000) * 3).astype(np.int64))
    kinds, buckets = np.arange(5000) % 2, 7
    bucket = scoring_lm.bucket_of(grams, buckets)
    held = []
    for kind in (0, 1):
        for b in np.unique(bucket):
            mine = (kinds == kind) & (bucket == b)
            held.append((kind, int(b), scoring_lm.shard_of(kind, grams[mine], counts[mine])))
    some = scoring_lm.Shards(held, buckets, sum(len(bits) for *_, bits in held))
    for kind in (0, 1):
        mine = kinds == kind
        assert (some.levels(kind, grams[mine]) == scoring_lm.levels_of(counts[mine])).mean() > 0.99
    assert (some.levels(0, rng.integers(0, 2**63, 5000, dtype=np.uint64)) == 0).mean() > 0.99


def test_pairs_that_occur_once_are_in_the_model(documents, prose):
    rows = [(i, prose(i, 40)) for i in range(20) if zlib.crc32(str(i).encode()) % 5 != 1]
    shards, buckets = scoring_lm.filter_shards(documents(rows))
    pairs = Counter(p for _, t in rows for p in scoring_lm.pairs_of(scoring_lm.tokens(t)).tolist())
    found = shards.where("kind = 1").collect()
    assert sum(r.grams for r in found) == len(pairs) and sum(r.total for r in found) == sum(pairs.values()) and 1 in pairs.values()
    some = scoring_lm.Shards([(r.kind, r.bucket, r.bits) for r in found], buckets, sum(len(r.bits) for r in found))
    assert (some.levels(1, np.array(list(pairs), np.uint64)) >= scoring_lm.levels_of(np.array(list(pairs.values())))).all()
    # A held-out text of such pairs scores better than its words in another order.
    held = [i for i in range(100, 200) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    words = rows[0][1].split()
    got = {r.doc_id: r.score for r in scoring_lm.scores(documents([*rows, (held[0], " ".join(words)), (held[1], " ".join(words[::-1]))])).collect()}
    assert got[held[0]] > got[held[1]] + 1


def test_more_passes_give_the_same_scores(documents, corpus, monkeypatch):
    monkeypatch.setattr(scoring_lm, "BUCKET", 4000)
    one = Counter((r.doc_id, round(r.score, 9)) for r in scoring_lm.scores(documents(corpus)).collect())
    monkeypatch.setattr(scoring_lm, "PASS_BYTES", 10_000)
    assert len(scoring_lm.passes({0: 6000, 1: 6000}, 5)) == 10 and scoring_lm.passes({}, 1) == [[(0, 0, 1), (1, 0, 1)]]
    more = Counter((r.doc_id, round(r.score, 9)) for r in scoring_lm.scores(documents(corpus)).collect())
    assert one == more


def test_empty_tables(spark, documents):
    none = documents([(1, "x")]).where("doc_id = 2")
    assert minhash.near_duplicates(none).count() == 0
    assert substrings.without_repeats(none).count() == 0
    assert lines.without_repeated_lines(none, ["doc_id"]).count() == 0
    assert scoring_lm.scores(none).count() == 0
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
