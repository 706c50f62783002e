"""Operators that look at one text at a time, against plain readings of their rules."""

import functools
import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from kpiloom.llm import licenses, mixing, packing, pii, quality
from kpiloom.llm.packing import CAPACITY, Encoder, cuts, plan

ODD = [
    (1, None),
    (2, ""),
    (3, "  \n\t "),
    (4, "mail a.b@c.org, d@e.f_g@h.io; 1.2.3.4 999.1.1.1 +49 (30) 123-4567 4111 1111 1111 1111"),
    (4, "mail a.b@c.org, d@e.f_g@h.io; 1.2.3.4 999.1.1.1 +49 (30) 123-4567 4111 1111 1111 1111"),
    (None, "All rights reserved, ALL RIGHTS-reserved! CC BY-NC 4.0"),
    (6, "1.1.1.1.2.2.2.2 é@ü.de x@y.z.w K 5555-5555-5555-4444 12345678901234567890123"),
    (7, "a b c a b c a b c\na b c\n\na b c\n" + "1" * 5000),
    (8, "@" * 50 + "a" * 20000 + "." * 20000),
]


def test_spans_are_those_of_the_plain_patterns(documents):
    found = Counter()
    for r in pii.digest(pii.personal_data(documents(ODD))).collect():
        found[tuple(r)[:6]] += 1

    def digits(s):
        return re.sub("[^0-9]", "", s)

    def luhn(s):
        odd, even = s[-1::-2], s[-2::-2]
        return (sum(map(int, odd)) + sum(sum(divmod(2 * int(c), 10)) for c in even)) % 10 == 0

    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15),
    ]
    want = Counter()
    for doc_id, text in ODD[:-1]:
        spans = [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, p, ok) in enumerate(rules) for m in re.finditer(p, text or "") if ok(m[0])]
        joined = ",".join(s for *_, s in sorted(spans))
        counts = Counter(k for _, k, _ in spans)
        want[doc_id, *[counts[k] for k in range(4)], hashlib.sha256(joined.encode()).hexdigest()] += 1
    want[8, 0, 0, 0, 0, hashlib.sha256(b"").hexdigest()] += 1
    assert found == want


def test_checksums_and_context_add_spans():
    assert [s[1] for s in pii.find("IBAN DE89 3704 0044 0532 0130 00 is mine")] == [pii.KINDS.index("iban")]
    assert not pii.find("IBAN DE88 3704 0044 0532 0130 00 is not")
    assert [s[1] for s in pii.find("her social security number 219-09-9999")] == [pii.KINDS.index("ssn")]
    assert not pii.find("version 219-09-9999")


def test_ibans_end_where_their_country_says():
    def found(text):
        return [text[a:b] for a, b in pii.ibans(text)]

    spaced, plain = "DE89 3704 0044 0532 0130 00", "DE89370400440532013000"
    for iban in (spaced, plain, "GB29 NWBK 6016 1331 9268 19", "NO93 8601 1117 947", "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "BE68 5390 0754 7034", "FR14 2004 1010 0505 0001 3M02 606"):
        for after in (" BIC COBADEFFXXX", " EUR 250", " 250", ".", "", " A", " EUR", f" {plain} EUR"):
            assert found(f"AB11 {iban}{after}")[0] == iban
    assert found(f"{spaced} {plain} BIC X") == [spaced, plain]
    assert not found(f"{plain}0") and not found(f"{plain}x") and not found(f"A{plain}") and not found("DE88 3704 0044 0532 0130 00 BIC")
    other = next(c for c in (f"ZZ{k:02} 1234 5678 9012 34" for k in range(2, 99)) if pii.mod97(c.replace(" ", "")))
    assert found(other) == [other] and found(f"{other[:9]} {plain}")[-1] == plain
    assert [s[1] for s in pii.find(f"{spaced} BIC COBADEFFXXX")] == [pii.KINDS.index("iban")]


@given(st.text(alphabet="ab@._-1 +", max_size=60))
@settings(max_examples=300, deadline=None)
def test_emails_by_pattern(text):
    pattern = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
    assert list(pii.emails(text)) == [m.span() for m in re.finditer(pattern, text)]


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = list(zip(words, words[1:], words[2:]))
    count, covered, seen, dup = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered |= {i, i + 1, i + 2}
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(covered), failed


def test_measures_by_hand(documents, prose):
    rows = [*ODD, (20, prose(1, 300)), (21, (prose(2, 30) + "\n") * 10), (22, "### " * 60 + prose(3, 60))]
    got = Counter(tuple(r)[:7] for r in quality.digest(quality.verdicts(documents(rows), ["doc_id"])).collect())
    assert got == Counter((d, *measures(t)) for d, t in rows)


def test_limits_follow_the_group(documents, prose):
    # In one source a sixth of all characters are symbols throughout, in the other in one text.
    marked = [(i, " ".join(f"{w} #" for w in prose(i, 80).split()), "en", "tables") for i in range(20)]
    plain = [(100 + i, prose(i, 80), "en", None) for i in range(20)]
    odd = [(200, " ".join(f"{w} #" for w in prose(7, 80).split()), "en", None)]
    kept = {r.doc_id: r.kept for r in quality.digest(quality.verdicts(documents(marked + plain + odd), ["doc_id"])).collect()}
    assert all(kept[i] for i in range(20)) and all(kept[100 + i] for i in range(20)) and not kept[200]


def test_license_phrases_and_labels(documents, prose):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    rows = [*ODD, (30, prose(1, 200)), (31, f"{prose(2, 40)} {mit} {prose(3, 40)}"), (32, "GNU General-Public LICENSE"), (33, "all rights all rights reserved cc by cc by")]
    got = {}
    for r in licenses.digest(licenses.licences(documents(rows))).collect():
        got.setdefault(r.doc_id, []).append(tuple(r)[1:])
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    for doc_id, text in rows:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))
        places = sorted((i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split())
        labels = sorted({label for _, label in places})
        want = (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(labels))
        assert all(g[:5] == want and set(labels) <= set(g[5].split(",")) | {""} for g in got[doc_id])
    assert got[31][0][5] == "mit" and got[31][0][6] > 0.5
    assert got[30][0][5:] == ("", 0.0)


def test_an_outlier_of_each_measure_goes_from_its_group(documents, prose):
    """Usual documents have a few symbols, a repeated line and a repeated passage."""

    def usual(seed):
        lines = [prose(1000 * seed + i, 12) for i in range(20)]
        return [*lines, lines[seed % 20], " #" * (1 + seed % 4)]

    def rates(r):
        return [1000 * getattr(r, part) // getattr(r, of) for part, of in quality.RATES.values()]

    plain = [(i, "\n".join(usual(i))) for i in range(40)]
    odd = [
        (100, "\n".join(usual(100)) + " #&" * 90),
        (101, "\n".join([*usual(101), *[f"ab {k // 2}" for k in range(20)]])),
        (102, "\n".join([*usual(102), *[prose(9, 6) + f" {k}" for k in range(12)]])),
        (103, "\n".join(usual(103)).replace(" ", "x y").replace("x y", "xyzxyzxyz ")),
        (104, " ".join(f"{'abcdefghij'[k % 10]} {k % 97}" for k in range(200))),
    ]
    got = {r.row.doc_id: r for r in quality.verdicts(documents(plain + odd), ["doc_id"]).collect()}
    assert not any(r.base_failed for r in got.values())
    of = {m: got[0][f"of_{m}"] for m in quality.RATES}
    for k, m in enumerate(quality.RATES):
        assert of[m].n >= 30 and rates(got[100 + k])[k] > of[m].top
    assert {i for i, r in got.items() if not r.kept} >= {100, 101, 102, 103, 104}
    assert sum(r.kept for i, r in got.items() if i < 100) >= 36


def test_limits_differ_between_groups(spark, documents, prose):
    rows = [(1000 * g + i, " ".join(f"{w} #" if k % (10 - g) == 0 else w for k, w in enumerate(prose(i, 90).split())), "en", f"s{g}") for g in range(3) for i in range(20)]
    found = {r.source: r for r in quality.limits(quality.sketches(quality.measured(documents(rows), ["doc_id"]))).collect()}
    assert len({r.of_symbol_rate.top for r in found.values()}) == 3
    # Sketches of parts merge by adding: two halves give the limits of the whole.
    halves = [quality.sketches(quality.measured(documents(rows[k::2]), ["doc_id"])) for k in (0, 1)]
    merged = halves[0].union(halves[1]).groupBy("lang", "source", "measure", "bucket").agg(F.sum("n").alias("n"))
    assert {r.source: r for r in quality.limits(merged).collect()} == found


def license_labels(frame):
    return {r.doc_id: set(r.labels.split(",")) - {""} for r in licenses.digest(licenses.licences(frame)).collect()}


def test_a_common_licence_keeps_its_label(documents, prose):
    mit, bsd = licenses.TEMPLATES["mit"][0], licenses.TEMPLATES["bsd"][0]
    rows = [(i, f"{prose(i, 30)} {(mit, bsd, '')[i % 3]}") for i in range(30)]
    assert license_labels(documents(rows)) == {i: ({"mit"}, {"bsd"}, set())[i % 3] for i in range(30)}
    assert license_labels(documents([(1, f"{prose(1, 30)} {mit}")])) == {1: {"mit"}}


def test_each_licence_of_a_file_is_found(documents, prose):
    three = {t: licenses.TEMPLATES[t][0] for t in ("apache-2.0", "bsd", "mit")}
    words = " ".join(w for w in licenses.VOCABULARY if w not in " ".join(three.values()).split())
    rows = [(i, prose(i, 60)) for i in range(20)]
    rows += [(100, f" {prose(100, 40)} ".join(three.values())), (101, f"{words} {prose(101, 40)} {three['mit']}")]
    # Ordinary words of the template's second half, rarer than those of its first half.
    front, back = three["mit"].split()[:20], three["mit"].split()[20:]
    rows += [(102, f"{' '.join(front)} {prose(102, 40)} {' '.join(reversed(back))}"), *((200 + i, " ".join(front[:7]) + " " + prose(i, 30)) for i in range(5))]
    got = license_labels(documents(rows))
    assert got[100] == set(three) and "mit" in got[101] and "mit" in got[102]
    assert not any(got[i] for i in range(20))


def test_native_operators_run_no_python(documents, plan):
    docs = documents(ODD)
    measured = quality.measured(docs, ["doc_id"])
    frames = [licenses.licences(docs), licenses.digest(licenses.licences(docs)), measured, quality.limits(quality.sketches(measured)), quality.verdicts(docs, ["doc_id"]), mixing.mixed(docs, ["doc_id"])]
    for frame in frames:
        assert not re.search("Python|Pandas|Arrow", plan(frame))


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@given(st.lists(st.text(alphabet="ab'sé,.1 \n\t 中", max_size=40), max_size=8))
@settings(max_examples=150, deadline=None)
def test_encoder_gives_the_tokenizers_ids(texts):
    for encoder in encoders():
        assert encoder(texts) == [encoder._whole(t) for t in texts]


@functools.cache
def encoders():
    path = public_tokenizers.path("byte_bpe_50k.json")
    return Encoder(path), Encoder(path, public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_cuts_leave_the_remainder_to_the_first_piece():
    assert cuts(1) == [(0, 1)]
    assert cuts(2048) == [(0, 2048)]
    assert cuts(2049) == [(0, 1), (1, 2048)]
    assert cuts(5000) == [(0, 904), (904, 2048), (2952, 2048)]


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=20))
@settings(max_examples=300, deadline=None)
def test_plan_is_best_fit_decreasing(counts):
    left, bins = [], 0
    for length in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        room = min((r for r in left if r >= length), default=None)
        if room is None:
            left.append(40 - length)
            bins += 1
        else:
            left[left.index(room)] -= length
    filled, placed = {}, Counter()
    for length, low, high, first, each, offset in plan(counts, 40):
        placed[length] += high - low + 1
        for rank in range(low, high + 1):
            k, j = divmod(rank - low, each)
            assert filled.setdefault(first + k, 0) == offset + j * length
            filled[first + k] += length
    assert placed == Counter(counts) and len(filled) == bins and all(v <= 40 for v in filled.values())


def test_packing_round_trip(documents, prose, tokenizer):
    rows = [*ODD, *((100 + i, prose(i, 20 + 37 * i)) for i in range(40)), (300, prose(1, 4000)), *((400 + i, "same text here") for i in range(50))]
    out = packing.packed(documents(rows), public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"], with_ids=True)
    pieces = out.collect()
    texts = {}
    for p in sorted(pieces, key=lambda p: (p.row.doc_id is not None, p.row.doc_id, p.piece)):
        texts.setdefault(p.row.doc_id, []).extend(p.ids)
    for doc_id, text in rows:
        if doc_id != 4:
            assert texts[doc_id] == tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
    ends = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert ends.get(p.sequence_id, 0) == p.offset
        ends[p.sequence_id] = p.offset + p.length
    assert max(ends.values()) <= CAPACITY
    joined = {r.sequence_id: len(r.ids) for r in packing.sequences(out).collect()}
    assert joined == ends


def filled_by_hand(sizes):
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    left, open_, targets = 1.5 * sum(sizes.values()), set(sizes), {}
    while open_:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if level * weights[s] > 2 * sizes[s]}
        if not full:
            return targets | {s: level * weights[s] for s in open_}
        for s in full:
            targets[s] = 2.0 * sizes[s]
            left -= targets[s]
        open_ -= full
    return targets


def test_mix_meets_the_targets(documents, prose):
    rng = random.Random(3)
    rows = [(i, prose(i, rng.choice([3, 20, 60, 200])), "en", rng.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    rows += [(1000, None, "en", "a"), (1001, "", None, "empty"), (1002, None, "en", "null texts"), rows[0]]
    got = mixing.digest(mixing.mixed(documents(rows), ["doc_id"])).collect()
    again = mixing.digest(mixing.mixed(documents(rows).repartition(7), ["doc_id"])).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    source = {r[0]: r[3] for r in rows}
    sizes, taken, targets = Counter(), Counter(), {}
    for r in got:
        s = source[r.doc_id]
        sizes[s] += r.size
        taken[s] += r.taken
        targets[s] = r.target
        assert r.taken <= 2 * r.size
    want = filled_by_hand(dict(sizes))
    for s in sizes:
        assert targets[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6)
        assert abs(taken[s] - targets[s]) <= max(20, 0.005 * targets[s])


def test_empty_tables(documents):
    none = documents([(1, "x")]).where("doc_id = 2")
    assert pii.personal_data(none).count() == 0
    assert quality.digest(quality.verdicts(none, ["doc_id"])).count() == 0
    assert licenses.digest(licenses.licences(none)).count() == 0
    assert mixing.digest(mixing.mixed(none, ["doc_id"])).count() == 0
    assert packing.packed(none, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"]).count() == 0
