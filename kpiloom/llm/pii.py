"""Personal data: patterns propose spans, checksums confirm, context adjusts.

A proposed span gets a score: what its pattern is worth alone, more if a checksum
holds, more or less by the words next to it. The kinds ``email``, ``ip``,
``card`` and ``phone`` are kept whenever their own check holds; the others are
kept from ``THRESHOLD`` on.

Rows are independent, so the operator is one pass without a shuffle and a hot
source or a group of copies loads no single task. A null text is an empty one;
a null id is passed on; a repeated row gives its row again; only the named
columns are read, so that further columns cannot clash.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.common import slices

#: Order of kinds among spans with the same start.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
THRESHOLD = 0.6
#: Characters before and after a span in which context words count.
REACH = 40

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Digit runs are taken whole, so that a long one is read once.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: What every IBAN starts with, and characters that may belong to it.
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
_REST = re.compile(r"(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_DIGIT = re.compile("[0-9]")
_WORD = re.compile(r"[^\W\d_]+")

#: An IBAN's characters by country, as registered.
LENGTHS = {
    c: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
        27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for c in countries.split()
}
_REST_OF = {n: re.compile(rf"(?:\x20?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])") for n in set(LENGTHS.values())}

#: Context words by kind, and what speaks against any of them.
CONTEXT = {
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta", "transfer", "payment"},
    "ssn": {"ssn", "social", "security", "taxpayer", "tin"},
}
AGAINST = {"version", "isbn", "sample", "example", "order", "part", "serial"}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(code: str) -> bool:
    """The check of an IBAN without blanks."""
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches without overlap of local part, @, and domain with a dot,
    worked out from each @, as nothing else can anchor one."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > after and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            after = domain.end()
        else:
            after = at + 1
        at = text.find("@", after)


def ibans(text: str) -> list[tuple[int, int]]:
    """Spans whose checksum holds, in order and without overlap. A country's IBAN
    has its length, whatever is written after it. Of a code that is no country's,
    the whole run of groups counts, where it takes nothing from a country's."""
    spans: list[tuple[int, int]] = []
    heads = list(_IBAN.finditer(text))
    for countries in (True, False):
        first, after = [*spans, (len(text), len(text))], 0
        for m in heads:
            known = LENGTHS.get(m[0][:2])
            if (known is not None) != countries or m.start() < after:
                continue
            rest = (_REST_OF[known] if known else _REST).match(text, m.end())
            at = bisect_left(first, m.span())
            if rest and rest.end() <= first[at][0] and (not at or first[at - 1][1] <= m.start()) and mod97(text[m.start() : rest.end()].replace(" ", "")):
                after = rest.end()
                spans.append((m.start(), after))
    return sorted(spans)


def _near(text: str, start: int, end: int) -> set[str]:
    around = f"{text[max(0, start - REACH) : start]} {text[end : end + REACH]}"
    return {w.lower() for w in _WORD.findall(around)}


def _context(kind: str, text: str, start: int, end: int) -> float:
    near = _near(text, start, end)
    return 0.3 * bool(near & CONTEXT.get(kind, set())) - 0.3 * bool(near & AGAINST)


def find(text: str) -> list[tuple[int, int, str, float]]:
    """(start, rank of the kind, end, score) of every span kept, in order."""
    spans = []
    for start, end in emails(text) if "@" in text else ():
        spans.append((start, 0, end, 0.9))
    if not _DIGIT.search(text):
        return sorted(spans)
    for m in _IP.finditer(text):
        # A part of more digits than any number to 255 could need is leading zeros or too large.
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append((m.start(), 1, m.end(), 0.7))
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((m.start(), 2, m.end(), 0.9))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            spans.append((m.start(), 3, m.end(), 0.7))
    for start, end in ibans(text):
        spans.append((start, 4, end, 0.8 + _context("iban", text, start, end)))
    for m in _SSN.finditer(text):
        # Numbers that are never issued fail as a checksum would.
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            spans.append((m.start(), 5, m.end(), 0.5 + _context("ssn", text, *m.span())))
    return sorted(s for s in spans if s[1] < len(BASE_KINDS) or s[3] >= THRESHOLD)


def _scan(batches):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    for batch in slices(batches):
        found = [[{"kind": KINDS[rank], "start": start, "end": end, "score": score} for start, rank, end, score in find(t or "")] for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, and ``spans`` as an array of (kind, start, end, score): code
    points, end exclusive, in order of start and then of ``KINDS``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_scan, "doc_id long, spans array<struct<kind: string, start: long, end: long, score: double>>")


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the spans as text and the hash of the base ones."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))

    def written(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
