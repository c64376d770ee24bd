"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

The base kinds (email, ip, card, phone) stay whenever their own test passes. The added kinds need a score: a start value
for the pattern, more for a passed checksum, more or less for words within ``NEAR`` characters.
Every scan takes time in proportion to the text, also for very long runs of one character.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.common import filled, slices, strings

KINDS = ["email", "ip", "card", "phone", "iban", "ssn", "shortcard"]
BASE_KINDS = KINDS[:4]
NEAR = 40
#: Score from which an added span counts, and what a checksum and words nearby add or take.
ENOUGH, CONFIRMED, HELPED, HINDERED = 0.6, 0.4, 0.3, -0.3
SPAN = "struct<kind:string,start:int,end:int,score:double,base:boolean>"

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A number fails from its first digit exactly if it fails from a later one, so scans start at first digits only.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")


@dataclass(frozen=True)
class Hints:
    start: float
    helping: re.Pattern
    hindering: re.Pattern = re.compile(r"\b(?:isbn|order|invoice|version|serial)\b", re.I)


HINTS = {
    "iban": Hints(0.3, re.compile(r"\b(?:iban|account|bank|konto|compte)\b", re.I)),
    "ssn": Hints(0.3, re.compile(r"\b(?:ssn|social security)\b", re.I)),
    "shortcard": Hints(0.1, re.compile(r"\b(?:card|credit|amex|visa|debit)\b", re.I)),
}


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str):
    done, after_at = 0, 0  # ends of the last email and of the last @
    at = text.find("@")
    while at >= 0:
        low = max(done, after_at)
        start = at
        while start > low and text[start - 1] in _LOCAL_SIGNS:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        after_at = at + 1
        at = text.find("@", max(after_at, done))


def _base(text: str):
    if "@" in text:
        for a, b in _emails(text):
            yield "email", a, b
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        parts = (p.lstrip("0") for p in m.group().split("."))
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start():
            digits = re.sub(r"[\x20-]", "", m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield "card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGIT.findall(m.group())) <= 15:
                yield "phone", *m.span()


def _score(kind: str, text: str, start: int, end: int, confirmed: bool) -> float:
    hints = HINTS[kind]
    near = text[max(0, start - NEAR) : start] + "\n" + text[end : end + NEAR]
    return round(hints.start + CONFIRMED * confirmed + HELPED * bool(hints.helping.search(near))
                 + HINDERED * bool(hints.hindering.search(near)), 3)


def _added(text: str):
    """Proposed spans of the added kinds with their scores."""
    if not _DIGIT.search(text):
        return
    for m in _IBAN.finditer(text):
        # Capital words may follow the number: the longest end at a word's end whose checksum passes counts.
        for end in range(m.end(), m.start() + 14, -1):
            if text[end - 1] != " " and not (end < len(text) and text[end].isalnum()):
                number = text[m.start() : end].replace(" ", "")
                if 15 <= len(number) <= 34 and mod97(number):
                    yield "iban", m.start(), end, _score("iban", text, m.start(), end, True)
                    break
    for m in _SSN.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", *m.span(), _score("ssn", text, *m.span(), False)
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start() <= 29:
            digits = re.sub(r"[\x20-]", "", m.group())
            if 13 <= len(digits) <= 15 and luhn(digits):
                yield "shortcard", *m.span(), _score("shortcard", text, *m.span(), True)


def spans_of(text: str) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, score, base) by kind as listed, then start; positions are code points, ends exclusive."""
    base = [(k, a, b, 1.0, True) for k, a, b in _base(text)]
    phones = [(a, b) for k, a, b, *_ in base if k == "phone"]
    added = [(k, a, b, s, False) for k, a, b, s in _added(text) if s >= ENOUGH
             and not (k == "shortcard" and any(a < y and x < b for x, y in phones))]
    return sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1]))


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``spans``, an array of (kind, start, end, score, base), for every row.

    Null and empty texts have no spans. Whole texts are scanned. Repeated rows, null and repeated ids each give a
    row; no rows give no rows. Other columns are not carried, so their names cannot clash.
    """
    def run(batches):
        for batch in slices(batches, "text"):
            found = [[dict(zip(("kind", "start", "end", "score", "base"), s)) for s in spans_of(t)]
                     for t in strings(filled(batch.column("text")))]
            kind = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                              ("score", pa.float64()), ("base", pa.bool_())])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(kind))], ["doc_id", "spans"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, spans array<{SPAN}>")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """The columns of the op8 query, from the spans."""
    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in BASE_KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def masked(text: str) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become the first one's kind."""
    out, done = [], 0
    for kind, start, end, *_ in sorted(spans_of(text), key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def mask(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``length`` set to the new length where the text changed."""
    def run(batches):
        for batch in slices(batches, text):
            old = batch.column(text).to_pylist()
            new = [t if t is None else masked(t) for t in old]
            columns = {n: batch.column(n) for n in batch.schema.names}
            columns[text] = pa.array(new, pa.string())
            if length in columns:
                sizes = [n if a == b else len(b) for a, b, n in zip(old, new, columns[length].to_pylist())]
                columns[length] = pa.array(sizes, columns[length].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(run, docs.schema)
