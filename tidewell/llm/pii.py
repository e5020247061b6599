"""PII spans: regular expressions propose, checksums confirm, nearby words adjust the score."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

# The patterns of the base kinds are fixed values. Look-behinds and possessive loops only spare
# the scanner starts that can't match, so that long runs cost linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
#: Words near a span that raise or lower its score.
CONTEXT = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "credit", "payment", "mastercard", "debit", "carte", "karte", "tarjeta"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "contact"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security", "number", "taxpayer"),
}
AGAINST = ("version", "example", "isbn", "order", "invoice", "sku", "build", "release")
#: Score of a bare span, and the least that a span which isn't of a base kind needs.
START = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "ssn": 0.4}
LEAST = 0.5
#: Characters looked at on either side.
WINDOW = 48
_DIGITS = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    double = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    return sum(double[int(c)] if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def mod97(iban: str) -> bool:
    text = iban.replace(" ", "")
    rest = 0
    for c in text[4:] + text[:4]:
        rest = (rest * (10 if c.isdigit() else 100) + int(c, 36)) % 97
    return rest == 1 and 15 <= len(text) <= 34


def _emails(text: str):
    at, end = text.find("@"), 0
    while at >= 0:
        if at >= end:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (found := _DOMAIN.match(text, at + 1)):
                end = found.end()
                yield start, end
            else:
                end = max(end, at)
        at = text.find("@", at + 1)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and part <= "255"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the four base kinds, by kind, then start."""
    out = [(0, *x) for x in _emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := _DIGITS.sub("", m[0])) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_DIGITS.sub("", m[0])) <= 15]
    return out


def _iban_end(found: str, start: int) -> int | None:
    """Where the number ends: the longest beginning, cut at a space or the end, that passes. What follows an IBAN often looks like another group of it."""
    ends = [len(found), *(i for i in range(len(found) - 1, 0, -1) if found[i] == " ")]
    return next((start + i for i in ends if mod97(found[:i])), None)


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = f"{text[max(0, start - WINDOW) : start]} {text[end : end + WINDOW]}".lower()
    words = set(re.findall(r"[^\W\d_]+", near))
    return START[kind] + 0.2 * bool(words & set(CONTEXT[kind])) - 0.2 * bool(words & set(AGAINST))


def spans(text: str | None) -> list[tuple[int, int, int, float]]:
    """All spans with their scores: the base ones, and IBANs and social-security numbers that pass their checks and score enough."""
    if not text:
        return []
    found = base_spans(text)
    found += [(4, m.start(), end) for m in _IBAN.finditer(text) if (end := _iban_end(m[0], m.start()))]
    for m in _SSN.finditer(text):
        if m[0][:3] not in ("000", "666") and m[0][0] != "9" and m[0][4:6] != "00" and m[0][7:] != "0000":
            found.append((5, *m.span()))
    scored = [(k, a, b, round(_score(text, KINDS[k], a, b), 2)) for k, a, b in found]
    return [x for x in scored if x[0] < 4 or x[3] >= LEAST]


def find_pii(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its spans: kind, start, end (code points, end exclusive) and score.

    Null and empty texts have none. Repeated rows each get theirs; other columns are ignored.
    """

    def run(batch):
        found = [[{"kind": KINDS[k], "start": a, "end": b, "score": s} for k, a, b, s in spans(t)] for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "spans": found}

    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, spans array<struct<kind:string,start:int,end:int,score:double>>")


def mask(text: str | None) -> str | None:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first stays."""
    if not text:
        return text
    out, at = [], 0
    for kind, start, end, _ in sorted(spans(text), key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
            at = end
    return "".join([*out, text[at:]])


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and the list of all spans."""
    listed = lambda x: F.array_join(F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:4]))
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [number(k) for k in KINDS[:4]]
    scores = F.transform("spans", lambda s: s["score"])
    return found.select("doc_id", *counts, F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), scores.alias("scores"))
