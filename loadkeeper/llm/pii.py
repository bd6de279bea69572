"""Personal data: regular expressions propose spans, checksums confirm them, nearby words move the score.

Four kinds are always kept once confirmed: email addresses, IPv4 addresses whose parts are at most 255,
card numbers of 14 to 19 digits that pass Luhn, and phone numbers of 10 to 15 digits after a plus sign. Proposals
of one kind are the leftmost that do not overlap; one that fails its test is dropped without another try. The method adds
two kinds that need more evidence: account numbers (iban) that pass mod 97, and phone numbers
without a plus sign (local), which a nearby context word has to confirm. An added span never
overlaps a kept one.

Positions count code points; ends are exclusive. Null and empty texts have no spans. All functions
work on one column, so clashing names elsewhere do not matter, and repeated rows get equal results.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "local")
TYPE = "array<struct<kind:string,start:int,end:int,score:double>>"

# The words that make a kind likelier when they stand close to a span.
CONTEXT = {
    "email": {"mail", "email", "e-mail", "contact", "write"},
    "ip": {"ip", "host", "server", "address", "login"},
    "card": {"card", "credit", "visa", "mastercard", "amex", "payment"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telephone"},
    "iban": {"iban", "account", "bank", "transfer"},
    "local": {"phone", "tel", "call", "mobile", "fax", "telephone"},
}
#: The score of a confirmed span, what a context word adds, and the least score of an added span.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "local": 0.3}
BOOST, LEAST, NEAR = 0.3, 0.5, 40

MAIL_RUN = re.compile(r"[A-Za-z0-9._%+-]*")
MAIL_REST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits that starts no address at its first digit starts none later, so only first digits are tried.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
LOCAL = re.compile(r"(?<![0-9+(])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9])")
DIGIT, WORD = re.compile(r"[0-9]"), re.compile(r"[a-z-]+")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Whether the sum of the digits, every second one from the right doubled, is divisible by 10."""
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number, its first four characters moved to the end and letters as 10 to 35, leaves 1."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses, found from their @ signs: the local part is the run before one, read backwards; no @ is in it."""
    after, at = 0, text.find("@")
    while at >= 0:
        start = at - MAIL_RUN.match(text[after:at][::-1]).end()
        rest = MAIL_REST.match(text, at) if start < at else None
        if rest:
            yield start, rest.end()
        after = rest.end() if rest else at + 1
        at = text.find("@", after)


def _is_ip(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in found.split("."))


def _is_card(found: str) -> bool:
    digits = found.replace(" ", "").replace("-", "")
    return 14 <= len(digits) <= 19 and luhn(digits)


def _is_phone(found: str) -> bool:
    return 10 <= sum("0" <= c <= "9" for c in found) <= 15


def _account_end(found: str) -> int:
    """The length of the longest start of ``found``, ending where a group ends, that passes mod 97; else 0."""
    ends = [i for i, c in enumerate(found) if c == " "] + [len(found)]
    return next((e for e in reversed(ends) if 15 <= len(own := found[:e].replace(" ", "")) <= 34 and mod97(own)), 0)


def _scored(text: str, kind: str, start: int, end: int) -> Span:
    near = WORD.findall(text[max(0, start - NEAR) : start].lower()) + WORD.findall(text[end : end + NEAR].lower())
    return Span(kind, start, end, min(1.0, SCORES[kind] + BOOST * (not CONTEXT[kind].isdisjoint(near))))


def spans(text: str) -> list[Span]:
    """The spans of a text by start, then by kind in the order of KINDS."""
    found = [("email", a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        for kind, pattern, test in (("ip", IP, _is_ip), ("card", CARD, _is_card), ("phone", PHONE, _is_phone)):
            found += [(kind, *m.span()) for m in pattern.finditer(text) if test(m.group())]
        kept = sorted((a, b) for _, a, b in found)
        starts, ends = [a for a, _ in kept], [0, *accumulate((b for _, b in kept), max)]
        more = [("iban", m.start(), m.start() + n) for m in IBAN.finditer(text) if (n := _account_end(m.group()))]
        more += [("local", *m.span()) for m in LOCAL.finditer(text)]
        for kind, a, b in more:
            if _scored(text, kind, a, b).score >= LEAST and ends[bisect_left(starts, b)] <= a:
                found.append((kind, a, b))
    return sorted((_scored(text, *x) for x in found), key=lambda s: (s.start, KINDS.index(s.kind)))


def find(text: Column) -> Column:
    """array<struct<kind, start, end, score>>: the personal data of a text, by start."""

    @F.arrow_udf(TYPE)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for texts in batches:
            yield pa.array(([s._asdict() for s in spans(t.as_py() or "")] for t in texts), kind)

    return found(text)


def redact(text: Column, found: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; spans may overlap, the first one wins."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("int").alias("at"))

    def step(state, span):
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        replaced = F.struct(F.concat(state["out"], gap, F.lit("<"), span["kind"], F.lit(">")).alias("out"), span["end"].alias("at"))
        return F.when(span["start"] >= state["at"], replaced).otherwise(state)

    rest = lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.char_length(text)))
    return F.when(F.size(found) == 0, text).otherwise(F.aggregate(found, start, step, rest))
