"""Personal data in texts: patterns propose spans, checksums confirm them, and words near a span move its score.

Base kinds (email, ip, card, phone) are leftmost non-overlapping matches per kind that pass their check; a match that
fails is dropped, without another try inside it. They are always reported; their score tells how sure they are. The other
kinds (iban with its mod-97 check, tried at the end of every word it may reach to; ssn) are reported from a score of ``THRESHOLD`` on, which for ssn takes a context word.

Defined results: null and empty texts have no spans; a text of any length is searched whole; repeated rows give repeated
results; an empty table gives an empty table. Spans are in order of kind, then start; spans of different kinds may overlap,
and ``redact`` joins overlapping ones. Input columns named like an output column are replaced, all others are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import add_columns, fresh

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")
THRESHOLD = 0.5

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a match can begin at a run's first digit only
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
IBAN_BODY = re.compile(r"(?:\x20?[A-Z0-9]){11,30}")
WORD_END = re.compile(r"(?<=[A-Z0-9])(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

#: Characters of an IBAN by country.
IBAN_SIZES = {
    c: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for c in countries.split()
}

#: Score of a match by kind before its context is read.
START = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.7, "ssn": 0.35}
#: Words that raise or lower the score of a kind when they stand near it.
CONTEXT = {
    "email": (("mail", "email", "contact", "write"), ("example",)),
    "ip": (("ip", "address", "host", "server", "login"), ("version", "release", "section")),
    "card": (("card", "credit", "debit", "visa", "payment", "pay"), ("order", "isbn", "serial", "tracking")),
    "phone": (("phone", "call", "tel", "mobile", "fax", "whatsapp"), ("isbn", "serial")),
    "iban": (("iban", "bank", "account", "konto", "transfer"), ()),
    "ssn": (("ssn", "social", "security", "taxpayer"), ("part", "serial", "order")),
}
STEP = 0.2
#: Characters on either side of a span that are read for context words.
NEAR = 48
WORD = re.compile(r"[a-z]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        if i & 1:
            v = v * 2 - 9 * (v > 4)
        total += v
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(t: str) -> Iterator[tuple[int, int]]:
    """As the pattern local part, at sign, domain would match: only an at sign with a local part before it can begin one."""
    end, at = 0, t.find("@")
    while at >= 0:
        start = at
        while start > end and t[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(t, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = t.find("@", end if m else at + 1)


def _ibans(t: str) -> Iterator[tuple[int, int]]:
    """Words may follow an IBAN that could belong to it: of its ends at words that pass, its country's, else the last."""
    end = 0
    for head in IBAN_HEAD.finditer(t):
        body = IBAN_BODY.match(t, head.end()) if head.start() >= end else None
        if not body:
            continue
        passed = {}
        for e in WORD_END.finditer(t, head.end() + 11, min(len(t), body.end() + 1)):
            x = t[head.start() : e.start()].replace(" ", "")
            if e.start() <= body.end() and len(x) >= 15 and mod97(x):
                passed[len(x)] = e.start()
        if passed:
            end = passed.get(IBAN_SIZES.get(head[0][:2]), max(passed.values()))
            yield head.start(), end


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _proposals(t: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans in order of kind, then start."""
    for a, b in _emails(t):
        yield "email", a, b
    for m in IP.finditer(t):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            yield "ip", m.start(), m.end()
    for m in CARD.finditer(t):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", m.start(), m.end()
    if "+" in t:
        for m in PHONE.finditer(t):
            if 8 <= len(_digits(m[0])) <= 15:
                yield "phone", m.start(), m.end()
    for a, b in _ibans(t):
        yield "iban", a, b
    for m in SSN.finditer(t):
        yield "ssn", m.start(), m.end()


def find(t: str) -> list[tuple[str, int, int, float]]:
    """Reported spans of a text: kind, start, end (exclusive, in code points), score."""
    out = []
    for kind, a, b in _proposals(t):
        words = set(WORD.findall(t[max(0, a - NEAR) : a].lower())) | set(WORD.findall(t[b : b + NEAR].lower()))
        more, less = CONTEXT[kind]
        score = START[kind] + STEP * (not words.isdisjoint(more)) - STEP * (not words.isdisjoint(less))
        if kind in BASE_KINDS or score >= THRESHOLD:
            out.append((kind, a, b, round(min(1.0, max(0.0, score)), 3)))
    return out


SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)
SPANS = T.StructField("pii_spans", T.ArrayType(SPAN))


def detect(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``pii_spans``, an array of kind, start, end and score."""

    def compute(texts: pa.Array) -> list:
        return [[[dict(zip(SPAN.names, s)) for s in find(t)] for t in texts.to_pylist()]]

    return add_columns(df, text, [SPANS], compute)


def mask(t: str) -> str:
    """The text with every span, or run of overlapping spans, replaced by its kind in angle brackets."""
    spans = sorted((a, -b, kind) for kind, a, b, _ in find(t))
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [t[at:a], f"<{kind.upper()}>"]
        at = max(at, -b)
    return "".join([*out, t[at:]]) if spans else t


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every span in the text replaced by its kind; null texts stay null."""
    into = fresh("masked")
    made = add_columns(
        df, text, [T.StructField(into, T.StringType())], lambda texts: [[mask(t) for t in texts.to_pylist()]]
    )
    out = [F.when(F.col(c).isNotNull(), F.col(into)).alias(c) if c == text else F.col(c) for c in df.columns]
    return made.select(*out)
