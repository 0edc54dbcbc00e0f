"""Operator 2: personal data spans in whole texts.

Regular expressions propose spans, checksums (Luhn for cards, mod-97 for account numbers) and range
rules confirm them, and words near a span raise or lower its score. The base kinds (email, ip, card,
phone) are always kept once confirmed; the method adds ``iban`` spans.

Cases: null or empty text has no spans; spans of different kinds may overlap, spans of one kind don't;
a proposal that fails its check is dropped and its characters are used up; very long texts are scanned
whole in linear time; repeated rows are scanned each; an empty table gives an empty table; a column
already named like the output is replaced, all others pass through.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martpulse.llm.common import add_columns

#: Kinds in digest order; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "iban")
BASE_KINDS = KINDS[:4]

_SIGNAL = re.compile(r"[0-9@]")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_WORD = re.compile(r"[^\W\d_]+")

#: Score of a confirmed span without context, by kind.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9}
#: Words within ``NEAR`` characters that speak for or against a kind.
FOR = {
    "email": {"mail", "email", "contact", "contacto", "kontakt", "courriel"},
    "ip": {"ip", "address", "host", "server", "adresse"},
    "card": {"card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"},
    "phone": {"phone", "tel", "call", "mobile", "telefon", "telefono", "fax"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
}
AGAINST = {"version", "isbn", "release", "build", "sample", "example", "order", "invoice"}
NEAR = 40
STEP = 0.1

SPAN_TYPE = "array<struct<kind:string,start:int,end:int,score:double>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _emails(text: str):
    """A local part is the run of its characters before an @, cut at the last match or the last @."""
    low, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        low = m.end() if m else at + 1
        at = text.find("@", low)


def find_spans(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score), by start and then kind order; code points, end exclusive."""
    if not text or not _SIGNAL.search(text):
        return []
    found = [("email", s, e) for s, e in _emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_octet, m.group().split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c in "0123456789" for c in m.group()) <= 15:
            found.append(("phone", *m.span()))
    found += [("iban", *m.span()) for m in _IBAN.finditer(text)
              if 15 <= len(a := m.group().replace(" ", "")) <= 34 and mod97(a)]
    found.sort(key=lambda f: (f[1], KINDS.index(f[0])))
    return [(*f, _score(text, *f)) for f in found]


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = {w.lower() for w in _WORD.findall(text[max(0, start - NEAR):start] + " " + text[end:end + NEAR])}
    raw = PRIOR[kind] + STEP * len(near & FOR[kind]) - STEP * len(near & AGAINST)
    return round(min(1.0, max(0.0, raw)), 3)


def find_pii(df: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """``df`` plus the array ``out`` of spans (kind, start, end, score)."""

    def run(texts: pa.Array) -> list[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                   ("score", pa.float64())]))
        return [pa.array([[dict(zip(("kind", "start", "end", "score"), f, strict=True)) for f in find_spans(t)]
                          for t in texts.to_pylist()], kind)]

    return add_columns(df, text, run, f"`{out}` {SPAN_TYPE}")


def redact(df: DataFrame, text: str = "text", least_score: float = 0.0) -> DataFrame:
    """``df`` with every span of at least ``least_score`` replaced by its kind in angle brackets."""

    def run(texts: pa.Array) -> list[pa.Array]:
        out = []
        for t in texts.to_pylist():
            parts, at = [], 0
            for kind, s, e, score in find_spans(t):
                if score >= least_score and e > at:
                    parts += [t[at:s] if s > at else "", f"<{kind}>"]
                    at = e
            out.append("".join([*parts, t[at:]]) if parts else t)
        return [pa.array(out, pa.string())]

    return add_columns(df, text, run, f"`{text}` string").select(*df.columns)


def kind_count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digest(spans: Column, kinds=KINDS) -> Column:
    """kind:start:end of the spans of ``kinds``, comma-joined."""
    picked = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(picked, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
