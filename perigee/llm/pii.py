"""Personal data: patterns propose spans, checksums confirm them, words around them adjust the score.

Base kinds (email, ip, card, phone) are the leftmost non-overlapping matches of their pattern
that pass their test, whatever their score. Further kinds (iban by mod 97, ssn by its number
ranges, local: a phone number without country code) are added where no base span lies and the
score, from pattern, checksum and context, reaches ``ADD_FROM``.

Every pattern is matched in time linear in the text: searches start at the beginning of a run
of digits only, quantifiers give nothing back, and addresses are found from their @.

Defined results. Null or empty text: no spans. Places are code points, ends exclusive. Repeated
rows are each searched. An empty table gives an empty result. ``redacted`` keeps all columns.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "local")
ADD_FROM = 0.7
CONTEXT_CHARS = 40
#: Words that speak for a kind when they stand shortly before or behind a span.
CONTEXT = {
    "email": {"email", "mail", "contact", "write", "correo", "courriel"},
    "ip": {"ip", "address", "server", "host", "login"},
    "card": {"card", "visa", "credit", "mastercard", "karte", "carte", "tarjeta"},
    "phone": {"phone", "call", "tel", "mobile", "fax", "telefon"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security", "taxpayer"},
    "local": {"phone", "call", "tel", "mobile", "fax", "telefon"},
}
_LONGEST = max(len(w) for words in CONTEXT.values() for w in words)
_LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_LOCAL = re.compile(r"(?<![0-9+(])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
_DIGIT = re.compile("[0-9]")
_WORD = re.compile(r"\w+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(code: str) -> bool:
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def emails(text: str):
    after = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > after and text[start - 1] in _LOCAL_PART:
            start -= 1
        if start < m.start():
            yield start, m.end()
            after = m.end()


def _ip_ok(match: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match.split("."))


def base_spans(text: str):
    """(kind, start, end, whether a checksum confirmed it) of the base kinds, in their order."""
    if "@" in text:
        for a, b in emails(text):
            yield "email", a, b, False
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        if _ip_ok(m[0]):
            yield "ip", *m.span(), False
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", *m.span(), True
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                yield "phone", *m.span(), False


def _added(text: str):
    for m in _IBAN.finditer(text):
        # take the longest beginning that the checksum confirms, so that words behind don't hide it
        ends = [i for i in range(m.start() + 15, m.end() + 1) if i == m.end() or not text[i].isalnum()]
        for end in reversed(ends):
            if mod97(text[m.start() : end].replace(" ", "")):
                yield "iban", m.start(), end, True
                break
    for m in _SSN.finditer(text):
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            yield "ssn", *m.span(), False
    for m in _LOCAL.finditer(text):
        yield "local", *m.span(), False


def _around(text: str, start: int, end: int):
    """Words that lie, or begin or end, within ``CONTEXT_CHARS`` of a span; whole, unless longer than any word of context."""
    first = max(0, start - CONTEXT_CHARS - _LONGEST - 1)
    for m in _WORD.finditer(text[first:start]):
        if m.end() + first > start - CONTEXT_CHARS:
            yield m[0].lower()
    for m in _WORD.finditer(text[end : end + CONTEXT_CHARS + _LONGEST + 1]):
        if m.start() < CONTEXT_CHARS:
            yield m[0].lower()


def score(text: str, kind: str, start: int, end: int, confirmed: bool) -> float:
    """0.5 for the pattern, 0.3 for a checksum, 0.2 for a word of its context shortly before or behind."""
    return 0.5 + 0.3 * confirmed + 0.2 * (not CONTEXT[kind].isdisjoint(_around(text, start, end)))


def spans(text: str) -> list:
    """(kind, start, end, score), base kinds in their order, then added ones, each by start."""
    found = [(k, a, b, score(text, k, a, b, c)) for k, a, b, c in base_spans(text)]
    taken = sorted((a, b) for _, a, b, _ in found)
    if _DIGIT.search(text):
        for k, a, b, c in _added(text):
            s = score(text, k, a, b, c)
            if s >= ADD_FROM - 1e-9 and not any(x < b and a < y for x, y in taken):
                found.append((k, a, b, s))
    return found


def masked(text: str, found: list) -> str:
    """The text with every span, or run of overlapping spans, replaced by its (first) kind."""
    out, at, end = [], 0, 0
    for kind, a, b, _ in sorted(found, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = end = max(end, b)
    return "".join([*out, text[at:]])


def _joined(found: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, _ in found)


def personal_data(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, base_sha256, spans, and the scores of the spans in their order."""
    schema = pa.schema([("doc_id", pa.int64())] + [(f"n_{k}", pa.int64()) for k in BASE]
                       + [("base_sha256", pa.string()), ("spans", pa.string()), ("scores", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                found = spans(text or "")
                kinds = [s[0] for s in found]
                base = _joined([s for s in found if s[0] in BASE])
                rows.append([*(kinds.count(k) for k in BASE), hashlib.sha256(base.encode()).hexdigest(), _joined(found), [round(s[3], 1) for s in found]])
            columns = list(zip(*rows, strict=True)) or [()] * (len(schema) - 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(list(c), f.type) for c, f in zip(columns, list(schema)[1:], strict=True))], schema=schema)

    kinds = ", ".join(f"n_{k} long" for k in BASE)
    wanted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return wanted.mapInArrow(run, f"doc_id long, {kinds}, base_sha256 string, spans string, scores array<double>")


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with all spans in ``text`` masked, and ``n_chars``, if there, counted anew where the text changed."""
    at = docs.columns.index("text")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            new = [t if not t or not (found := spans(t)) else masked(t, found) for t in texts]
            columns = list(batch.columns)
            columns[at] = pa.array(new, columns[at].type)
            if chars is not None:
                old = columns[chars].to_pylist()
                columns[chars] = pa.array([n if t == o else len(t) for n, t, o in zip(old, new, texts, strict=True)], columns[chars].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
