"""Personal data against plain patterns, and the added kinds."""

import hashlib
import random
import re

from perigee.llm import pii

DOCS = "doc_id long, text string, n_chars long"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    only = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        check = sum(sum(map(int, str(int(c) * (1 + i % 2)))) for i, c in enumerate(only(m)[::-1]))
        if 13 <= len(only(m)) <= 19 and check % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(only(m)) <= 15]


def texts(seed, size):
    rnd = random.Random(seed)
    pieces = ["a.b+c@d-e.fr", "@", "x@y", "1.2.3.4", "999.1.1.1", ".", "4111 1111-1111 1111", "4111111111111112", "+1 (743) 555-3824", "+", "12", " ", "é", "-", "0005.1.1.1"]
    return ["".join(rnd.choice(pieces) for _ in range(rnd.randrange(14))) for _ in range(size)]


def test_base_kinds_equal_the_plain_patterns(make):
    rows = [(i, t, len(t)) for i, t in enumerate(texts(1, 2000))] + [(None, "a@b.cd", 6), (5000, None, None), (5001, "", 0), (0, "x", 1)]
    got = pii.personal_data(make(rows, DOCS)).collect()
    want = []
    for doc_id, t, _ in rows:
        found = plain(t or "")
        kinds = [f[0] for f in found]
        digest = hashlib.sha256(",".join("%s:%d:%d" % f for f in found).encode()).hexdigest()
        want.append((doc_id, *(kinds.count(k) for k in pii.BASE), digest))
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    for r in got:
        assert len(r["scores"]) == len([s for s in r["spans"].split(",") if s])


def test_added_kinds_need_evidence():
    ok = "Please pay to account DE89 3704 0044 0532 0130 00 today"
    assert [s[0] for s in pii.spans(ok)] == ["iban"] and ok[pii.spans(ok)[0][1] : pii.spans(ok)[0][2]] == "DE89 3704 0044 0532 0130 00"
    assert pii.spans("DE89 3704 0044 0532 0130 01") == []
    assert [s[0] for s in pii.spans("social security 123-45-6789")] == ["ssn"] and pii.spans("order 123-45-6789") == []
    assert [s[0] for s in pii.spans("call 743-555-3824")] == ["local"] and pii.spans("743-555-3824") == []


def test_long_runs_stay_linear():
    for text in ("1" * 100_000, "a" * 100_000 + "@", "1." * 50_000, "+1 " * 30_000, "@a" * 50_000, "A" * 100_000, "+1" + "(" * 100_000):
        pii.spans(text)


def test_redacted_keeps_columns_and_masks_everything(make):
    rows = [(1, "mail a@b.cd or +1 743 555 3824 now", 34), (2, "nothing", 7), (3, None, None), (4, "1.2.3.4", 7)]
    out = pii.redacted(make(rows, DOCS))
    assert out.columns == ["doc_id", "text", "n_chars", "size", "token"]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    masked = "mail <EMAIL> or <PHONE> now"
    assert got == {1: (masked, len(masked)), 2: ("nothing", 7), 3: (None, None), 4: ("<IP>", 4)}
    assert pii.personal_data(make([], DOCS)).collect() == []


def test_overlapping_spans_are_masked_once():
    assert pii.masked("ab12345cd", [("ip", 2, 5, 1), ("card", 4, 7, 1)]) == "ab<IP>cd"


def test_context_behind_a_span_and_whole_words():
    assert [s[0] for s in pii.spans("078-05-1120 (SSN)")] == ["ssn"] and [s[0] for s in pii.spans("555-123-4567 (mobile)")] == ["local"]
    assert [s[0] for s in pii.spans("telefon " + "x " * 18 + "555-123-4567")] == ["local"]  # the window cuts the word
    assert pii.spans("hotel " + ". " * 18 + " 555-123-4567") == []  # nor is "tel" a word of its own
    assert pii.spans("555-123-4567" + " ." * 25 + " mobile") == [] and pii.spans("mobile" + " ." * 25 + " 555-123-4567") == []
