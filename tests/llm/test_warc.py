"""Archives: what is written is read back, and captures come out whole."""

import base64
import gzip
import hashlib
from pathlib import Path

import pytest

from perigee.llm import warc

PAGES = "page_id long, url string, html string"


def rows():
    tricky = "<p>x</p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\né\n"
    return [
        (1, "https://a.example/x?y=1#z", "<p>one</p>"), (2, "https://b.example", "<p>one</p>"), (3, None, tricky), (4, "no\r\nurl", tricky),
        (5, "https://c.example/", None), (6, "https://c.example/", ""), (7, "u", "y" * 300_000), (None, "https://n.example/", "<p>one</p>"), (8, "u", "single"),
        (9, "u", "twice"), (9, "u", "twice"), (-7, "u", "below"),
    ]


def wanted(given, revisit_from=0):
    best = {}
    for page, _, html in given:
        best[html or ""] = max(best.get(html or "", -(10**9)), -(10**9) if page is None else page)
    out = []
    for page, _, html in given:
        payload = (html or "").encode()
        first = best[html or ""]
        again = len(payload) >= revisit_from and page != first
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page, len(payload), digest, "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("revisit_from", [0, 8])
def test_round_trip(spark, make, tmp_path, revisit_from):
    path = str(tmp_path / "archives")
    warc.write_archives(make(rows(), PAGES), path, revisit_from=revisit_from)
    records = warc.read_records(spark, path)
    assert records.count() == 3 * len(rows())
    got, payloads = [], {}
    for r in warc.transactions(records).collect():
        size = r["response"]["size"] if r["response"]["size"] is not None else r["metadata"]["size"]
        refers = r["response"]["refers_to"]
        got.append((r["page_id"], size, r["response"]["digest"], r["response"]["kind"], int(refers.rsplit(":", 1)[1]) if refers else None))
        if r["response"]["payload"] is not None:
            payloads[r["page_id"]] = bytes(r["response"]["payload"]).decode()
        assert r["request"]["record_id"].endswith(":request") and r["metadata"]["record_id"].endswith(":metadata")
    assert sorted(got, key=str) == wanted(rows(), revisit_from)
    assert payloads[4] == rows()[3][2] and len(payloads[7]) == 300_000


def test_files_are_warc_by_the_lengths_they_state(make, tmp_path):
    path = tmp_path / "archives"
    warc.write_archives(make(rows(), PAGES, 1), str(path))
    kinds = [h["warc-type"] for f in path.glob("*.gz") for h, _ in warc.parse(gzip.decompress(f.read_bytes()))]
    assert sorted(set(kinds)) == ["metadata", "request", "response", "revisit"] and len(kinds) == 3 * len(rows())
    with pytest.raises(ValueError, match="no record"):
        list(warc.parse(b"junk\r\n\r\n"))


def test_no_pages(spark, make, tmp_path):
    warc.write_archives(make([], PAGES), str(tmp_path / "none"))
    assert not list(Path(tmp_path / "none").glob("*.gz")) or warc.transactions(warc.read_records(spark, str(tmp_path / "none"))).collect() == []
