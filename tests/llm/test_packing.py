"""Packing against a plain search for the tightest compatible bin."""

import random

import pytest
from pyspark.sql import functions as F

from perigee.llm import packing as P


def plain(items, capacity):
    bins, out = [], []
    for size, source, cluster in items:
        fits = [(b["room"], n) for n, b in enumerate(bins) if b["room"] >= size and not b["source"] & source and not b["cluster"] & cluster]
        if fits:
            n = min(fits)[1]
        else:
            n = len(bins)
            bins.append({"room": capacity, "source": 0, "cluster": 0})
        bins[n]["room"] -= size
        bins[n]["source"] |= source
        bins[n]["cluster"] |= cluster
        out.append(n)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_tightest_compatible_bin(seed):
    rnd = random.Random(seed)
    items = [(rnd.randrange(0, 60), 1 << rnd.randrange(6) if rnd.random() < 0.8 else 0, 1 << rnd.randrange(90) if rnd.random() < 0.3 else 0) for _ in range(400)]
    assert P.best_fit(items, 100) == plain(items, 100)


DOCS = "doc_id long, text string, source string"


def run(make, rows, capacity=20):
    return P.packed(make(rows, DOCS), P.words(), F.col("source"), P.copies(), capacity).collect()


def test_nothing_lost_and_no_conflicts(make, monkeypatch):
    monkeypatch.setattr(P, "SHARD", 50)
    rnd = random.Random(2)
    rows = [(i, " ".join(f"w{rnd.randrange(99)}" for _ in range(rnd.randrange(45))), f"s{rnd.randrange(9)}" if i % 3 else "hot") for i in range(400)]
    rows += [(1000 + i, rows[7][1].upper(), None) for i in range(20)] + [(2000, None, "s1"), (2001, " ", None), (None, "a b c", "s2"), rows[9], (3000, "long " * 5000, "s3")]
    got = run(make, rows)
    assert sorted(str((r["doc_id"], r["size"], r["start"])) for r in got) == sorted(
        str((i, min(20, n - s), s)) for i, t, _ in rows for n in [len((t or "").split())] for s in range(0, max(n, 1), 20)
    )
    by_bin = {}
    source, key = {i: s for i, _, s in rows}, {i: "".join((t or "").lower().split()) for i, t, _ in rows}
    for r in got:
        by_bin.setdefault(r["bin"], []).append(r)
    for pieces in by_bin.values():
        assert sum(r["size"] for r in pieces) <= 20 and sorted(r["position"] for r in pieces) == list(range(len(pieces)))
        sources = [source[r["doc_id"]] for r in pieces if source[r["doc_id"]]]
        clusters = [key[r["doc_id"]] for r in pieces]
        assert len(sources) == len(set(sources)) and len(clusters) == len(set(clusters))


def test_same_rows_in_any_order_give_the_same_bins(make):
    rows = [(i, "w " * (i % 13), f"s{i % 4}") for i in range(100)]
    assert sorted(map(tuple, run(make, rows))) == sorted(map(tuple, run(make, rows[::-1])))
    assert run(make, []) == []
