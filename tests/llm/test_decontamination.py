"""Passages with edits against an alignment of the whole text."""

import random

import numpy as np

from perigee.llm import decontamination as D


def fewest_edits(passage, text):
    a, row = np.frombuffer(text, np.uint8), np.zeros(len(text) + 1, int)
    for c in passage:
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (a != c))
        row = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(row.min())


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice(["th", "er", "on", "an", "é", "sh"]) for _ in range(rnd.randrange(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rnd.randrange(6, 40))) for i in range(20)] + [(90, None), (91, "ab"), (None, prose(12)), (5, prose(15))]
    docs = []
    for i in range(120):
        text = list(rnd.choice(items[:20])[1])
        for _ in range(rnd.randrange(len(text) // 7 + 1)):
            at = rnd.randrange(len(text))
            text[at : at + 1] = rnd.choice([[], ["q"], [text[at], "z"]])
        docs.append((i, prose(rnd.randrange(30)) + rnd.choice(["", " ", ". "]) + "".join(text) + " " + prose(rnd.randrange(30))))
    return items, docs + [(500, None), (501, ""), (None, items[22][1]), docs[0]]


def test_equals_whole_alignment(make):
    items, docs = corpus(3)
    want = []
    for doc_id, text in docs:
        for item_id, passage in items:
            p = D.normalise(passage)
            if len(p) >= D.Q and (d := fewest_edits(p, D.normalise(text))) <= D.budget(len(p), 0.1):
                want.append((doc_id, item_id, d))
    found = D.passages_in(make(docs, "doc_id long, text string"), make(items, "item_id long, text string"), 0.1)
    got = [(r["doc_id"], r["item_id"], r["edits"]) for r in found.collect()]
    assert len(got) > 60 and sorted(got, key=str) == sorted(want, key=str)
    clean = D.without_passages(make(docs, "doc_id long, text string"), make(items, "item_id long, text string"), 0.1)
    assert clean.columns == ["doc_id", "text", "size", "token"]
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(d) for d, _ in docs if d not in {w[0] for w in want})


def test_blocks_of_passages_give_the_same(make, monkeypatch):
    items, docs = corpus(4)
    tables = make(docs, "doc_id long, text string"), make(items, "item_id long, text string")
    one = sorted(map(str, D.passages_in(*tables).collect()))
    monkeypatch.setattr(D, "BLOCK_CHARS", 300)
    monkeypatch.setattr(D, "SCAN_CHARS", 2000)
    assert sorted(map(str, D.passages_in(*tables).collect())) == one


def test_case_and_punctuation_don_t_hide_a_passage(make):
    rows = [(1, "x " * 5000 + "The QUICK, brown -- fox: jumps; over the lazy dog!" + " y" * 5000)]
    got = D.passages_in(make(rows, "doc_id long, text string"), make([(7, "the quick brown fox jumps over the lazy dog")], "item_id long, text string"))
    assert [(r["doc_id"], r["item_id"], r["edits"]) for r in got.collect()] == [(1, 7, 0)]


def test_empty_tables(make):
    none, one = make([], "doc_id long, text string"), make([(1, "a b c d e f g h")], "doc_id long, text string")
    items = make([], "item_id long, text string")
    assert D.passages_in(one, items).collect() == [] and D.without_passages(one, items).count() == 1
    assert D.passages_in(none, make([(1, "a b c d e f g h")], "item_id long, text string")).collect() == []
