"""The compression classifier: held-out accuracy, and rows that can't be learned from."""

import random
import zlib

import pytest

from perigee.llm import quality

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int"


def corpus(n, seed=1):
    """Good texts are prose, bad ones shout, list, or repeat a word."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice(["an", "the", "ri", "so", "lun", "mer", "ta", "ek"]) for _ in range(rnd.randrange(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rnd.choice([30, 80, 200, 900]))]
        good = rnd.random() < 0.8
        if not good:
            words = rnd.choice([[w.upper() + "!!" for w in words], [w + " |" for w in words], words[:1] * len(words)])
        docs.append((i, " ".join(words)))
        labels.append((i, int(good)))
    return docs, labels


@pytest.fixture(scope="module")
def given():
    return corpus(1200)


def test_held_out_accuracy(make, given):
    docs, labels = given
    model = quality.fit(make(docs, DOCS), make([r for r in labels if r[0] < 900], LABELS))
    got = quality.scores(make(docs, DOCS), model).collect()
    truth = dict(labels)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    unseen = [r for r in got if r["held_out"] or r["doc_id"] >= 900]
    right = [r["predicted"] == truth[r["doc_id"]] for r in unseen]
    assert len(right) > 400 and sum(right) / len(right) > 0.97
    good = [r["score"] for r in unseen if truth[r["doc_id"]] == 1]
    bad = [r["score"] for r in unseen if truth[r["doc_id"]] == 0]
    above = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad)
    assert above > 0.98 and all(0 <= s <= 1 for s in good + bad)
    assert abs(sum(good + bad) / len(unseen) - len(good) / len(unseen)) < 0.05  # calibrated


def test_held_out_labels_and_partitions_change_nothing(make, given):
    docs, labels = corpus(300)
    other = [(i, 1 - q) if zlib.crc32(str(i).encode()) % 4 == 2 else (i, q) for i, q in labels]
    got = [sorted(map(tuple, quality.scores(make(docs, DOCS, parts), quality.fit(make(docs, DOCS, parts), make(rows, LABELS, parts))).collect())) for rows, parts in ((labels, 2), (other, 5))]
    assert got[0] == got[1]


def test_odd_rows(make):
    docs, labels = corpus(200)
    docs += [(None, docs[0][1]), (900, None), (901, ""), docs[1], docs[1], (902, "A" * 3_000_000), (3, "another text of this id")]
    labels += [(None, 1), (5, None), (777_777, 0), (6, 1), (6, 0), labels[2], labels[2]]
    got = quality.scores(make(docs, DOCS), quality.fit(make(docs, DOCS), make(labels, LABELS))).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(i) for i, _ in docs)
    by_text = {r["doc_id"]: r["score"] for r in got}
    assert by_text[900] == by_text[901] and by_text[None] == by_text[0] and not any(r["held_out"] for r in got if r["doc_id"] is None)


@pytest.mark.parametrize(("labels", "score"), [([], 0.5), ([(0, 1), (1, 1)], 1.0), ([(3, 0)], 0.0)])
def test_one_kind_of_label_or_none(make, labels, score):
    docs = [(i, f"text {i}") for i in range(8)]
    assert not any(zlib.crc32(str(i).encode()) % 4 == 2 for i, _ in labels)
    got = quality.scores(make(docs, DOCS), quality.fit(make(docs, DOCS), make(labels, LABELS))).collect()
    assert {r["score"] for r in got} == {score} and len(got) == 8


def test_empty_table(make):
    assert quality.scores(make([], DOCS), quality.fit(make([], DOCS), make([], LABELS))).collect() == []
