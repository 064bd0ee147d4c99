"""The classifier chain on a planted vocabulary: held-out accuracy, out-of-fold inputs, edge cases."""

import random

import numpy as np

from perigee.llm import toxicity as T

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"


def planted(seed, size=600):
    rnd = random.Random(seed)
    bad = ["vilx" + s for s in ("a", "o", "en", "ing", "er")]
    docs, labels = [], []
    for i in range(size):
        toxic, poor = rnd.random() < 0.25, rnd.random() < 0.3
        words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 8))) for _ in range(rnd.randrange(20, 200))]
        if toxic:
            for _ in range(max(2, len(words) // 40)):
                words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        if poor:
            words = [w + "!!!###" for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, int(not poor), int(toxic)))
    return docs, labels


def test_held_out_documents(make):
    docs, labels = planted(1)
    chain = T.fit(make(docs, DOCS), make(labels[:400], LABELS))
    got = {r["doc_id"]: r for r in T.probabilities(make(docs, DOCS), chain).collect()}
    assert len(got) == len(docs)
    toxic = [got[i]["toxic"] for i, _, t in labels[400:] if t]
    clean = [got[i]["toxic"] for i, _, t in labels[400:] if not t]
    assert np.mean(toxic) >= 0.95 and np.mean(clean) <= 0.01
    right = [(got[i]["p_low_quality"] >= 0.5) == (q == 0) for i, q, _ in labels[400:]]
    assert np.mean(right) >= 0.9
    kept = T.without_toxic(make(docs, DOCS), chain)
    assert kept.columns == ["doc_id", "text", "size", "token"]
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if not r["toxic"]}


def test_later_models_get_out_of_fold_probabilities():
    docs, labels = planted(2, 150)
    rows = [np.array(T.features(t), np.int64) for _, t in docs]
    y = np.array([[1 - q, t] for _, q, t in labels], float)
    folds = np.arange(len(rows)) % T.FOLDS
    models, out = T.fit_chain(rows, y, folds)
    alone = T.LinearModel([r for r, f in zip(rows, folds, strict=True) if f != 0], np.zeros(((folds != 0).sum(), 0)), y[folds != 0, 0])
    assert np.allclose(out[0, 0], alone.probability(np.array([alone.w[rows[0]].sum()]), np.zeros((1, 0))))
    assert [len(m.v) for m in models] == [0, 1]


def test_nulls_repeats_and_missing_labels(make):
    docs, labels = planted(3, 200)
    odd = [(None, docs[0][1]), (900, None), (901, ""), docs[1], (902, "vilxa " * 100_000)]
    table = make(docs + odd, DOCS)
    chain = T.fit(table, make([*labels, (None, 1, 1), (3, None, 1), (12345, 1, 1), labels[0]], LABELS))
    got = T.probabilities(table, chain).collect()
    assert len(got) == len(docs) + len(odd)
    assert next(r for r in got if r["doc_id"] == 902)["toxic"] and not next(r for r in got if r["doc_id"] == 900)["toxic"]
    none = T.fit(table, make([], LABELS))
    assert not any(r["toxic"] for r in T.probabilities(table, none).collect())
    assert T.probabilities(make([], DOCS), chain).collect() == []


def test_sample_is_bounded(make):
    docs, labels = planted(4, 200)
    rows, marks, folds = T.sampled(make(docs, DOCS), make(labels, LABELS), 10)
    assert len(rows) == len(marks) == len(folds) <= 40


def test_sampled_rows_stand_for_all_labelled_documents(make):
    docs, labels = planted(5, 300)
    without = [(i, q, t) for i in range(1000, 3000) for q, t in [((i >> 1) & 1, i & 1)]]
    rows, marks, _ = T.sampled(make(docs, DOCS), make(labels + without, LABELS), 10)
    assert len(rows) == 40  # labels without a document take no places
    *_, marks, _, weights = T.weighed_sample(make(docs, DOCS), make(labels + without, LABELS), 10)
    for quality in (0, 1):
        for toxic in (0, 1):
            there = (marks[:, 0] == 1 - quality) & (marks[:, 1] == toxic)
            assert round(weights[there].sum(), 6) == sum((q, t) == (quality, toxic) for _, q, t in labels)
    p, y, w = np.array([0.3, 0.3, 0.7, 0.9]), np.array([0.0, 1.0, 0.0, 1.0]), np.array([40.0, 1.0, 40.0, 1.0])
    assert T.best_limit(p, y) <= 0.3 and T.best_limit(p, y, w) > 0.7
