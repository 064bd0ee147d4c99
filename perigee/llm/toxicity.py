"""Toxicity categories by a classifier chain.

Categories are predicted in order. The model of a category is linear in hashed word features
and in the probabilities of all earlier categories. While training, those probabilities are out
of fold: each row's comes from a model that has not seen the row (nor a copy of its text, as
folds are by text). At prediction the models fitted on all sampled rows are used.

The models are fitted on a bounded sample of labelled rows, ``SAMPLE`` of each combination of
labels, those with the smallest hashed doc_id among labels that have a document. In the fit and in
the limit each weighs as many labelled rows as it stands for, so that both follow how common the
combinations are, whatever the size of the table. The rows are a few megabytes, and every document is
scored where it lies, over its whole text, in one scan.

Features of a text are its distinct lower-case words, their first three, four and five
characters, and the text's share of letters and length, as buckets.

Defined results. Null or empty text: scored by its two shape features. Null doc_id: kept.
Labels that are null, or without a document, don't count. Without a positive and a negative
sampled row a category has the constant probability of its only label, or 0 without any rows,
so nothing is rejected for lack of labels. Repeated rows are each scored. Extra columns of
documents are kept by ``without_toxic`` and ignored by ``probabilities``.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from perigee.llm.common import stored

#: Rows sampled of each combination of label values.
SAMPLE = 2000
FOLDS = 3
SLOTS = 1 << 18
EPOCHS = 6
#: Category and the condition on the labels table, in chain order.
CATEGORIES = [("low_quality", "quality = 0"), ("toxic", "toxic = 1"), ("severe", "toxic = 1 AND quality = 0")]
#: Documents are rejected for this category, from the limit on that served best out of fold.
DECIDES = "toxic"
#: Standard errors that a feature's log odds ratio must be away from 0 to count.
SURE = 2.0
_WORD = re.compile(r"\w+")
_KNOWN_WORDS = 400_000


def _slots(word: str) -> tuple:
    """The feature slots of one word."""
    keys = [word] + [f"{word[:k]}~{k}" for k in (3, 4, 5) if len(word) >= k]
    return tuple(zlib.crc32(k.encode("utf-8", "surrogatepass")) % SLOTS for k in keys)


def _shape(text: str, words: list) -> tuple:
    letters = sum(map(len, words)) / max(1, len(text))
    keys = (f"\tletters{int(letters * 10)}", f"\tlength{int(math.log2(len(text) + 1))}")
    return tuple(zlib.crc32(k.encode()) % SLOTS for k in keys)


def features(text: str) -> list:
    words = _WORD.findall(text.lower())
    out = list(_shape(text, words))
    for w in set(words):
        out += _slots(w)
    return sorted(out)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _probability(sums, dense, v, b, constant):
    return _sigmoid(b + dense @ v + sums) if constant is None else np.full(len(sums), constant)


def evidence(rows: list, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """How surely each slot tells the labels apart: the z-score of its log odds ratio beyond ``SURE``, else 0.

    Weights shift the odds; how sure they are depends on the number of rows seen.
    """
    yes, no = float(labels.sum()), float(len(labels) - labels.sum())
    share = [weights / weights[labels == y].mean() for y in (0, 1)]
    seen, weighed = ([np.zeros(SLOTS), np.zeros(SLOTS)] for _ in range(2))
    for i, (r, y) in enumerate(zip(rows, labels, strict=True)):
        slots = np.unique(r)
        seen[int(y)][slots] += 1
        weighed[int(y)][slots] += share[int(y)][i]
    n, p = seen
    wn, wp = np.minimum(weighed[0], no), np.minimum(weighed[1], yes)
    odds = np.log((wp + 0.5) / (yes - wp + 0.5)) - np.log((wn + 0.5) / (no - wn + 0.5))
    z = odds / np.sqrt(1 / (p + 0.5) + 1 / (n + 0.5))
    return np.sign(z) * np.minimum(np.maximum(np.abs(z) - SURE, 0), 3.0)


class LinearModel:
    """Logistic regression over slots, weighed by their evidence, and a few dense inputs; AdaGrad on small batches."""

    def __init__(self, rows: list, dense: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None):
        self.w, self.v, self.b = np.zeros(SLOTS), np.zeros(dense.shape[1]), 0.0
        self.constant = float(labels[0]) if len(labels) and len(set(labels.tolist())) == 1 else (None if len(labels) else 0.0)
        if self.constant is not None:
            return
        weights = np.ones(len(labels)) if weights is None else weights / weights.mean()
        scale = evidence(rows, labels, weights)
        rows = [r[scale[r] != 0] for r in rows]
        gw, gv, gb = np.full(SLOTS, 1e-6), np.full(dense.shape[1], 1e-6), 1e-6
        rng = np.random.default_rng(0)
        for _ in range(EPOCHS):
            order = rng.permutation(len(rows))
            for batch in np.array_split(order, max(1, len(order) // 32)):
                index = np.concatenate([rows[i] for i in batch])
                owner = np.repeat(np.arange(len(batch)), [len(rows[i]) for i in batch])
                z = self.b + dense[batch] @ self.v + np.bincount(owner, self.w[index] * scale[index], len(batch))
                error = (_sigmoid(z) - labels[batch]) * weights[batch]
                used, at = np.unique(index, return_inverse=True)
                grad = np.bincount(at, error[owner], len(used)) * scale[used] / len(batch) + 1e-5 * self.w[used]
                gw[used] += grad**2
                self.w[used] -= 0.1 * grad / np.sqrt(gw[used])
                grad = error @ dense[batch] / len(batch)
                gv += grad**2
                self.v -= 0.1 * grad / np.sqrt(gv)
                grad = float(error.mean())
                gb += grad**2
                self.b -= 0.1 * grad / math.sqrt(gb)
        self.w *= scale

    def probability(self, sums: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """sums: of the slots' weights, by row."""
        return _probability(sums, dense, self.v, self.b, self.constant)


def fit_chain(rows: list, labels: np.ndarray, folds: np.ndarray, weights: np.ndarray | None = None) -> tuple[list, np.ndarray]:
    """The models in chain order and all out-of-fold probabilities (rows x categories)."""
    weights = np.ones(len(rows)) if weights is None else weights
    dense, models = np.zeros((len(rows), 0)), []
    for c in range(labels.shape[1]):
        y, out = labels[:, c], np.zeros(len(rows))
        for fold in range(FOLDS):
            train, test = np.flatnonzero(folds != fold), np.flatnonzero(folds == fold)
            if len(test):
                m = LinearModel([rows[i] for i in train], dense[train], y[train], weights[train])
                out[test] = m.probability(np.array([m.w[rows[i]].sum() for i in test]), dense[test])
        models.append(LinearModel(rows, dense, y, weights))
        dense = np.column_stack([dense, out])
    return models, dense


def _featurise(batches):
    schema = pa.schema([("slots", pa.list_(pa.int32())), ("fold", pa.int32()), ("marks", pa.list_(pa.float64())), ("weight", pa.float64())])
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        folds = [zlib.crc32(t.encode("utf-8", "surrogatepass")) // 7 % FOLDS for t in texts]
        yield pa.RecordBatch.from_arrays(
            [pa.array([features(t) for t in texts], schema[0].type), pa.array(folds, pa.int32()), batch.column("marks").cast(schema[2].type), batch.column("weight")], schema=schema
        )


def weighed_sample(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels, folds of the bounded sample of labelled documents, and how many labelled rows each stands for."""
    marks = F.array(*[F.expr(f"CAST({test} AS DOUBLE)") for _, test in CATEGORIES])
    known = labels.where("doc_id is not null and quality is not null and toxic is not null").select("doc_id", "quality", "toxic").distinct()
    known = stored(known.join(docs.where("doc_id is not null").select("doc_id"), "doc_id", "left_semi"), "toxicity-labelled")
    counts = known.groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("labelled"))
    by_hash = Window.partitionBy("quality", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        known.withColumn("place", F.row_number().over(by_hash)).where(F.col("place") <= size)
        .join(F.broadcast(counts), ["quality", "toxic"])  # a row for each combination of labels
        .select("doc_id", marks.alias("marks"), (F.col("labelled") / F.least(F.col("labelled"), F.lit(size))).alias("weight"))
    )
    # at most ``size`` rows of each combination of labels: small enough to send to every task
    texts = docs.select("doc_id", F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id").select("text", "marks", "weight")
    got = texts.mapInArrow(_featurise, "slots array<int>, fold int, marks array<double>, weight double").toArrow()
    slots = got.column("slots").combine_chunks()
    values, ends = slots.values.to_numpy().astype(np.int64), slots.offsets.to_numpy()
    rows = [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    order = sorted(range(len(rows)), key=lambda i: rows[i].tobytes())  # the same whatever the partitions
    marks = np.array(got.column("marks").to_pylist(), float).reshape(len(rows), len(CATEGORIES))
    folds = np.array(got.column("fold").to_pylist(), np.int64)
    weights = np.array(got.column("weight").to_pylist(), float)
    return [rows[i] for i in order], marks[order], folds[order], weights[order]


def sampled(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> tuple[list, np.ndarray, np.ndarray]:
    """Features, labels and folds of the bounded sample of labelled documents."""
    return weighed_sample(docs, labels, size)[:3]


def _scorer(models: list):
    """Function from texts to probabilities (texts x categories). models: (w, v, b, constant) of each."""
    weights = np.stack([w for w, *_ in models], axis=1)
    known: dict = {}  # word to its row in sums_of
    sums_of = np.zeros((_KNOWN_WORDS, len(models)))

    def run(texts: list) -> np.ndarray:
        sums = np.zeros((len(texts), len(models)))
        for i, text in enumerate(texts):
            words = _WORD.findall(text.lower())
            total = weights[list(_shape(text, words))].sum(axis=0)
            distinct = set(words)
            new = distinct.difference(known)
            if len(known) + len(new) > _KNOWN_WORDS:
                known.clear()
                new = distinct
            if len(new) > _KNOWN_WORDS:  # one text with more distinct words than are kept
                sums[i] = total + sum(weights[list(_slots(w))].sum(axis=0) for w in distinct)
                continue
            for w in new:
                sums_of[len(known)] = weights[list(_slots(w))].sum(axis=0)
                known[w] = len(known)
            sums[i] = total + sums_of[[known[w] for w in distinct]].sum(axis=0)
        dense = np.zeros((len(texts), 0))
        for c, (_, *rest) in enumerate(models):
            dense = np.column_stack([dense, _probability(sums[:, c], dense, *rest)])
        return np.round(dense, 9)  # sums of the same weights in another order end alike

    return run


def _by_batch(shared, column: int, run):
    def each(batches):
        score, limit = _scorer(shared.value[0]), shared.value[1]
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield run(part, score([t or "" for t in part.column(column).to_pylist()]), limit)

    return each


def best_limit(p: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None) -> float:
    """The limit with the best F1 of out-of-fold probabilities; of equal ones that nearest to a half."""
    w = np.ones(len(p)) if weights is None else weights
    tried = np.arange(1, 20) / 20
    f1 = [2 * (w * y)[p >= t].sum() / max(1.0, w[p >= t].sum() + (w * y).sum()) for t in tried]
    return float(min(zip(tried, f1, strict=True), key=lambda x: (-x[1], abs(x[0] - 0.5)))[0])


def fit(docs: DataFrame, labels: DataFrame):
    """The chain fitted on the labelled rows of ``docs`` and the limit of rejection, as a broadcast."""
    rows, marks, folds, weights = weighed_sample(docs, labels)
    models, out_of_fold = fit_chain(rows, marks, folds, weights)
    decides = [name for name, _ in CATEGORIES].index(DECIDES)
    limit = best_limit(out_of_fold[:, decides], marks[:, decides], weights)
    return docs.sparkSession.sparkContext.broadcast(([(m.w, m.v, m.b, m.constant) for m in models], limit))


def probabilities(docs: DataFrame, chain) -> DataFrame:
    """doc_id, p_<category> of each category, and whether the text is rejected as toxic."""
    names = [name for name, _ in CATEGORIES]
    decides = names.index(DECIDES)
    schema = pa.schema([("doc_id", pa.int64())] + [(f"p_{n}", pa.float64()) for n in names] + [("toxic", pa.bool_())])

    def run(batch, p, limit):
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(p[:, c]) for c in range(p.shape[1])), pa.array(p[:, decides] >= limit)], schema=schema)

    wanted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    kinds = ", ".join(f"p_{n} double" for n in names)
    return wanted.mapInArrow(_by_batch(chain, 1, run), f"doc_id long, {kinds}, toxic boolean")


def without_toxic(docs: DataFrame, chain) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    decides = [name for name, _ in CATEGORIES].index(DECIDES)
    keep = _by_batch(chain, docs.columns.index("text"), lambda batch, p, limit: batch.filter(pa.array(p[:, decides] < limit)))
    return docs.mapInArrow(keep, docs.schema)
