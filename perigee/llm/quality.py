"""Text quality by how well a text compresses after good and after bad examples.

A zstandard dictionary is built from labelled good texts and another from bad ones. A text is cut
into blocks, each is compressed with either, and the difference of the compressed sizes, over their
sum, tells which kind the text resembles. Blocks keep a long text from teaching the compressor its
own words, so the dictionaries count for all of it. Four measures of a text (that difference, the
worst block's, compressed size over size, and the logarithm of its size) become a calibrated score
by logistic regression.

Fitting takes a bounded sample: of each label, the ``SAMPLE`` labelled documents with the smallest
hashed doc_id. By their text they fall in two halves. One gives the dictionaries: of each document
a block of ``BLOCK`` bytes, the one with the smallest hash. The other, measured whole where it lies,
gives the calibration, which thus sees texts that the dictionaries don't hold. Each sampled row weighs as many labelled
rows as it stands for. The driver gets 2 * ``SAMPLE`` blocks and as many rows of four numbers.
Every document is then scored in one scan, over its whole text.

Which documents may be learned from is decided by ``learnable``; labels, language, source and
doc_id are no inputs of a score.

Defined results. Null text: as the empty one, which has a score by its measures like any other.
Null doc_id: scored, not held out, not learned from. Labels that are null, without a document, or
contradict each other for a doc_id don't count; repeated labels count once. A doc_id with several
texts is learned from by one of them. Repeated rows are each scored. Without labels of both kinds
on both halves every score is the share of good labels, or 0.5 without any. Empty table: no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import stored

#: Labelled documents of each label that are learned from.
SAMPLE = 4000
#: Bytes of a block, and of a dictionary at most.
BLOCK = 2048
DICTIONARY = 1 << 16
LEVEL = 3
GOOD_FROM = 0.7
MEASURES = 4


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def blocks(text: str) -> list[bytes]:
    data = text.encode("utf-8", "surrogatepass")
    return [data[at : at + BLOCK] for at in range(0, len(data), BLOCK)] or [b""]


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; from too few samples to train on, the samples themselves."""
    samples = sorted(samples)
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def compressor(data: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(data) if data else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False)


def measurer(dictionaries: tuple[bytes, bytes]):
    """Function from texts to their measures. dictionaries: of bad texts, of good ones."""
    bad, good = (compressor(d) for d in dictionaries)

    def run(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), MEASURES))
        for i, text in enumerate(texts):
            parts = blocks(text)
            b = np.array([len(bad.compress(p)) for p in parts], float)
            g = np.array([len(good.compress(p)) for p in parts], float)
            size = sum(map(len, parts))
            out[i] = (b.sum() - g.sum()) / (b.sum() + g.sum()), ((b - g) / (b + g)).min(), g.sum() / (size + 64), np.log(size + 1)
        return out

    return run


def _inputs(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), (x - mean) / scale])


def _curve(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def calibration(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression of labels on standardised measures, by Newton's steps with a small ridge: mean, scale, weights."""
    weights = weights / weights.mean()
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    a = _inputs(x, mean, scale)
    w = np.zeros(a.shape[1])
    for _ in range(50):
        p = _curve(a @ w)
        slope = a.T @ (weights * (p - y)) + 0.01 * w
        bend = (a.T * (weights * p * (1 - p))) @ a + 0.01 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w - step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-10:
            break
    return mean, scale, w


def labelled(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> tuple[DataFrame, dict]:
    """The sampled ids with their labels (``good``), and the number of labelled documents of each label."""
    clean = labels.where("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    clean = clean.agg(F.min("quality").cast("int").alias("good"), F.max("quality").cast("int").alias("most")).where("good = most").drop("most")
    clean = clean.where(~held_out(F.col("doc_id")))
    known = stored(clean.join(docs.select(F.col("doc_id").cast("long")), "doc_id", "left_semi"), "quality-labelled")
    counts = {r["good"]: r["count"] for r in known.groupBy("good").count().collect()}
    first = [known.where(F.col("good") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size) for y in (0, 1)]
    return stored(first[0].unionByName(first[1]), "quality-sample"), counts


def _examples(batches):
    """Of each document, its half, and the block with the smallest hash."""
    schema = pa.schema([("doc_id", pa.int64()), ("good", pa.int32()), ("half", pa.int32()), ("block", pa.binary())])
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        half = [_half(t) for t in texts]
        chosen = [min(blocks(t), key=lambda p: (zlib.crc32(p), p)) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("good"), pa.array(half, pa.int32()), pa.array(chosen, pa.binary())], schema=schema)


def _half(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass")) >> 7 & 1


def _measured(shared):
    """Measures of the documents of the second half."""
    schema = pa.schema([("doc_id", pa.int64()), ("good", pa.int32()), ("x", pa.list_(pa.float64()))])

    def run(batches):
        measure = measurer(shared.value)
        for batch in batches:
            batch = batch.filter(pa.array([_half(t or "") == 1 for t in batch.column("text").to_pylist()], pa.bool_()))
            x = measure([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("good"), pa.array(x.tolist(), schema[2].type)], schema=schema)

    return run


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE):
    """Dictionaries, calibration (None if there is none) and the share of good labels, as a broadcast."""
    spark = docs.sparkSession
    sample, counts = labelled(docs, labels, size)
    share = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    # at most ``size`` rows of each label
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(sample), "doc_id")
    one = F.min(F.struct("half", "block")).alias("e")
    examples = texts.mapInArrow(_examples, "doc_id long, good int, half int, block binary").groupBy("doc_id", "good").agg(one).where("e.half = 0").collect()
    samples = [[bytes(r["e"]["block"]) for r in examples if r["good"] == y] for y in (0, 1)]
    if not all(samples):
        return spark.sparkContext.broadcast(((b"", b""), None, share))
    dictionaries = tuple(dictionary(s) for s in samples)
    measured = texts.mapInArrow(_measured(spark.sparkContext.broadcast(dictionaries)), "doc_id long, good int, x array<double>")
    rows = sorted((r["doc_id"], r["good"], r["x"]) for r in measured.groupBy("doc_id", "good").agg(F.min("x").alias("x")).collect())
    y = np.array([r[1] for r in rows], float)
    if len(set(y.tolist())) < 2:
        return spark.sparkContext.broadcast((dictionaries, None, share))
    seen = {label: max(1, int((y == label).sum())) for label in (0, 1)}
    weights = np.array([counts[int(label)] / seen[int(label)] for label in y])
    return spark.sparkContext.broadcast((dictionaries, calibration(np.array([r[2] for r in rows]), y, weights), share))


def scores(docs: DataFrame, model) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def run(batches):
        dictionaries, fitted, share = model.value
        measure = measurer(dictionaries)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                score = np.full(part.num_rows, float(share))
                if fitted is not None:
                    mean, scale, w = fitted
                    score = np.round(_curve(_inputs(measure([t or "" for t in part.column("text").to_pylist()]), mean, scale) @ w), 9)
                predicted = pa.array((score >= GOOD_FROM).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(score), predicted], schema=schema)

    wanted = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id").cast("long")).alias("held_out"), F.col("text").cast("string"))
    return wanted.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
