"""Benchmark passages inside documents, by the q-gram lemma and banded alignment.

A passage of n characters that occurs with at most e edits keeps at least n - q + 1 - q*e of its
q-grams, and these lie on e + 1 neighbouring diagonals (place in the document minus place in the
passage). Every q-gram of a document is looked up among the passages' q-grams; hits are counted
in diagonal bands of width e + 1, of which neighbours are taken together, so that they overlap;
a band pair that reaches the bound is aligned, inside the diagonals that an occurrence with a
hit in the pair's lower band can touch: one band more on its lower side.

Passages are the query set. They are taken in blocks of ``BLOCK_CHARS`` characters, and every
block is broadcast and run against all documents, so memory does not grow with their number.
Documents are scanned whole where they lie: nothing is shuffled.

Texts are compared in lower case with every run of other ASCII characters than letters and
digits as one space, as UTF-8 bytes. The edit budget is ``rate`` times n, or what the lemma can
serve if that is less (short passages).

Defined results. Null or empty texts hold nothing. Passages that are null, or shorter than q
after normalising, are not searched: they identify nothing. Passages with equal text are each
reported. Repeated documents are each reported. Empty tables give empty results. Extra columns
of documents are kept by ``without_passages`` and ignored by ``passages_in``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perigee.llm.common import chunks_by_length

Q = 8
#: Characters of passages held at once.
BLOCK_CHARS = 1 << 22
#: Characters of documents scanned at once.
SCAN_CHARS = 1 << 21
_LETTERS = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else 32 for c in range(256))
_BITS = 20
_K = np.uint64(0x9E3779B97F4A7C15)


def normalise(text: str | None) -> bytes:
    return b" ".join((text or "").lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split())


def budget(n: int, rate: float) -> int:
    """Edits allowed in a passage of n characters, so that the lemma's bound stays positive."""
    return min(int(n * rate), (n - Q) // Q)


def _codes(text: bytes) -> np.ndarray:
    """All q-grams as integers: eight bytes each, read at every offset."""
    if len(text) < Q:
        return np.zeros(0, np.uint64)
    return np.ndarray((len(text) - Q + 1,), "<u8", buffer=text, strides=(1,)).copy()


def _slot(codes: np.ndarray) -> np.ndarray:
    return ((codes * _K) >> np.uint64(64 - _BITS)).astype(np.int64)


class PassageIndex:
    """The q-grams of one block of passages."""

    def __init__(self, items: list, rate: float):
        self.items = [(item_id, t, budget(len(t), rate)) for item_id, t in items]
        codes = [_codes(t) for _, t, _ in self.items]
        every = np.concatenate(codes) if codes else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        place = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.codes, first, self.many = np.unique(every[order], return_index=True, return_counts=True)
        self.first = first.astype(np.int64)
        self.owner, self.place = owner[order].astype(np.int64), place[order].astype(np.int64)
        self.some = np.zeros(1 << _BITS, bool)
        self.some[_slot(self.codes)] = True
        self.step = np.array([e + 1 for _, _, e in self.items], np.int64)
        self.need = np.array([len(t) - Q + 1 - Q * e for _, t, e in self.items], np.int64)
        self.gap = bytes(Q + int(self.step.max(initial=0)))  # crossing it costs more than any budget

    def bands(self, codes: np.ndarray):
        """(item, band) of the band pairs that hold enough shared q-grams."""
        at = np.flatnonzero(self.some[_slot(codes)])
        if not len(at) or not len(self.codes):
            return np.zeros((0, 2), np.int64)
        known = np.minimum(np.searchsorted(self.codes, codes[at]), len(self.codes) - 1)
        real = self.codes[known] == codes[at]
        at, known = at[real], known[real]
        many = self.many[known]
        total = int(many.sum())
        if not total:
            return np.zeros((0, 2), np.int64)
        which = np.repeat(self.first[known] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(total)
        item = self.owner[which]
        # one band more, as diagonals may start before the text
        band = (np.repeat(at, many) - self.place[which]) // self.step[item] + (1 << 36)
        key, count = np.unique((item << 40) | band, return_counts=True)
        item, band = key >> 40, (key & ((1 << 40) - 1)) - (1 << 36)
        after = np.zeros(len(key), np.int64)
        joined = key[1:] == key[:-1] + 1
        after[:-1][joined] = count[1:][joined]
        fits = count + after >= self.need[item]
        return np.stack([item[fits], band[fits]], axis=1)

    def aligned(self, text: bytes, item: int, bands: np.ndarray):
        """Fewest edits of the item around each band pair and where that alignment ends; budget + 1 if above."""
        _, passage, e = self.items[item]
        n, width = len(passage), 3 * (e + 1)
        start = (bands - 1) * (e + 1)
        edits, end = np.full(len(bands), e + 1), np.zeros(len(bands), np.int64)
        left = []
        for c, s in enumerate(start.tolist()):
            found = text.find(passage, max(0, s), max(0, s + n + width))
            if found >= 0:
                edits[c], end[c] = 0, found + n
            else:
                left.append(c)
        if not left or e == 0:
            return edits, end
        left = np.array(left)
        # diagonals may start before the text and end behind it
        padded = np.concatenate([np.zeros(2 * width, np.uint8), np.frombuffer(text, np.uint8), np.zeros(n + 2 * width, np.uint8)])
        first = start[left] + 2 * width
        k = np.arange(width, dtype=np.int16)
        row = np.zeros((len(left), width), np.int16)
        for i, letter in enumerate(passage):
            there = padded[first[:, None] + (i + k)[None, :]]
            best = row + (there != letter)
            best[:, :-1] = np.minimum(best[:, :-1], row[:, 1:] + 1)
            row = np.minimum.accumulate(best - k, axis=1) + k
            low = row.min(axis=1) <= e
            if not low.all():
                row, first, left = row[low], first[low], left[low]
                if not len(left):
                    return edits, end
        at = row.argmin(axis=1)
        edits[left] = row[np.arange(len(left)), at]
        end[left] = first - 2 * width + n + at
        return edits, end

    def found(self, texts: list):
        """(place of the text, item, edits, start, stop) of the best occurrence of each passage in each text."""
        best = {}
        for a, b in chunks_by_length(texts, SCAN_CHARS):
            parts = [normalise(t) for t in texts[a:b]]
            begin = np.cumsum([0] + [len(p) + len(self.gap) for p in parts])[:-1]
            whole = self.gap.join(parts)
            near = self.bands(_codes(whole))
            for item in np.unique(near[:, 0]).tolist():
                edits, end = self.aligned(whole, item, near[near[:, 0] == item, 1])
                _, passage, e = self.items[item]
                for d, stop in zip(edits.tolist(), end.tolist(), strict=True):
                    if d <= e:
                        doc = int(np.searchsorted(begin, max(0, stop - 1 - len(passage) // 2), side="right")) - 1
                        stop -= int(begin[doc])
                        hit = (d, max(0, stop - len(passage)), stop)
                        best[a + doc, item] = min(best.get((a + doc, item), hit), hit)
        return [(doc, item, *hit) for (doc, item), hit in sorted(best.items())]


def _blocks(items: DataFrame):
    """The passages, normalised, a block at a time."""
    block, size = [], 0
    for row in items.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        t = normalise(row["text"])
        if len(t) >= Q:
            block.append((row["item_id"], t))
            size += len(t)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _find(shared):
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())])

    def run(batches):
        index = PassageIndex(*shared.value)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            hits = index.found([t or "" for t in batch.column("text").to_pylist()])
            rows = [(ids[d], index.items[i][0], edits, start, stop) for d, i, edits, start, stop in hits]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)] if rows
                                             else [pa.array([], f.type) for f in schema], schema=schema)

    return run


def passages_in(docs: DataFrame, items: DataFrame, rate: float = 0.1) -> DataFrame:
    """doc_id, item_id, edits, start, stop: the best occurrence of every passage in every document that holds it.

    start and stop are byte places in the normalised text; the start is estimated from the end.
    """
    spark, out = docs.sparkSession, None
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    for block in _blocks(items):
        found = texts.mapInArrow(_find(spark.sparkContext.broadcast((block, rate))), "doc_id long, item_id long, edits int, start long, stop long")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "doc_id long, item_id long, edits int, start long, stop long")
    return out


def _clean(shared, at: int):
    def run(batches):
        index = PassageIndex(*shared.value)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for hit in index.found([t or "" for t in batch.column(at).to_pylist()]):
                keep[hit[0]] = False
            yield batch.filter(pa.array(keep))

    return run


def without_passages(docs: DataFrame, items: DataFrame, rate: float = 0.1) -> DataFrame:
    """The rows of ``docs`` that hold no passage, with all their columns."""
    for block in _blocks(items):
        docs = docs.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast((block, rate)), docs.columns.index("text")), docs.schema)
    return docs
