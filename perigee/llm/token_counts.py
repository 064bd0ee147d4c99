"""Exact token counts of every prefix of a text, by dynamic programming over its words.

The tokenizer splits a text into words before it merges, so the count of a prefix is the count
of its whole words plus that of the cut word's beginning. The table of a text holds the running
count at the end of every word; the counts of words are remembered, and only words not met
before reach the tokenizer. Length, truncation and budget questions are then look-ups.

Texts with characters outside a plain range (where lower-casing and white space are the same in
Python and in the tokenizer), or holding a special token's string, go through the tokenizer
whole; their table comes from its offsets.

Defined results. Null text: empty, 0 tokens. Null doc_id: kept. Repeated rows are each counted.
Empty table: empty result. Extra columns are ignored. Texts of any length are counted whole.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7e\\u00a1-\\u012f\\u0131-\\u0148\\u014a-\\u017f]*")
_KNOWN_WORDS = 500_000


class PrefixCounter:
    """Token counts by one tokenizer file (.json) that splits by a pattern and lower-cases."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = spec["pre_tokenizer"].get("pretokenizers", [spec["pre_tokenizer"]])
        kinds = [n["type"] for n in spec["normalizer"].get("normalizers", [spec["normalizer"]])]
        if steps[0]["type"] != "Split" or not steps[0]["invert"] or "Lowercase" not in kinds:
            raise ValueError("the word table needs a tokenizer that lower-cases and splits by a pattern of words")
        self.words = regex.compile(steps[0]["pattern"]["Regex"])
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.known: dict = {}

    def learn(self, words) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > _KNOWN_WORDS:
            self.known.clear()
            new = list(words)
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            self.known.update(zip(part, (len(e.ids) for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)), strict=True))

    def is_plain(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def totals(self, texts: list) -> list:
        """The last entry of every text's table."""
        split = [self.words.findall(t.lower()) if self.is_plain(t) else None for t in texts]
        out = []
        for text, words in zip(texts, split, strict=True):
            if words is None:
                out.append(len(self.tokenizer.encode(text, add_special_tokens=False).ids))
            else:
                out.append(int(self._running(words)[-1]) if words else 0)
        return out

    def _running(self, words: list) -> np.ndarray:
        known = self.known
        try:
            return np.cumsum([known[w] for w in words])
        except KeyError:
            self.learn(set(words))
            return np.cumsum([self.known[w] for w in words])

    def table(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """starts, ends (code points) and the running token count of the words of a text."""
        if self.is_plain(text):
            low = text.lower()
            spans = [m.span() for m in self.words.finditer(low)]
            counts = self._running([low[a:b] for a, b in spans]) if spans else np.zeros(0, np.int64)
            return np.array([a for a, _ in spans], np.int64), np.array([b for _, b in spans], np.int64), counts
        e = self.tokenizer.encode(text, add_special_tokens=False)
        offsets = np.array(e.offsets, np.int64).reshape(-1, 2)
        owner = np.array([-1 if w is None else w for w in e.word_ids])
        last = np.flatnonzero(np.append((owner[1:] != owner[:-1]) | (owner[1:] < 0), True)) if len(owner) else np.zeros(0, np.int64)
        last = last[np.append(offsets[last[:-1] + 1, 0] >= offsets[last[:-1], 1], True)] if len(last) else last  # not inside a character
        first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
        return offsets[first, 0], offsets[last, 1], last + 1

    def at(self, text: str, chars: int, table=None) -> int:
        """Tokens of ``text[:chars]``, exactly."""
        if not self.is_plain(text):
            return len(self.tokenizer.encode(text[:chars], add_special_tokens=False).ids)
        starts, ends, counts = table or self.table(text)
        whole = int(np.searchsorted(ends, chars, side="right"))
        total = int(counts[whole - 1]) if whole else 0
        if whole < len(starts) and starts[whole] < chars:
            cut = self.words.findall(text[int(starts[whole]) : chars].lower())
            total += int(self._running(cut)[-1]) if cut else 0
        return total

    def fitting(self, text: str, budget: int, table=None) -> int:
        """Characters up to the end of the last whole word that fits into the budget; all if everything fits."""
        _, ends, counts = table or self.table(text)
        if not len(counts) or counts[-1] <= budget:
            return len(text)
        whole = int(np.searchsorted(counts, budget, side="right"))
        return int(ends[whole - 1]) if whole else 0


_counters: dict = {}


def counter(path: str) -> PrefixCounter:
    """One counter for each file and process."""
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, and fitting_chars: how much of the text fits the limit, in whole words."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_()), ("fitting_chars", pa.int64())])

    def run(batches):
        count = counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [t or "" for t in part.column("text").to_pylist()]
                totals = count.totals(texts)
                fit = [count.fitting(t, limit) if n > limit else len(t) for t, n in zip(texts, totals, strict=True)]
                columns = [part.column("doc_id"), [len(t.encode("utf-8", "surrogatepass")) for t in texts], totals, [n > limit for n in totals], fit]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if isinstance(c, list) else c for c, f in zip(columns, schema, strict=True)], schema=schema)

    wanted = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return wanted.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fitting_chars long")
