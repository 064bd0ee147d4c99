"""Counts against the library, for whole texts and every prefix."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from perigee.llm import token_counts as T

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def count():
    whole = Tokenizer.from_file(PATH)
    return lambda t: len(whole.encode(t, add_special_tokens=False).ids)


def samples(seed, size):
    rnd = random.Random(seed)
    alphabet = ["the", "ing", "'s", "'re", "'", "é", "É", "½", "1", "_", "-", ".", " ", "\n", "\t", "<|endoftext|>", "<|start", "Σ", "İ", "́", "東", "\x1c", "\xa0", "​", "s"]
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(12))) for _ in range(size)]


def test_totals_prefixes_and_budgets(count):
    c = T.PrefixCounter(PATH)
    for t in samples(1, 700):
        table = c.table(t)
        assert c.totals([t]) == [count(t)]
        for k in range(len(t) + 1):
            assert c.at(t, k, table) == count(t[:k])
        for budget in range(6):
            n = c.fitting(t, budget, table)
            assert count(t[:n]) <= budget or n == 0


def test_rows(make, count):
    long = "alpha beta, gamma " * 60_000
    rows = [(i, t) for i, t in enumerate(samples(2, 300))] + [(None, "it's"), (1000, None), (1001, ""), (3, "again"), (1002, long)]
    got = T.token_counts(make(rows, "doc_id long, text string"), PATH, 50).collect()
    want = [(d, len((t or "").encode()), count(t or ""), count(t or "") > 50) for d, t in rows]
    assert sorted((tuple(r)[:4] for r in got), key=str) == sorted(want, key=str)
    cut = next(r["fitting_chars"] for r in got if r["doc_id"] == 1002)
    assert count(long[:cut]) <= 50 < count(long[: cut + 12])
    assert T.token_counts(make([], "doc_id long, text string"), PATH).collect() == []


def test_forgetting_words_changes_nothing(count, monkeypatch):
    monkeypatch.setattr(T, "_KNOWN_WORDS", 5)
    c, texts = T.PrefixCounter(PATH), samples(3, 100) + ["a b c d e f g h"]
    assert c.totals(texts) == [count(t) for t in texts]
