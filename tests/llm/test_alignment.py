"""Alignment of two tokenizers against a byte-by-byte comparison."""

import hashlib
import random
import time
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from perigee.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"


def plain(rows):
    """Token bytes, groups and links straight from the definition, by the libraries of the two files."""
    tokenizer, pieces = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tokenizer.encode_special_tokens = True
    alphabet = alignment.byte_alphabet()
    docs = []
    for doc_id, text in rows:
        wanted = b" " + (text or "").encode()
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        bytes_a = [bytes(alphabet[c] for c in tokenizer.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, pieces.id_to_piece(i)) for i in b)]
        if not text or b"".join(bytes_a) != wanted or b"".join(bytes_b) != wanted:
            docs.append((doc_id, [], [], [], []))
            continue
        owner = [[i for i, t in enumerate(side) for _ in t] for side in (bytes_a, bytes_b)]
        links = sorted(set(zip(*owner, strict=True)))
        ends = [{sum(map(len, side[: i + 1])) for i in range(len(side))} for side in (bytes_a, bytes_b)]
        groups, start = [], 0
        for end in sorted(ends[0] & ends[1]):
            here = [sorted({o for o in side[start:end]}) for side in owner]
            groups.append(",".join(str(a[i]) for i in here[0]) + "|" + ",".join(str(b[i]) for i in here[1]))
            start = end
        docs.append((doc_id, a, b, groups, [(a[i], b[j]) for i, j in links]))
    counts = Counter(pair for *_, links in docs for pair in links)
    highest = {}
    for (_, j), n in counts.items():
        highest[j] = max(n, highest.get(j, 0))
    return [
        (doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")
        for doc_id, a, b, groups, links in docs
    ]


def texts(seed):
    rnd = random.Random(seed)
    words = ["the", "unlikely", "Straße", "naïve", "l'été", "don't", "3.14159", "你好世界", "\U0001f600", "السلام", "x" * 30, "é", "###", " ", "<s>", "<|endoftext|>", "<0x41>", "\x00", "İ", "​"]
    spaces = [" ", " ", " ", "  ", "\n", "\t", " \n  ", ""]
    rows = [(i, "".join(rnd.choice(words) + rnd.choice(spaces) for _ in range(rnd.randrange(1, 60)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " "), (103, "   "), (104, "a▁b"), (105, "▁"), (106, "\n"), (107, " lead and trail "), (None, "no id"), rows[0], rows[0]]
    return rows + [(200 + i, "the same words again and again") for i in range(20)]


@pytest.mark.parametrize(("seed", "block", "remembered"), [(1, 1 << 20, 150_000), (2, 40, 50)])
def test_equals_the_definition(make, monkeypatch, seed, block, remembered):
    monkeypatch.setattr(alignment, "REMEMBERED", remembered)
    rows = texts(seed)
    got = alignment.alignments(make(rows, SCHEMA), A, B, block=block).collect()
    assert sorted(map(tuple, got), key=str) == sorted(plain(rows), key=str)


def test_empty_table(make):
    assert alignment.alignments(make([], SCHEMA), A, B).collect() == []


def test_both_libraries_of_a_agree():
    a = alignment.ByteTokens(A)
    assert a.fast is not None
    rnd = random.Random(3)
    plain_characters = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xA1, 0x180), 0x2019, 0x20AC]]
    for _ in range(400):
        t = "".join(rnd.choices(plain_characters, k=rnd.randrange(80))) + " " + "".join(rnd.choices(" \n'aes1.", k=20))
        assert a.encode([t]) == [a.tokenizer.encode(t, add_special_tokens=False).ids]


def test_very_long_text_without_spaces():
    aligner = alignment.Aligner(A, B)
    text = "ab1é" * 50_000
    found = aligner.documents([text, "", "short one"])
    (_, n_a, n_b, n_groups, *_), (_, short, *_) = plain([(1, text[:400])])[0], plain([(2, "short one")])[0]
    assert n_a > 0 and found["n_a"][0] > n_a and found["n_groups"][0] > n_groups and found["n_b"][0] > n_b and found["n_a"][2] == short
    assert found["n_links"][0] == found["n_a"][0] + found["n_b"][0] - found["n_groups"][0]


def test_words_not_met_before_cost_little_beside_the_tokenizers():
    aligner, rnd = alignment.Aligner(A, B), random.Random(4)
    letters = [chr(c) for c in range(ord("a"), ord("z") + 1)]
    words = lambda: " ".join("".join(rnd.choices(letters, k=rnd.randrange(4, 12))) for _ in range(2000))
    chunks = [[words() for _ in range(10)] for _ in range(4)]
    aligner.documents(chunks[0])
    spent = []
    for work in (aligner.tokens, aligner.documents):
        start = time.process_time()
        for chunk in chunks[1:]:
            work(chunk)
        spent.append(time.process_time() - start)
    assert spent[1] < 2 * spent[0]
