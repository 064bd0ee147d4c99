"""The n-gram join against all pairs compared one by one."""

import random
import re

import pytest

from perigee.llm import ngram_join
from perigee.llm.components import components

SCHEMA = "doc_id long, text string"


def by_pairs(rows, n, num, den):
    sets = []
    for _, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()})
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        out.append((doc_id, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc_id))
    return sorted(out, key=str)


def near_copies(seed):
    rnd = random.Random(seed)
    vocabulary = [f"W{i}" if i % 3 else f"wé{i}" for i in range(300)]
    bases = [[rnd.choice(vocabulary) for _ in range(size)] for size in (3, 9, 40, 120)]
    passage = [rnd.choice(vocabulary) for _ in range(20)]
    rows = []
    for i in range(260):
        words = list(rnd.choice(bases)) if rnd.random() < 0.7 else [rnd.choice(vocabulary) for _ in range(rnd.randrange(80))]
        if rnd.random() < 0.4:
            words += passage
        for _ in range(rnd.randrange(5)):
            if words:
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        rows.append((i * 3, rnd.choice([" ", "\n", "\t "]).join(words)))
    return rows + [(9001, None), (9002, ""), (9003, " \n"), (None, rows[5][1]), (None, None), rows[7], rows[7], (9004, "one"), (9005, "ONE")]


@pytest.mark.parametrize(("seed", "rule", "often", "salt"), [(1, (4, 85, 100), 8, 1 << 16), (2, (5, 80, 100), 3, 20)])
def test_equals_all_pairs(make, monkeypatch, seed, rule, often, salt):
    monkeypatch.setattr(ngram_join, "FREQUENT_FROM", often)
    monkeypatch.setattr(ngram_join, "BUCKET", often)
    monkeypatch.setattr(ngram_join, "SIDE", salt)
    monkeypatch.setattr(ngram_join, "ROWS_PER_SALT", salt)
    rows = near_copies(seed)
    got = [tuple(r) for r in ngram_join.ngram_components(make(rows, SCHEMA), *rule).collect()]
    assert sorted(got, key=str) == by_pairs(rows, *rule)


def test_empty_table(make):
    assert ngram_join.ngram_components(make([], SCHEMA)).collect() == []


def test_very_long_text_is_used_whole():
    words = " ".join(f"a{i}" for i in range(200_000))
    changed = words.rsplit(" ", 1)[0] + " other"
    a, b = ngram_join.token_sets([words, changed], 4)
    assert len(a) == len(b) == 199_997 and len(set(a.tolist()) ^ set(b.tolist())) == 2


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(200, 200), (7, 7), (139, 300), (None, 3)]
    got = dict(components(spark.createDataFrame(links, "u long, v long")).collect())
    assert got == {i: 0 for i in range(51)} | {i: 100 for i in [*range(100, 140), 300]} | {200: 200}


WORDS = [f"word{i}" for i in range(400)]


def prose(start, size=60, change=()):
    words = WORDS[start : start + size]
    for at in change:
        words[at] = f"other{start}{at}"
    return " ".join(words)


def test_one_of_each_component_stays_and_nothing_else_goes(spark):
    a, b, c, d = prose(0), prose(100), prose(200), prose(300)
    rows = [(1, a), (2, a), (2, b), (3, c), (4, d), (4, prose(300, change=[30])), (5, ""), (5, ""), (6, None), (None, prose(60)), (None, prose(60)), (None, prose(60, change=[0])), (None, c), (7, prose(160)), (7, prose(160))]
    df = spark.createDataFrame([(*r, "x", None) for r in rows], "doc_id int, text string, class_of_text string, stays int").repartition(3)
    kept = ngram_join.without_near_duplicates(df)
    assert kept.columns == df.columns
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str)
    fours = [t for i, t in got if i == 4]
    nulls = [t for i, t in got if i is None]
    assert len(fours) == 1 and len(nulls) == 1 and nulls[0] != c
    assert [g for g in got if g[0] not in (4, None)] == sorted([(1, a), (2, b), (3, c), (5, ""), (5, ""), (6, None), (7, prose(160))], key=str)


def test_all_ids_alike_and_empty_table(spark):
    df = spark.createDataFrame([(i, prose(i % 3 * 70)) for i in range(30)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in ngram_join.without_near_duplicates(df).collect()) == [0, 1, 2]
    assert ngram_join.without_near_duplicates(df.limit(0)).collect() == []


def test_pairs_whose_parities_differ_in_the_highest_place(spark):
    """Each text has one copy with a word changed: whichever places the changed n-grams flip, it is found."""
    texts = [[f"t{k}w{i}" for i in range(100)] for k in range(60)]
    rows = [(2 * k + at, " ".join([*words[:50], f"new{k}", *words[51:]] if at else words)) for k, words in enumerate(texts) for at in (0, 1)]
    got = [tuple(r) for r in ngram_join.ngram_components(spark.createDataFrame(rows, SCHEMA), 4, 85, 100).collect()]
    assert sorted(got) == [(i, 97, i - i % 2) for i in range(120)]


@pytest.mark.parametrize("size", [100, 300])
def test_pairs_just_under_the_limit_cost_the_size_of_their_group(spark, monkeypatch, size):
    """Near copies with one or two words changed: similar to the text they come from, mostly not to each other."""
    rnd = random.Random(size)
    rows = [(i, prose(0, 150, rnd.sample(range(4, 140), rnd.choice([1, 2, 2, 2])))) for i in range(size)]
    emitted = []
    agree = ngram_join._Join.agree

    def counted(self, pairs):
        emitted.append(pairs.count())
        return agree(self, pairs)

    monkeypatch.setattr(ngram_join._Join, "agree", counted)
    got = [tuple(r) for r in ngram_join.ngram_components(spark.createDataFrame(rows, SCHEMA), 4, 85, 100).collect()]
    assert sorted(got, key=str) == by_pairs(rows, 4, 85, 100)
    assert sum(emitted) < 30 * size
