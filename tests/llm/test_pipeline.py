"""The corpus pipeline: each stage's decisions, on planted rows and on the smallest tables."""

import random
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline as C
from checks.compare import compare

SMALL = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SMALL).exists(), reason="driver tables not present")


@pytest.fixture
def planted(spark, tmp_path):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abcdefghijkl") for _ in range(rnd.randrange(3, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    texts = [prose(60) for _ in range(150)]
    toxic = [i for i in range(150) if i % 5 == 0]
    for i in toxic:
        texts[i] += " vilxen vilxing vilxa"
    passage = prose(20)
    texts[1], texts[2] = texts[1] + " " + passage, texts[3] + " mail me@home.org"
    texts[4] = texts[6]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(texts)] + [(7, texts[7], "en", "s1", len(texts[7])), (None, "no id here", None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path), toxic


def test_planted_rows(spark, planted):
    folder, toxic = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, []
    for _, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept.append(sorted(r["doc_id"] for r in docs.collect() if r["doc_id"] is not None))
    everyone = set(range(150))
    assert set(kept[0]) == everyone - set(toxic)
    assert kept[1] == sorted(everyone - set(toxic) - {3, 6}) and kept[2] == kept[3] == [i for i in kept[1] if i != 1]
    assert any("<EMAIL>" in r["text"] for r in docs.collect())
    packed = C.STAGES[-1][1](spark, docs, folder).collect()
    assert {r["doc_id"] for r in packed} == set(kept[3]) | {None}


@needs_tables
def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SMALL)
    assert sorted(map(str, docs.collect())) == sorted(map(str, C.run(spark, SMALL).collect()))


@needs_tables
@pytest.mark.parametrize("name", ["op4_ngram_jaccard_join", "op6_warc", "op8_chat_formatting"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in Path(SMALL).glob("*.parquet"):
        con.sql(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    assert compare(spark, con, SMALL, name).startswith("ok")


def test_every_operator_is_registered():
    names = [n for n in contract.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in contract.queries()
    assert set(contract.oracle_sql()) <= set(contract.queries())
