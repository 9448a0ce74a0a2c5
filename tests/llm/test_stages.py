"""The stages one by one on planted rows, and the whole pipeline."""

import base64
import os
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from boardlake.llm import mixing, secrets, stages

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, text_key string, taken int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(1)
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(k, " ".join(words(rng, 40))) for k in range(5)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id bigint, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def words(rng, n):
    return [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randint(0, 4000)}" for _ in range(n)]


def frame(spark, texts, start=0):
    return spark.createDataFrame([(None if i is None else i + start, t, "en", "s", len(t or ""), "x", 1) for i, t in texts], SCHEMA)


def test_columns_stay(spark, folder):
    docs = frame(spark, [(i, t) for i, t in enumerate([None, "", "some words here", "w " * 50_000])] + [(None, "no id"), (None, "no id")])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        assert name == "mixing" or out.dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), folder).count() == 0


def test_toxic_go(spark, folder):
    rng = random.Random(2)
    texts = [(i, " ".join(words(rng, 20) + (["vile", "rotten"] if i % 4 == 0 else []))) for i in range(200)]
    kept = {r.doc_id for r in stages.drop_toxic(spark, frame(spark, texts), folder).collect()}
    assert kept == {i for i in range(200) if i % 4}


def edited(rng, text, n):
    out = text[:]
    for _ in range(n):
        out[rng.randrange(len(out))] = f"edit{rng.random()}"
    return out


def jaccard(a, b):
    x, y = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (a, b))
    return len(x & y) / len(x | y)


def test_one_of_near_copies(spark, folder):
    rng = random.Random(3)
    base = [words(rng, rng.randint(40, 400)) for _ in range(60)]
    texts, gone = list(enumerate(base)), set()
    for j in range(120):
        k = rng.randrange(20)
        copy = edited(rng, base[k], max(1, len(base[k]) // 80))
        if jaccard(copy, base[k]) >= 0.88:
            texts.append((100 + j, copy))
            gone.add(100 + j)
    texts += [(300 + j, base[30]) for j in range(500)] + [(900 + k, edited(rng, base[k], len(base[k]) // 8)) for k in range(40, 60)]
    gone |= {300 + j for j in range(500)}
    rows = [(i, " ".join(t)) for i, t in texts] + [(2000, None), (2001, ""), (2002, " \n"), (7, " ".join(base[7])), (None, " ".join(base[8])), (None, "alone without an id")]
    kept = stages.keep_one_of_near_copies(spark, frame(spark, rows), folder).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted({i for i, _ in texts} - gone | {2000})
    assert [r.text for r in kept if r.doc_id is None] == ["alone without an id"]


def test_leaks_go(spark, folder):
    rng = random.Random(4)
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    texts = [(i, " ".join(words(rng, 30)) + (" " + items[i % 5] if i % 3 == 0 else "")) for i in range(60)]
    assert {r.doc_id for r in stages.drop_benchmark_copies(spark, frame(spark, texts), folder).collect()} == {i for i in range(60) if i % 3}


def test_secrets_masked(spark, folder):
    key = base64.b64encode(random.Random(5).randbytes(30)).decode()
    texts = [(0, f"token={key} and more"), (1, "plain"), (2, None)]
    got = {r.doc_id: (r.text, r.n_chars) for r in stages.mask_secrets(spark, frame(spark, texts), folder).collect()}
    assert got == {0: ("[secret] and more", 17), 1: ("plain", 5), 2: (None, 0)}


def test_mix_matches_operator(spark, folder):
    rng = random.Random(6)
    docs = frame(spark, [(i, " ".join(words(rng, rng.randint(0, 90)))) for i in range(150)] + [(None, "a b c")]).withColumn("source", F.when(F.col("doc_id") % 2 == 0, "a"))
    plain = {(r.doc_id, r.size, r.taken) for r in mixing.mix_sources(docs).collect() if r.taken}
    assert {(r.doc_id, r.n_words, r._taken) for r in stages.mix(spark, docs, folder).collect()} == plain


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    assert out.columns == [*docs.columns, "n_words", "taken"]
    ids = [r.doc_id for r in rows]
    assert len(set(ids)) == len(ids) and 0 < len(ids) < docs.count()
    assert all(0 < r.taken <= 2 * r.n_words and len(r.text.split()) == r.n_words for r in rows)
    left = secrets.scan_secrets(out.select("doc_id", "text")).agg(F.sum("n_assign"), F.sum("n_access"), F.sum("n_hex")).first()
    assert list(left) == [0, 0, 0]
