"""Language identification: gram counts against a plain count, and accuracy on rows that were not learned."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from boardlake.llm import language

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, score string, nearest int"


def plain_grams(text: str) -> set[tuple[str, int]]:
    """Every gram of 1 to 3 characters with its count, gaps as one blank."""
    line = " "
    for c in text.lower() + " ":
        c = c if c.isalpha() else " "
        line += c if c != " " or line[-1] != " " else ""
    grams = [line[i : i + n] for n in (1, 2, 3) for i in range(len(line) - n + 1) if line[i : i + n] != " "]
    return {(g, grams.count(g)) for g in set(grams)}


@pytest.mark.parametrize("text", ["", "Añb, c", "  The cat -- THE hat. ", "x" * 5, "12 34", "日本 の"])
def test_grams_are_counted_whole_and_in_chunks(monkeypatch, text):
    whole, lettered = language.gram_counts(text)
    assert lettered == any(c.isalpha() for c in text)
    if lettered:
        assert sorted(whole[whole > 0]) == sorted(n for _, n in plain_grams(text))
    for size in (1, 2, 3):
        monkeypatch.setattr(language, "CHUNK", size)
        assert (language.gram_counts(text)[0] == whole).all()


def corpus(n: int = 60) -> list[tuple]:
    words = {"aa": "kalo miru tesa nopi", "bb": "strug blenk grift whond"}
    rows = [(i, " ".join(np.random.default_rng(i).permutation(words[x].split())) + " " + words[x][: i % 9], x, None, None) for i, x in zip(range(n), ["aa", "bb"] * n)]
    return rows + [(i + 1000, rows[0][1], "aa", None, None) for i in range(n)]  # one text fills half of the table


def test_nulls_empty_and_strange_texts(spark):
    rows = corpus() + [(None, "kalo miru", "aa", None, None), (5, "tesa", None, None, None), (6, None, "aa", None, None), (6, None, "aa", None, None), (7, "", "bb", None, None), (8, "12 ?!", "bb", None, None), (9, "ЖЩЮ ЩЫЪ", None, None, None), (10, "grift " * 200_000, None, None, None), (11, "🙂", None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = language.fit(docs, per_language=20)
    assert set(model.languages) == {"aa", "bb"}
    found = {(r.id, r.score > 0): r for r in language.identify(docs, model).collect()}
    for key in (6, 7, 8, 11):
        assert (found[key, False].lang, found[key, False].nearest, found[key, False].score) == (None, None, 0.0)
    assert found[None, True].lang == "aa" and found[5, True].nearest == "aa" and found[10, True].nearest == "bb"
    strange = [r for (key, _), r in found.items() if key == 9][0]
    assert strange.rejected and strange.lang is None and strange.nearest in ("aa", "bb")
    assert language.identify(docs, model).count() == len(rows)


def test_model_is_the_same_for_any_partitioning_and_empty_without_rows(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    one, two = language.fit(docs.repartition(5)), language.fit(docs.coalesce(1))
    assert one.languages == two.languages and (one.centroids == two.centroids).all() and (one.idf == two.idf).all()
    none = language.fit(docs.limit(0))
    assert none.languages == [] and language.identify(docs, none).filter("nearest IS NOT NULL").count() == 0
    assert language.identify(docs.limit(0), one).count() == 0


def test_sample_is_bounded_and_every_language_has_its_turn(spark):
    docs = spark.createDataFrame([(i, f"text {chr(97 + i % 26)}{chr(97 + i // 26 % 26)} word", f"l{i % 7}", None, None) for i in range(300)], SCHEMA)
    sample = language._sample(docs, 5, 14).groupBy("lang").count().collect()
    assert sorted(r["count"] for r in sample) == [2] * 7


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # Languages of held-out rows are spoilt first: they must not matter.
    model = language.fit(docs.withColumn("lang", F.when(language.may_learn(F.col("doc_id")), F.col("lang")).otherwise("spoilt")))
    found = language.identify(docs, model).withColumnRenamed("id", "doc_id").drop("lang").join(docs, "doc_id").filter(~language.may_learn(F.col("doc_id")))
    assert found.filter(F.col("nearest") == F.col("lang")).count() >= 0.98 * found.count()
    assert found.filter("rejected").count() <= 0.01 * found.count()
