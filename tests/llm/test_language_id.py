import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import DATA
from tests.llm.cases import SCHEMA, awkward_docs, no_docs
from tillwork.llm import language_id as lid
from tillwork.llm import queries
from tillwork.llm.texts import documents

GRAMS = lid.Grams()
MASK = (1 << 64) - 1
WORDS = {
    "en": "the and with thing house water under nothing which always".split(),
    "de": "und der nicht wasser haus immer über schön straße dass".split(),
    "fr": "le la avec eau maison toujours où été garçon leur".split(),
    "es": "el la con agua casa siempre dónde año señor más".split(),
    "xx": "qapla jatlh tlhingan hol dajatlhaa qaghaa batlh vay".split(),
}


def bucket(gram):
    h = len(gram)
    for c in gram:
        h = ((h ^ c) * 0x9E3779B97F4A7C15) & MASK
        h ^= h >> 29
    return h % lid.DIMENSIONS


def plain_counts(text):
    found = Counter()
    for word in re.findall(r"\w+", text.lower()):
        for run in "".join(c if c.isalpha() else " " for c in word).split():
            codes = [0, *map(ord, run), 0]
            for n in lid.LENGTHS:
                grams = [codes[k : k + n] for k in range(len(codes) - n + 1)]
                found.update(bucket(g) for g in grams if any(g))
    return found


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("aAbéßİΣ中 .\n1_²½́-", max_size=30), max_size=5))
def test_counts_equal_the_definition_whatever_lies_beside(texts):
    found = GRAMS.counts(texts)
    for row, text in zip(found, texts):
        assert {k: v for k, v in enumerate(row) if v} == dict(plain_counts(text))


def test_long_texts_are_cut_at_white_space():
    text = " ".join(random.Random(1).choices(WORDS["en"], k=5000))
    parts = lid.segments(text, 1000)
    assert "".join(parts) == text and all(len(p) <= 1000 and p.endswith(" ") for p in parts[:-1])
    assert [len(p) for p in lid.segments("a" * 2500, 1000)] == [1000, 1000, 500]
    long = "wort " * 800_000  # four million characters in one line
    assert (GRAMS.counts([long])[0] == 800_000 * GRAMS.counts(["wort"])[0]).all()
    assert len(np.flatnonzero(GRAMS.counts(["a" * 3_000_000])[0])) <= 12


def corpus(spark, rng, rows=400, langs=tuple(WORDS)):
    found = []
    for k in range(rows):
        lang = langs[k % len(langs)]
        text = " ".join(rng.choices(WORDS[lang], k=rng.randint(6, 60)))
        found.append((k, text, lang, f"s{k % 3}", 1, "r", "k", "h", "y", "p", 3))
    return spark.createDataFrame(found, SCHEMA)


def predictions(docs):
    return {r.doc_id: (r.lang_pred, r.score, r.held_out) for r in lid.language_id(docs).collect()}


def test_languages_of_families_and_alone(spark):
    docs = corpus(spark, random.Random(2))
    found = predictions(docs)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert all(found[k][0] == truth[k] and 0.5 < found[k][1] <= 1 for k in truth)
    import zlib

    assert all(found[k][2] == (zlib.crc32(str(k).encode()) % 4 == 2) for k in truth)


def test_held_out_labels_and_other_columns_change_nothing(spark):
    docs = corpus(spark, random.Random(3), 200)
    changed = docs.withColumn(
        "lang", F.when(lid.held_out(), F.lit("de")).otherwise(F.col("lang"))
    ).withColumn("source", F.lit("other"))
    assert predictions(docs) == predictions(changed)
    moved = docs.filter(lid.held_out()).withColumn("doc_id", F.col("doc_id") + 10_000_000)
    kept = docs.unionByName(moved.withColumn("lang", F.lit(None).cast("string")))
    found = predictions(kept)
    assert all(found[k][:2] == v[:2] for k, v in predictions(docs).items())
    assert all(found[k + 10_000_000][0] == v[0] for k, v in found.items() if k < 10_000_000 and v[2])


def test_one_row_of_a_language_or_none(spark):
    row = (1, "the and", "en", "s", 1, "r", "k", "h", "y", "p", 3)
    one = spark.createDataFrame([row, (5, None, *row[2:]), (9, "12 .", *row[2:]), (None, "x", *row[2:])], SCHEMA)
    assert predictions(one) == {
        1: ("en", 1.0, False), 5: ("und", 0.0, True), 9: ("und", 0.0, False), None: ("en", 1.0, False)
    }
    unlabelled = one.withColumn("lang", F.lit(None).cast("string"))
    assert {v[:2] for v in predictions(unlabelled).values()} == {("und", 0.0)}
    assert lid.language_id(no_docs(spark)).count() == 0
    rows = lid.language_id(awkward_docs(spark)).collect()
    assert len(rows) == awkward_docs(spark).count()
    assert {r.lang_pred for r in rows} == {"en", "und"} and sum(r.lang_pred == "und" for r in rows) == 4


def test_the_sample_is_bounded_whatever_copies_there_are(spark, monkeypatch):
    monkeypatch.setattr(lid, "SAMPLE", 20)
    docs = corpus(spark, random.Random(4), 300, ("en", "de"))
    many = docs.unionByName(docs.filter("doc_id = 1").crossJoin(spark.range(200)).drop("id"))
    pinned = []
    monkeypatch.setattr(lid, "pin", lambda df, label: pinned.append(df.cache()) or pinned[-1])
    lid.learn(many.select("doc_id", "lang", "text"))
    per = {r["lang"]: r["count"] for r in pinned[0].groupBy("lang").count().collect()}
    assert set(per) == {"en", "de"} and max(per.values()) <= 20 and min(per.values()) >= 10


def test_duels_decide_inside_the_family():
    langs = ["de", "en", "fr", "nl"]
    plan = lid.problems(langs)
    assert plan == [
        ("family", "germanic", ""), ("family", "romance", ""),
        ("pair", "de", "en"), ("pair", "de", "nl"), ("pair", "en", "nl"),
    ]
    weights = np.zeros((lid.DIMENSIONS + 1, len(plan)))
    weights[-1] = [2.0, 1.0, -1.0, 0.5, 0.25]  # en beats de and nl, de beats nl
    found, score = lid.Model(langs, plan, weights).predict(np.zeros((1, lid.DIMENSIONS)))
    assert found == ["en"]
    want = 1 / (1 + np.exp(-lid.SLOPE)) / (1 + np.exp(-0.25 * lid.SLOPE))
    assert score == pytest.approx([want])
    weights[-1, 2:] = [-1.0, 0.5, -0.25]  # each wins once: the sum of margins decides
    found, _ = lid.Model(langs, plan, weights).predict(np.zeros((1, lid.DIMENSIONS)))
    assert found == ["en"]


def test_svm_separates_with_the_largest_margin():
    x = np.array([[0.0, 1.0], [0.0, 2.0], [1.0, -1.0], [3.0, -1.0]])
    w = lid.svm(x, np.array([1.0, 1.0, -1.0, -1.0]), cost=1e4, epochs=2000)
    margins = x @ w[:-1] + w[-1]
    assert (margins[:2] > 0.9).all() and (margins[2:] < -0.9).all()


def test_query_over_the_whole_table(spark):
    found = {r.doc_id: r for r in queries.op12_language_id(spark, DATA).collect()}
    rows = documents(spark, DATA).collect()
    assert len(found) == len(rows)
    unseen = [found[r.doc_id].lang_pred == r.lang for r in rows if found[r.doc_id].held_out]
    assert len(unseen) > 30 and sum(unseen) >= 0.97 * len(unseen)
