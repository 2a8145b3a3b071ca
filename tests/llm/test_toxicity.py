import math
import random
import re
import time

import pytest

from tests.llm.cases import awkward, awkward_docs, no_docs, prose
from tillwork.llm import toxicity


def labelled(spark, flip=None):
    rng = random.Random(8)
    bad = ["vilex", "grubnik", "snarfo", "moron"]
    docs, labels = [], []
    for k in range(900):
        words, toxic = prose(rng, rng.randint(30, 120)).split(), int(k % 6 == 0)
        for _ in range(4 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((k, " ".join(words)))
        labels.append((k, toxic))
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    if flip is not None:
        from pyspark.sql import functions as F

        known = known.withColumn("toxic", F.when(flip, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    return rows, known, dict(labels)


def test_held_out_documents_are_told_apart(spark):
    docs, known, truth = labelled(spark)
    rows = toxicity.toxicity(docs, known).collect()
    held = [r for r in rows if r.held_out]
    assert 100 < len(held) < 260
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_held_out_labels_are_never_read(spark):
    docs, known, _ = labelled(spark)
    _, flipped, _ = labelled(spark, toxicity.held_out())
    a = toxicity.toxicity(docs, known).orderBy("doc_id").collect()
    b = toxicity.toxicity(docs, flipped).orderBy("doc_id").collect()
    assert a == b


def test_folding():
    assert toxicity.fold("M0R0N mоrоn ｍｏｒｏｎ") == "moron moron moron"
    assert toxicity.fold("in 2013 at 10:45, 100 a 5") == "in 2013 at 10:45, 100 a 5"
    assert toxicity.fold("привет мир") == "привет мир"


def test_words_stems_and_exceptions():
    lexicon = toxicity.Lexicon({"trash": 3.0, "vile*": 2.0})
    assert lexicon.features("take out the trash can today") == (0.0, 0.0, 0.0, 0.0)
    assert lexicon.features("such trash")[3] == 3.0
    assert lexicon.features("trashy")[3] == 0.0
    assert lexicon.features("vilest")[3] == 2.0 and lexicon.features("vile")[3] == 0.0
    assert lexicon.features("servile vileness")[3] == 2.0


def test_awkward_rows_and_empty_tables(spark):
    docs, known, _ = labelled(spark)
    assert toxicity.toxicity(awkward_docs(spark), known).count() == len(awkward())
    assert toxicity.toxicity(no_docs(spark), known).count() == 0
    missing = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    scores = {r.score < 1e-6 for r in toxicity.toxicity(awkward_docs(spark), missing).collect()}
    assert scores == {True}


def plain_features(weights, text):
    """Every entry looked for by itself."""
    folded = toxicity.fold(text)
    best, excepted = {}, set()
    for phrase in toxicity.EXCEPTIONS:
        if phrase in weights or phrase + "*" in weights:
            continue
        for m in re.finditer(f"(?=(?<![^\\W\\d_]){re.escape(phrase)}(?![^\\W\\d_]))", folded):
            excepted |= set(range(m.start(), m.start() + len(phrase)))
    for entry, weight in weights.items():
        word = entry.rstrip("*")
        after = "(?=[^\\W\\d_])" if entry.endswith("*") else "(?![^\\W\\d_])"
        for m in re.finditer(f"(?<![^\\W\\d_]){re.escape(word)}{after}", folded):
            if weight > best.get(m.start(), (0.0,))[0]:
                best[m.start()] = (weight, word)
    hits = [best[k] for k in best if k not in excepted]
    if not hits:
        return 0.0, 0.0, 0.0, 0.0
    words = folded.count(" ") + folded.count("\n") + 20
    return (
        100 * sum(w for w, _ in hits) / words, 100 * len(hits) / words,
        math.log1p(len({w for _, w in hits})), max(w for w, _ in hits),
    )


def test_features_equal_a_plain_search_of_every_entry():
    rng = random.Random(4)
    weights = {"trash": 3.0, "tra*": 2.5, "vile*": 2.0, "moron": 4.0, "clown": 1.5, "scum": 2.25, "not": 1.75, "stupid": 3.5}
    lexicon = toxicity.Lexicon(weights)
    pool = [*weights, *toxicity.EXCEPTIONS, "trashy", "M0R0N", "vilest", "mоron", "can", "x", "fish.", "pond-scum", "the"]
    for _ in range(300):
        text = " ".join(rng.choice(pool).rstrip("*") for _ in range(rng.randint(0, 40)))
        assert lexicon.features(text) == pytest.approx(plain_features(weights, text))


def test_very_many_hits_and_exceptions_in_one_text():
    lexicon = toxicity.Lexicon({"trash": 3.0})
    start = time.time()
    found = lexicon.features("trash trash can " * 100_000)
    assert found[1] == pytest.approx(100 * 100_000 / (300_000 + 20)) and time.time() - start < 20
