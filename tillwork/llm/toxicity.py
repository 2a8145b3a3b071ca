"""Toxicity from a weighted lexicon, matched by an Aho-Corasick automaton in folded text.

Folding writes homoglyphs (Cyrillic, Greek, full width) as Latin letters and digits or signs
inside a word as the letters they stand for. The lexicon holds words and word beginnings whose
weight is the log-odds of toxic against clean documents. Every word of a text counts with its
heaviest entry; words inside an exception phrase do not count. The sum and the number of hits,
normalised by the length of the text, go through a logistic curve.

Entries, weights and curve are learned from labels, on at most SAMPLE labelled rows with the
least hash of their id (a documented bound, so the ids may be broadcast); labels are only read
where crc32(id) mod 5 is not 0. Half of the sample, by another hash, chooses the lexicon, the
other half fits the curve. Documents are then scored one by one, whole, without a shuffle.

Defined results: a missing text counts as empty and gets the score of a text without hits; rows
without id are scored and count as not held out. Rows that repeat an id share its label. Without
any usable label every score is 0. Very long texts are scored whole, in time linear in their
length and hits. Columns of other names are never read. An empty table gives no rows.
"""

import math
import re
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.texts import corpus, pin

SAMPLE = 40_000
HELD_OUT = 5
STEMS = range(4, 9)
MIN_DOCUMENTS = 3
MIN_SHARE = 0.004  # of the toxic documents have an entry
MIN_LOG_ODDS = 1.5
BATCH_TEXTS = 1_000

# Look-alike letters, and what digits and signs stand for inside a word.
HOMOGLYPHS = dict(
    zip(
        map(ord, "аеорсухіјѕһԁԛԝᴀвкмнтαβεικνορτυχϲ"),
        "aeopcyxijshdqwabkmhtabeiknoptuxc",
    )
)
SUBSTITUTES = str.maketrans("01345678@$!", "oieasgtbasi")
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "trash collection", "take out the trash",
    "clown fish", "circus clown", "pond scum", "soap scum", "sore loser", "loser bracket",
    "idiot proof", "the word idiot", "the word stupid", "not stupid", "not worthless",
)

_LOOKALIKE = re.compile("[" + "".join(map(chr, HOMOGLYPHS)) + "！-～]")
_SUBSTITUTED = re.compile(r"(?<=[^\W\d_])[01345678@$!]+(?=[^\W\d_])|(?<!\S)[01345678@$]+(?=[^\W\d_]{2})")
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    if not text.isascii() and _LOOKALIKE.search(text.lower()):
        # Only words that are mixed, or look Latin throughout, are written in Latin.
        text = re.sub(r"\w+", _folded_word, unicodedata.normalize("NFKC", text).lower())
    text = text.lower()
    return _SUBSTITUTED.sub(lambda m: m.group().translate(SUBSTITUTES), text)


def _folded_word(match) -> str:
    word = match.group()
    latin = word.translate(HOMOGLYPHS)
    return latin if latin.isascii() or re.search("[a-z]", word) else word


def entries_of(text: str) -> set[str]:
    """The words of a text, and their beginnings marked by a star."""
    words = set(_WORD.findall(fold(text)))
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


def _documents_with(candidates: frozenset | None):
    """Rows (entry, documents) of a batch, of all entries or of the candidates."""

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_TEXTS):
                found = Counter()
                for text in batch.column(0).slice(at, BATCH_TEXTS).to_pylist():
                    entries = entries_of(text)
                    found.update(entries if candidates is None else entries & candidates)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())],
                    ["entry", "documents"],
                )

    return run


def _counted(texts: DataFrame, candidates: frozenset | None = None) -> DataFrame:
    rows = texts.select("text").mapInArrow(_documents_with(candidates), "entry string, documents long")
    return rows.groupBy("entry").agg(F.sum("documents").alias("documents"))


class Lexicon:
    """The automaton over entries and exception phrases."""

    def __init__(self, weights: dict[str, float], exceptions=EXCEPTIONS):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        by_word: dict[str, list] = {}
        for entry, weight in weights.items():
            by_word.setdefault(entry.rstrip("*"), []).append((weight, entry.endswith("*")))
        for word, kinds in by_word.items():
            self.automaton.add_word(word, (word, kinds))
        for phrase in exceptions:
            if phrase not in by_word:
                self.automaton.add_word(phrase, (phrase, None))
        self.empty = not by_word
        if not self.empty:
            self.automaton.make_automaton()

    def features(self, text: str) -> tuple[float, float, float, float]:
        """Weighted hits by length, hits by length, distinct words hit, heaviest hit."""
        if self.empty or not text:
            return 0.0, 0.0, 0.0, 0.0
        folded = fold(text)
        best: dict[int, tuple[float, str]] = {}
        excepted = []
        for end, (word, kinds) in self.automaton.iter(folded):
            start, after = end + 1 - len(word), folded[end + 1 : end + 2]
            if folded[start - 1 : start].isalpha() if start else False:
                continue
            if kinds is None:
                if not after.isalpha():
                    excepted.append((start, end))
                continue
            for weight, stem in kinds:
                if stem == after.isalpha() and weight > best.get(start, (0.0,))[0]:
                    best[start] = (weight, word)
        hits = [best[s] for s in _outside(sorted(best), sorted(excepted))]
        if not hits:
            return 0.0, 0.0, 0.0, 0.0
        words = folded.count(" ") + folded.count("\n") + 20
        total = sum(weight for weight, _ in hits)
        return (
            100 * total / words,
            100 * len(hits) / words,
            math.log1p(len({word for _, word in hits})),
            max(weight for weight, _ in hits),
        )


def _outside(places: list[int], spans: list[tuple[int, int]]):
    """The places in no span; both are sorted and swept once."""
    at, reach = 0, -1
    for place in places:
        while at < len(spans) and spans[at][0] <= place:
            reach = max(reach, spans[at][1])
            at += 1
        if place > reach:
            yield place


def _row(f) -> list[float]:
    return [1.0, math.log1p(f[0]), math.log1p(f[1]), f[2], f[3]]


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> list[float]:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w - np.linalg.solve(hessian, gradient)
    return w.tolist()


def _scored(weights: dict[str, float], curve: list[float] | None, passed: int):
    """Score, or without a curve the features, of texts; the first ``passed`` columns go along."""

    def run(batches):
        lexicon = Lexicon(weights)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(at, BATCH_TEXTS)
                features = [_row(lexicon.features(t)) for t in part.column(passed).to_pylist()]
                if curve is None:
                    last = pa.array(features, pa.list_(pa.float64()))
                else:
                    z = np.clip(np.array(features).reshape(-1, 5) @ np.array(curve), -30, 30)
                    last = pa.array(1 / (1 + np.exp(-z)), pa.float64())
                columns = [part.column(k) for k in range(passed)] + [last]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[:passed], "result"])

    return run


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % HELD_OUT == 0, F.lit(False))


def learn(texts: DataFrame, labels: DataFrame) -> tuple[dict[str, float], list[float]]:
    """The lexicon and the curve, from rows (doc_id, text) and labels (doc_id, toxic)."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    half = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(2)).alias("half")
    rows = texts.join(F.broadcast(chosen), "doc_id").select("text", "toxic", half)  # SAMPLE ids
    rows = pin(rows, "labelled")
    first = rows.filter("half = 0")
    sizes = dict(first.groupBy("toxic").count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    least = max(MIN_DOCUMENTS, int(MIN_SHARE * toxic))
    found = _counted(first.filter("toxic = 1")).filter(F.col("documents") >= least)
    common = dict(found.collect())  # entries of SAMPLE texts at most
    others = dict(_counted(first.filter("toxic = 0"), frozenset(common)).collect())
    odds = {
        entry: math.log((n + 0.5) / (toxic + 1)) - math.log((others.get(entry, 0) + 0.5) / (clean + 1))
        for entry, n in common.items()
    }
    ranked = sorted(odds, key=lambda e: (-odds[e] * math.sqrt(common[e]), e))
    weights = {e: round(odds[e], 4) for e in ranked if odds[e] >= MIN_LOG_ODDS}
    second = rows.filter("half = 1").select("toxic", "text")
    measured = second.mapInArrow(_scored(weights, None, 1), "toxic int, result array<double>").collect()
    if not measured:
        return weights, [-30.0, 0.0, 0.0, 0.0, 0.0]
    x = np.array([r["result"] for r in measured])
    y = np.array([float(r["toxic"] > 0) for r in measured])
    return weights, _fit(x, y)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    texts = corpus(docs, id_col, text_col)
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    weights, curve = learn(texts, known)
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, result double"
    rows = texts.select("doc_id", held_out().alias("held_out"), "text")
    scored = rows.mapInArrow(_scored(weights, curve, 2), schema).withColumnRenamed("result", "score")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
