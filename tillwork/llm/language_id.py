"""Language ID in two steps: the family first, then one-versus-one linear SVMs inside it.

A text becomes a unit vector of hashed character n-grams (1 to 4 letters, word borders included,
none across words), each weighing the square root of its share. A linear SVM for each family
against the others picks the family; inside it every pair of languages has an SVM of its own, and
the language with most won duels is the answer (ties: the larger sum of margins, then the lesser
name). ``score`` is the logistic of the family's lead times that of the answer's narrowest duel.

Learning: rows with a language whose crc32(id) mod 4 is not 2, at most SAMPLE rows a language (a
documented bound), those with the least hashes of the whole row. Only how many rows a language has
is collected to keep the rest from being ranked. Every SVM is fitted in a task of its own, by dual
coordinate descent over its bounded rows, sorted first, so a task that runs again gives the same
weights; the driver sees one row of weights per SVM. Prediction reads the text alone, whole, in
segments of bounded size, without a shuffle.

Defined results: a missing text or one without a letter is ``und`` with score 0, and so is every
text if nothing could be learned; with one language learned it is always the answer, with score 1.
Rows without id are predicted, count as not held out and teach nothing. Rows that repeat an id are
predicted one by one. A language that FAMILIES does not list is a family of its own. Very long
texts are cut into segments of SEGMENT code points at white space if there is some, else between
any two; a cut counts as a word border. Columns of other names are never read. An empty table
gives no rows.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.texts import pin

SAMPLE = 800  # rows of a language that the SVMs may learn from
FOLDS, HELD_OUT = 4, 2
DIMENSIONS = 1 << 12
LENGTHS = (1, 2, 3, 4)
COST, EPOCHS = 10.0, 60
SLOPE = 4.0  # of the logistic curves over margins
SEGMENT = 1 << 19
CHARS = 1 << 19  # code points in work at once
RANGE = 1 << 30
UNKNOWN = "und"

# Language families by ISO 639-1 code.
FAMILIES = {
    **dict.fromkeys("en de nl sv da no nb nn is af fy lb".split(), "germanic"),
    **dict.fromkeys("fr es it pt ro ca gl oc".split(), "romance"),
    **dict.fromkeys("ru uk be bg mk sr hr bs sl cs sk pl".split(), "slavic"),
    **dict.fromkeys("fi et hu".split(), "uralic"),
    **dict.fromkeys("lt lv".split(), "baltic"),
    **dict.fromkeys("hi ur bn mr ne pa gu".split(), "indic"),
    **dict.fromkeys("tr az kk uz tk".split(), "turkic"),
    **dict.fromkeys("ar he".split(), "semitic"),
}


def family_of(lang: str) -> str:
    return FAMILIES.get(lang.lower().split("-")[0].split("_")[0], f"only {lang}")


def _letters() -> np.ndarray:
    """Which code points are letters, for numpy."""
    return np.char.isalpha(np.arange(0x110000, dtype=np.uint32).view("U1"))


def segments(text: str, size: int | None = None) -> list[str]:
    size = size or SEGMENT
    found, at = [], 0
    while len(text) - at > size:
        spaces = [m.end() for m in re.finditer(r"\s", text[at + size - 200 : at + size])]
        end = at + size - 200 + spaces[-1] if spaces and size > 200 else at + size
        found.append(text[at:end])
        at = end
    return found + [text[at:]]


class Grams:
    """Counts of hashed n-grams of texts, many side by side."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.dimensions = dimensions
        self.letter = _letters()

    def counts(self, texts: list[str]) -> np.ndarray:
        """One row of counts per text; a row of zeros has no letter."""
        found = np.zeros((len(texts), self.dimensions))
        parts, owners, chars = [], [], 0
        for k, text in enumerate(texts):
            for part in segments(text):
                parts.append(part)
                owners.append(k)
                chars += len(part)
                if chars > CHARS:
                    self._add(found, parts, owners)
                    parts, owners, chars = [], [], 0
        if parts:
            self._add(found, parts, owners)
        return found

    def _add(self, found: np.ndarray, parts: list[str], owners: list[int]) -> None:
        lower = [p.lower() for p in parts]
        codes = np.frombuffer(("\n".join(lower) + "\n").encode("utf-32-le"), np.uint32)
        owner = np.repeat(np.array(owners), [len(p) + 1 for p in lower])
        inside = self.letter[codes]
        # Runs of other characters become one border; the text starts with one.
        keep = inside | np.concatenate([[True], inside[:-1]])
        seq = np.concatenate([[0], np.where(inside, codes, 0)[keep]]).astype(np.uint64)
        owner = np.concatenate([owner[:1], owner[keep]])
        row = np.unique(owner)
        place = np.searchsorted(row, owner)
        letters = seq > 0
        for n in LENGTHS:
            m = len(seq) - n + 1
            if m <= 0:
                continue
            whole = letters[:m] | letters[n - 1 : n - 1 + m] if n < 3 else np.ones(m, bool)
            for j in range(1, n - 1):  # a border only at the ends
                whole &= letters[j : j + m]
            at = np.flatnonzero(whole)
            h = np.full(len(at), n, np.uint64)
            for j in range(n):
                h = (h ^ seq[at + j]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            bucket = (h % np.uint64(self.dimensions)).astype(np.int64)
            # An n-gram belongs to the text of its last character; texts end with a border.
            flat = place[at + n - 1] * self.dimensions + bucket
            size = len(row) * self.dimensions
            found[row] += np.bincount(flat, minlength=size).reshape(len(row), self.dimensions)

    def vectors(self, texts: list[str]) -> np.ndarray:
        """Unit vectors; a row of zeros has no letter."""
        counts = self.counts(texts)
        total = counts.sum(axis=1, keepdims=True)
        return np.sqrt(counts / np.maximum(total, 1))


def _by_size(texts: list[str], rows: int = 256, chars: int = CHARS):
    """Ranges of texts that are worked on at once."""
    first = size = 0
    for k, text in enumerate(texts):
        if k > first and (k - first == rows or size + len(text) > chars):
            yield first, k
            first, size = k, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def svm(x: np.ndarray, y: np.ndarray, cost: float = COST, epochs: int = EPOCHS) -> np.ndarray:
    """Weights and bias of a linear SVM (squared hinge), by dual coordinate descent."""
    x = np.hstack([x, np.ones((len(x), 1))])
    # Both sides weigh the same, however many rows they have.
    c = cost * np.where(y > 0, len(y) / (2 * max((y > 0).sum(), 1)), len(y) / (2 * max((y < 0).sum(), 1)))
    diagonal = 1 / (2 * c)
    norm = np.einsum("ij,ij->i", x, x) + diagonal
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(y))
    order = np.random.default_rng(7)
    for _ in range(epochs):
        largest = 0.0
        for i in order.permutation(len(y)):
            gradient = y[i] * (x[i] @ w) - 1 + diagonal[i] * alpha[i]
            new = max(alpha[i] - gradient / norm[i], 0.0)
            step = new - alpha[i]
            if step:
                w += step * y[i] * x[i]
                alpha[i] = new
                largest = max(largest, abs(step))
        if largest < 1e-4 * cost:
            break
    return w


def problems(langs: list[str]) -> list[tuple[str, str, str]]:
    """(kind, one, other): families against the rest, and pairs of languages of a family."""
    families = sorted({family_of(x) for x in langs})
    found = [("family", f, "") for f in families] if len(families) > 1 else []
    for f in families:
        own = sorted(x for x in langs if family_of(x) == f)
        found += [("pair", a, b) for k, a in enumerate(own) for b in own[k + 1 :]]
    return found


def _features(batches):
    """(lang, place, value): the filled places of the vectors of rows (lang, text)."""
    grams = Grams()
    for batch in batches:
        texts, langs = batch.column(1).to_pylist(), batch.column(0).to_pylist()
        for first, end in _by_size(texts):
            vectors = grams.vectors(texts[first:end])
            places = [np.flatnonzero(v) for v in vectors]
            rows = [k for k, p in enumerate(places) if len(p)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([langs[first + k] for k in rows], pa.string()),
                    pa.array([places[k].astype(np.int32) for k in rows], pa.list_(pa.int32())),
                    pa.array([vectors[k][places[k]] for k in rows], pa.list_(pa.float64())),
                ],
                ["lang", "place", "value"],
            )


def _fitted(plan: list):
    """One row (problem, weights) for the rows of a problem."""

    def run(table: pa.Table) -> pa.Table:
        number = table.column("problem")[0].as_py()
        kind, one, _ = plan[number]
        langs = table.column("lang").to_pylist()
        places, values = table.column("place").to_pylist(), table.column("value").to_pylist()
        order = sorted(range(len(langs)), key=lambda k: (langs[k], places[k], values[k]))
        x = np.zeros((len(order), DIMENSIONS))
        for row, k in enumerate(order):
            x[row, places[k]] = values[k]
        own = [(family_of(langs[k]) if kind == "family" else langs[k]) == one for k in order]
        w = svm(x, np.where(own, 1.0, -1.0))
        return pa.table({"problem": pa.array([number], pa.int32()), "weights": pa.array([w.tolist()])})

    return run


class Model:
    """The languages, what each SVM tells apart, and the weights, one column per SVM."""

    def __init__(self, langs: list[str], plan: list, weights: np.ndarray):
        self.langs, self.plan, self.weights = sorted(langs), plan, weights

    def predict(self, vectors: np.ndarray) -> tuple[list[str], list[float]]:
        if not self.langs:
            return [UNKNOWN] * len(vectors), [0.0] * len(vectors)
        margins = vectors @ self.weights[:-1] + self.weights[-1] if self.plan else np.zeros((len(vectors), 0))
        families = sorted({family_of(x) for x in self.langs})
        score = np.ones(len(vectors))
        family = np.zeros(len(vectors), np.int64)
        if len(families) > 1:
            own = margins[:, : len(families)]
            family = own.argmax(axis=1)
            rest = own.copy()
            rest[np.arange(len(own)), family] = -np.inf
            score = 1 / (1 + np.exp(-SLOPE * (own.max(axis=1) - rest.max(axis=1))))
        found = np.empty(len(vectors), dtype=object)
        for k, name in enumerate(families):
            at = np.flatnonzero(family == k)
            own = [x for x in self.langs if family_of(x) == name]
            wins, total = np.zeros((len(at), len(own))), np.zeros((len(at), len(own)))
            narrow = np.full((len(at), len(own)), np.inf)
            for column, (kind, a, b) in enumerate(self.plan):
                if kind == "pair" and a in own:
                    m, i, j = margins[at, column], own.index(a), own.index(b)
                    for side, lead in ((i, m), (j, -m)):
                        wins[:, side] += lead > 0
                        total[:, side] += lead
                        narrow[:, side] = np.minimum(narrow[:, side], lead)
            best = np.lexsort((np.tile(-np.arange(len(own)), (len(at), 1)), total, wins), axis=1)[:, -1]
            found[at] = np.array(own, dtype=object)[best]
            lead = narrow[np.arange(len(at)), best]
            score[at] *= 1 / (1 + np.exp(-SLOPE * np.clip(lead, -100, 100)))
        return found.tolist(), score.tolist()


def _predicted(model: Model):
    def run(batches):
        grams = Grams()
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            langs, scores = [], []
            for first, end in _by_size(texts):
                vectors = grams.vectors(texts[first:end])
                some = vectors.any(axis=1)
                named, score = model.predict(vectors)
                langs += [x if s else UNKNOWN for x, s in zip(named, some)]
                scores += [x if s else 0.0 for x, s in zip(score, some)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def learn(rows: DataFrame) -> Model:
    """From rows (doc_id, lang, text)."""
    known = rows.filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out() & F.col("text").rlike(r"\p{L}")
    )
    counts = dict(known.groupBy("lang").count().collect())  # a row per language
    if not counts:
        return Model([], [], np.zeros((DIMENSIONS + 1, 0)))
    # The least hashes: first those that can be among them, then exactly SAMPLE of a language.
    share = F.create_map(
        *[F.lit(x) for lang, n in counts.items() for x in (lang, min(RANGE, 2 * SAMPLE * RANGE // n + RANGE // n))]
    )
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(RANGE))
    few = known.withColumn("place", place).filter(F.col("place") < share[F.col("lang")])
    order = Window.partitionBy("lang").orderBy("place", "doc_id", "text")
    chosen = few.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= SAMPLE)
    vectors = chosen.select("lang", "text").mapInArrow(
        _features, "lang string, place array<int>, value array<double>"
    )
    vectors = pin(vectors, "language-vectors")
    langs = sorted(r["lang"] for r in vectors.select("lang").distinct().collect())
    plan = problems(langs)
    if not plan:
        return Model(langs, plan, np.zeros((DIMENSIONS + 1, 0)))
    taught = {
        x: [k for k, (kind, a, b) in enumerate(plan) if kind == "family" or x in (a, b)] for x in langs
    }
    numbers = F.create_map(*[v for x in langs for v in (F.lit(x), F.array(*map(F.lit, taught[x])))])
    dealt = vectors.select(F.explode(numbers[F.col("lang")]).alias("problem"), "lang", "place", "value")
    fitted = dealt.groupBy("problem").applyInArrow(_fitted(plan), "problem int, weights array<double>")
    by_problem = {r["problem"]: r["weights"] for r in fitted.collect()}
    return Model(langs, plan, np.array([by_problem[k] for k in range(len(plan))]).T)


def language_id(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")
    )
    model = learn(rows)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    return rows.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(_predicted(model), schema)
