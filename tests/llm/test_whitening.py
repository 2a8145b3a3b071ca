import random
from collections import defaultdict
from fractions import Fraction
from math import floor

import numpy as np
import pytest

from tillwork.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<double>, w string, c string, n string, component string"


def rows_of(vectors, first=0):
    return [(first + k, v, "w", "c", "n", "x") for k, v in enumerate(vectors)]


def awkward_vectors(seed=3, width=5):
    rng = random.Random(seed)
    good = [[rng.gauss(0.1 * d, 0.5 + d) for d in range(width)] for _ in range(60)]
    good += [list(good[0])] * 40  # a third of the rows are one vector
    bad = [None, [], [None] * width, [float("nan")] + [0.0] * (width - 1), [float("inf")] * width, [1.0, 2.0]]
    return good, bad


def plain(vectors, components):
    """Everything by its definition, the covariances in fractions."""
    x = [[floor(1024 * c) + 100000 for c in v] for v in vectors]
    n, width = len(x), len(x[0])
    s = [sum(row[d] for row in x) for d in range(width)]
    deviation = [sum((n * row[d] - s[d]) ** 2 for d in range(width)) for row in x]
    centred = [[row[d] - Fraction(s[d], n) for d in range(width)] for row in x]
    v = np.array(
        [[float(sum(r[i] * r[j] for r in centred) / n) for j in range(width)] for i in range(width)]
    )
    values, axes = np.linalg.eigh(v)
    order = np.argsort(-values)[:components]
    whitened = np.array([[float(c) for c in r] for r in centred]) @ axes[:, order] / np.sqrt(values[order])
    return n, deviation, whitened, values[order] / np.trace(v)


def test_equals_the_definition_and_drops_bad_vectors(spark):
    good, bad = awkward_vectors()
    rows = rows_of(good) + rows_of(bad, 1000) + [(None, good[3], "w", "c", "n", "x")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    found = whitening.whiten(docs, components=3).collect()
    vectors = good + [good[3]]
    n, deviation, whitened, explained = plain(vectors, 3)
    assert len(found) == 3 * len(vectors)
    by_component = defaultdict(dict)
    for r in found:
        k = len(good) if r.vec_id is None else r.vec_id
        assert (r.n, r.deviation, r.deviation_exact) == (n, deviation[k], deviation[k])
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-10)
        assert r.identity_error < 1e-10
        by_component[r.component - 1][k] = r.whitened
    for component, of in by_component.items():
        got = np.array([of[k] for k in range(len(vectors))])
        want = whitened[:, component]
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-9


def test_covariances_are_exact():
    rng = np.random.default_rng(1)
    x = rng.integers(-5000, 5000, (40, 4)) + 100000
    n, totals = len(x), x.sum(axis=0).tolist()
    centre = [(2 * s + n) // (2 * n) for s in totals]
    rest = [s - n * m for s, m in zip(totals, centre)]
    z = (x - np.array(centre)).tolist()
    squares = {
        (i, j): sum((row[i] if i == j else row[i] + row[j]) ** 2 for row in z)
        for i in range(4)
        for j in range(i, 4)
    }
    y = [[n * int(row[d]) - totals[d] for d in range(4)] for row in x]
    want = [[sum(r[i] * r[j] for r in y) / n**3 for j in range(4)] for i in range(4)]
    assert whitening.covariance(squares, n, rest).tolist() == want


def test_task_sums_do_not_depend_on_batches():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    c = rng.normal(0, 100, (3000, 3))
    batch = [pa.RecordBatch.from_arrays([pa.array(part.tolist())], ["c"]) for part in (c, c[:1000], c[1000:])]
    run = whitening._squares(np.array([100000, 100010, 99990]))
    one = next(run([batch[0]])).to_pydict()
    two = next(run(batch[1:])).to_pydict()
    whole = [[(h << whitening.HALF) + low for h, low in zip(p["high"], p["low"])] for p in (one, two)]
    z = np.floor(1024 * c).astype(int) + 100000 - np.array([100000, 100010, 99990])
    assert whole[0] == whole[1] == [
        int(((z[:, i] + (z[:, j] if i != j else 0)) ** 2).sum()) for i, j in zip(one["i"], one["j"])
    ]


def test_without_variance_and_without_rows(spark):
    same = spark.createDataFrame(rows_of([[0.5, 0.25]] * 4), SCHEMA)
    found = whitening.whiten(same).collect()
    assert [(r.component, r.whitened, r.explained, r.identity_error, r.deviation) for r in found] == [
        (k, None, None, None, 0) for _ in range(4) for k in (1, 2)
    ]
    line = spark.createDataFrame(rows_of([[0.0, 1.0], [1.0, 1.0], [2.0, 1.0]]), SCHEMA)
    found = {(r.vec_id, r.component): r for r in whitening.whiten(line).collect()}
    assert found[0, 1].explained == 1.0 and found[0, 2].whitened is None
    assert [abs(found[k, 1].whitened) for k in range(3)] == pytest.approx([1.5**0.5, 0, 1.5**0.5])
    for vectors in ([], [None, [], [None]]):
        empty = whitening.whiten(spark.createDataFrame(rows_of(vectors), SCHEMA))
        assert empty.count() == 0 and empty.columns[:3] == ["vec_id", "component", "n"]


def test_a_deviation_beyond_a_long_keeps_its_exact_value(spark):
    vectors = [[8000.0 * (-1) ** k] * 64 for k in range(200)]
    found = whitening.whiten(spark.createDataFrame(rows_of(vectors), SCHEMA), components=1).collect()
    exact = 64 * (200 * 1024 * 8000) ** 2
    assert exact > 2**63 and {(r.deviation, int(r.deviation_exact)) for r in found} == {(None, exact)}
    with pytest.raises(Exception, match="or more in size"):
        whitening.whiten(spark.createDataFrame(rows_of([[1e9], [0.0]]), SCHEMA))


def test_query_over_the_whole_table(spark):
    from tests.conftest import DATA

    table = spark.read.parquet(f"{DATA}/embeddings.parquet")
    vectors = {r.vec_id: r.embedding for r in table.collect()}
    found = queries.op13_whitening(spark, DATA).collect()
    assert len(found) == 8 * len(vectors)
    ids = sorted(vectors)
    n, deviation, whitened, explained = plain([[float(c) for c in vectors[k]] for k in ids], 8)
    at = {k: p for p, k in enumerate(ids)}
    sign = {}
    for r in found:
        want = whitened[at[r.vec_id], r.component - 1]
        sign.setdefault(r.component, np.sign(want * r.whitened) if abs(want) > 1e-6 else 1)
    for r in found:
        assert r.deviation == deviation[at[r.vec_id]] and r.n == n
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        want = whitened[at[r.vec_id], r.component - 1]
        assert r.whitened == pytest.approx(sign[r.component] * want, abs=1e-7)
