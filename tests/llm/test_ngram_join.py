import random
from collections import Counter

import pytest

from tests.llm.cases import awkward_docs, no_docs, prose
from tillwork.llm import components, ngram_join
from tillwork.llm.shingles import shingle_set


def brute(rows, width, percent):
    sets = [(i, shingle_set(t, width)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b)
            if both and 100 * both >= percent * (len(a) + len(b) - both):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return Counter((i, len(s), root(i)) for i, s in sets)


def family(rng, size, copies, first):
    """A base and variants of it, so that variants are linked through the base only."""
    base = prose(rng, size).split()
    rows = [(first, " ".join(base))]
    for k in range(1, copies):
        words = list(base)
        for _ in range(rng.randint(0, max(1, size // 25))):
            words[rng.randrange(size)] = f"new{rng.randrange(10**6)}"
        rows.append((first + k, " ".join(words)))
    return rows


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for k, size in enumerate([4, 8, 15, 30, 60, 150, 400]):
        rows += family(rng, size, 25, 1000 * (k + 1))
    passage = prose(rng, 40)
    rows += [(20_000 + k, passage + " " + prose(rng, rng.randint(5, 60))) for k in range(60)]
    rows += [(30_000 + k, t) for k, t in enumerate(["", None, "one", "one", "Two words", "two WORDS"])]
    rng.shuffle(rows)
    return rows


def found(spark, rows, width, percent):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    joined = ngram_join.ngram_join(docs, width, percent).collect()
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in joined if r.doc_id is not None)


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_components_equal_brute_force(spark, width, percent):
    rows = corpus(width)
    assert found(spark, rows, width, percent) == brute(rows, width, percent)


def test_one_deletion_neighbourhoods_lose_nothing(spark, monkeypatch):
    near = lambda low, most, documents: (most // 2 + 1, 0, True)
    monkeypatch.setattr(ngram_join, "allocation", near)
    rows = corpus(9)
    assert found(spark, rows, 3, 90) == brute(rows, 3, 90)


def test_the_cost_model_turns_to_deletions_in_crowded_bands():
    assert not ngram_join.allocation(10, 1, 1_000)[2]
    assert ngram_join.allocation(10, 1, 10**12)[2]


def test_bands_reach_every_partner():
    layout = ngram_join.bands(5000, 80)
    for k, (low, high, partner, most) in enumerate(layout[:-1]):
        assert layout[k + 1][0] == high + 1 and partner <= layout[k + 1][1]
        for size in range(low, min(high, low + 50) + 1):
            assert ngram_join.max_difference(size, size * 100 // 80, 80) <= most


def test_awkward_rows(spark):
    docs = awkward_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    joined = ngram_join.ngram_join(docs).collect()
    assert len(joined) == len(rows)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in joined if r.doc_id is not None)
    assert got == brute(rows, 5, 80)
    assert all(r.component_id is None for r in joined if r.doc_id is None)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert not {101, 129, 200, 201, 202, 305} & {r.doc_id for r in kept.collect()}
    assert ngram_join.ngram_join(no_docs(spark)).count() == 0


def chance(rng, pairs):
    """Documents that share passages by twos without being similar, and a near copy of every fifth."""
    rows = []
    for k in range(pairs):
        passage = prose(rng, 40)
        own = [prose(rng, 110) + " " + passage for _ in range(2)]
        rows += [(10 * k + j, text) for j, text in enumerate(own)]
        if k % 5 == 0:
            rows.append((10 * k + 2, own[0] + " end"))
    return rows


def test_what_few_documents_share_takes_no_part_in_the_rounds(spark, monkeypatch):
    opened, pin = [], ngram_join.pin

    def counted(frame, label):
        pinned = pin(frame, label)
        if label == "open":
            opened.append(pinned.count())
        return pinned

    monkeypatch.setattr(ngram_join, "pin", counted)
    rows = chance(random.Random(4), 30)
    assert found(spark, rows, 5, 80) == brute(rows, 5, 80)
    assert opened and not any(opened)


def test_pairs_of_few_documents_lose_nothing_at_any_bound(spark, monkeypatch):
    rows = corpus(11)
    for small in (0, 100):
        monkeypatch.setattr(ngram_join, "SMALL", small)
        assert found(spark, rows, 5, 80) == brute(rows, 5, 80)


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(10, 60)] + [(k, 200) for k in range(100, 160)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    labels = {r.doc: r.component for r in found}
    assert {labels.get(k, k) for k in range(10, 61)} == {10}
    assert {labels.get(k, k) for k in [*range(100, 160), 200]} == {100}


def test_pairs_are_compared_without_a_list_of_their_texts():
    import pyarrow as pa

    from tillwork.llm import ngram_join as nj

    class Texts(list):
        def to_pylist(self):
            raise AssertionError("all texts of a batch at once")

    text = "one two three four five six"
    held = {"doc": pa.array([5, 6, 7]), "centre": pa.array([1, 1, 2]),
            "mine": Texts(pa.array([text, "other words that are not shared", text])),
            "theirs": Texts(pa.array([text, text, text.upper()]))}
    batch = type("Batch", (), {"column": lambda self, name: held[name]})()
    found = list(nj._compare(80, 5)([batch]))[0].to_pydict()
    assert found == {"a": [5, 7], "b": [1, 2]}


def test_a_task_gives_memory_back_at_its_end(monkeypatch):
    import pyarrow as pa

    from tillwork.llm.texts import released

    asked = []
    pool = type("Pool", (), {"release_unused": lambda self: asked.append("end")})()
    monkeypatch.setattr(pa, "default_memory_pool", lambda: pool)
    rows = released(lambda batches: (b for b in batches))(iter([1, 2]))
    assert next(rows) == 1 and not asked
    assert list(rows) == [2] and asked == ["end"]
