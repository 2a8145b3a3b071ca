import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import awkward, awkward_docs, no_docs, prose
from tillwork.llm import packing, token_counts
from tillwork.llm.tokens import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
PATH = tokenizer_path(token_counts.TOKENIZER)
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
COUNTER = token_counts.TokenCounter(PATH)
ENCODER = packing.Encoder(PATH)
ALPHABET = (
    "aAbZ '’İΣσςßẞÉé́K1²½٣\n\t\x0b\x1c\x1f\x85\xa0  漢字カ​‍😀‍🏽.!?#*|<>\"$_-–'sthetion'll'RE"
)
TEXTS = st.lists(
    st.one_of(st.text(ALPHABET, max_size=40), st.sampled_from(["<|endoftext|>", "<|startoftext|>", "aaaa" * 9])),
    max_size=6,
).map("".join)


def ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_counts_and_ids_equal_the_library(text):
    assert COUNTER([text]) == [len(ids(text))]
    assert next(iter(ENCODER([text])))[0].tolist() == ids(text)


def test_caches_start_anew_when_full(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED_PIECES", 10)
    monkeypatch.setattr(packing, "CACHED_PIECES", 10)
    counter, encoder, rng = token_counts.TokenCounter(PATH), packing.Encoder(PATH), random.Random(1)
    for _ in range(5):
        text = prose(rng, 40)
        assert counter([text, ""]) == [len(ids(text)), 0]
        assert [x[0].tolist() for x in encoder([text, ""])] == [ids(text), []]


def test_counts_of_awkward_rows(spark):
    rows = token_counts.token_counts(awkward_docs(spark)).collect()
    want = [(r[0] or -1, len((r[1] or "").encode()), len(ids(r[1] or ""))) for r in awkward()]
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in rows) == sorted(want)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in rows)
    assert token_counts.token_counts(no_docs(spark)).count() == 0


def check_pieces(rows, limit):
    sequences, documents = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        documents[r.doc_id].append(r)
    spare = total = 0
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= limit
        spare, total = spare + packing.padding(at, limit), total + at
    return documents, spare / max(total, 1)


def test_pieces_hold_every_token_once(spark):
    unique = [r for r in awkward() if r[0] not in (None, 307, 308)]
    rows = packing.pack(awkward_docs(spark).repartition(3)).collect()
    documents, spare = check_pieces(rows, 4096)
    assert spare < 0.02
    for i, text, *_ in unique:
        want, at = np.array(ids(text or "") + [2], dtype="<u4"), 0
        for r in sorted(documents[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(want)
            at += r.length
            assert r.ids_crc32 == zlib.crc32(want[r.start : at].tobytes())
        assert at == len(want)
    assert packing.pack(no_docs(spark)).count() == 0


def test_long_documents_go_on_in_the_next_block(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 5000)
    rng = random.Random(4)
    docs = spark.createDataFrame([(k, prose(rng, 9000)) for k in range(3)], "doc_id long, text string")
    documents, _ = check_pieces(packing.pack(docs.coalesce(1)).collect(), 4096)
    for parts in documents.values():
        assert sum(r.length for r in parts) == parts[0].doc_tokens


def spare(length, limit):
    return packing.padding(length, limit) if length >= limit // 16 else limit - length


def cheapest(cuts, penalties, limit):
    best = [0] + [None] * (len(cuts) - 1)
    for j in range(1, len(cuts)):
        best[j] = min(
            best[i] + spare(cuts[j] - cuts[i], limit) + packing.SEQUENCE + penalties[j]
            for i in range(j)
            if cuts[j] - cuts[i] <= limit
        )
    return best[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=40), st.integers(0, 10**6))
def test_cuts_are_the_cheapest(steps, seed):
    rng = random.Random(seed)
    cuts = [0, *np.cumsum(steps).tolist()]
    penalties = [0, *[rng.choice([0, 24, 96]) for _ in steps]]
    ends = packing.windows(np.array(cuts), np.array(penalties), 64)
    cost = sum(
        spare(b - a, 64) + packing.SEQUENCE + penalties[cuts.index(b)]
        for a, b in zip([0, *ends], ends)
    )
    assert ends[-1] == cuts[-1] and cost == cheapest(cuts, penalties, 64)
