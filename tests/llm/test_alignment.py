import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import DATA
from tests.llm.cases import SCHEMA, awkward, awkward_docs, no_docs
from tillwork.llm import alignment as al
from tillwork.llm import queries
from tillwork.llm.texts import documents
from tillwork.llm.tokens import tokenizer_path

pytest.importorskip("tokenizers")
pytest.importorskip("sentencepiece")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path(al.BYTE_LEVEL))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(al.PIECES))


def byte_of(character):
    """The byte-level code, from its definition: printable bytes stand for themselves."""
    shifted = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
    return {chr(256 + k): b for k, b in enumerate(shifted)}.get(character, ord(character))


def encoded(text, libraries):
    """[(id, bytes)] of A and of B, or none."""
    if not text:
        return [], []
    a, b = libraries
    one = [(k, bytes(map(byte_of, a.id_to_token(k)))) for k in a.encode(" " + text, add_special_tokens=False).ids]
    two = []
    for k in b.encode(text):
        name = b.id_to_piece(k)
        two.append((k, bytes([int(name[3:5], 16)]) if b.is_byte(k) else name.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    same = b"".join(x for _, x in one) == raw and b"".join(x for _, x in two) == raw
    return (one, two) if same else ([], [])


def plain(texts, libraries):
    """Rows in the order of ``texts``, byte by byte."""
    links, groups, sizes = [], [], []
    for text in texts:
        spans = []
        for side in encoded(text, libraries):
            at, own = 0, []
            for k, raw in side:
                own.append((at, at + len(raw), k))
                at += len(raw)
            spans.append(own)
        one, two = spans
        sizes.append((len(one), len(two)))
        bytes_a = [k for k, (s, e, _) in enumerate(one) for _ in range(s, e)]
        bytes_b = [k for k, (s, e, _) in enumerate(two) for _ in range(s, e)]
        found = sorted(set(zip(bytes_a, bytes_b)))
        links.append([(one[x][2], two[y][2]) for x, y in found])
        cuts = sorted({e for _, e, _ in one} & {e for _, e, _ in two})
        parts, before = [], 0
        for cut in cuts:
            inside = [",".join(str(k) for s, e, k in side if before < e <= cut) for side in (one, two)]
            parts.append("|".join(inside))
            before = cut
        groups.append(parts)
    count = Counter(pair for own in links for pair in set(own))
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    return [
        (
            *size, len(parts), len(own), sum(count[p] == top[p[0]] for p in own), sum(count[p] for p in own),
            hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else "",
        )
        for size, parts, own in zip(sizes, groups, links)
    ]


def compare(spark, texts, libraries, parts=3):
    rows = [(k, t, "en", "s", 1, "r", "k", "h", "y", "p", 3) for k, t in enumerate(texts)]
    found = al.alignment(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in found}
    want = plain(texts, libraries)
    assert len(found) == len(texts)
    for k, row in enumerate(want):
        assert got[k] == row, texts[k][:80] if texts[k] else texts[k]


ENDS = st.lists(st.integers(1, 40), min_size=1, max_size=60, unique=True).map(sorted)


@settings(max_examples=400, deadline=None)
@given(ENDS, ENDS, st.integers(1, 9))
def test_pieces_of_the_path_equal_all_overlaps(a, b, step):
    last = max(a[-1], b[-1])
    a, b = [*[x for x in a if x < last], last], [*[x for x in b if x < last], last]
    one, two, meet = al.align(np.array(a), np.array(b), step)
    spans = [list(zip([0, *ends[:-1]], ends)) for ends in (a, b)]
    want = [
        (i, j)
        for i, (s, e) in enumerate(spans[0])
        for j, (t, f) in enumerate(spans[1])
        if max(s, t) < min(e, f)
    ]
    assert list(zip(one.tolist(), two.tolist())) == want
    assert meet.tolist() == sorted(set(a) & set(b))
    split = al.crossings(np.array(a), np.array(b), step)
    steps = np.diff(split) + np.diff(np.append(np.arange(0, len(a) + len(b), step), len(a) + len(b)) - split)
    assert (steps[:-1] == step).all() and 0 < steps[-1] <= step  # equal work


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=30))
def test_bytes_of_tokens(text):
    tokens = test_bytes_of_tokens.__dict__.setdefault(
        "tokens", al.Tokens(tokenizer_path(al.BYTE_LEVEL), tokenizer_path(al.PIECES))
    )
    a, b = tokens([text])[0]
    for ids, side in ((a, 0), (b, 1)):
        if len(ids):
            assert b"".join(tokens.bytes[side][k] for k in ids) == (" " + text).encode()


def test_awkward_texts(spark, libraries):
    texts = [
        None, "", " ", "  two  spaces ", "line\nbreak\r\n\ttab", "a▁b", "<|endoftext|> </s> <s><unk> <0x41>", " x",
        "é ß 漢字 😀👍🏽 é", "ﬁ ① ｆｕｌｌ", "\x00nul", "a" * 5000, "the the the", "the", "THE cat", " ﻿x",
    ] + [r[1] for r in awkward()][:60]
    compare(spark, texts, libraries)


def test_blocks_and_pieces_do_not_change_the_result(spark, libraries, monkeypatch):
    monkeypatch.setattr(al, "BLOCK_ROWS", 4)
    monkeypatch.setattr(al, "PIECE", 5)
    monkeypatch.setattr(al, "BLOCK_BYTES", 300)
    compare(spark, [r[1] for r in awkward()][:45] + ["the cat"] * 30, libraries, 2)


def test_rows_without_id_repeated_rows_and_no_rows(spark, libraries):
    found = al.alignment(awkward_docs(spark)).collect()
    want = plain([r[1] for r in awkward()], libraries)
    keyed = sorted((r[0] if r[0] is not None else -1, *w) for r, w in zip(awkward(), want))
    assert sorted((r.doc_id if r.doc_id is not None else -1, *[r[c] for c in COLUMNS]) for r in found) == keyed
    assert al.alignment(no_docs(spark)).count() == 0


WHITE = ["\n", "\t", "\r\n", "\x0b", "\x1c", "\x85", "\xa0", "\u180e", "\u200b", "\u2028", "\u3000", "\ufeff", " "]
PARTS = st.sampled_from([*WHITE, " ", " ", "it's", "'ll", "the", "42nd", "--", "é", "漢字", "<|endoftext|>", "▁", "\u0301", "😀"])


@pytest.fixture(scope="module")
def tokens():
    return al.Tokens(tokenizer_path(al.BYTE_LEVEL), tokenizer_path(al.PIECES))


@settings(max_examples=600, deadline=None)
@given(st.lists(PARTS, min_size=1, max_size=12).map("".join))
def test_words_encoded_apart_give_the_tokens_of_the_library(libraries, tokens, text):
    assert tokens.by_words
    a, b = tokens([text])[0]
    assert (a.tolist(), b.tolist()) == tuple([k for k, _ in side] for side in encoded(text, libraries))


def test_a_repeated_word_is_encoded_once_by_both_sides(libraries):
    tokens, seen = al.Tokens(tokenizer_path(al.BYTE_LEVEL), tokenizer_path(al.PIECES)), Counter()

    class Counted:
        def __init__(self, side, library, plain):
            self.side, self.library, self.plain = side, library, plain

        def take(self, texts, *rest, **more):
            seen[self.side] += sum(map(len, [texts] if isinstance(texts, str) else texts))
            return getattr(self.library, self.plain)(texts, *rest, **more)

        encode = encode_batch_fast = take

    tokens.a, tokens.b = Counted("a", tokens.a, "encode_batch_fast"), Counted("b", tokens.b, "encode")
    texts = ["the cat sat on the mat " * 200 + "again", "a cat on the mat\n " * 200 + "again"]
    found = tokens(texts)
    assert seen["a"] < 100 and seen["b"] < 100
    for (a, b), text in zip(found, texts):
        assert (a.tolist(), b.tolist()) == tuple([k for k, _ in side] for side in encoded(text, libraries))


def test_a_text_of_megabytes(spark):
    rows = [(1, "word, " * 500_000, "en", "s", 1, "r", "k", "h", "y", "p", 3)]
    row = al.alignment(spark.createDataFrame(rows, SCHEMA)).first()
    assert row.n_links >= row.n_groups > 900_000 and row.count_sum == row.n_links == row.n_best + (
        row.n_links - row.n_best
    )


def test_query_over_the_whole_table(spark, libraries):
    rows = documents(spark, DATA).select("doc_id", "text").collect()
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.op11_alignment(spark, DATA).collect()}
    want = plain([r.text for r in rows], libraries)
    assert found == {r.doc_id: w for r, w in zip(rows, want)}
