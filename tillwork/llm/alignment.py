"""Alignment of two tokenizers by merge-path partitioning of their token ends.

A encodes space + text (byte-level BPE), B the text, to which it adds that space (pieces with byte
fallback). Both cover the same bytes, so their token ends are two sorted lists of offsets. Merging
the lists walks a path in the grid (ends of A taken, ends of B taken); each step that moves on in
the bytes is one overlap of an A token with a B token. Diagonals of the grid, PIECE steps apart,
cut the path into pieces of equal work, whatever the lengths of the documents: a binary search on
each diagonal finds where the path crosses it, and a piece then needs nothing but its own stretch
of both lists and the offset at which it starts. Pieces emit overlaps and the offsets where both
ends meet; groups that run over the border of a piece are stitched by those offsets.

Texts with single spaces between words are encoded word by word, each word once in the life of a
cache: a token of either side has no space but at its front, so neither reaches over such a space.
The others, and those with a word that begins with white space of another kind, are encoded whole.

Documents are worked on in blocks of bounded rows and bytes. A block hands on its distinct pairs of
ids, each with the number of its documents that hold it; these sum to the counts of the corpus, on
the map side first, so a pair that every document holds is one row per block. The counts and
whether they are the highest of their A id return to the block as one row per pair and meet its
documents there, which carry their pairs as compressed numbers of the block's list. Nothing is
broadcast and no pair is ever listed per document.

Defined results: texts that are null, empty or whose tokens do not give back space + text in bytes
(white space that a normalizer changes, for example) have no tokens: zeros and an empty string.
Rows count as documents one by one, repeated ids and null ids too. Of an A id's pairs all that
reach its highest count are best. Very long texts are a block of their own, encoded whole. Columns
of other names are never read. An empty table gives no rows.
"""

import hashlib
import json
import os
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.texts import pin
from tillwork.llm.tokens import CACHED_PIECES, tokenizer_path

BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
PIECE = 1 << 14  # steps of the merge path
BLOCK_ROWS, BLOCK_BYTES = 1_000, 3 << 20
CALL_BYTES = 1 << 20  # of texts that a library call encodes
CALL_WORDS = 1 << 14  # that a library call encodes
SPACE = "▁"


def _printable() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = iter(range(256, 512))
    return {chr(b) if b in plain else chr(next(shifted)): b for b in range(256)}


def _by_expression(a) -> bool:
    """Whether a tokenizer cuts plain text by the byte-level expression before anything else."""
    parts = json.loads(a.to_str())
    cut = parts["pre_tokenizer"] or {}
    own = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
    return own and not parts["normalizer"] and all(x["special"] for x in parts["added_tokens"])


class Tokens:
    """Both tokenizers and the bytes of each of their ids."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings are plain text
        of = _printable()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            a_bytes[k] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        b_bytes = []
        for k in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(k)
            byte = self.b.is_byte(k)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if byte else piece.replace(SPACE, " ").encode())
        # No piece has a space inside but those of spaces alone, and A's expression takes a space
        # only before what follows it or with other white space, so the words of a text are encoded
        # apart wherever single spaces part them.
        joined = [p for p in b_bytes if b" " in p[1:] and p.strip(b" ")]
        self.by_words = not joined and _by_expression(self.a)
        self._forget()
        self.bytes = a_bytes, b_bytes
        self.sizes = [np.array([len(x) for x in side], dtype=np.int64) for side in self.bytes]

    def _forget(self):
        self.number: dict[str, int] = {}
        self.flat = [np.zeros(0, np.int64)] * 2
        self.start = [np.zeros(1, np.int64)] * 2
        self.sound = np.zeros(0, bool)  # B gives the word back
        self.alone = np.zeros(0, bool)  # A gives it back and takes no space before it into other white space

    def _learn(self, words: list[str]) -> None:
        for word in words:
            self.number[word] = len(self.number)
        spaced = [" " + word for word in words]
        sides = self._encoded(spaced), self.b.encode(words, num_threads=1)
        raws, gives = [raw.encode() for raw in spaced], []
        lengths = np.cumsum([len(raw) for raw in raws])
        for side, ids in enumerate(sides):
            sizes = np.array([len(own) for own in ids], dtype=np.int64)
            flat = np.fromiter(chain.from_iterable(ids), np.int64, int(sizes.sum()))
            # All at once: the same bytes in all, and the same length up to each word.
            so_far = np.concatenate([[0], np.cumsum(self.sizes[side][flat])])[np.cumsum(sizes)]
            if (so_far == lengths).all() and self._gives(flat.tolist(), side, b"".join(raws)):
                gives.append(np.ones(len(words), bool))
            else:
                gives.append(np.array([self._gives(own, side, raw) for own, raw in zip(ids, raws)], bool))
            self.flat[side] = np.concatenate([self.flat[side], flat])
            self.start[side] = np.concatenate([self.start[side], self.start[side][-1] + np.cumsum(sizes)])
        self.sound = np.concatenate([self.sound, gives[1]])
        # Of the characters that count as white space anywhere only the space is printable.
        self.alone = np.concatenate([self.alone, gives[0] & [word[0].isprintable() for word in words]])

    def _encoded(self, spaced: list[str]) -> list[list[int]]:
        return [x.ids for x in self.a.encode_batch_fast(spaced, add_special_tokens=False)]

    def _by_words(self, at: np.ndarray, side: int) -> np.ndarray:
        start = self.start[side]
        size = start[at + 1] - start[at]
        begin = np.repeat(start[at] - (np.cumsum(size) - size), size)
        return self.flat[side][begin + np.arange(len(begin))]

    def _both(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of A and B of each text, None where they do not give it back."""
        if len(self.number) > CACHED_PIECES:
            self._forget()
        split = [t.split(" ") if self.by_words else [""] for t in texts]
        plain = ["" not in words for words in split]  # else spaces meet or stand at an end
        new = sorted(set().union(*[w for w, p in zip(split, plain) if p]).difference(self.number))
        for first in range(0, len(new), CALL_WORDS):
            self._learn(new[first : first + CALL_WORDS])
        found, whole = [None] * len(texts), []
        for k, (words, apart) in enumerate(zip(split, plain)):
            if not apart:
                whole.append(k)
                continue
            at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
            if not self.sound[at].all():
                continue
            if not self.alone[at].all():
                whole.append(k)
                continue
            found[k] = self._by_words(at, 0), self._by_words(at, 1)
        spaced = [" " + texts[k] for k in whole]
        for k, text, a in zip(whole, spaced, self._encoded(spaced)):
            b = self.b.encode(texts[k])
            if self._gives(b, 1, text.encode()) and self._gives(a, 0, text.encode()):
                found[k] = np.array(a, np.int64), np.array(b, np.int64)
        return found

    def __call__(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B of each text; empty where it has no tokens."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        found = [none] * len(texts)
        some = [k for k, t in enumerate(texts) if t]
        for at in _cuts([len(texts[k]) for k in some], BLOCK_ROWS, CALL_BYTES):
            chosen = some[at[0] : at[1]]
            for k, both in zip(chosen, self._both([texts[k] for k in chosen])):
                if both:
                    found[k] = both
        return found

    def _gives(self, ids: list[int], side: int, raw: bytes) -> bool:
        return b"".join(map(self.bytes[side].__getitem__, ids)) == raw


def _cuts(sizes, rows: int, total: int):
    """Ranges of at most ``rows`` elements and, unless one alone is larger, ``total`` in size."""
    first = size = 0
    for k, own in enumerate(sizes):
        if k > first and (k - first == rows or size + own > total):
            yield first, k
            first, size = k, 0
        size += own
    if first < len(sizes):
        yield first, len(sizes)


def crossings(a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many ends of A lie before each diagonal 0, step, 2 * step, ..., len(a) + len(b), by one
    binary search per diagonal, all side by side. Of equal ends A's comes first."""
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, step), total)
    low, high = np.maximum(diagonal - len(b), 0), np.minimum(diagonal, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        # A's end number ``middle`` is among the first ``diagonal`` ones if B's at the other end
        # of the diagonal is not smaller.
        other = np.clip(diagonal - middle - 1, 0, max(len(b) - 1, 0))
        earlier = a[np.minimum(middle, len(a) - 1)] <= b[other]
        low = np.where(open_ & earlier, middle + 1, low)
        high = np.where(open_ & ~earlier, middle, high)
    return low


def piece(a: np.ndarray, b: np.ndarray, i: int, j: int, start: int) -> tuple[np.ndarray, ...]:
    """Overlaps (A token, B token) of a stretch of the path from (i, j), and where both ends meet.
    ``a`` and ``b`` are the ends of the stretch, ``start`` is the last end before it."""
    n = len(a) + len(b)
    from_a = np.zeros(n, bool)
    from_a[np.arange(len(a)) + np.searchsorted(b, a, "left")] = True
    ends = np.empty(n, a.dtype)
    ends[from_a], ends[~from_a] = a, b
    before = np.concatenate([np.array([start], a.dtype), ends[:-1]])
    moves = ends > before
    one = i + np.cumsum(from_a) - from_a
    two = j + np.cumsum(~from_a) - ~from_a
    return one[moves].astype(a.dtype), two[moves].astype(a.dtype), ends[~moves]


def align(a: np.ndarray, b: np.ndarray, step: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All overlaps of tokens with these ends, in order, and the offsets at which groups end."""
    split = crossings(a, b, step)
    diagonal = np.append(np.arange(0, len(a) + len(b), step), len(a) + len(b))
    found = []
    for p in range(len(split) - 1):
        i, to_i = split[p], split[p + 1]
        j, to_j = diagonal[p] - i, diagonal[p + 1] - to_i
        start = max(a[i - 1] if i else 0, b[j - 1] if j else 0)
        found.append(piece(a[i:to_i], b[j:to_j], i, j, start))
    if not found:
        return (np.zeros(0, a.dtype),) * 3
    return tuple(np.concatenate(part) for part in zip(*found))


class Writer:
    """Digests of groups ``a1,a2|b1;a3|b2,b3``, from fixed-width strings of ids and separators."""

    def __init__(self, ids: int):
        names = np.arange(ids).astype("S")
        width = f"S{names.dtype.itemsize + 1}"
        self.table = np.concatenate([np.char.add(names, sep).astype(width) for sep in (b",", b"|", b";")])
        self.ids = ids

    def places(self, ids: np.ndarray, last: np.ndarray, side: int) -> np.ndarray:
        """Where the strings of these ids are; ``last`` of their side in a group; ``side`` 0 or 1."""
        return np.where(last, (side + 1) * self.ids, 0).astype(np.int32) + ids

    def __call__(self, places: np.ndarray) -> str:
        text = self.table[places].tobytes().translate(None, b"\0")
        return hashlib.sha256(text[:-1]).hexdigest()  # no separator after the last group


def _aligned(a_path: str, b_path: str):
    """Rows of documents (kind 0) and of the pairs of a block (kind 1), numbered in order."""

    def run(batches):
        tokens = Tokens(a_path, b_path)
        writer = Writer(max(map(len, tokens.bytes)))
        packer = pa.Codec("zstd")
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = batch.column(1).to_pylist()
            for first, end in _cuts(sizes, BLOCK_ROWS, BLOCK_BYTES):
                part = batch.slice(first, end - first)
                yield _block(block, part.column(0), part.column(2).to_pylist(), tokens, writer, packer)
                block += 1

    return run


def _block(block: int, ids: pa.Array, texts: list, tokens: Tokens, writer: Writer, packer) -> pa.RecordBatch:
    encoded = tokens(texts)
    n_a = np.array([len(x[0]) for x in encoded])
    n_b = np.array([len(x[1]) for x in encoded])
    all_a, all_b = [np.concatenate(side).astype(np.int32) for side in zip(*encoded)]
    del encoded
    ends_a, ends_b = [np.cumsum(size[ids], dtype=np.int32) for size, ids in zip(tokens.sizes, (all_a, all_b))]
    one, two, meet = align(ends_a, ends_b)
    of_a, of_b = np.repeat(np.arange(len(texts), dtype=np.int32), n_a), np.repeat(np.arange(len(texts)), n_b)
    n_groups, digests = _groups(all_a, all_b, ends_a, ends_b, meet, of_a, of_b, n_a, n_b, writer)
    del ends_a, ends_b, meet, of_b
    doc = of_a[one].astype(np.int64)
    n_links = np.bincount(doc, minlength=len(texts))

    width = len(tokens.sizes[1])
    pair = all_a[one].astype(np.int64) * width + all_b[two]
    del one, two, all_a, all_b, of_a
    known, number = np.unique(pair, return_inverse=True)
    del pair
    held, times = np.unique(doc * len(known) + number, return_counts=True)
    del doc, number
    holders = np.bincount(held % max(len(known), 1), minlength=len(known))
    start = np.searchsorted(held, np.arange(len(texts) + 1) * len(known))
    packed = []
    for k in range(len(texts)):
        own = slice(start[k], start[k + 1])
        numbers = np.diff(held[own] % max(len(known), 1), prepend=0)
        raw = np.stack([numbers, times[own]]).astype(np.uint32).tobytes()
        packed.append(packer.compress(raw, asbytes=True) if raw else b"")

    zeros = np.zeros(len(known), np.int64)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat([0, 1], [len(texts), len(known)]).astype(np.int32)),
            pa.array(np.full(len(texts) + len(known), block)),
            pa.concat_arrays([ids, pa.nulls(len(known), ids.type)]),
            *[
                pa.array(np.concatenate([x, y]))
                for x, y in (
                    (n_a, known // width),
                    (n_b, known % width),
                    (n_groups, holders),
                    (n_links, np.arange(len(known))),
                    (np.diff(start), zeros),
                )
            ],
            pa.array(digests + [None] * len(known), pa.string()),
            pa.array(packed + [None] * len(known), pa.binary()),
        ],
        ["kind", "block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_pairs", "groups_sha256", "pairs"],
    )


def _groups(all_a, all_b, ends_a, ends_b, meet, of_a, of_b, n_a, n_b, writer: Writer):
    """Number and digest of the groups of each text of a block."""
    # Groups end where ends meet, and so do documents.
    group_a, group_b = [np.searchsorted(meet, ends, "left").astype(np.int32) for ends in (ends_a, ends_b)]
    last_a = np.append(group_a[1:] != group_a[:-1], True)[: len(group_a)]
    last_b = np.append(group_b[1:] != group_b[:-1], True)[: len(group_b)]
    n_groups = np.bincount(of_a[last_a], minlength=len(n_a))
    bounds_a, bounds_b = [np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b)]
    # A's tokens of a group come before B's of the same group.
    sizes_a, sizes_b = [np.bincount(g, minlength=len(meet)) for g in (group_a, group_b)]
    order = np.zeros(len(all_a) + len(all_b), np.int32)
    place_a = np.arange(len(all_a)) + (np.cumsum(sizes_b) - sizes_b)[group_a]
    order[place_a] = writer.places(all_a, last_a, 0)
    del place_a
    order[np.arange(len(all_b)) + np.cumsum(sizes_a)[group_b]] = writer.places(all_b, last_b, 1)
    bounds = bounds_a + bounds_b
    digests = [""] * len(n_a)
    for k in np.flatnonzero(n_a):
        digests[k] = writer(order[bounds[k] : bounds[k + 1]])
    return n_groups, digests


def _summed(left: pa.Table, right: pa.Table) -> pa.Table:
    """The documents of a block with the counts of their pairs."""
    count = np.zeros(right.num_rows, np.int64)
    best = np.zeros(right.num_rows, bool)
    at = right.column("number").to_numpy()
    count[at], best[at] = right.column("count").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
    codec = pa.Codec("zstd")
    n_best, count_sum = [], []
    for packed, size in zip(left.column("pairs").to_pylist(), left.column("n_pairs").to_pylist()):
        if not size:
            n_best.append(0)
            count_sum.append(0)
            continue
        raw = np.frombuffer(codec.decompress(packed, 8 * size, asbytes=True), np.uint32).reshape(2, size)
        number, times = np.cumsum(raw[0], dtype=np.int64), raw[1].astype(np.int64)
        n_best.append(int(times[best[number]].sum()))
        count_sum.append(int((times * count[number]).sum()))
    kept = left.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    kept = kept.append_column("n_best", pa.array(n_best, pa.int64()))
    kept = kept.append_column("count_sum", pa.array(count_sum, pa.int64()))
    return kept.append_column("groups_sha256", left.column("groups_sha256"))


def alignment(
    docs: DataFrame,
    a_path: str | None = None,
    b_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.octet_length(text), F.lit(0)).alias("size"), text.alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    numbers = "n_a long, n_b long, n_groups long, n_links long"
    run = _aligned(a_path or tokenizer_path(BYTE_LEVEL), b_path or tokenizer_path(PIECES))
    # Pinned: a block is what one task made of its part of the scan.
    both = pin(
        rows.mapInArrow(
            run,
            f"kind int, block long, doc_id {kind}, {numbers}, n_pairs long, groups_sha256 string, pairs binary",
        ),
        "aligned",
    )
    of_docs = both.filter("kind = 0").drop("kind")
    pairs = both.filter("kind = 1").select(
        F.col("block").alias("of_block"), F.col("n_a").alias("a"), F.col("n_b").alias("b"),
        F.col("n_groups").alias("docs"), F.col("n_links").alias("number"),
    )
    counted = pairs.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    highest = counted.groupBy("a").agg(F.max("count").alias("top"))
    known = counted.join(highest, "a").select(
        F.col("a").alias("of_a"), F.col("b").alias("of_b"), "count", (F.col("count") == F.col("top")).alias("best")
    )
    priced = pairs.join(known, (F.col("a") == F.col("of_a")) & (F.col("b") == F.col("of_b")))
    priced = priced.select("of_block", "number", "count", "best")
    return (
        of_docs.groupBy("block")
        .cogroup(priced.groupBy("of_block"))
        .applyInArrow(
            _summed, f"doc_id {kind}, {numbers}, n_best long, count_sum long, groups_sha256 string",
        )
    )
