"""Token counts by rank-synchronous merging of ragged numpy arrays.

The byte-pair merges of a whole batch of pre-tokens run side by side: one flat array of symbol
ids, in which every round looks up the rank of each adjacent pair, takes the lowest rank of each
sequence and applies that pair at all its places at once; sequences without a pair that merges
leave the array. What is left of a sequence is its number of tokens.

This is for vocabularies that drop white space (end-of-word BPE), so texts are split at white
space first and the counts of the pieces are cached, in a cache of bounded size. Normalizing
(NFC, lower case), special strings and the pre-token pattern follow the tokenizer file.

Defined results: a missing text counts as empty, 0 tokens. Rows are counted one by one, so ties,
repeated rows and missing ids change nothing. An empty table gives no rows.
"""

import json
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.texts import corpus
from tillwork.llm.tokens import CACHED_PIECES, pieces, tokenizer_path

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
BATCH_TEXTS = 1_000
NEVER = np.iinfo(np.int64).max


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class Merger:
    """The merges of a vocabulary as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, vocab = spec["model"], spec["model"]["vocab"]
        end = model["end_of_word_suffix"] or ""
        symbols = _byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], dtype=np.int64)
        self.last = np.array([vocab[s + end] for s in symbols], dtype=np.int64)
        self.base = max(vocab.values()) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], dtype=np.int64)
        # "x</w>" is the last symbol of a word; a merge keeps the suffix of its right part.
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order.astype(np.int64), made[order]
        self.special = [t["content"] for t in spec["added_tokens"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.pattern = split["pattern"]["Regex"]

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """What is left of non-empty words: all symbols in a row, and how many of each word."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        ends = np.cumsum(sizes)
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        ids = self.inner[raw]
        ids[ends - 1] = self.last[raw[ends - 1]]
        owner = np.repeat(np.arange(len(words)), sizes)
        final_ids, final_owners = [], []
        while len(ids):
            key = ids[:-1] * self.base + ids[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (owner[:-1] == owner[1:])
            rank = np.append(np.where(known, self.ranks[at], NEVER), NEVER)
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            lowest = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(ids)))
            done = np.repeat(lowest == NEVER, size)
            final_ids.append(ids[done])
            final_owners.append(owner[done])
            left = np.flatnonzero(_leftmost((rank == np.repeat(lowest, size)) & ~done))
            ids[left] = self.made[at[left]]
            keep = ~done
            keep[left + 1] = False
            ids, owner = ids[keep], owner[keep]
        owners = np.concatenate(final_owners)
        order = np.argsort(owners, kind="stable")
        return np.concatenate(final_ids)[order], np.bincount(owners, minlength=len(words))


def _leftmost(merge: np.ndarray) -> np.ndarray:
    """Of places that overlap (a run of one symbol) every second one, from the left."""
    index = np.flatnonzero(merge)
    if not len(index):
        return merge
    starts = np.append(True, np.diff(index) > 1)
    run = np.repeat(index[starts], np.diff(np.append(np.flatnonzero(starts), len(index))))
    merge = merge.copy()
    merge[index[(index - run) % 2 == 1]] = False
    return merge


def normal(piece: str) -> str:
    """NFC and lower case as the tokenizer file asks for."""
    if piece.isascii():
        return piece.lower()
    # Character by character: a final sigma is not treated apart.
    return unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()


def split_words(pattern, piece: str) -> list[str]:
    """The pre-tokens; letters alone are one, whatever else the pattern looks for."""
    return [piece] if piece.isalpha() else pattern.findall(piece)


class TokenCounter:
    def __init__(self, path: str):
        import regex

        self.merger = Merger(path)
        self.words = regex.compile(self.merger.pattern)
        self.specials = regex.compile("|".join(map(regex.escape, self.merger.special)) or r"(?!)")
        self.known: dict[str, int] = {}

    def _learn(self, new: list[str]) -> None:
        found = [split_words(self.words, normal(piece)) for piece in new]
        unique = list({w: None for w in chain.from_iterable(found)})
        of = dict(zip(unique, self.merger.merged([w.encode() for w in unique])[1].tolist())) if unique else {}
        for piece, parts in zip(new, found):
            self.known[piece] = sum(map(of.__getitem__, parts))

    def __call__(self, texts: list[str]) -> list[int]:
        extra, split = [], []
        for text in texts:
            special = 0
            if "<|" in text:
                parts = self.specials.split(text)
                special, text = len(parts) - 1, "\n".join(parts)
            extra.append(special)
            split.append(pieces(text))
        if len(self.known) > CACHED_PIECES:
            self.known = {}
        new = set().union(*split).difference(self.known)
        if new:
            self._learn(sorted(new))
        look = self.known.__getitem__
        return [n + sum(map(look, one)) for n, one in zip(extra, split)]


def _count(path: str):
    def run(batches):
        counter = TokenCounter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(at, BATCH_TEXTS)
                n = pa.array(counter(part.column(2).to_pylist()), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), n], ["doc_id", "n_bytes", "n_tokens"]
                )

    return run


def token_counts(
    docs: DataFrame,
    path: str | None = None,
    limit: int = LIMIT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row. ``path`` is a tokenizer file."""
    texts = corpus(docs, id_col, text_col).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text"
    )
    kind = texts.schema["doc_id"].dataType.simpleString()
    counted = texts.mapInArrow(
        _count(path or tokenizer_path(TOKENIZER)), f"doc_id {kind}, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
