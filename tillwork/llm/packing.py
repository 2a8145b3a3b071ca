"""Packing by order-preserving dynamic programming over cut positions.

The documents of a scan partition, in stored order and each closed by an end id, are a stream of
tokens; sequences are consecutive windows of it. Windows may end where a document ends (free),
after a sentence (a small penalty) or, so that long stretches without a sentence can be cut at
all, on a grid (a large one). A sequence costs its padding: none at a power of two, else up to
the limit. The cheapest cuts of a block are found from left to right: the cost before a window
plus the position where it starts is what varies among its possible starts, so a monotone queue
over the last ``limit`` tokens holds the best start, and starts at exactly a power of two are
looked up beside it. What is left at the end of a block is cut into powers of two where that is
cheaper than padding it.

No shuffle and no sort: a scan partition is a fixed part of the stored files, so a task that runs
again gives the same sequences. Tokens are held a block at a time; a longer document goes on in
the next block.

Defined results: a missing text is empty and packs as its end id alone. Rows that repeat an id
are packed one by one. An empty table gives no rows.
"""

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tillwork.llm.texts import corpus
from tillwork.llm.token_counts import Merger, normal, split_words
from tillwork.llm.tokens import CACHED_PIECES, pieces, tokenizer_path

TOKENIZER = "word_bpe_49k.json"
LIMIT = 4096
END_ID = 2
BLOCK = 1 << 20  # tokens in memory, with their cut positions
BATCH_TEXTS = 500
GRID = 512
SENTENCE_CUT, HARD_CUT, SEQUENCE = 24, 96, 48  # in tokens of padding
SENTENCE_ENDS = (".", "!", "?", "…", "。", "！", "？")


class _Numbers(dict):
    """Numbers pieces in the order in which they are first asked for, and notes the new ones."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, piece):
        self.new.append(piece)
        number = self[piece] = len(self)
        return number


class Encoder:
    """Token ids of whole texts, and where their sentences end. Pieces between white space are
    encoded once, many side by side as in token_counts, and kept, flat, in a cache of bounded
    size; texts with special strings are left to the library."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merger = Merger(path)
        self.words = regex.compile(self.merger.pattern)
        self._forget()

    def _forget(self):
        self.number = _Numbers()
        self.ids = np.zeros(0, np.uint32)
        self.start = np.zeros(1, np.int64)
        self.ends = np.zeros(0, bool)

    def _learn(self) -> None:
        new, self.number.new = self.number.new, []
        found = [split_words(self.words, normal(piece)) for piece in new]
        unique: dict[str, int] = {}
        parts = [unique.setdefault(w, len(unique)) for one in found for w in one]
        flat, sizes = self.merger.merged([w.encode() for w in unique]) if unique else (self.ids, self.start[:0])
        starts = np.cumsum(sizes) - sizes
        parts = np.array(parts, dtype=np.int64)
        size = sizes[parts]
        begin = np.repeat(starts[parts] - (np.cumsum(size) - size), size)
        # Pieces hold some words each: their tokens are those of the words in a row.
        after = np.concatenate([[0], np.cumsum(size)])
        words = np.cumsum([len(one) for one in found])
        self.ids = np.concatenate([self.ids, flat[begin + np.arange(len(begin))].astype(np.uint32)])
        self.start = np.concatenate([self.start, self.start[-1] + after[words]])
        ends = [p.rstrip("\"')]»”").endswith(SENTENCE_ENDS) for p in new]
        self.ends = np.concatenate([self.ends, np.array(ends, dtype=bool)])

    def __call__(self, texts: list[str]):
        """(ids, positions after a sentence) of each text."""
        if len(self.number) > CACHED_PIECES:
            self._forget()
        look, numbers = self.number.__getitem__, []
        for text in texts:
            if "<|" in text and any(s in text for s in self.merger.special):
                numbers.append(None)
            else:
                one = pieces(text)
                numbers.append(np.fromiter(map(look, one), np.int64, len(one)))
        if self.number.new:
            self._learn()
        for text, at in zip(texts, numbers):
            if at is None:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                yield np.array(ids, dtype=np.uint32), np.zeros(0, np.int64)
                continue
            size = self.start[at + 1] - self.start[at]
            after = np.cumsum(size)
            begin = np.repeat(self.start[at] - (after - size), size)
            yield self.ids[begin + np.arange(len(begin))], after[self.ends[at]]


def padding(length: int, limit: int) -> int:
    return 0 if length & (length - 1) == 0 else limit - length


def windows(cuts: np.ndarray, penalties: np.ndarray, limit: int) -> list[int]:
    """The cheapest ends of sequences. ``cuts`` are sorted positions, 0 and the end among them,
    at most ``limit`` apart. Shorter sequences than a sixteenth of the limit count as padded, so
    that texts are not cut into crumbs."""
    position, penalty = cuts.tolist(), penalties.tolist()
    powers = [limit >> k for k in range(5)]
    exact: dict[int, list[int]] = {}
    for power in powers:
        at = np.searchsorted(cuts, cuts - power)
        at = np.minimum(at, len(cuts) - 1)
        for j in np.flatnonzero(cuts[at] == cuts - power).tolist():
            exact.setdefault(j, []).append(int(at[j]))
    cost, origin = [0] * len(position), [0] * len(position)
    queue: deque = deque([0])  # indices whose cost + position rises
    keys = [0] * len(position)
    for j in range(1, len(position)):
        here = position[j]
        while here - position[queue[0]] > limit:
            queue.popleft()
        start = queue[0]
        best = keys[start] + limit - here
        for i in exact.get(j, ()):
            if cost[i] < best:
                best, start = cost[i], i
        cost[j], origin[j] = best + SEQUENCE + penalty[j], start
        keys[j] = key = cost[j] + here
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    ends, j = [], len(position) - 1
    while j:
        ends.append(position[j])
        j = origin[j]
    return ends[::-1]


def _tail(ends: list[int], limit: int) -> list[int]:
    """Cut the last sequence into powers of two if its padding costs more than the cuts."""
    first = ends[-2] if len(ends) > 1 else 0
    length, more = ends[-1] - first, []
    while length:
        part = 1 << (length.bit_length() - 1)
        first, length = first + part, length - part
        more.append(first)
    spare = padding(ends[-1] - (ends[-2] if len(ends) > 1 else 0), limit)
    return ends[:-1] + more if spare > (len(more) - 1) * (HARD_CUT + SEQUENCE) else ends


class _Block:
    """Pieces of documents up to BLOCK tokens, and their cut positions."""

    def __init__(self):
        self.size, self.parts, self.cuts, self.costs = 0, [], [0], [0]

    def add(self, doc, ids: np.ndarray, start: int, sentences: np.ndarray) -> int:
        """Take the tokens of a document from ``start``; returns how far they fit."""
        stop = min(len(ids), start + BLOCK - self.size)
        shift = self.size - start
        inner = sentences[(sentences > start) & (sentences < stop)]
        grid = np.arange(start + GRID, stop, GRID)
        at = np.concatenate([inner, grid])
        costs = np.concatenate([np.full(len(inner), SENTENCE_CUT), np.full(len(grid), HARD_CUT)])
        order = np.lexsort((costs, at))
        at, costs = at[order], costs[order]
        once = np.append(True, at[1:] != at[:-1]) if len(at) else np.zeros(0, bool)
        self.cuts += (at[once] + shift).tolist() + [stop + shift]
        self.costs += costs[once].tolist() + [0 if stop == len(ids) else HARD_CUT]
        self.parts.append((doc, ids, start, stop))
        self.size += stop - start
        return stop

    def sequences(self, limit: int, number: int):
        """Rows (doc, start, length, crc, doc tokens, sequence, offset), and the next number."""
        if not self.size:
            return [], number
        ends = _tail(windows(np.array(self.cuts), np.array(self.costs), limit), limit)
        rows, at, window, begin = [], 0, 0, 0
        for doc, ids, start, stop in self.parts:
            while start < stop:
                length = min(stop - start, ends[window] - at)
                crc = zlib.crc32(ids[start : start + length].astype("<u4").tobytes())
                rows.append((doc, start, length, crc, len(ids), number + window, at - begin))
                start, at = start + length, at + length
                if at == ends[window]:
                    window, begin = window + 1, at
        return rows, number + len(ends)


COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _pack(path: str, limit: int, end_id: int):
    def table(rows, kind):
        columns = list(zip(*rows)) or [()] * len(COLUMNS)
        kinds = [kind] + [pa.int64()] * (len(COLUMNS) - 1)
        arrays = [pa.array(c, t) for c, t in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, list(COLUMNS))

    def run(batches):
        encoder, block, kind = Encoder(path), _Block(), pa.int64()
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            kind = batch.schema.field(0).type
            for first in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(first, BATCH_TEXTS)
                encoded = encoder(part.column(1).to_pylist())
                for doc, (ids, sentences) in zip(part.column(0).to_pylist(), encoded):
                    ids = np.append(ids, np.uint32(end_id))
                    done = 0
                    while done < len(ids):
                        done = block.add(doc, ids, done, sentences)
                        if block.size == BLOCK:
                            rows, number = block.sequences(limit, number)
                            yield table(rows, kind)
                            block = _Block()
        rows, _ = block.sequences(limit, number)
        if rows:
            yield table(rows, kind)

    return run


def pack(
    docs: DataFrame,
    path: str | None = None,
    limit: int = LIMIT,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of a document in a sequence: COLUMNS. ``path`` is a tokenizer file,
    ``limit`` a power of two of at least GRID."""
    texts = corpus(docs, id_col, text_col)
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COLUMNS[1:])
    return texts.mapInArrow(_pack(path or tokenizer_path(TOKENIZER), limit, end_id), schema)
