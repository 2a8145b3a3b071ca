"""Passages that repeat across documents, by a sparse suffix array.

Of all suffixes of a text, word by word, only those are kept that may begin a repeated passage.
The first LEAST words of a suffix hold WINDOW grams of GRAM words, and the least hash among them
(the minimiser) is the same wherever these words stand. A first pass lists the minimisers of each
document; those that two documents hold are given back to their documents, and a second pass
keeps the suffixes that have one of them.

The kept suffixes are sorted by their first LEAST words (the minimiser, then the hash of the
words), then by document and place, so equal ones stand together. Each is given the least other
document with the same words: the first document of its group, or the second one for the rows of
the first. Nothing is sampled and no place is left out: each suffix whose first LEAST words stand
in another document is found, however many documents hold them, however often one document does
and whatever surrounds them. Suffixes at neighbouring places make up longer passages.

The sort is a range partition on all its keys, so a passage that a third of the documents share
is cut into even slices, and a slice holds the rows of one document at most. Groups that cross
the border of slices are settled by the first two documents that each slice saw of them: at most
four rows a slice. Rows are linear in the words that lie in passages: no pairs within a group.

Defined results: spans count words [start, end) split at ASCII white space, case counts. Words
are equal if two 64-bit hashes, of the minimiser and of all LEAST words, are. Missing and short
texts have no spans, and a row without id is not looked at. Rows that repeat an id are one
document. A passage repeated inside one document only is not reported. An empty table gives no
rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.shingles import CACHED_WORDS, WordHashes, mixed
from tillwork.llm.texts import corpus, matching, pin, slices

LEAST = 50
GRAM = 32  # a power of two
WINDOW = LEAST - GRAM + 1
BUCKETS = 1 << 20  # bound of the broadcast that thins the texts before they are shuffled
ROWS_PER_SLICE = 20_000_000
_SORT = ("gram", "words", "doc", "place")
_ROWS = "gram long, words long, doc long, place int"


def _extreme(values: np.ndarray, width: int, pick) -> np.ndarray:
    """The least or largest of each ``width`` neighbours, by doubling."""
    done = 1
    found = values
    while 2 * done <= width:
        found, done = pick(found[: len(found) - done], found[done:]), 2 * done
    rest = width - done
    return pick(found[: len(found) - rest], found[rest:]) if rest else found


def minimisers(grams: np.ndarray, window: int) -> np.ndarray:
    """Places whose hash is the least of some ``window`` neighbours."""
    least = _extreme(grams, window, np.minimum)
    none = np.zeros(window - 1, grams.dtype)
    best = _extreme(np.concatenate([none, least, none]), window, np.maximum)
    return np.flatnonzero(best == grams)


def _doubled(hashes: np.ndarray, words: int) -> np.ndarray:
    done = 1
    while done < words:
        hashes = mixed(hashes[: len(hashes) - done] * np.uint64(3) ^ hashes[done:])
        done *= 2
    return hashes


def _hashed(batches):
    """The columns of each batch and, for its texts of LEAST words or more, (row, word hashes)."""
    hashes = WordHashes()
    for batch in batches:
        if len(hashes) > CACHED_WORDS:
            hashes.clear()
        look, rows = hashes.__getitem__, []
        columns = [c.to_pylist() for c in batch.columns]
        for row, text in enumerate(columns[1]):
            words = text.encode().split()
            if len(words) >= LEAST:
                rows.append((row, np.fromiter(map(look, words), np.uint64, len(words))))
        yield columns, rows


def _batch(names, parts):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], list(names))


def _grams(batches):
    """The distinct minimisers of each text."""
    for columns, rows in _hashed(batches):
        found = []
        for row, h in rows:
            grams = _doubled(h, GRAM)
            kept = np.unique(grams[minimisers(grams, WINDOW)]).view(np.int64)
            found.append((kept, np.full(len(kept), columns[0][row], np.int64)))
        if found:
            yield _batch(("gram", "doc"), found)


def _suffixes(batches):
    """Of each text, the suffixes of LEAST words or more whose minimiser is asked for."""
    for columns, rows in _hashed(batches):
        found = []
        for row, h in rows:
            grams = _doubled(h, GRAM)
            least = _extreme(grams, WINDOW, np.minimum)
            at = np.flatnonzero(np.isin(least.view(np.int64), np.array(columns[2][row], np.int64)))
            # Two grams that overlap cover the LEAST words.
            words = mixed(grams[at] * np.uint64(5) ^ grams[at + LEAST - GRAM])
            doc = np.full(len(at), columns[0][row], np.int64)
            found.append((least[at].view(np.int64), words.view(np.int64), doc, at.astype(np.int32)))
        if found:
            yield _batch(_SORT, found)


_SETTLED, _OPEN, _SEEN = 0, 1, 2
_OTHERS = "kind int, gram long, words long, doc long, place int, other long, other_place int"


def _others(batches):
    """Of a sorted slice: its rows with the least other document of their group (settled), rows
    whose group may have more in other slices (open), and the first row of each of the first two
    documents of the groups at the ends of the slice (seen)."""
    top = None  # the group that the slice begins with
    held = None  # rows of the last group: those without another document, or two that stand for it

    def table(kind, columns, at, other=None):
        n = len(at)
        if other is None:
            others = [pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())]
        else:
            others = [pa.array(columns[2][other]), pa.array(columns[3][other])]
        arrays = [pa.array(np.full(n, kind, np.int32)), *[pa.array(c[at]) for c in columns[:4]], *others]
        return pa.RecordBatch.from_arrays(arrays, ["kind", *_SORT, "other", "other_place"])

    def seen(columns):
        """``held`` has one or two documents; the first row of each."""
        doc = columns[2]
        return np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))

    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(columns[0]):
            continue
        columns.append(np.zeros(len(columns[0]), bool))  # told already
        if held is not None:
            columns = [np.concatenate([h, c]) for h, c in zip(held, columns)]
        gram, words, doc, _, told = columns
        if top is None:
            top = (gram[0], words[0])
        fresh = np.concatenate([[True], (gram[1:] != gram[:-1]) | (words[1:] != words[:-1])])
        group, first = np.cumsum(fresh) - 1, np.flatnonzero(fresh)
        change = np.concatenate([[True], fresh[1:] | (doc[1:] != doc[:-1])])
        changes = np.append(np.flatnonzero(change), len(doc))
        ends = np.append(first[1:], len(doc))
        second = changes[np.searchsorted(changes, first) + 1]
        second = np.where(second < ends, second, -1)
        other = np.where(doc == doc[first][group], second[group], first[group])
        at_top = (gram == top[0]) & (words == top[1])
        waits = (group == group[-1]) & (second[-1] < 0)
        settled = np.flatnonzero(~told & ~at_top & (other >= 0))
        if len(settled):
            yield table(_SETTLED, columns, settled, other[settled])
        opened = np.flatnonzero(~told & at_top & ~waits)
        if len(opened):
            yield table(_OPEN, columns, opened)
        if at_top[0] and not at_top[-1]:
            ahead = [first[0], second[0]] if second[0] >= 0 else [first[0]]
            yield table(_SEEN, columns, np.array(ahead))
        if second[-1] < 0:
            held = [c[first[-1] :] for c in columns]
        else:
            held = [c[[first[-1], second[-1]]] for c in columns]
            held[4][:] = True
    if held is not None:
        left = np.flatnonzero(~held[4])
        if len(left):
            yield table(_OPEN, held, left)
        yield table(_SEEN, held, seen(held))


_FOUND = ("doc", "place", "other", "other_place")
_MATCHES = "doc_id long, start long, end long, other_id long, other_start long"


def _runs(batches):
    """Suffixes at neighbouring places with neighbouring places in the other document, united."""
    held = None
    names = ["doc_id", "start", "end", "other_id", "other_start"]
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
        if not len(columns[0]):
            continue
        doc, place, other, other_place = columns
        shift = other_place - place
        goes_on = (doc[1:] == doc[:-1]) & (place[1:] - place[:-1] <= 1)
        goes_on &= (other[1:] == other[:-1]) & (shift[1:] == shift[:-1])
        first = np.flatnonzero(np.concatenate([[True], ~goes_on]))
        last = np.append(first[1:], len(doc)) - 1
        runs = [doc[first], place[first], place[last] + LEAST, other[first], other_place[first]]
        if held is not None:
            joins = held[0] == runs[0][0] and held[3] == runs[3][0] and held[2] - LEAST + 1 >= runs[1][0]
            if joins and held[4] - held[1] == runs[4][0] - runs[1][0]:
                runs[1][0], runs[4][0] = held[1], held[4]
            else:
                runs = [np.concatenate([[h], r]) for h, r in zip(held, runs)]
        held = [r[-1] for r in runs]
        if len(runs[0]) > 1:
            yield pa.RecordBatch.from_arrays([pa.array(r[:-1]) for r in runs], names)
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([int(h)], pa.int64()) for h in held], names)


def _bucket(column: str):
    return F.pmod(F.xxhash64(column), F.lit(BUCKETS)).cast("int")


def _settled(rows: DataFrame) -> DataFrame:
    """The rows with the least other document of their group, the open ones from what the slices
    have seen of it. One row of the broadcast at most meets a row."""
    seen = F.array_sort(F.collect_set(F.struct("doc", "place")))
    groups = rows.filter(F.col("kind") == _SEEN).groupBy("gram", "words").agg(seen.alias("seen"))
    groups = groups.withColumn("first", F.get("seen", F.lit(0)))
    strange = F.filter("seen", lambda s: s["doc"] != F.col("first.doc"))
    groups = groups.withColumn("second", F.get(strange, F.lit(0))).drop("seen")
    met = rows.filter(F.col("kind") != _SEEN).join(F.broadcast(groups), ["gram", "words"], "left")
    known = F.when(F.col("doc") == F.col("first.doc"), F.col("second")).otherwise(F.col("first"))
    told = F.when(F.col("kind") == _SETTLED, F.struct(F.col("other").alias("doc"), F.col("other_place").alias("place")))
    met = met.select("doc", "place", F.coalesce(told, known).alias("of")).filter("of is not null")
    return met.select("doc", "place", F.col("of.doc").alias("other"), F.col("of.place").alias("other_place"))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Matches (doc_id, start, end, other_id, other_start): each place of each document whose next
    LEAST words another document holds lies in one, with the least such document."""
    texts = corpus(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    texts = texts.filter("doc_id is not null")
    grams = pin(texts.mapInArrow(_grams, "gram long, doc long"), "grams")
    ends = grams.groupBy("gram").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    shared = ends.filter("low < high").select(F.col("gram").alias("shared"))
    # A document has fewer minimisers than words.
    asked = grams.join(shared, matching("gram", "shared"), "left_semi").groupBy("doc")
    asked = pin(asked.agg(F.collect_set("gram").alias("grams")), "asked")
    buckets = F.broadcast(asked.select(_bucket("doc").alias("bucket")).distinct())
    few = texts.join(buckets, _bucket("doc_id") == F.col("bucket"), "left_semi")
    both = few.join(asked, F.col("doc_id") == F.col("doc")).select("doc_id", "text", "grams")
    suffixes = pin(both.mapInArrow(_suffixes, _ROWS), "suffixes")
    parts = slices(texts.sparkSession, suffixes.count(), ROWS_PER_SLICE)
    array = suffixes.repartitionByRange(parts, *_SORT).sortWithinPartitions(*_SORT)
    compared = pin(array.mapInArrow(_others, _OTHERS), "others")
    found = _settled(compared).repartition("doc")
    return found.sortWithinPartitions(*_FOUND).mapInArrow(_runs, _MATCHES)


def repeated_spans(matches: DataFrame) -> DataFrame:
    """The matches of each document united: doc_id, start, end, n_words, other_id (the least id
    that shares one of the passages). A document has fewer matches than places."""
    order = Window.partitionBy("doc_id").orderBy("start", "end", "other_id")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.when(F.col("start") <= reached, 0).otherwise(1)
    numbered = matches.withColumn("fresh", island).withColumn("island", F.sum("fresh").over(order))
    spans = numbered.groupBy("doc_id", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("other_id").alias("other_id")
    )
    return spans.select("doc_id", "start", "end", (F.col("end") - F.col("start")).alias("n_words"), "other_id")
