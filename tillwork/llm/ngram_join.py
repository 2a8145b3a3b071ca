"""Jaccard join of shingle sets: a partition of the shingle universe and the pigeonhole.

Two sets of sizes l <= s reach the threshold only if they differ in at most H(l, s) shingles.
Hash the universe into m = H + 1 + x segments: at least x + 1 segments of the two sets agree.
Every document leaves out its x weakest segments and emits a signature of each other one. The
order of weakness looks only at what a segment holds, so the strongest agreeing segment has x
weaker agreeing ones and is left out by neither side: no link is lost. Weak are segments with
few shingles and with shingles that much of the corpus shares; those shingles are counted over
all documents. Where a band has so many documents that plain segments would collide by chance,
the cost model gives each segment one difference instead: fewer, larger segments, emitted whole
and with each shingle left out in turn (one-deletion neighbourhoods).

Sizes fall into bands; a document emits the scheme of its own band and, if it can be the larger
of a pair, the one of the band below.

A signature that many documents share is combined inside each Arrow batch, so the shuffle gets
a row per batch of it. Equal sets (the same size and the same two 64-bit sums over the hashes of
the shingles) are one class before any of this. Most signatures that are shared at all are shared
by chance and by few documents: those of at most SMALL documents are taken out at once, as pairs
whose sizes may be similar, fewer than two for each of their rows. Documents of the others are not
paired with each other. First come rounds of one pair per document: the signature's best known
document is its centre, and a document is compared with the centre it shares most signatures with.
What links is merged, signatures left with one component go, and the rounds end when they merge
little. So a family of near copies, however large, costs a pair per document and a round. Then the
pairs of small signatures, and the documents of every other one that is still open, block with
block where there are many, are compared in sketches, and only pairs that pass go on: each document
with its closest one, then with GROWTH times as many; what links is merged, pairs inside one
component go, until none is left.

A parity sketch of each set, as long as the set is large, bounds the difference of two sets from
below: of all pairs only those it lets through are compared on their texts, and what a pair is
worth is decided on the shingles themselves. Merges are handed on as pairs of labels, never as
pairs of documents.

Defined results: texts without words have an empty set and link with nothing; a row without id
is returned with a null component and links with nothing; rows that repeat an id are one node
and link as soon as one of their texts does. Ids must be whole numbers or cast to them: others
become null. Very long texts are shingled whole, in a batch of their own. Columns of other names
are never read. An empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.components import components
from tillwork.llm.shingles import Shingler, mixed, shingle_set
from tillwork.llm.texts import corpus, matching, pin, released

BAND = 1.5  # ratio of the sizes in a band
SPARE = 0.25  # x as a share of H + 1
PLAIN, HEAVY = 16, 1  # what a shingle adds to the strength of its segment
HEAVY_SHARE = 0.002  # of the documents hold a heavy shingle
MAX_HEAVY = 1 << 16  # bound of the broadcast; which shingles are heavy only moves cost
CHANCE = HEAVY_SHARE  # that a document has a given shingle; those with more are left out first
BUCKETS = 1 << 20  # bound of the broadcast that thins the texts before they are shuffled
SKETCH = 64  # bits of the shortest sketch; a longer one is this times a power of two
GROWTH = 16  # partners of a document that are compared on their texts, from one round to the next
SPARSE = 2  # bits of a sketch for each shingle, at least
SMALL = 4  # documents of a signature whose pairs are listed
BLOCK = 512  # documents of a signature that are compared with each other in one place
FEW = 0.02  # of the open documents: fewer merges end the rounds of one pair per document
BATCH_TEXTS, BATCH_CHARS = 500, 1 << 21


def max_difference(small: int, large: int, percent: int) -> int:
    return (100 - percent) * (small + large) // (100 + percent)


def bands(largest: int, percent: int) -> list[tuple[int, int, int, int]]:
    """(least size, largest size, largest size of a partner, H) of each band."""
    found, low = [], 1
    while low <= max(largest, 1):
        high = max(int(low * BAND), low * 100 // percent)
        partner = high * 100 // percent
        found.append((low, high, partner, max_difference(high, partner, percent)))
        low = high + 1
    return found


def allocation(low: int, most: int, documents: int) -> tuple[int, int, bool]:
    """(segments, left out, with deletions) of a band, by estimated rows and comparisons."""
    spare = -(-int(1000 * SPARE) * (most + 1) // 1000)
    plain = most + 1 + spare
    near = most // 2 + 1
    plain_cost = (most + 1) * (1 + documents * CHANCE ** max(1, low // plain))
    near_cost = low + near + near * documents * CHANCE ** max(1, low // near - 1)
    return (near, 0, True) if near_cost < plain_cost else (plain, spare, False)


def _batches(batch: pa.RecordBatch):
    """(ids, texts) of parts of a batch, bounded in rows and, but for single texts, in size."""
    sizes = pc.binary_length(batch.column(1)).to_pylist()
    first = size = 0
    for k, own in enumerate([*sizes, None]):
        if k > first and (own is None or k - first == BATCH_TEXTS or size + own > BATCH_CHARS):
            ids = batch.column(0).slice(first, k - first).cast(pa.int64())  # may hold nulls
            yield ids, batch.column(1).slice(first, k - first).to_pylist()
            first, size = k, 0
        size += own or 0


def _fingerprints(width: int):
    """Rows of documents (kind 0: doc, size, set hash in two halves, sketch) and of frequent
    shingles."""

    def run(batches):
        shingle = Shingler(width)
        for ids, texts in (part for batch in batches for part in _batches(batch)):
            flat, start = shingle(texts)
            n = np.diff(start)
            a, b = _sums(mixed(flat), start), _sums(mixed(~flat), start)
            values, counts = np.unique(flat, return_counts=True)
            often = counts >= max(3, HEAVY_SHARE * len(n) / 2)
            heavy = values[often].view(np.int64)
            zeros = np.zeros(len(heavy), np.int64)
            yield _table(
                kind=np.concatenate([np.zeros(len(n)), np.ones(len(heavy))]).astype(np.int32),
                doc=pa.concat_arrays([ids, pa.array(zeros)]),
                n=np.concatenate([n, counts[often]]),
                a=np.concatenate([a.view(np.int64), heavy]),
                b=np.concatenate([b.view(np.int64), zeros]),
                sketch=pa.concat_arrays([sketches(flat, start), pa.nulls(len(heavy), pa.list_(pa.int64()))]),
            )

    return run


def sketches(flat: np.ndarray, start: np.ndarray) -> pa.Array:
    """For each bit of a sketch, whether the shingles that fall on it are odd in number. Two sets
    differ in at least as many shingles as their sketches differ in bits. A sketch has the least
    SKETCH * 2^k bits that are no fewer than SPARSE times the shingles, in longs; the parts of a
    longer one, taken together by exclusive or, are the shorter one."""
    n = np.diff(start)
    bits = SKETCH << np.maximum(np.ceil(np.log2(np.maximum(n, 1) * SPARSE / SKETCH)), 0).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(bits)])
    owner = np.repeat(np.arange(len(n)), n)
    place = (mixed(flat ^ np.uint64(0x5BD1E995)) & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(first[owner] + place, minlength=first[-1]) & 1
    longs = np.packbits(odd.astype(np.uint8)).view(np.int64)
    return pa.ListArray.from_arrays(pa.array((first // 64).astype(np.int32)), pa.array(longs))


def _table(**columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _sums(values: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sums of runs, modulo 2^64."""
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return running[start[1:]] - running[start[:-1]]


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of these lengths: which run each element is in, and its place there."""
    run = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return run, np.arange(len(run)) - first[run]


def segments_of(flat, start, scheme: int, m: int, left_out: int, deletions: bool, heavy):
    """(signature, index of the set) of the sets of one scheme, given sorted hashes."""
    sizes = np.diff(start)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = ((flat >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
    segment = owner * m + place.astype(np.int64)
    bounds = np.searchsorted(segment, np.arange(len(sizes) * m + 1))
    values = mixed(flat ^ np.uint64(0xA5A5A5A5DEADBEEF))
    sums = _sums(values, bounds)
    index = np.tile(np.arange(m, dtype=np.uint64), len(sizes))
    salt = mixed(index + np.uint64(scheme << 32) + np.uint64(1 << 60))
    signature = mixed(sums ^ salt)
    of = np.repeat(np.arange(len(sizes)), m)
    if deletions:
        less = mixed((sums[segment] - values) ^ salt[segment])
        return np.concatenate([signature, less]), np.concatenate([of, owner])
    strength = np.full(len(flat), PLAIN, dtype=np.uint64)
    if len(heavy):
        strength[np.isin(flat, heavy)] = HEAVY
    strength = _sums(strength, bounds)
    order = np.lexsort((signature, strength, of))
    strong = order.reshape(len(sizes), m)[:, left_out:].ravel()
    return signature[strong], of[strong]


def _signatures(width: int, plan: list, heavy: np.ndarray):
    """Signature rows of a batch. Of documents that share one, all but the first are members
    (kind 1), which are known to be shared; the first is a head (kind 0), and knows whether it
    has members (kind 2)."""

    def run(batches):
        shingle = Shingler(width)
        for batch in batches:
            for ids, texts in _batches(batch):
                flat, start = shingle(texts)
                part = ids.to_numpy(zero_copy_only=False)
                sizes = np.diff(start)
                same = np.stack([_sums(mixed(flat), start), _sums(mixed(~flat), start)], axis=1)
                first = np.unique(same, axis=0, return_index=True)[1]  # one of equal sets
                once = np.zeros(len(sizes), bool)
                once[first] = True
                found, docs = [], []
                for scheme, low, partner, m, left_out, deletions in plan:
                    chosen = np.flatnonzero(once & (sizes >= low) & (sizes <= partner))
                    if not len(chosen):
                        continue
                    run_, place = _spread(sizes[chosen])
                    own = flat[start[chosen][run_] + place]
                    own_start = np.concatenate([[0], np.cumsum(sizes[chosen])])
                    s, of = segments_of(own, own_start, scheme, m, left_out, deletions, heavy)
                    found.append(s)
                    docs.append(part[chosen][of])
                if not found:
                    continue
                sig, doc = np.concatenate(found), np.concatenate(docs)
                order = np.lexsort((doc, sig))
                sig, doc = sig[order].view(np.int64), doc[order]
                again = np.concatenate([[False], sig[1:] == sig[:-1]])
                repeat = again & np.concatenate([[False], doc[1:] == doc[:-1]])
                kind = again.astype(np.int32)
                kind[:-1][again[1:] & ~again[:-1]] = 2
                keep = ~repeat
                yield _table(sig=sig[keep], doc=doc[keep], kind=kind[keep])

    return run


def _shared(rows: DataFrame) -> DataFrame:
    """(sig, doc) of signatures that more than one document has.

    A group of the window is the heads of one signature, at most one per Arrow batch. Members
    go anywhere.
    """
    key = F.when(F.col("kind") == 1, F.xxhash64("sig", "doc")).otherwise(F.col("sig"))
    counted = rows.withColumn("key", key).withColumn(
        "heads", F.count("*").over(Window.partitionBy("key"))
    )
    return counted.filter("kind > 0 or heads > 1").select("sig", "doc")


def _bucket(column: str):
    return F.pmod(F.xxhash64(column), F.lit(BUCKETS)).cast("int")


def _compare(percent: int, width: int):
    def run(batches):
        known, last = None, None
        for batch in batches:
            docs, centres = batch.column("doc").to_pylist(), batch.column("centre").to_pylist()
            linked = []
            for row in zip(batch.column("mine"), batch.column("theirs")):  # one pair of texts at a time
                text, other = (x.as_py() for x in row)
                if other != known or last is None:
                    known, last = other, shingle_set(other, width)
                own = shingle_set(text, width)
                both = len(own & last)
                linked.append(both > 0 and 100 * both >= percent * (len(own) + len(last) - both))
            keep = np.flatnonzero(linked)
            yield _table(
                a=np.array(docs, dtype=np.int64)[keep], b=np.array(centres, dtype=np.int64)[keep]
            )

    return run


def _asked(rows: DataFrame, column: str, pairs: DataFrame) -> DataFrame:
    """``rows`` without most of those whose id in ``column`` is in none of ``pairs``."""
    ids = pairs.select(F.explode(F.array("doc", "centre")).alias("id"))
    buckets = F.broadcast(ids.select(_bucket("id").alias("bucket")).distinct())
    return rows.join(buckets, _bucket(column) == F.col("bucket"), "left_semi")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """Those of ``pairs`` (doc, centre) whose whole texts reach the threshold.

    Texts of other documents are dropped by hash buckets, at most BUCKETS broadcast rows, before
    any shuffle. The centre is joined last, as one row per id, so AQE can split a popular one.
    """
    few = _asked(texts, "doc_id", pairs)
    mine = few.select(F.col("doc_id").alias("doc"), F.col("text").alias("mine"))
    theirs = few.select(F.col("doc_id").alias("centre"), F.col("text").alias("theirs"))
    both = pairs.join(mine, "doc").join(theirs, "centre")
    return both.mapInArrow(released(_compare(percent, width)), "a long, b long")


def _classes(rows: DataFrame) -> DataFrame:
    """(a, b): every document with the least id of an equal set, where that is another one."""
    least = rows.groupBy("n", "a", "b").agg(F.min("doc").alias("least"), F.count("*").alias("rows"))
    named = least.filter("rows > 1").select(F.struct("n", "a", "b").alias("at"), F.col("least"))
    joined = rows.withColumn("set", F.struct("n", "a", "b")).join(named, matching("set", "at"))
    return joined.filter("doc != least").select(F.col("doc").alias("a"), F.col("least").alias("b")).distinct()


def ngram_join(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: components of the similarity graph."""
    all_texts = corpus(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    texts = all_texts.filter("doc_id is not null")
    schema = "kind int, doc long, n long, a long, b long, sketch array<long>"
    first = pin(all_texts.mapInArrow(released(_fingerprints(width)), schema), "shingle-sets")
    sets = first.filter("kind = 0").drop("kind")
    full = sets.filter("n > 0 and doc is not null")

    # At most one row per band, and a bounded number of frequent shingles.
    largest = full.agg(F.max("n")).first()[0] or 0
    layout = bands(largest, percent)
    band = F.size(F.filter(F.array(*[F.lit(x[0]) for x in layout]), lambda low: low <= F.col("n")))
    in_band = dict(full.groupBy((band - 1).alias("band")).count().collect())
    total = sum(in_band.values())
    often = first.filter("kind = 1").groupBy("a").agg(F.sum("n").alias("n"))
    often = often.filter(F.col("n") >= HEAVY_SHARE * total).orderBy(F.desc("n"), "a").limit(MAX_HEAVY)
    heavy = np.array([r["a"] for r in often.select("a").collect()], dtype=np.int64).view(np.uint64)
    plan = []
    for k, (low, _, partner, most) in enumerate(layout):
        if most:  # without a difference only equal sets reach the threshold
            near = in_band.get(k, 0) + in_band.get(k + 1, 0)
            plan.append((k, low, partner, *allocation(low, most, near)))

    same = pin(_classes(full.drop("sketch")), "equal-sets")
    # An id with texts of its own on several rows has no sketch and is compared in full.
    several = full.groupBy("doc").count().filter("count > 1").select(F.col("doc").alias("repeated"))
    several = pin(several, "repeated")
    sketch = full.join(several, matching("doc", "repeated"), "left_anti").select("doc", "n", "sketch")
    rows = texts.mapInArrow(released(_signatures(width, plan, np.sort(heavy))), "sig long, doc long, kind int")
    # Links to the least of a class are stars already, unless an id is in several classes.
    labels = same.select(F.col("a").alias("doc"), F.col("b").alias("component"))
    repeats = not several.isEmpty()
    if repeats:
        labels = pin(components(same), "components")

    def linked(facing: DataFrame) -> DataFrame:
        possible = _possible(facing, sketch, percent).select("doc", "centre")
        return pin(_verified(possible, texts, percent, width), "similar")

    def merged(found: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
        """What the links merge, as (label, to), and the labels after it."""
        ends = _labelled(_labelled(found, labels, "a"), labels, "b")
        merges = pin(components(ends.filter("a != b")), "merges").select(
            F.col("doc").alias("label"), F.col("component").alias("to")
        )
        moved = _moved(labels.select("doc", F.col("component").alias("label")), merges)
        new = merges.select(F.col("label").alias("doc"), F.col("to").alias("label"))
        after = moved.unionByName(new).withColumnRenamed("label", "component")
        return merges, pin(after, "components")

    # One node for each class of equal sets; what is then alone in a signature goes.
    candidates = _labelled(_shared(rows), same, "doc", "b").distinct()
    candidates = candidates.withColumn("label", F.col("doc"))
    if repeats:  # else the least of a class is its own label
        candidates = _labelled(candidates, labels, "label")
    candidates = pin(_mixed(candidates), "signatures")
    few = pin(_few_pairs(candidates.filter(F.col("docs") <= SMALL), sketch, percent), "pairs")
    open_rows = candidates.filter(F.col("docs") > SMALL).drop("docs")
    scores = open_rows.groupBy("doc").agg(F.count("*").alias("score"))
    open_rows = open_rows.join(scores, "doc")
    little = FEW * scores.count()
    tried = None
    while True:  # one pair per document
        open_rows = pin(open_rows, "open")
        facing = _untried(_one_centre(open_rows), tried)
        facing = pin(facing, "pairs")
        tried = facing if tried is None else tried.unionByName(facing)
        found = linked(facing)
        if found.isEmpty():
            break
        merges, labels = merged(found, labels)
        if merges.count() <= little:  # so the rounds are at most 1 / FEW
            break
        open_rows = _mixed(_moved(open_rows, merges)).drop("docs")
    # Then all pairs of small and of open signatures that the sketches let through, the closest first.
    near = _near(open_rows, sketch, percent).unionByName(_possible(few, sketch, percent))
    near = _untried(pin(near.groupBy("doc", "centre").agg(F.min("apart").alias("apart")), "near"), tried)
    near = _labelled(_labelled(near.withColumns({"one": F.col("doc"), "other": F.col("centre")}), labels, "one"), labels, "other")
    near = pin(near.filter("one != other"), "near")
    many, order = 1, Window.partitionBy("doc").orderBy("apart", "centre")
    while not near.isEmpty():
        ranked = near.withColumn("rank", F.row_number().over(order))
        closest = pin(ranked.filter(F.col("rank") <= many).select("doc", "centre"), "pairs")
        many *= GROWTH
        found = pin(_verified(closest, texts, percent, width), "similar")
        near = near.join(closest, ["doc", "centre"], "left_anti")
        if not found.isEmpty():
            merges, labels = merged(found, labels)
            merges = merges.withColumnRenamed("label", "doc")
            near = _labelled(_labelled(near, merges, "one", "to"), merges, "other", "to")
        near = pin(near.filter("one != other"), "near")
    found = sets.select("doc", "n").join(labels, "doc", "left")
    return found.select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component_id"),
    )


def _labelled(rows: DataFrame, labels: DataFrame, column: str, to: str = "component") -> DataFrame:
    """``rows`` with the label of ``column`` in its place. ``labels`` has a row per id that has
    another label than itself, in ``doc`` or ``a``."""
    key = "doc" if "doc" in labels.columns else "a"
    named = labels.select(F.col(key).alias("named_id"), F.col(to).alias("named_to"))
    joined = rows.join(named, matching(column, "named_id"), "left")
    return joined.withColumn(column, F.coalesce("named_to", column)).drop("named_id", "named_to")


def _moved(rows: DataFrame, merges: DataFrame) -> DataFrame:
    return _labelled(rows, merges.withColumnRenamed("label", "doc"), "label", "to")


def _one_centre(open_rows: DataFrame) -> DataFrame:
    """(doc, centre): for each document the centre with which it shares most signatures."""
    chosen = _centres(open_rows)
    facing = open_rows.join(chosen, matching("sig", "at")).filter(F.col("label") != F.col("best.label"))
    shared = facing.groupBy("doc", F.col("best.doc").alias("centre")).agg(F.count("*").alias("n"))
    best = F.max_by("centre", F.struct("n", -F.col("centre")))
    return shared.groupBy("doc").agg(best.alias("centre"))


def _centres(open_rows: DataFrame) -> DataFrame:
    """(at, best): of each signature the document with most signatures."""
    best = F.max_by(F.struct("doc", "label"), F.struct("score", -F.col("doc")))
    return open_rows.groupBy("sig").agg(best.alias("best")).select(F.col("sig").alias("at"), "best")


def _near(open_rows: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """(doc, centre, apart): pairs of different components in an open signature whose sketches let
    them be similar. Signatures with more than BLOCK documents are cut into blocks, and each two
    blocks are compared in one place: rows that move grow with the blocks, not with the pairs,
    and only pairs that pass are written."""
    rows = open_rows.select("sig", "doc", "label")
    sizes = rows.groupBy("sig").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    sizes = sizes.select(F.col("sig").alias("at"), "blocks")
    rows = rows.join(sizes, matching("sig", "at")).drop("at")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    known = sketch.select(F.col("doc").alias("its"), "n", "sketch")
    rows = rows.join(known, matching("doc", "its"), "left").drop("its")
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = ["sig", "low", "high"]
    dealt = rows.select(
        "sig", F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high"), "own", "doc", "label", "n", "sketch"
    )
    dealt = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(released(_compared(percent)), "doc long, centre long, apart int")


def _few_pairs(rows: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """(doc, centre): pairs of different labels in one signature of ``rows`` whose sizes let them be
    similar. The number of documents of a signature is bounded, so pairs grow with the rows."""
    known = sketch.select(F.col("doc").alias("its"), "n")
    rows = rows.join(known, matching("doc", "its"), "left").select("sig", "doc", "label", "n")
    other = rows.select(*[F.col(c).alias(f"other_{c}") for c in rows.columns])
    apart, total = F.abs(F.col("n") - F.col("other_n")), F.col("n") + F.col("other_n")
    sized = F.coalesce(apart * (100 + percent) <= (100 - percent) * total, F.lit(True))
    pair = (F.col("sig") == F.col("other_sig")) & (F.col("doc") > F.col("other_doc"))
    met = rows.join(other, pair & (F.col("label") != F.col("other_label")) & sized)
    return met.select("doc", F.col("other_doc").alias("centre")).distinct()


def _compared(percent: int):
    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            if not table.num_rows:
                continue
            keys = np.stack([table.column(c).to_numpy() for c in ("sig", "low", "high")])
            first = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
            for start, end in zip(first[:-1], first[1:]):
                yield from _pairs(table.slice(start, end - start), percent)
            held = table.slice(first[-1]).to_batches()[0]
        if held is not None:
            yield from _pairs(pa.Table.from_batches([held]), percent)

    return run


def _pairs(group: pa.Table, percent: int):
    """The pairs of a group (of two blocks, or of one) that may be similar."""
    doc, label, own = (group.column(c).to_numpy() for c in ("doc", "label", "own"))
    n = group.column("n").to_numpy(zero_copy_only=False).astype(float)
    lists = group.column("sketch").to_pylist()
    blind = np.array([x is None for x in lists])
    sizes = [len(x) for x in lists if x is not None]
    width = min(sizes, default=1)
    table = np.zeros((len(doc), width), np.uint64)
    for k, x in enumerate(lists):
        if x is not None:  # halves taken together until it is as short as the shortest
            table[k] = np.bitwise_xor.reduce(np.array(x, np.int64).view(np.uint64).reshape(-1, width), axis=0)
    one_block = group.column("low")[0].as_py() == group.column("high")[0].as_py()
    found = []
    for k in range(len(doc)):
        other = np.arange(k + 1, len(doc))
        other = other[(label[other] != label[k]) & (doc[other] != doc[k])]
        if not one_block:
            other = other[own[other] != own[k]]
        if not blind[k]:
            reach = (100 - percent) * (n[other] + n[k])
            other = other[blind[other] | (np.abs(n[other] - n[k]) * (100 + percent) <= reach)]
        if not len(other):
            continue
        apart = np.bitwise_count(table[other] ^ table[k]).sum(axis=1).astype(np.int64)
        unsure = blind[other] | blind[k]
        apart[unsure] = 0
        near = unsure | (apart * (100 + percent) <= (100 - percent) * (n[other] + n[k]))
        other, apart = other[near], apart[near]
        if len(other):
            found.append((np.maximum(doc[other], doc[k]), np.minimum(doc[other], doc[k]), apart.astype(np.int32)))
    if found:
        yield _table(**{c: np.concatenate(x) for c, x in zip(("doc", "centre", "apart"), zip(*found))})


def _untried(facing: DataFrame, tried: DataFrame | None) -> DataFrame:
    return facing if tried is None else facing.join(tried, ["doc", "centre"], "left_anti")


def _possible(facing: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """(doc, centre, apart): pairs without those whose sizes or sketches already differ by too much."""
    sketch = _asked(sketch, "doc", facing)
    mine = sketch.select(F.col("doc").alias("my_id"), F.struct("n", "sketch").alias("mine"))
    theirs = sketch.select(F.col("doc").alias("their_id"), F.struct("n", "sketch").alias("theirs"))
    both = facing.join(mine, matching("doc", "my_id"), "left").join(theirs, matching("centre", "their_id"), "left")
    total = F.col("mine.n") + F.col("theirs.n")
    apart = F.abs(F.col("mine.n") - F.col("theirs.n"))
    sized = apart * (100 + percent) <= (100 - percent) * total
    one, other = F.col("mine.sketch"), F.col("theirs.sketch")
    # Sizes that may be similar are less than twice each other: one fold is enough.
    one, other = (
        F.when(F.size(x) > F.size(y), _folded(x)).otherwise(x) for x, y in ((one, other), (other, one))
    )
    bits = F.aggregate(
        F.zip_with(one, other, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, k: total + k
    )
    near = sized & (bits * (100 + percent) <= (100 - percent) * total)
    apart = F.coalesce(bits, F.lit(0)).alias("apart")
    return both.filter(F.coalesce(near, F.lit(True))).select("doc", "centre", apart)


def _folded(sketch):
    half = F.size(sketch) / 2
    return F.zip_with(
        F.slice(sketch, F.lit(1), half.cast("int")),
        F.slice(sketch, half.cast("int") + 1, half.cast("int")),
        lambda x, y: x.bitwiseXOR(y),
    )


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows (sig, ..., label) of signatures with documents of more than one component, and how many
    rows their signature has."""
    ends = rows.groupBy("sig").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("docs")
    )
    open_ = ends.filter("low < high").select(F.col("sig").alias("open_sig"), "docs")
    return rows.join(open_, matching("sig", "open_sig")).drop("open_sig")


def keep_one(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` without those that are linked to a lesser id. Rows without id stay.

    Only the ids that go are joined: one row per linked document.
    """
    found = ngram_join(docs, width, percent, id_col, text_col)
    gone = found.filter("component_id < doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col(id_col).cast("long").alias("own_id"))
    return rows.join(gone, F.col("own_id") == F.col("gone_id"), "left_anti").select("row.*")
