"""Shards of nearly equal bytes: best-fit-decreasing bin packing of groups of equal texts.

A group of equal texts stays in one shard unless it is larger than a shard's fair share of bytes;
there are at most as many such groups as shards, and each is cut by a hash of the ids into pieces
of about half a share. Groups enter by size, largest first, the open shard with the
tightest remaining capacity that holds them, found in a balanced tree; the capacity is the
smallest, to a hundred thousandth, for which the shards suffice.

Equal sizes fill one shard until it is full, so packing needs only the number of groups of each
size. Sizes above 2048 bytes are rounded up to 1024 steps an octave, which leaves some 50,000
sizes at most whatever the corpus, and those counts are all that the driver sees. Groups learn
their shard from their rank among the groups of their size, and documents their slot from their
rank in the shard; both ranks are computed in even slices (over_ordered).

Defined results: a missing text has no bytes and is equal to an empty one. Rows that repeat an id
and a text get a slot each. Very long texts count whole; only their size and hash are shuffled.
Columns of other names are never read. Fewer groups than shards leave shards empty; an empty table gives no
rows.
"""

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.texts import corpus, matching, pin, whole
from tillwork.operators.ordered import over_ordered

SHARDS = 24
EXTRA_BYTES = 8
STEPS = 1024  # sizes per octave
PRECISION = 100_000


class _Tree:
    """A treap of (remaining capacity, shard): balanced in expectation by hashed priorities."""

    def __init__(self):
        self.root = None

    def insert(self, key):
        low, high = self._split(self.root, key)
        node = [key, xxhash.xxh3_64_intdigest(repr(key).encode()), None, None]
        self.root = self._merge(self._merge(low, node), high)

    def take_least_from(self, size: int):
        """Remove and return the least key whose capacity is at least ``size``."""
        low, high = self._split(self.root, (size, -1))
        if high is None:
            return None
        node, parent = high, None
        while node[2] is not None:
            parent, node = node, node[2]
        if parent is None:
            high = node[3]
        else:
            parent[2] = node[3]
        self.root = self._merge(low, high)
        return node[0]

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            node[3], high = self._split(node[3], key)
            return node, high
        low, node[2] = self._split(node[2], key)
        return low, node

    def _merge(self, low, high):
        if low is None or high is None:
            return high if low is None else low
        if low[1] > high[1]:
            low[3] = self._merge(low[3], high)
            return low
        high[2] = self._merge(low, high[2])
        return high


def best_fit(counts: list[tuple[int, int]], capacity: int, shards: int | None = None):
    """[(size, first rank, last rank + 1, shard)] for (size, number of groups), or None if they
    do not fit into so many shards."""
    tree, opened, plan = _Tree(), 0, []
    for size, number in sorted(counts, reverse=True):
        placed = 0
        while placed < number:
            best = tree.take_least_from(size)
            if best is None:
                if size > capacity or opened == shards:
                    return None
                best, opened = (capacity, opened), opened + 1
            remaining, shard = best
            many = min(number - placed, remaining // size)
            plan.append((size, placed, placed + many, shard))
            placed += many
            tree.insert((remaining - many * size, shard))
    return plan


def pack(counts: list[tuple[int, int]], shards: int):
    """``best_fit`` with the smallest capacity for which ``shards`` suffice."""
    if not counts:
        return []
    total = sum(size * number for size, number in counts)
    low = max(-(-total // shards), max(size for size, _ in counts))
    step = high = low
    grain = max(1, low // PRECISION)
    plan, step = best_fit(counts, low, shards), grain
    while plan is None:
        low, high = high, high + step
        plan, step = best_fit(counts, high, shards), 2 * step
    while high - low > grain:
        middle = (low + high) // 2
        found = best_fit(counts, middle, shards)
        plan, low, high = (plan, middle, high) if found is None else (found, low, middle)
    return plan


def _rounded_up(size):
    """At most STEPS sizes an octave; small sizes stay as they are."""
    octave = F.floor(F.log2(size.cast("double"))).cast("int")
    step = F.pow(F.lit(2.0), F.greatest(F.lit(0), octave - (STEPS.bit_length() - 1)))
    return (F.ceil(size / step) * step).cast("long")


def assign(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, text_sha256, shard and slot of every row of ``docs``."""
    spark = docs.sparkSession
    texts = corpus(docs, id_col, text_col)
    rows = pin(
        texts.select(
            "doc_id",
            (F.octet_length("text") + EXTRA_BYTES).cast("long").alias("size"),
            F.crc32("text").alias("text_crc32"),
            F.sha2("text", 256).alias("text_sha256"),
        ),
        "sizes",
    )
    total = rows.agg(F.sum("size")).first()[0]
    groups = rows.groupBy("text_sha256").agg(F.count("*").alias("n"), F.max("size").alias("size"))
    shares = shards * F.col("n") * F.col("size") / (total or 1)
    # Groups beyond a fair share of the bytes: at most as many as shards.
    large = groups.filter((F.col("n") > 1) & (shares > 1)).select(
        F.col("text_sha256").alias("sha"), F.ceil(2 * shares).cast("long").alias("pieces")
    )
    cut = rows.join(F.broadcast(large), F.col("text_sha256") == F.col("sha"), "left").drop("sha")
    piece = F.pmod(F.xxhash64("doc_id"), F.coalesce("pieces", F.lit(1)))
    cut = cut.withColumn("unit", F.concat_ws("/", "text_sha256", piece.cast("string"))).drop("pieces")

    units = cut.groupBy("unit").agg(F.sum("size").alias("bytes"))
    sized = units.select("unit", _rounded_up(F.col("bytes")).alias("rounded"))
    ranked = pin(over_ordered(sized, [("unit", "asc")], ["rounded"], row_number="rank"), "units")
    counts = [tuple(r) for r in ranked.groupBy("rounded").count().collect()]  # bounded, see above
    plan = spark.createDataFrame(pack(counts, shards), "size_ long, first long, next long, shard int")
    place = (F.col("rounded") == F.col("size_")) & (F.col("rank") > F.col("first")) & (F.col("rank") <= F.col("next"))
    placed = ranked.join(F.broadcast(plan), place).select(F.col("unit").alias("its_unit"), "shard")
    sharded = cut.join(placed, matching("unit", "its_unit")).drop("unit", "its_unit")
    order = [("doc_id", "asc"), ("text_sha256", "asc")]
    slotted = over_ordered(sharded, order, ["shard"], row_number="slot")
    return slotted.withColumn("slot", F.col("slot") - 1)


def report(assigned: DataFrame) -> DataFrame:
    """The columns of the contract; the law is bytes, so there is no grown shard."""
    return assigned.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Parquet files of whole shards (folder shard=N), in the order of their slots.

    Rows that repeat id and text are written once for each of their slots. Columns of the input
    that are named shard or slot are replaced.
    """
    assigned = assign(docs, shards, id_col, text_col)
    key = F.struct(F.col(id_col).alias("doc_id"), F.sha2(whole(text_col), 256).alias("text_sha256"))
    others = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    row = F.struct(*[F.col(f"`{c}`") for c in others])
    rows = docs.select(key.alias("key"), row.alias("row")).groupBy("key").agg(F.first("row").alias("row"))
    places = assigned.select(F.struct("doc_id", "text_sha256").alias("its"), "shard", "slot")
    met = rows.join(places, F.col("key").eqNullSafe(F.col("its"))).select("row.*", "shard", "slot")
    ranged = met.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ranged.write.partitionBy("shard").parquet(path)
