"""Mixing sources to target weights: exact block quotas, split among shards by a random tree.

Targets. Sources in code point order (a missing one last) weigh 5, 2, 1, repeating, and share
150% of all words. No target exceeds twice the words of its source; the excess is shared anew by
weight until none is above. Every round is one aggregate over the sources.

Draw. Each source's documents lie in a random order (MD5 of seed and id) on a line of words that
is walked until the target is reached, twice at most; the last document is cut. The lines are
cut into blocks of equal length. A tree splits the blocks among the shards: the left half of a
node draws its number of blocks out of all blocks of the node without replacement, so the counts
by source are multivariate hypergeometric and the quotas of all shards add up exactly. A shard
takes the next blocks of each line, so no block is drawn twice. Documents are not cut at the
borders of blocks: one belongs to the block where it starts, so a shard has more or fewer words
than its quota by what reaches over these borders, and a document longer than a block leaves
the blocks it covers without words of their own.

Shuffle. ``mixed_documents`` writes shard after shard, each in the order of a hash of its own
(MD5 of seed, shard, pass and id), by a range partition on both. There are BLOCKS blocks a shard whatever the size of the corpus, so the tree is
small; all that grows are running sums, which over_ordered cuts into even slices, so a source
with a third of all rows is spread like any other.

Defined results: a missing text has no words and is never taken; a row without id takes part.
Rows that repeat an id and a text share their pieces in ``mixed_documents``. All sizes zero:
all targets are zero. An empty table gives no rows. The same input gives the same mix.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillwork.llm.texts import SPACE, corpus, matching, pin, whole, words_of
from tillwork.operators.ordered import over_ordered

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2  # passes over a source
SHARDS = 24
BLOCKS = 64  # of a shard, on average
SEED = "mix-1"


def _place(source: Column) -> Column:
    """A key that is never null and sorts by code point, a missing source last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def _draw(*parts) -> Column:
    columns = [F.lit(SEED)]
    for part in parts:
        columns += [F.lit("/"), F.coalesce(part.cast("string"), F.lit(""))]
    return F.md5(F.concat(*columns))


def targets(sizes: DataFrame) -> DataFrame:
    """place, source_size, target of rows (place, source_size), one per source."""
    ranked = pin(over_ordered(sizes, [("place", "asc")], row_number="rank"), "sources")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.col("rank") - 1, len(WEIGHTS)) + 1).cast("int"))
    weighed = ranked.withColumn("weight", weight)
    limit = MOST * F.col("source_size")
    total, weights = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    per_weight, before = (SHARE * total / weights if weights else 0.0), None
    while per_weight != before:
        before, full = per_weight, limit < per_weight * F.col("weight")
        spent, open_ = weighed.agg(
            F.sum(F.when(full, limit).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))
        ).first()
        per_weight = (SHARE * total - spent) / open_ if open_ else before
    target = F.least(limit.cast("double"), F.lit(per_weight) * F.col("weight"))
    return weighed.select("place", "source_size", target.alias("target"))


def split(quotas: DataFrame, shards: int) -> DataFrame:
    """(place, block, shard) from (place, blocks): the splitting tree.

    Each level ranks the blocks of a node by a hash and gives the first ones to the left half.
    """
    nodes = quotas.select("place", "blocks", F.lit(0).alias("low"), F.lit(shards).alias("high"))
    for _ in range((shards - 1).bit_length()):
        single = F.explode(F.sequence(F.lit(1).cast("long"), "blocks")).alias("unit")
        units = nodes.filter("blocks > 0").select("place", "low", "high", single)
        node = Window.partitionBy("low")
        rank = F.row_number().over(node.orderBy(_draw(F.col("low"), F.col("place"), F.col("unit"))))
        units = units.withColumns({"rank": rank, "all": F.count("*").over(node)})
        middle = F.floor((F.col("low") + F.col("high") + 1) / 2).cast("int")
        part = F.floor(F.col("all") * (middle - F.col("low")) / (F.col("high") - F.col("low")))
        left = F.col("rank") <= part
        nodes = (
            units.select(
                "place",
                F.when(left, F.col("low")).otherwise(middle).alias("low"),
                F.when(left, middle).otherwise(F.col("high")).alias("high"),
            )
            .groupBy("place", "low", "high")
            .agg(F.count("*").alias("blocks"))
        )
    so_far = Window.partitionBy("place").orderBy("low")
    ends = nodes.withColumn("end", F.sum("blocks").over(so_far))
    block = F.explode(F.sequence(F.col("end") - F.col("blocks"), F.col("end") - 1)).alias("block")
    return ends.select("place", F.col("low").alias("shard"), block)


def mix(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: doc_id, text_key, size, source_size, target, and for each pass the
    words taken and the shard they go to (words_0, shard_0, words_1, shard_1)."""
    texts = corpus(docs, id_col, text_col, place=_place(F.col(source_col).cast("string")))
    rows = texts.select(
        "doc_id",
        "place",
        F.size(words_of(F.col("text"))).cast("long").alias("size"),
        F.xxhash64("text").alias("text_key"),
        _draw(F.col("doc_id")).alias("draw"),
    )
    order = [("draw", "asc"), ("doc_id", "asc"), ("text_key", "asc")]
    lines = pin(over_ordered(rows, order, ["place"], running={"line_end": "size"}), "lines")
    sources = pin(targets(lines.groupBy("place").agg(F.sum("size").alias("source_size"))), "targets")
    goal = F.floor(F.col("target") + 0.5).cast("long")
    sources = sources.withColumn("goal", goal)
    all_words = sources.agg(F.sum("goal")).first()[0] or 0
    block_words = max(1, -(-all_words // (shards * BLOCKS)))
    blocks = F.ceil(F.col("goal") / block_words).cast("long")
    dealt = pin(split(sources.select("place", blocks.alias("blocks")), shards), "blocks")

    named = sources.withColumnRenamed("place", "its_place")
    found = lines.join(named, matching("place", "its_place"))
    for k in range(MOST):
        start = k * F.col("source_size") + F.col("line_end") - F.col("size")
        words = F.greatest(F.lit(0), F.least("size", F.col("goal") - start)).cast("long")
        # Rows that take nothing are spread over keys that no block has.
        nowhere = -1 - F.pmod(F.xxhash64("draw"), F.lit(4096))
        block = F.when(words > 0, F.floor(start / block_words)).otherwise(nowhere)
        at = dealt.select(
            F.col("place").alias("at_place"), F.col("block").alias("at_block"), F.col("shard").alias(f"shard_{k}")
        )
        found = found.withColumns({f"words_{k}": words, "block": block.cast("long")})
        same = (F.col("place") == F.col("at_place")) & (F.col("block") == F.col("at_block"))
        found = found.join(at, same, "left").drop("at_place", "at_block", "block")
    passes = [f"{name}_{k}" for k in range(MOST) for name in ("words", "shard")]
    return found.select("doc_id", "text_key", "size", "source_size", "target", *passes)


def taken(mixed: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and the shards of its passes."""
    return mixed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("words_0") + F.col("words_1")).alias("taken"),
        F.concat_ws(",", F.col("shard_0").cast("string"), F.col("shard_1").cast("string")).alias("shards"),
    )


def mixed_documents(docs: DataFrame, shards: int = SHARDS, **columns: str) -> DataFrame:
    """The rows of the mix: a document as often as it is taken, the last of a source cut, shard
    after shard and shuffled inside each.

    The texts are shuffled twice, to meet the few columns of the plan and into their order.
    """
    id_col, text_col = columns.get("id_col", "doc_id"), columns.get("text_col", "text")
    plan = mix(docs, shards, **columns)
    # Words and shard of a pass as one number, so that rows that repeat share both.
    both = lambda k: F.col(f"words_{k}") * shards + F.coalesce(f"shard_{k}", F.lit(0))
    plan = plan.groupBy(F.struct("doc_id", "text_key").alias("key"), F.col("size")).agg(
        *[F.max(both(k)).alias(f"pass_{k}") for k in range(MOST)]
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text_key = F.xxhash64(whole(text_col)).alias("text_key")
    rows = docs.select(row, F.struct(F.col(id_col).alias("doc_id"), text_key).alias("key"))
    passes = [
        F.struct(
            F.floor(F.col(f"pass_{k}") / shards).alias("words"),
            F.pmod(f"pass_{k}", F.lit(shards)).alias("shard"),
            F.lit(k).alias("number"),
        )
        for k in range(MOST)
    ]
    part = F.explode(F.filter(F.array(*passes), lambda p: p["words"] > 0)).alias("part")
    met = rows.join(plan.withColumnRenamed("key", "its"), F.col("key").eqNullSafe(F.col("its")))
    pieces = met.select("row", "size", "key", part)
    pieces = pieces.select(
        "row",
        "size",
        "key",
        F.col("part.words").alias("part"),
        F.col("part.shard").alias("shard"),
        _draw(F.col("part.shard"), F.col("part.number"), F.col("key.doc_id")).alias("at"),
    )
    order = ["shard", "at", F.col("key.text_key")]
    pieces = pieces.repartitionByRange(*order).sortWithinPartitions(*order)
    text = F.col("row").getField(text_col)
    # Possessive, so that the match is one loop without a stack.
    first = F.concat(F.lit(rf"\A(?:[{SPACE}]*+[^{SPACE}]++){{"), F.col("part").cast("string"), F.lit("}+"))
    cut = F.when(F.col("part") < F.col("size"), F.regexp_substr(text, first)).otherwise(text)
    return pieces.select(F.col("row").withField(f"`{text_col}`", cut).alias("row")).select("row.*")
