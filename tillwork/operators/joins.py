"""Joins that stay balanced when one key holds a large share of the rows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.operators.ordered import SLICE, slice_count, slices
from tillwork.sources.shared import pin

HOT_ROWS = 1_000_000  # of one key, which one task may join
HOT_KEYS = 100_000  # a side, at most


def keys_of(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct non-null keys. Copies collapse before the shuffle, so no key is heavy."""
    return df.select(*columns).na.drop().distinct()


def having_match(df: DataFrame, other: DataFrame, on: str, key: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` occurs as ``key`` in ``other`` (IN / EXISTS)."""
    keys = keys_of(other, key).withColumnRenamed(key, "_key")
    return df.join(keys, F.col(on) == F.col("_key"), "left_semi")


def lacking_match(df: DataFrame, other: DataFrame, on: str, key: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` is absent from ``other``; a null ``on`` has no match."""
    keys = keys_of(other, key).withColumnRenamed(key, "_key")
    return df.join(keys, F.col(on) == F.col("_key"), "left_anti")


def outer_join(
    left: DataFrame, right: DataFrame, on: str, key: str, how: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """A left, right or full join on ``on = key``, also when the side that is filled with nulls has
    hot keys, which Spark cannot split there. The two sides share no column names.

    A key is hot if it has over ``hot_rows`` rows, or a HOT_KEYS-th of all rows of its side if that
    is more; so there are at most HOT_KEYS hot keys a side, and they may be broadcast. Without any,
    this is the plain join. Rows of hot keys meet in an inner join of their own: the side with more
    rows is dealt into parts of ``hot_rows``, by a hash of the whole row, so a task that runs again
    deals alike; the other side is repeated for each part. Rows whose hot key is missing on the
    other side need no join. All other rows, those without key too, are joined as usual.
    """
    matches = F.col(on) == F.col(key)
    filled = {"left": [(right, key)], "right": [(left, on)], "full": [(left, on), (right, key)]}[how]
    heavy = [_heavy(df, c, hot_rows) for df, c in filled]
    found = pin(heavy[0].unionByName(heavy[1]).distinct() if len(heavy) > 1 else heavy[0], "hot-keys")
    if found.isEmpty():
        return left.join(right, matches, how)

    sizes = _sizes(left, on, found, "_lefts").join(_sizes(right, key, found, "_rights"), "_hot", "full")
    most = F.greatest("_lefts", "_rights")
    hot = pin(
        sizes.na.fill(0).withColumns(
            {"_parts": F.ceil(most / hot_rows), "_split": F.when(F.col("_rights") >= F.col("_lefts"), "right").otherwise("left")}
        ),
        "hot-keys",
    )
    both = hot.filter("_lefts > 0 and _rights > 0")
    dealt = _dealt(left, on, both, "left").withColumnRenamed("_part", "_part_left")
    met = dealt.join(_dealt(right, key, both, "right"), matches & (F.col("_part_left") == F.col("_part")))

    columns = [*left.columns, *right.columns]
    found = F.broadcast(hot.select("_hot"))
    usual = left.join(found, F.col(on) == F.col("_hot"), "left_anti").join(
        right.join(found, F.col(key) == F.col("_hot"), "left_anti"), matches, how
    )
    rows = usual.select(*columns).unionByName(met.select(*columns))
    if how != "right":
        alone = F.broadcast(hot.filter("_rights = 0").select("_hot"))
        lost = left.join(alone, F.col(on) == F.col("_hot"), "left_semi")
        rows = rows.unionByName(lost, allowMissingColumns=True)
    if how != "left":
        alone = F.broadcast(hot.filter("_lefts = 0").select("_hot"))
        lost = right.join(alone, F.col(key) == F.col("_hot"), "left_semi")
        rows = rows.unionByName(lost, allowMissingColumns=True)
    return rows


def _heavy(df: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """Keys with too many rows for one task; counted where the rows are, before the shuffle."""
    least = max(hot_rows, df.count() // HOT_KEYS)
    counts = df.select(F.col(key).alias("_hot")).na.drop().groupBy("_hot").agg(F.count("*").alias("_rows"))
    return counts.filter(F.col("_rows") > least).select("_hot")


def _sizes(df: DataFrame, key: str, hot: DataFrame, name: str) -> DataFrame:
    """The number of rows of each hot key that occurs."""
    rows = df.select(F.col(key).alias("_hot")).join(F.broadcast(hot), "_hot", "left_semi")
    return rows.groupBy("_hot").agg(F.count("*").alias(name))


def _dealt(df: DataFrame, key: str, hot: DataFrame, side: str) -> DataFrame:
    """Rows of hot keys with the part they go to, or in each part if the other side is dealt."""
    own = F.array(F.pmod(F.xxhash64(*df.columns), F.col("_parts")))
    each = F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)
    met = df.join(F.broadcast(hot), F.col(key) == F.col("_hot"))
    parts = F.when(F.col("_split") == side, own).otherwise(each)
    return met.select(*df.columns, F.explode(parts).alias("_part"))


def first_pairs(left: DataFrame, right: DataFrame, left_order, right_order, n: int) -> DataFrame:
    """The first ``n`` pairs of all combinations, ordered by left and then by right.

    They use the first ``n`` rows of either side only, so a product of two tables is never
    built: both sides are cut to ``n`` rows and the right one travels as an array.
    """
    few = right.orderBy(*right_order).limit(n)
    packed = few.agg(F.array_agg(F.struct(*right.columns)).alias("pairs"))
    return (
        left.orderBy(*left_order)
        .limit(n)
        .withColumn("_right", F.explode(packed.scalar()))
        .select(*left.columns, *[F.col(f"_right.{c}").alias(c) for c in right.columns])
        .orderBy(*left_order, *right_order)
        .limit(n)
    )


def as_of(facts: DataFrame, versions: DataFrame, on: str, key: str, at: str) -> DataFrame:
    """Attach the version in force: ``effective_date <= at < end_date``, open end allowed.

    The versions of a key do not overlap, so only the last one that began can be in force. Facts
    and versions are put in one order by (key, time), in even slices, and each version is carried
    forward to the facts behind it; what a slice begins with comes from one row per slice. No
    fact meets another version than its own, however many versions a key has, and a key that
    most facts have is cut like any other.
    """
    own, theirs = facts.schema, versions.schema
    rows = facts.filter(F.col(on).isNotNull() & F.col(at).isNotNull()).select(
        F.col(on).alias("_key"), F.col(at).cast("date").alias("_time"), F.lit(1).alias("_kind"),
        F.struct(*facts.columns).alias("_fact"), F.lit(None).cast(theirs).alias("_version"),
    )
    begun = versions.filter(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col("effective_date").cast("date").alias("_time"), F.lit(0).alias("_kind"),
        F.lit(None).cast(own).alias("_fact"), F.struct(*versions.columns).alias("_version"),
    )
    both = rows.unionByName(begun)
    order = [("_time", "asc"), ("_kind", "asc")]
    count = slice_count(both)
    sliced = slices(both, ["_key"], order, count)
    place = Window.partitionBy("_key", SLICE).orderBy("_time", "_kind")
    so_far = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = sliced.repartitionByRange(count, SLICE).withColumn(
        "_last", F.last("_version", ignorenulls=True).over(so_far)
    )
    # The last version of a key in each slice, for the slices in which the key goes on.
    ends = sliced.groupBy("_key", SLICE).agg(
        F.max_by("_version", F.when(F.col("_kind") == 0, F.col("_time"))).alias("_end")
    )
    earlier = Window.partitionBy("_key").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    handed = ends.select(
        F.col("_key").alias("_at_key"), F.col(SLICE).alias("_at_slice"),
        F.last("_end", ignorenulls=True).over(earlier).alias("_handed"),
    ).filter("_handed is not null")
    # A slice begins with one key at most that began before: one row per slice.
    met = carried.filter("_kind = 1").join(
        F.broadcast(handed), (F.col("_key") == F.col("_at_key")) & (F.col(SLICE) == F.col("_at_slice")), "left"
    )
    found = met.select("_fact", "_time", F.coalesce("_last", "_handed").alias("_version"))
    end = F.col("_version.end_date")
    in_force = F.col("_version").isNotNull() & (end.isNull() | (F.col("_time") < end))
    return found.filter(in_force).select("_fact.*", "_version.*")


def best_with_ties(df: DataFrame, key: str, value: str) -> DataFrame:
    """All rows that reach the maximum of their key.

    The join key holds the value too, so a heavy key is spread over the partitions.
    """
    best = df.groupBy(key).agg(F.max(value).alias(value))
    return df.join(best, [key, value])
