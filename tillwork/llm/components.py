"""Connected components of a link table by alternating stars; every vertex keeps its least id."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.texts import matching, pin


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(
        F.explode(
            F.array(
                F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                F.struct(F.col("b").alias("u"), F.col("a").alias("v")),
            )
        ).alias("e")
    ).select("e.u", "e.v")


def _star(neighbours: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each vertex to the least among them and itself.

    The least neighbour is combined on the map side, and joined back as one row per vertex, so
    AQE can split a hub.
    """
    least = neighbours.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("at"), F.least("u", "m").alias("m")
    )
    joined = neighbours.join(least, matching("u", "at"))
    if large:
        moved = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        own = least.filter(F.col("at") != F.col("m")).select(F.col("at").alias("a"), F.col("m").alias("b"))
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(own)
    return moved.filter("a != b").distinct()


def _seal(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(doc, component) of every vertex of ``links`` (a, b).

    Rounds are logarithmic in the longest chain; each writes its links to the shared folder.
    """
    links = pin(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while (now := _seal(links)) != before:
        before = now
        spread = _star(_both_ways(links), large=True)
        down = spread.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        links = pin(_star(down, large=False), "links")
    return links.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "doc")
