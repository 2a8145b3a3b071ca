"""What the text operators share: reading a corpus, words, pinned tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.sources.shared import pin

# White space of the contracts, for Java, RE2 and Python regular expressions.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"
SPACES = " \t\n\x0b\f\r"

ROWS_PER_SLICE = 2_000_000


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet")


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet")


def whole(text: str | Column) -> Column:
    """The whole text; a missing one counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def corpus(docs: DataFrame, id_col: str, text_col: str, **more: Column) -> DataFrame:
    """Only ``doc_id`` and ``text`` (and ``more``), so other columns of the input cannot clash."""
    named = [c.alias(name) for name, c in more.items()]
    return docs.select(F.col(id_col).alias("doc_id"), whole(text_col).alias("text"), *named)


def wrapped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row`` holds all columns of the input; ``select("row.*")`` gives them back."""
    return corpus(docs, id_col, text_col, row=F.struct(*[F.col(f"`{c}`") for c in docs.columns]))


def words_of(text: Column) -> Column:
    """The words as an array: split at one plain character, without a regular expression."""
    for space in SPACES[1:]:
        text = F.replace(text, F.lit(space), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def released(run):
    """``run`` over the batches of a task. At its end the Python worker, which stays for later tasks,
    gives back what the allocators hold: an executor has no room for what idle workers keep."""

    def whole_task(batches):
        import ctypes

        import pyarrow

        yield from run(batches)
        pyarrow.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return whole_task


def slices(spark: SparkSession, rows: int, per_slice: int = ROWS_PER_SLICE) -> int:
    """How many ranges ``rows`` are cut into: it grows with the input."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_slice))


def matching(left: str, right: str) -> Column:
    """Equality of two columns, as a join condition that gets exchanges of its own.

    A join that follows a groupBy on the same key reuses its layout, and AQE cannot split a hot
    key there. With the hash as a second key both sides are dealt anew, and it can.
    """
    return (F.xxhash64(left) == F.xxhash64(right)) & (F.col(left) == F.col(right))
