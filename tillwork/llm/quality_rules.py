"""Quality rules, line first: bad lines go, then documents that lose too much of their text.

Per line: a line of symbol-laden words (punctuation), of short cells between bars (navigation),
of shouting marks, or that is short and begins with a known notice (boilerplate) is removed. A
longer line that begins so is a paragraph and stays. A document is rejected if it fails the base
rules (too few words, or too many words in repeated 8-word windows) or if fewer than MIN_SHARE of
its words are left in good lines.

All of it is expressions over one row: no shuffle, no Python. Windows are compared by 64-bit
hashes, sorted inside the row, so a document of many equal windows costs n log n.

Defined results: a missing text counts as empty: no words, base_failed, not kept. Rows are
judged one by one, so ties and repeated rows change nothing. An empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.texts import SPACE, WORD, corpus, words_of, wrapped

MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED_PERCENT = 30
MIN_SHARE = 0.5  # of the words have to be in good lines
MAX_CELL_WORDS = 3
MAX_NOTICE_WORDS = 20
SYMBOLS = "#*$%&|<>"
NOTICE = (
    r"(?i)^[^\p{L}\p{N}]*(copyright|all rights reserved|licensed under|released under"
    r"|cookie policy|privacy policy|terms of (use|service)|subscribe (to|now)|sign up"
    r"|log ?in|click here|read more|share this|enable javascript)\b"
)


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once, also where ``use`` loops over it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _without(text: Column, characters: str) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def _count(text: Column, characters: str) -> Column:
    """How many of the ASCII ``characters`` the text has, from its length without them."""
    return F.octet_length(text) - F.octet_length(_without(text, characters))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, b: a + b)


def _covered(windows: Column) -> Column:
    """Words that lie in windows found more than once, each counted once."""

    def starts(marked: Column) -> Column:
        key = lambda j: F.get(marked, j)["h"]
        twin = lambda e, j: e["h"].eqNullSafe(key(j - 1)) | e["h"].eqNullSafe(key(j + 1))
        return F.array_sort(F.transform(F.filter(marked, twin), lambda e: e["i"]))

    def lengths(at: Column) -> Column:
        step = lambda i, j: F.coalesce(F.get(at, j + 1) - i, F.lit(WINDOW))
        return F.transform(at, lambda i, j: F.least(F.lit(WINDOW), step(i, j)).cast("long"))

    pair = lambda h, i: F.struct(h.alias("h"), i.alias("i"))
    marked = F.array_sort(F.transform(windows, pair))
    return _total(let(let(marked, starts), lengths))


def repeated_words(words: Column) -> Column:
    """How many words lie in windows of WINDOW words that occur more than once in ``words``."""

    def count(padded: Column) -> Column:
        windows = F.slice(padded, F.lit(1), F.size(padded) - (WINDOW - 1))
        return let(
            windows,
            lambda w: F.when(F.size(F.array_distinct(w)) < F.size(w), _covered(w)).otherwise(0),
        )

    half = WINDOW // 2

    def halves(w: Column) -> Column:
        near = lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, half)])
        return F.transform(w, near)

    def doubled(h: Column) -> Column:
        return F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + half)))

    # The words are bound too: a filter on the result may move below the column that holds them,
    # and would then split the text anew for every word.
    hashed = let(words, lambda w: F.when(F.size(w) > WINDOW, let(let(halves(w), doubled), count)))
    return F.coalesce(hashed, F.lit(0)).cast("long")


def _bad(line: Column) -> Column:
    """The rules of a line. Words are counted only where a symbol makes it suspicious."""

    def symbols(words: Column) -> Column:
        bars = _count(line, "|")
        cells = (bars >= 3) & (words - bars <= MAX_CELL_WORDS * (bars + 1))
        laden = _count(line, SYMBOLS.replace("|", "")) > words
        shouting = (_count(line, "!") >= words) & (words >= 3)
        return cells | laden | shouting

    suspicious = line.rlike(r"[#*$%&|<>!]")
    short = F.regexp_count(line, F.lit(WORD)) <= MAX_NOTICE_WORDS
    return (line.rlike(NOTICE) & short) | F.when(
        suspicious, let(F.regexp_count(line, F.lit(WORD)), symbols)
    ).otherwise(False)


def assess(texts: DataFrame) -> DataFrame:
    """Add the measures, the verdict ``kept`` and ``bad``, the bad lines, to rows with ``text``."""
    text = F.col("text")
    with_word = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(f"[^{SPACE}]"))
    rows = texts.withColumns({"words": words_of(text), "lines": with_word})
    rows = rows.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(F.array_join("words", "")).cast("long"),
            "n_symbols": F.when(text.rlike(r"[#*$%&|<>]"), _count(text, SYMBOLS))
            .otherwise(0)
            .cast("long"),
            "n_repeat_words": repeated_words(F.col("words")),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "bad": F.filter("lines", _bad),
        }
    ).drop("words", "lines")
    lost = _total(F.transform("bad", lambda line: F.regexp_count(line, F.lit(WORD)).cast("long")))
    base = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    rows = rows.withColumns({"words_left": F.col("n_words") - lost, "base_failed": base})
    enough = F.col("words_left") >= MIN_SHARE * F.col("n_words")
    return rows.withColumn("kept", ~F.col("base_failed") & enough)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measures and the verdict for every row of ``docs``."""
    return assess(corpus(docs, id_col, text_col)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "words_left",
        "base_failed",
        "kept",
    )


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; ``text_col`` without its bad lines.

    A text all of whose lines are good is left as it is.
    """
    rows = assess(wrapped(docs, id_col, text_col)).filter("kept")
    good = F.filter(F.split("text", "\n", -1), lambda line: ~_bad(line))
    text = F.when(F.size("bad") == 0, F.col("text")).otherwise(F.array_join(good, "\n"))
    return rows.select(F.col("row").withField(f"`{text_col}`", text).alias("row")).select("row.*")
