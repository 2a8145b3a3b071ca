"""Small awkward corpora, and the words of a text in plain Python."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " row string, kept string, sha string, `key` string, place string, shard int"
)


def words(text):
    return WORD.findall(text or "")


def prose(rng, n):
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in "nrstl"]
    text = [rng.choice(vocabulary) for _ in range(n)]
    return " ".join(w + ("." if k % 11 == 10 else "") for k, w in enumerate(text))


def awkward(seed=5):
    """Rows with missing and empty values, copies, near copies, repeated rows, long texts."""
    rng = random.Random(seed)
    base = prose(rng, 120)
    near = base.split()
    near[60] = "changed"
    long = prose(rng, 30_000)
    rows = [(k, prose(rng, rng.randint(1, 200)), f"s{k % 5}") for k in range(40)]
    rows += [(100 + k, base, "s0") for k in range(30)]  # a large group of copies
    rows += [(200, " ".join(near), "s1"), (201, " ".join(near[:-1]), None), (202, base.upper(), "s1")]
    rows += [(300, None, "s2"), (301, "", "s2"), (302, " \n\t ", None), (303, "one", "s9")]
    rows += [(304, long, "s3"), (305, long + " end", "s3"), (306, "é ß 漢字\x0bß\x1cé", "é")]
    rows += [(307, "x y " * 50, "s4"), (307, "x y " * 50, "s4"), (308, "same row", "s4"), (308, "same row", "s4")]
    rows += [(None, "no id here", "s5"), (None, base, None), (None, None, None)]
    # The other columns only have names that operators might use themselves.
    return [(i, t, "en", s, 1, "r", "k", "h", "y", "p", 3) for i, t, s in rows]


def awkward_docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
