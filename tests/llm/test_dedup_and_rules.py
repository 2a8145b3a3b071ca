import hashlib
from collections import Counter, defaultdict

from tests.llm.cases import awkward, awkward_docs, no_docs, words
from tillwork.llm import exact_dedup, quality_rules


def test_copies_are_found_by_whole_texts(spark):
    groups = defaultdict(list)
    for row in awkward():
        groups[row[1] or ""].append(row[0])
    found = exact_dedup.exact_dedup(awkward_docs(spark)).collect()
    assert len(found) == len(awkward())
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for row in found:
        ids = by_sha[row.text_sha256]
        assert row.group_size == len(ids)
        assert row.keep_id == max((i for i in ids if i is not None), default=None)
        assert row.kept == (row.doc_id == row.keep_id)


def test_one_of_each_text_stays_with_its_columns(spark):
    docs = awkward_docs(spark)
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({r[1] or "" for r in awkward()})


def test_prefix_and_length_alone_do_not_make_copies(spark):
    head = "h" * exact_dedup.PREFIX_CHARS
    rows = [(1, head + "a"), (2, head + "b"), (3, head + "a"), (4, "x")]
    found = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.keep_id, r.group_size) for r in found.collect()} == {
        (1, 3, 2), (2, 2, 1), (3, 3, 2), (4, 4, 1)
    }


def measures(text):
    w = words(text)
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_measures_equal_brute_force(spark):
    extra = [(900 + k, t) for k, t in enumerate([
        "a b c d e f g h\na b c d e f g h\nx", "# * $ |\n\n# * $ |", "w " * 8, "w " * 9, "a b c d e f g h " * 2,
        "l1 l2\nl1 l2\n l1 l2", "\n\n", "ab" * 5000,
    ])]
    rows = [(r[0], r[1]) for r in awkward()] + extra
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in quality_rules.quality(docs).collect()
    )
    assert found == Counter((i, *measures(t)) for i, t in rows)


def test_bad_lines_go_and_gutted_documents_too(spark):
    good = "This line has plain words and stands as it is written here today."
    more = "Another one goes on with quite different things for anybody who reads it."
    nav = "home | news | sport | games | music | about"
    rows = [
        (1, "\n".join([good, more, nav])),
        (2, "\n".join([nav, nav.upper(), nav.title(), good])),
        (3, "\n".join([good, more, "Copyright 2020 somebody"])),
        (4, "\n".join([good, more, "Odd*** lines### have$$$ signs***"])),
        (5, "\n\n".join([good, more])),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r.text for r in quality_rules.cleaned(docs).collect()}
    assert set(kept) == {1, 3, 4, 5}
    assert kept[1] == kept[3] == kept[4] == "\n".join([good, more])
    assert kept[5] == rows[4][1]


def test_columns_stay_and_empty_tables_work(spark):
    docs = awkward_docs(spark)
    assert quality_rules.cleaned(docs).columns == docs.columns
    assert quality_rules.quality(no_docs(spark)).count() == 0
    assert quality_rules.cleaned(no_docs(spark)).count() == 0
    assert exact_dedup.exact_dedup(no_docs(spark)).count() == 0
    assert exact_dedup.keep_one(no_docs(spark)).count() == 0


def test_a_paragraph_that_begins_like_a_notice_stays(spark):
    said = " ".join(f"word{k}" for k in range(40))
    notice = "Copyright " + " ".join(f"holder{k}" for k in range(quality_rules.MAX_NOTICE_WORDS - 1))
    rows = [(1, f"Copyright {said}"), (2, f"Sign up {said}\nplus a good line"), (3, f"{said}\n{notice}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id: r.text for r in quality_rules.cleaned(docs).collect()}
    assert kept == {1: rows[0][1], 2: rows[1][1], 3: said}
