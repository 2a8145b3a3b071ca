"""DuckDB SQL that gives the same rows as the queries."""

from tillwork.llm.mixing import BLOCKS, MOST, SEED, SHARDS, SHARE, WEIGHTS
from tillwork.llm.secret_scan import BASE, RULES
from tillwork.llm.quality_rules import (
    MAX_CELL_WORDS,
    MAX_REPEATED_PERCENT,
    MIN_SHARE,
    MIN_WORDS,
    NOTICE,
    WINDOW,
)

WORD = r"[^\x20\x09-\x0D]+"

EXACT_DEDUP = """
WITH d AS (SELECT doc_id, sha256(COALESCE(text, '')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, MAX(doc_id) AS keep_id, COUNT(*) AS group_size FROM d GROUP BY 1)
SELECT d.doc_id, g.keep_id, CAST(g.group_size AS BIGINT) AS group_size,
       d.doc_id = g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""

QUALITY = f"""
WITH d AS (SELECT doc_id, COALESCE(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '{WORD}') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines
      FROM d),
grams AS (
    SELECT doc_id, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS gram
    FROM (SELECT doc_id, words, UNNEST(range(1, len(words) - {WINDOW - 2})) AS i FROM w
          WHERE len(words) >= {WINDOW})),
twice AS (SELECT doc_id, i FROM grams
          QUALIFY COUNT(*) OVER (PARTITION BY doc_id, gram) > 1),
covered AS (SELECT doc_id, COUNT(DISTINCT i + k) AS n
            FROM twice, range({WINDOW}) AS r(k) GROUP BY 1),
counted AS (
    SELECT doc_id, x AS line, len(regexp_extract_all(x, '{WORD}')) AS n,
           length(x) - length(replace(x, '|', '')) AS bars,
           length(regexp_replace(x, '[^#*$%&<>]', '', 'g')) AS marks,
           length(x) - length(replace(x, '!', '')) AS shouts
    FROM (SELECT doc_id, UNNEST(lines) AS x FROM w)),
lost AS (
    SELECT doc_id, SUM(n) AS n FROM counted
    WHERE (bars >= 3 AND n - bars <= {MAX_CELL_WORDS} * (bars + 1)) OR marks > n
       OR (shouts >= n AND n >= 3) OR regexp_matches(line, '{NOTICE}')
    GROUP BY 1),
m AS (
    SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(COALESCE(covered.n, 0) AS BIGINT) AS n_repeat_words,
           CAST(len(words) - COALESCE(lost.n, 0) AS BIGINT) AS words_left
    FROM w LEFT JOIN covered USING (doc_id) LEFT JOIN lost USING (doc_id)),
v AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words
             AS base_failed FROM m)
SELECT *, NOT base_failed AND words_left >= {MIN_SHARE} * n_words AS kept FROM v
"""

NGRAM_JOIN = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS gram
    FROM (SELECT doc_id, words, UNNEST(range(1, greatest(len(words) - 1, 2))) AS i
          FROM d WHERE len(words) > 0)),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY 1),
same AS (
    SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS n
    FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
    SELECT a, b FROM same JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE 100 * same.n >= 90 * (x.n + y.n - same.n)),
reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM d
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other)
SELECT r.doc_id, CAST(COALESCE(ANY_VALUE(n.n), 0) AS BIGINT) AS n_shingles,
       MIN(r.other) AS component_id
FROM reached r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY 1
"""


def _tree() -> str:
    """The levels of the splitting tree, each a pair of subqueries."""
    parts = [f"t0 AS (SELECT place, blocks, 0 AS low, {SHARDS} AS high FROM goals)"]
    for k in range((SHARDS - 1).bit_length()):
        parts.append(f"""
u{k} AS (
    SELECT place, low, high, (low + high + 1) // 2 AS middle, COUNT(*) OVER (PARTITION BY low) AS n,
           ROW_NUMBER() OVER (PARTITION BY low
                              ORDER BY md5('{SEED}/' || low || '/' || place || '/' || unit)) AS r
    FROM (SELECT *, UNNEST(range(1, blocks + 1)) AS unit FROM t{k} WHERE blocks > 0)),
t{k + 1} AS (
    SELECT place, COUNT(*) AS blocks, IF(goes_left, low, middle) AS low,
           IF(goes_left, middle, high) AS high
    FROM (SELECT *, r <= n * (middle - low) // (high - low) AS goes_left FROM u{k})
    GROUP BY ALL)""")
    return ",".join(parts)


MIXING = f"""
WITH d AS (
    SELECT doc_id, IF(source IS NULL, '1', '0' || source) AS place,
           CAST(len(regexp_extract_all(COALESCE(text, ''), '{WORD}')) AS BIGINT) AS size,
           md5('{SEED}/' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS draw
    FROM documents),
s AS (
    SELECT place, CAST(SUM(size) AS BIGINT) AS source_size,
           [{", ".join(map(str, WEIGHTS))}][(ROW_NUMBER() OVER (ORDER BY place) - 1) % {len(WEIGHTS)} + 1]
               AS weight
    FROM d GROUP BY place),
-- The rounds of sharing end where the sources up to some ratio of limit to weight are full.
c AS (
    SELECT *, COALESCE(SUM({MOST} * source_size) OVER before, 0) AS spent,
           SUM(weight) OVER () - COALESCE(SUM(weight) OVER before, 0) AS open_weight,
           {SHARE} * SUM(source_size) OVER () AS shared
    FROM s WINDOW before AS (ORDER BY source_size / weight, place
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
    SELECT CAST(MIN_BY((CAST(shared AS DOUBLE) - CAST(spent AS DOUBLE)) / CAST(open_weight AS DOUBLE),
                       source_size / weight) AS DOUBLE) AS per_weight
    FROM c WHERE (CAST(shared AS DOUBLE) - CAST(spent AS DOUBLE)) / CAST(open_weight AS DOUBLE) * weight
                 <= {MOST} * source_size),
t AS (
    SELECT place, source_size,
           LEAST(CAST({MOST} * source_size AS DOUBLE), per_weight * weight) AS target FROM s, l),
b AS (
    SELECT *, CAST(FLOOR(target + 0.5) AS BIGINT) AS goal,
           GREATEST(1, CAST(CEIL(SUM(FLOOR(target + 0.5)) OVER () / {SHARDS * BLOCKS}) AS BIGINT)) AS width
    FROM t),
goals AS (SELECT *, CAST(CEIL(goal / width) AS BIGINT) AS blocks FROM b),
{_tree()},
dealt AS (
    SELECT place, low AS shard, UNNEST(range(CAST(e - blocks AS BIGINT), CAST(e AS BIGINT))) AS block
    FROM (SELECT *, SUM(blocks) OVER (PARTITION BY place ORDER BY low) AS e
          FROM t{(SHARDS - 1).bit_length()})),
lines AS (
    SELECT d.*, g.source_size, g.target, g.goal, g.width,
           SUM(size) OVER (PARTITION BY place ORDER BY draw, doc_id ROWS UNBOUNDED PRECEDING) - size
               AS line
    FROM d JOIN goals g USING (place)),
passes AS (
    SELECT *, k, CAST(GREATEST(0, LEAST(size, goal - k * source_size - line)) AS BIGINT) AS words,
           CAST(k * source_size + line AS BIGINT) // width AS block
    FROM lines, range({MOST}) AS r(k)),
placed AS (
    SELECT p.*, shard FROM passes p
    LEFT JOIN dealt ON dealt.place = p.place AND dealt.block = p.block AND p.words > 0)
SELECT doc_id, ANY_VALUE(size) AS size, ANY_VALUE(source_size) AS source_size,
       ANY_VALUE(target) AS target, CAST(SUM(words) AS BIGINT) AS taken,
       COALESCE(STRING_AGG(CAST(shard AS VARCHAR), ',' ORDER BY k), '') AS shards
FROM placed GROUP BY doc_id
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _kind(number: int) -> str:
    """The spans of a rule: starts follow from the lengths of what lies between the matches."""
    rule = RULES[number]
    return f"""
SELECT doc_id, {number} AS number, '{rule.kind}' AS kind, start, start + length(m) AS stop
FROM (SELECT doc_id, m, SUM(length(a)) OVER w
             + COALESCE(SUM(length(m)) OVER (PARTITION BY doc_id ORDER BY k
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM (SELECT doc_id, UNNEST(string_split_regex(text, {_quoted(rule.pattern)})) AS a,
                   UNNEST(regexp_extract_all(text, {_quoted(rule.pattern)})) AS m,
                   UNNEST(range(len(string_split_regex(text, {_quoted(rule.pattern)})))) AS k
            FROM d WHERE regexp_matches(text, {_quoted(rule.pattern)}))
      WINDOW w AS (PARTITION BY doc_id ORDER BY k ROWS UNBOUNDED PRECEDING))
WHERE m IS NOT NULL AND length(regexp_extract(m, {_quoted(rule.pattern)}, {rule.group})) >= {rule.least}
"""


SECRETS = f"""
WITH d AS (SELECT doc_id, COALESCE(text, '') AS text FROM documents),
s AS ({" UNION ALL ".join(map(_kind, range(len(RULES))))}),
p AS (SELECT *, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span FROM s),
g AS (
    SELECT doc_id, {", ".join(f"COUNT(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)},
           STRING_AGG(span, ',' ORDER BY start, number) FILTER (number < {len(BASE)}) AS base,
           STRING_AGG(span, ',' ORDER BY start, number) AS spans
    FROM p GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"CAST(COALESCE(n_{r.kind}, 0) AS BIGINT) AS n_{r.kind}" for r in BASE)},
       sha256(COALESCE(base, '')) AS base_sha256, COALESCE(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""
