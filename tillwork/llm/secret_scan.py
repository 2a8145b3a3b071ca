"""Secret scans over a trigram inverted index.

Each rule's Boolean trigram query is derived from its parsed regular expression: what stands in a
row is joined into strings, alternatives and small classes give several, a repeat or a large class
ends them. Every clause of a query must hold; a clause asks for all trigrams, folded to lower
case, of one of its branches. The index maps each trigram that some
query asks for to the documents that contain it (``postings``); the documents of a trigram are
rows, never a list, so a frequent trigram is as good as any other. A query intersects postings by
combining the trigrams of a document, on the map side first, and keeps the documents that fulfil
all clauses. Only those are matched against the rule's regular expression. A rule without mandatory
trigrams, such as a run of hex digits, scans every document.

Spans come from built-in functions alone: what a regular expression splits a text into, and what
it extracts, alternate, so their lengths add up to the positions of the matches. Positions count
code points, ends are exclusive.

Defined results: a missing text counts as empty. Rows that repeat an id are looked up by it, a
missing id too, and each is matched against its own text. Very long texts are matched whole, in
time linear in their length and matches. Columns of other names are never read. An empty table
gives no rows.
"""

import re._parser as sre
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.texts import corpus, pin


@dataclass(frozen=True)
class Rule:
    """``group`` must have at least ``least`` characters; a shorter match is dropped but uses up
    its text."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base kinds, in the order in which they are listed. Runs that are too
# short cannot begin a longer match, so the last two ask for the length in the pattern.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[baprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    # Longer runs of scheme characters count from their last 21, so that they are read once.
    Rule("url_password", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]+:[^\s/:@]+@"),
)
RULES = BASE + MORE
STRINGS = 64  # that a row of literals, alternatives and small classes may stand for


def trigrams(literal: str) -> frozenset[str]:
    folded = literal.lower()
    return frozenset(folded[i : i + 3] for i in range(len(folded) - 2))


Clause = list[frozenset[str]]  # any of these must be there whole


def _clause(strings: set[str]) -> Clause | None:
    """None if some string has no trigram, and so asks for nothing."""
    sets = {trigrams(x) for x in strings}
    if frozenset() in sets:
        return None
    return sorted((x for x in sets if not any(y < x for y in sets)), key=sorted)


class _Walk:
    """The clauses of a sequence of parsed nodes, and the strings it may still end in."""

    def __init__(self):
        self.clauses: list[Clause] = []
        self.strings = {""}
        self.only = True  # the strings are all that was matched so far

    def flush(self) -> None:
        clause = _clause(self.strings)
        if clause and clause not in self.clauses:
            self.clauses.append(clause)
        self.strings, self.only = {""}, False

    def add(self, strings: set[str] | None) -> None:
        if strings is None or len(self.strings) * len(strings) > STRINGS:
            self.flush()
        if strings is not None and len(strings) <= STRINGS:
            self.strings = {x + y for x in self.strings for y in strings}

    def sequence(self, nodes) -> "_Walk":
        for kind, value in nodes:
            self.node(kind, value)
        return self

    def node(self, kind, value) -> None:
        if kind is sre.LITERAL:
            self.add({chr(value).lower()})
        elif kind is sre.IN:
            self.add(_members(value))
        elif kind is sre.SUBPATTERN:
            self.part(value[-1])
        elif kind is sre.ATOMIC_GROUP:
            self.part(value)
        elif kind is sre.BRANCH:
            self.branch([_Walk().sequence(x) for x in value[1]])
        elif kind in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            self.repeat(*value)
        elif kind not in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):  # these match no characters
            self.flush()

    def part(self, nodes) -> None:
        inner = _Walk().sequence(nodes)
        if inner.only:
            self.add(inner.strings)
        else:
            self.flush()
            inner.flush()
            self.clauses += [c for c in inner.clauses if c not in self.clauses]

    def branch(self, parts: list["_Walk"]) -> None:
        if all(p.only for p in parts):
            self.add(set().union(*[p.strings for p in parts]))
            return
        self.flush()
        for p in parts:
            p.flush()
        if all(p.clauses for p in parts):  # any alternative by its longest clause
            best = [max(p.clauses, key=lambda c: min(map(len, c))) for p in parts]
            self.clauses.append(sorted(set().union(*best), key=sorted))

    def repeat(self, least, most, nodes) -> None:
        inner = _Walk().sequence(nodes)
        if inner.only and least == 0 and most == 1:
            self.add(inner.strings | {""})
        elif least == 0:
            self.flush()
        else:
            for _ in range(min(int(least), 3)):
                self.part(nodes)
            if least > 3 or most != least:
                self.flush()


def _members(items) -> set[str] | None:
    """The characters of a small class."""
    found: set[str] = set()
    for kind, value in items:
        if kind is sre.LITERAL:
            found.add(chr(value).lower())
        elif kind is sre.RANGE and value[1] - value[0] < STRINGS:
            found |= {chr(x).lower() for x in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= 8 else None


def derived(pattern: str) -> list[Clause]:
    """The trigram query of a regular expression: every clause is necessary for a match."""
    walk = _Walk().sequence(sre.parse(pattern))
    walk.flush()
    return walk.clauses


def queries(rules=RULES) -> dict[str, list[Clause]]:
    """kind -> clauses; none if the rule has no mandatory trigram and scans all."""
    return {r.kind: clauses for r in rules if (clauses := derived(r.pattern))}


def _asked(rules) -> list[str]:
    return sorted(set().union(*[b for clauses in queries(rules).values() for c in clauses for b in c]))


def postings(texts: DataFrame, rules=RULES) -> DataFrame:
    """The inverted index (trigram, doc_id) of rows (doc_id, text), for the trigrams asked for."""
    asked = _asked(rules)
    folded = texts.select("doc_id", F.lower("text").alias("text"))
    present = F.array_compact(
        F.array(*[F.when(F.col("text").contains(t), F.lit(t)) for t in asked])
    )
    return folded.select("doc_id", F.explode(present).alias("trigram"))


def candidates(index: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, kinds): the documents whose trigrams fulfil the queries of some rules."""
    asked = queries(rules)
    bit = {t: k for k, t in enumerate(_asked(rules))}
    # Words of 60 bits: or-ing them is the intersection of the postings, a document at a time.
    words = range(len(bit) // 60 + 1)
    number = F.create_map(*[F.lit(x) for t, k in bit.items() for x in (t, k)])[F.col("trigram")]
    numbered = index.withColumn("number", number)
    masks = [
        F.bit_or(
            F.when(
                F.floor(F.col("number") / 60) == w,
                F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.col("number"), F.lit(60))),
            ).otherwise(F.lit(0).cast("long"))
        ).alias(f"mask_{w}")
        for w in words
    ]
    by_doc = numbered.groupBy("doc_id").agg(*masks)

    def fulfils(branch: frozenset[str]) -> Column:
        tests = F.lit(True)
        for w in words:
            need = sum(1 << (bit[t] % 60) for t in branch if bit[t] // 60 == w)
            tests = tests & (F.col(f"mask_{w}").bitwiseAND(F.lit(need).cast("long")) == need)
        return tests

    kinds = []
    for kind, clauses in asked.items():
        every = F.lit(True)
        for clause in clauses:
            any_branch = F.lit(False)
            for branch in clause:
                any_branch = any_branch | fulfils(branch)
            every = every & any_branch
        kinds.append(F.when(every, F.lit(kind)))
    found = by_doc.select("doc_id", F.array_compact(F.array(*kinds)).alias("kinds"))
    return found.filter(F.size("kinds") > 0)


def spans(text: Column, rule: Rule, number: int) -> Column:
    """The matches of a rule as structs (start, number, kind, end), ``number`` for the order.

    Positions are running sums of lengths. An array that grows by one copies itself, so the sums
    run inside chunks of CHUNK matches and over the chunks: a text with very many matches takes
    time in proportion to them.
    """
    between = F.split(text, rule.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    lengths = F.zip_with(
        between, matches, lambda a, b: F.struct(F.length(a).alias("a"), F.length(b).alias("b"), b.alias("m"))
    )
    none = F.array().cast(f"array<{_SPAN}>")

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + part["a"]
        end = start + part["b"]
        span = F.struct(
            start.alias("start"), F.lit(number).alias("number"), F.lit(rule.kind).alias("kind"), end.alias("end")
        )
        # The split has one part more than there are matches: its last has no match.
        good = part["m"].isNotNull() & (
            F.length(F.regexp_extract(part["m"], rule.pattern, rule.group)) >= rule.least
        )
        return F.struct(
            F.coalesce(end, start).alias("at"),
            F.when(good, F.array_append(state["found"], span)).otherwise(state["found"]).cast(f"array<{_SPAN}>").alias("found"),
        )

    def chunk(part: Column) -> Column:
        return F.aggregate(part, F.struct(F.lit(0).alias("at"), none.alias("found")), step)

    chunks = F.transform(_chunks(lengths), chunk)
    begins = F.aggregate(
        chunks,
        F.array(F.lit(0)),
        lambda at, c: F.array_append(at, F.element_at(at, -1) + c["at"]),
    )
    moved = F.zip_with(chunks, begins, lambda c, at: F.transform(c["found"], lambda s: _moved(s, at)))
    # There is one beginning more than chunks.
    walked = F.flatten(F.filter(moved, lambda found: found.isNotNull()))
    return F.when(text.rlike(rule.pattern), walked).otherwise(none)


def _chunks(parts: Column) -> Column:
    number = F.floor((F.size(parts) - 1) / CHUNK).cast("int")
    return F.transform(F.sequence(F.lit(0), number), lambda k: F.slice(parts, k * CHUNK + 1, F.lit(CHUNK)))


def _moved(span: Column, by: Column) -> Column:
    return F.struct(
        (span["start"] + by).alias("start"), span["number"].alias("number"), span["kind"].alias("kind"),
        (span["end"] + by).alias("end"),
    )


CHUNK = 256
_SPAN = "struct<start:int,number:int,kind:string,end:int>"


def scan(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``found``, the sorted spans of all rules, for every row of ``docs``."""
    texts = corpus(docs, id_col, text_col)
    index = pin(postings(texts, rules), "postings")
    hits = pin(candidates(index, rules), "candidates").withColumnRenamed("doc_id", "its")
    rows = texts.join(hits, F.col("doc_id").eqNullSafe(F.col("its")), "left")
    each, asked_for = [], queries(rules)
    for number, rule in enumerate(rules):
        matched = spans(F.col("text"), rule, number)
        if rule.kind in asked_for:
            asked = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
            matched = F.when(asked, matched).otherwise(F.array().cast(f"array<{_SPAN}>"))
        each.append(matched)
    return rows.select("doc_id", F.array_sort(F.concat(*each)).alias("found"))


def _listed(found: Column) -> Column:
    return F.concat_ws(
        ",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    )


def report(scanned: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans as text."""
    base = [rule.kind for rule in BASE]
    of = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    only = F.filter("found", lambda s: s["kind"].isin(base))
    return scanned.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(_listed(only), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
    )
