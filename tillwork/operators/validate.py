"""Declared constraints, checked on whole tables."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.operators.joins import lacking_match
from tillwork.operators.profile import copies


@dataclass
class Constraints:
    """What the rows of a table must satisfy.

    ``checks`` maps a rule name to a predicate that must not be false (unknown passes, as
    in SQL); ``unique`` lists keys; ``references`` maps a column to (parent, parent key).
    """

    not_null: list[str] = field(default_factory=list)
    checks: dict[str, Column] = field(default_factory=dict)
    unique: list[list[str]] = field(default_factory=list)
    references: dict[str, tuple[DataFrame, str]] = field(default_factory=dict)


def _key_text(key: list[str]) -> Column:
    """The key as text, with its nulls. Rows are grouped by the key itself, not by this."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in key])


def violations(df: DataFrame, key: list[str], rules: Constraints) -> DataFrame:
    """(rule, row_key, occurrences) for every broken rule.

    All row rules share one scan; each key and each reference needs one more.
    """
    broken = {f"not_null:{c}": F.col(c).isNull() for c in rules.not_null}
    broken |= {f"check:{name}": ~test for name, test in rules.checks.items()}
    names = F.array(*[F.when(bad, F.lit(name)) for name, bad in broken.items()])
    per_row = df.select(*key, F.explode(F.array_compact(names)).alias("rule"))

    def counted(rows: DataFrame) -> DataFrame:
        groups = rows.groupBy("rule", *key).agg(F.count("*").alias("occurrences"))
        return groups.select("rule", _key_text(key).alias("row_key"), "occurrences")

    found = counted(per_row)
    for columns in rules.unique:
        again = copies(df.select(*columns), *columns).select(
            F.lit("unique:" + "+".join(columns)).alias("rule"),
            _key_text(columns).alias("row_key"),
            F.col("copies").alias("occurrences"),
        )
        found = found.unionByName(again)
    for column, (parent, parent_key) in rules.references.items():
        lost = lacking_match(df.filter(F.col(column).isNotNull()), parent, column, parent_key)
        lost = lost.select(*key, F.lit(f"references:{column}").alias("rule"))
        found = found.unionByName(counted(lost))
    return found


def orphan_rows(children: DataFrame, parents: DataFrame, on: str, key: str) -> DataFrame:
    """Children whose parent is missing; a null reference counts as missing."""
    return lacking_match(children, parents, on, key)
