"""Fragments shared by the oracle SQL. Money is summed as decimals on both sides."""

REV = "CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(5,4)))"
TOTAL = "CAST(o_totalprice AS DECIMAL(18,2))"
PRICE = "CAST(p_retailprice AS DECIMAL(18,2))"
FULFILLED = "o_orderstatus IN ('F', 'P')"


def amount(value: str, places: int = 2) -> str:
    return f"CAST(ROUND({value}, {places}) AS DOUBLE)"


def mean(value: str, places: int = 2) -> str:
    quotient = f"CAST(SUM({value}) AS DOUBLE) / COUNT({value})"
    return amount(f"CAST({quotient} AS DECIMAL(18,6))", places)


def ratio(part: str, whole: str, places: int = 2, scale: int = 1) -> str:
    quotient = f"CAST({part} AS DOUBLE) * {scale} / NULLIF(CAST({whole} AS DOUBLE), 0)"
    return amount(f"CAST({quotient} AS DECIMAL(18,6))", places)


def percent(part: str, whole: str, places: int = 2) -> str:
    return ratio(part, whole, places, 100)


def tier(value: str, cuts, otherwise: str) -> str:
    cases = " ".join(f"WHEN {value} >= {cut} THEN '{label}'" for label, cut in cuts)
    return f"CASE {cases} ELSE '{otherwise}' END"


def count(value: str = "*") -> str:
    return f"CAST(COUNT({value}) AS BIGINT)"


def total(value: str) -> str:
    return f"CAST(SUM({value}) AS BIGINT)"
