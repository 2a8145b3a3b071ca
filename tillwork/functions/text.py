"""Text cleaning expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens that count as missing when a raw text file is read.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Fixed value: the shape of a usable e-mail address.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"

# Spellings of product categories and the name each stands for.
CATEGORY_NAMES = {
    "electronics": "Electronics", "electronic": "Electronics",
    "clothing": "Clothing", "cloths": "Clothing",
    "grocery": "Grocery", "groceries": "Grocery",
    "furniture": "Furniture",
    "books": "Books", "book": "Books",
    "beauty": "Beauty",
    "sports": "Sports", "sport": "Sports",
}


def squeeze(text: Column) -> Column:
    """Strip white space of any kind from both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def title_case(text: Column) -> Column:
    """Capitalise every run of letters, so also after a hyphen, digit or apostrophe."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def blank_to_null(text: Column) -> Column:
    return F.when(text.rlike(r"\S"), text)


def tokens_to_null(text: Column, tokens=tuple(NULL_TOKENS)) -> Column:
    return F.when(~F.trim(text).isin(*tokens), text)


def to_integer(text: Column) -> Column:
    """Integer part of a numeric text; null for anything else."""
    return text.try_cast("double").try_cast("int")


def canonical(text: Column, names: dict[str, str]) -> Column:
    """Replace known spellings, whatever their case or padding; keep unknown values."""
    entries = F.array(*[F.struct(F.lit(k), F.lit(v)) for k, v in names.items()])
    return F.coalesce(F.map_from_entries(entries)[F.lower(F.trim(text))], text)


def is_email(text: Column) -> Column:
    """False for a missing address."""
    return F.coalesce(text.rlike(EMAIL_PATTERN), F.lit(False))
