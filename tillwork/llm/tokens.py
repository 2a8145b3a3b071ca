"""Pieces of text between white space: what a tokenizer that drops white space can cache."""

import re

CACHED_PIECES = 500_000  # of a Python worker; beyond it the cache starts anew

# Characters that str.split() takes for white space and Unicode does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_UNICODE_SPACE = re.compile(
    "[\t-\r \x85\xa0  -     　]+"
)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(text: str) -> list[str]:
    """The text split at Unicode white space."""
    if _SEPARATORS.search(text):
        return [piece for piece in _UNICODE_SPACE.split(text) if piece]
    return text.split()
