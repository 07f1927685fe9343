"""Regular expressions for the JVM from ordered vocabularies and patterns.

Dialect. ``PREFIX`` makes Java's engine behave as Unicode-aware, case-insensitive engines do: ``u``
and ``U`` for Unicode case and classes, ``d`` so that only ``\\n`` ends a line. Known rest: a combining
mark after a word is no boundary here, and U+001C to U+001F are no white space.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

PREFIX = "(?iuUd)"
#: Matches nothing: an empty vocabulary has no match (not a match everywhere).
NEVER = "(?!)"


def _quoted(term: str) -> str:
    return re.sub(r"([^\w\s])", r"\\\1", term, flags=re.ASCII) if term.isascii() else re.escape(term)


def words(terms: Iterable[str]) -> str:
    """Any of ``terms`` as whole words; the first in the given order wins at a position."""
    terms = list(terms)
    return PREFIX + r"\b(?:" + "|".join(map(_quoted, terms)) + r")\b" if terms else NEVER


def longest_first(terms: Iterable[str]) -> list[str]:
    """Distinct terms, longer ones first, then by their lower case."""
    return sorted(dict.fromkeys(terms), key=lambda t: (-len(t), t.lower()))


def alias_source(terms: Iterable[str]) -> str:
    """Any of ``terms``, longest first, not next to an ASCII letter or digit (no flags, to be put into
    larger patterns)."""
    terms = longest_first(terms)
    return r"(?<![A-Za-z0-9])(?:" + "|".join(map(_quoted, terms)) + r")(?![A-Za-z0-9])" if terms else NEVER


def aliases(terms: Iterable[str]) -> str:
    return PREFIX + alias_source(terms)


def ascii_words(source: str) -> str:
    """``source`` with word boundaries that only know ASCII, as JavaScript has them."""
    return rf"(?i)(?<![A-Za-z0-9_])(?:{source})(?![A-Za-z0-9_])"


def ported(source: str) -> str:
    """A pattern for the JVM with the dialect above."""
    return PREFIX + source
