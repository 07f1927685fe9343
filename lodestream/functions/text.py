"""Text expressions: normalisation, vocabulary matches, sentence units and windows.

All are column expressions that stay in the JVM. Positions count characters (code points).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestream.functions.patterns import PREFIX, ported

LINK, URL, SPACE = PREFIX + r"\[([^\]]+)\]\([^)]*\)", PREFIX + r"https?://\S+", PREFIX + r"\s+"
_SENTINEL = "\u0001"


def filled(c: Column) -> Column:
    """Null as the empty text."""
    return F.coalesce(c, F.lit(""))


def normalized(c: Column) -> Column:
    """Markdown links as their text, URLs and runs of white space as one space, trimmed; null as ''."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(filled(c), LINK, "$1"), URL, " "), SPACE, " "))


def unique_matches(c: Column, pattern: str) -> Column:
    """Lower-cased matches in the order of their first appearance."""
    return F.array_distinct(F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), lambda x: F.lower(x)))


def first_vocabulary(c: Column, patterns: dict[str, str]) -> Column:
    """struct(name, term) of the first vocabulary, in the given order, that matches; null if none."""
    found = [F.when(c.rlike(p), F.struct(F.lit(n).alias("name"), F.regexp_extract(c, p, 0).alias("term"))) for n, p in patterns.items()]
    return F.coalesce(*found) if found else F.lit(None).cast("struct<name:string,term:string>")


def matching_names(c: Column, patterns: dict[str, str]) -> Column:
    """Names of the vocabularies that match, in the given order."""
    return F.filter(F.array(*[F.when(c.rlike(p), F.lit(n)) for n, p in patterns.items()]), lambda x: x.isNotNull())


def sentence_units(title: Column, body: Column) -> Column:
    """The title, then the sentences and lines of the body, trimmed, without empty ones."""
    marked = F.regexp_replace(F.regexp_replace(filled(body), ported(r"(?<=[.!?])\s+"), _SENTINEL), r"\n+", _SENTINEL)
    parts = F.concat(F.array(filled(title)), F.split(marked, _SENTINEL))
    trimmed = F.transform(parts, lambda x: F.regexp_replace(x, ported(r"^\s+|\s+$"), ""))
    return F.filter(trimmed, lambda x: x != "")


def sentence_windows(units: Column) -> Column:
    """Each unit with the one after it, the last alone; ``. `` goes between them where the first has
    no end mark. Repeated windows are left out."""
    after = F.concat(F.slice(units, 2, F.greatest(F.size(units) - 1, F.lit(0))), F.array(F.lit(None).cast("string")))
    pairs = F.zip_with(units, after, lambda a, b: F.when(b.isNull(), a).otherwise(F.concat(a, F.when(a.rlike(r"[.!?]\s*$"), " ").otherwise(". "), b)))
    return F.when(F.size(units) > 0, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def question_windows(units: Column, question: str, before: int = 2, first: int = 3, size: int = 650) -> Column:
    """array<struct(question, context)> of the units that match ``question``: the first unit with the
    ``first`` units of the post and the beginning of both, others with ``before`` units before them
    and the end of both."""
    at = F.sequence(F.lit(1), F.greatest(F.size(units), F.lit(1)))

    def window(i: Column) -> Column:
        unit = F.get(units, i - 1)
        lead = F.array_join(F.slice(units, 1, first), " ")
        start = F.greatest(i - before, F.lit(1))
        near = F.array_join(F.slice(units, start, i - start + 1), " ")
        return F.when(
            unit.rlike(question),
            F.when(i == 1, F.struct(F.left(unit, F.lit(size)).alias("question"), F.left(lead, F.lit(size)).alias("context"))).otherwise(
                F.struct(F.right(unit, F.lit(size)).alias("question"), F.right(near, F.lit(size)).alias("context"))
            ),
        )

    return F.filter(F.transform(at, window), lambda x: x.isNotNull())


def post_windows(units: Column, question: str) -> Column:
    """array<struct(question, context)> of the units that match ``question``, with the whole post."""
    whole = F.array_join(units, " ")
    return F.transform(F.filter(units, lambda u: u.rlike(question)), lambda u: F.struct(u.alias("question"), whole.alias("context")))


def match_start(c: Column, source: str) -> Column:
    """Characters before the first match of ``source`` (a pattern without flags); null without one."""
    return F.when(c.rlike(ported(source)), F.length(F.regexp_extract(c, ported(rf"^([\s\S]*?)(?:{source})"), 1)))


def match_context(c: Column, source: str, radius: int = 220) -> Column:
    """The first match of ``source`` with ``radius`` characters on either side, trimmed."""
    start = match_start(c, source)
    end = start + F.length(F.regexp_extract(c, ported(source), 0))
    low = F.greatest(start - radius, F.lit(0))
    return F.trim(F.substring(c, low + 1, end + radius - low))


def rfind(c: Column, part: Column) -> Column:
    """Characters before the last occurrence of ``part``; -1 without one."""
    at = F.instr(F.reverse(c), F.reverse(part))
    return F.when(at > 0, F.length(c) - F.length(part) - at + 1).otherwise(F.lit(-1))
