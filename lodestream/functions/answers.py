"""Expressions on recorded answers: JSON in noisy text, decisions, confidences, probabilities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECISIONS = {"A": "YES", "B": "NO", "C": "AMBIGUOUS"}
INVALID = "INVALID"
LABELS = ("YES", "NO", "AMBIGUOUS")


def json_object(text: Column) -> Column:
    """The JSON object in ``text`` as a variant: the whole text, or else its first ``{`` to its last
    ``}``; null if neither parses. A value that is no object is null, too."""
    whole = F.try_parse_json(F.trim(text))
    inner = F.try_parse_json(F.nullif(F.regexp_extract(text, r"(?s)[{].*[}]", 0), F.lit("")))
    is_object = lambda v: F.when(F.schema_of_variant(v).startswith("OBJECT"), v)
    return F.coalesce(is_object(whole), is_object(inner))


def decision(value: Column) -> Column:
    """The decision of a letter (any case, spaces around it); everything else is INVALID."""
    key = F.upper(F.regexp_replace(F.coalesce(value, F.lit("")), r"(?U)^\s+|\s+$", ""))
    chain = F.lit(INVALID)
    for letter, name in reversed(DECISIONS.items()):
        chain = F.when(key == letter, F.lit(name)).otherwise(chain)
    return chain


def confidence(value: Column) -> Column:
    """A whole number from 1 to 10; null otherwise. Read from a variant as ``bigint``, fractions of
    numbers are cut off and texts must be whole numbers."""
    return F.when(value.between(1, 10), value).cast("int")


def probability_scores(yes: Column, no: Column, ambiguous: Column, epsilon: float = 1e-12) -> Column:
    """struct(yes, no, ambiguous, decision, confidence, margin, entropy, normalized_entropy): negative
    values count as 0, the three are scaled to sum 1; ties go to the first of YES, NO, AMBIGUOUS; where
    the sum is 0 all is null."""
    clipped = [F.greatest(F.lit(0.0), c.cast("double")) for c in (yes, no, ambiguous)]
    total = clipped[0] + clipped[1] + clipped[2]
    y, n, a = (F.when(total > 0, c / total) for c in clipped)
    top = F.sort_array(F.array(y, n, a), asc=False)
    entropy = -(y * F.ln(y + epsilon) + n * F.ln(n + epsilon) + a * F.ln(a + epsilon))
    best = F.when(total > 0, F.when((y >= n) & (y >= a), F.lit("YES")).when(n >= a, F.lit("NO")).otherwise(F.lit("AMBIGUOUS")))
    return F.struct(
        y.alias("yes"), n.alias("no"), a.alias("ambiguous"), best.alias("decision"), F.get(top, F.lit(0)).alias("confidence"),
        (F.get(top, F.lit(0)) - F.get(top, F.lit(1))).alias("margin"), entropy.alias("entropy"), (entropy / F.ln(F.lit(3.0))).alias("normalized_entropy"),
    )
