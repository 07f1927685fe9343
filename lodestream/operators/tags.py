"""Tags that say whether a record states enough facts to be decided, and along which axis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.functions.patterns import ported

_NUMBER = r"(?:\d+(?:\.\d+)?|a|an|one|two|three|four|five|six|seven|eight|nine|ten|eleven|twelve)"
# The patterns of the tags.
PATTERNS = {
    "has_prior_dose": r"\b(?:took|taken|had|used|swallowed|ingested|popped|have\s+taken|had\s+taken|been\s+taking)\b",
    "has_time": rf"\b(?:{_NUMBER}\s*(?:minutes?|mins?|hours?|hrs?)\s*ago|\d+(?:\.\d+)?\s*(?:hours?|hrs?)\b|at\s+\d{{1,2}}(?::\d{{2}})?\s*(?:a\.?m\.?|p\.?m\.?)|this\s+morning|this\s+afternoon|this\s+evening|last\s+night|tonight|yesterday|earlier|last\s+dose|previous\s+dose|a\s+few\s+hours\s+ago|couple\s+(?:of\s+)?hours\s+ago)\b",
    "has_amount": r"\b\d+(?:\.\d+)?\s*(?:mg|milligrams?|g|grams?|tablets?|pills?|caplets?|capsules?)\b",
    "has_strength": r"\b(?:325|500|200)\s*mg\b",
    "proposed_amount_stated": r"\b(?:take|have|use|do|pop|swallow|down)\b[^.?!]{0,40}\d+(?:\.\d+)?\s*(?:mg|milligrams?|tablets?|pills?|caplets?|capsules?)\b",
}
#: Axes by priority: the first whose tags all hold.
AXES = {"rolling": ("has_prior_dose", "has_time", "has_amount"), "interval": ("has_prior_dose", "has_time"), "single_dose": ("proposed_amount_stated",)}


def tagged(df: DataFrame, text: Column, patterns: dict[str, str] = PATTERNS, axes: dict[str, tuple[str, ...]] = AXES) -> DataFrame:
    """``df`` with ``decidability``: struct of the tags, ``decidable_axis`` (null if none) and ``decidable``."""
    text = F.coalesce(text, F.lit(""))
    with_tags = df.withColumns({f"_t_{n}": text.rlike(ported(p)) for n, p in patterns.items()})
    axis = F.lit(None).cast("string")
    for name, needs in reversed(axes.items()):
        all_of = F.lit(True)
        for n in needs:
            all_of = all_of & F.col(f"_t_{n}")
        axis = F.when(all_of, F.lit(name)).otherwise(axis)
    tags = [F.col(f"_t_{n}").alias(n) for n in patterns]
    return with_tags.withColumn("decidability", F.struct(*tags, axis.alias("decidable_axis"), axis.isNotNull().alias("decidable"))).drop(*[f"_t_{n}" for n in patterns])


def axis_counts(df: DataFrame, by: str | None = None) -> DataFrame:
    """How many records are decidable along each axis (null: not decidable)."""
    keys = [by] if by else []
    return df.groupBy(*keys, F.col("decidability.decidable_axis").alias("decidable_axis")).agg(F.count("*").alias("n"))
