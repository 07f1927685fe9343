"""Cleaning: normalised fields, first copies, empty texts, counters.

Defined results: the first copy of a key is kept by an explicit order; rows whose key is null or empty
are never copies; copies are dropped before empty texts, so an empty first copy hides later ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.functions.text import filled, normalized


def normalize(df: DataFrame, title: str = "title", body: str = "body") -> DataFrame:
    """``title_clean``, ``body_clean`` and ``clean_text``, the two put together and normalised again."""
    df = df.withColumns({"title_clean": normalized(F.col(title)), "body_clean": normalized(F.col(body))})
    return df.withColumn("clean_text", normalized(F.concat("title_clean", F.lit(" "), "body_clean")))


def with_fallbacks(df: DataFrame) -> DataFrame:
    """Clean fields that were never filled: from the raw ones; an empty clean_text from both."""
    t, b = F.coalesce("title_clean", "title", F.lit("")), F.coalesce("body_clean", "body", F.lit(""))
    return df.withColumns({"title_clean": t, "body_clean": b, "clean_text": F.when(filled(F.col("clean_text")) == "", F.concat(t, F.lit(" "), b)).otherwise(F.col("clean_text"))})


def copies(df: DataFrame, keys: list[str], order: list[Column | str], among: Column | None = None) -> DataFrame:
    """``df`` with ``is_copy``: not the first row of its keys, of the rows ``among`` which keys are
    compared. Other rows, and those whose last key is null or empty, are no copies; they are spread
    over the window's partitions, so a key that a third of all rows lack makes no hot one."""
    keyed = F.nullif(F.col(keys[-1]).cast("string"), F.lit("")).isNotNull()
    if among is not None:
        keyed = keyed & F.coalesce(among, F.lit(False))
    apart = df.withColumn("_keyed", keyed).withColumn("_apart", F.when(F.col("_keyed"), F.lit(-1)).otherwise(F.monotonically_increasing_id()))
    w = Window.partitionBy(*keys, "_apart").orderBy(*order)
    return apart.withColumn("is_copy", F.col("_keyed") & (F.row_number().over(w) > 1)).drop("_keyed", "_apart")


def cleaned(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """``df`` with ``outcome``: ``duplicate``, ``dropped_empty`` or ``kept``."""
    flagged = copies(df, keys, order)
    return flagged.withColumn("outcome", F.when(F.col("is_copy"), "duplicate").when(filled(F.col("clean_text")) == "", "dropped_empty").otherwise("kept")).drop("is_copy")


def counters(flags: DataFrame, by: str) -> DataFrame:
    return flags.groupBy(by).agg(F.count("*").alias("input"), *[F.count_if(F.col("outcome") == x).alias(n) for n, x in (("duplicates", "duplicate"), ("dropped_empty", "dropped_empty"), ("kept", "kept"))])
