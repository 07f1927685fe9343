"""Keyword labels for sheets, carried over from earlier labels, with integrity checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.functions.patterns import ascii_words

# The words that a label stands for, and the labels.
SOURCES = {"Tylenol": r"tylenol|acetaminophen|acetominophen|paracetamol|apap|panadol", "Advil": r"advil|ibuprofen(?:s)?|motrin|nurofen|brufen"}
REVIEW = "REVIEW"
ERROR_CELL = r"#(?:REF!|DIV/0!|VALUE!|NAME\?|N/A|NUM!|NULL!)"


def keyword_label(c: Column, sources: dict[str, str] = SOURCES, review: str = REVIEW) -> Column:
    """The names of all sources that occur, joined by ``_``; ``review`` where none does."""
    names = F.filter(F.array(*[F.when(F.coalesce(c, F.lit("")).rlike(ascii_words(p)), F.lit(n)) for n, p in sources.items()]), lambda x: x.isNotNull())
    return F.when(F.size(names) > 0, F.array_join(names, "_")).otherwise(F.lit(review))


def labelled(sheet: DataFrame, earlier: DataFrame, text: str = "question", label: str = "label", order: str = "sheet_row") -> DataFrame:
    """``sheet`` with ``label`` and ``source``: the last earlier label of the same trimmed text
    (``previous``), else a keyword label (``keyword``)."""
    key = F.trim(F.coalesce(F.col(text), F.lit("")))
    last = earlier.where(F.col(label).isNotNull()).select(key.alias("_k"), F.col(label).alias("_l"), F.col(order).alias("_o")).groupBy("_k").agg(F.max_by("_l", "_o").alias("_l"))
    joined = sheet.drop(label).withColumn("_k", key).join(last, "_k", "left")
    return joined.withColumns({label: F.coalesce("_l", keyword_label(F.col(text))), "source": F.when(F.col("_l").isNotNull(), "previous").otherwise("keyword")}).drop("_k", "_l")


def written_back(sheet: DataFrame, labels: DataFrame, label: str = "label") -> DataFrame:
    """``sheet`` with the labels of ``labels`` by row; rows without one keep theirs."""
    new = labels.select("sheet_row", F.col(label).alias("_new"))
    return sheet.join(new, "sheet_row", "left").withColumn(label, F.coalesce("_new", label)).drop("_new")


def row_gaps(df: DataFrame, key: str, first: int, last: int) -> DataFrame:
    """(row, problem): rows of first..last that are ``missing`` from ``df``, and rows of ``df`` that are
    ``unexpected`` there. Empty: complete."""
    spark = df.sparkSession
    have = df.select(F.col(key).cast("bigint").alias("row")).distinct()
    want = spark.range(first, last + 1).withColumnRenamed("id", "row")
    return want.join(have, "row", "left_anti").withColumn("problem", F.lit("missing")).unionByName(have.join(want, "row", "left_anti").withColumn("problem", F.lit("unexpected")))


def changed(old: DataFrame, new: DataFrame, key: str, column: str) -> DataFrame:
    """(key, before, after) where a column that must not change did, by row."""
    both = old.select(key, F.col(column).alias("before")).join(new.select(key, F.col(column).alias("after")), key, "full")
    return both.where(~F.col("before").eqNullSafe(F.col("after")))


def blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.trim(F.coalesce(F.col(column), F.lit(""))) == "")


def error_cells(df: DataFrame, key: str, columns: list[str], at_most: int = 300) -> DataFrame:
    """The first cells that hold a formula error (a report, so it has a limit)."""
    cells = df.select(key, F.explode(F.array(*[F.struct(F.lit(c).alias("cell"), F.col(c).cast("string").alias("value")) for c in columns])).alias("c")).select(key, "c.*")
    return cells.where(F.col("value").rlike(ERROR_CELL)).orderBy(key, "cell").limit(at_most)


def check(df: DataFrame, what: str) -> None:
    """Raise if a table of problems has rows."""
    rows = df.limit(5).collect()
    if rows:
        raise ValueError(f"{what}: {[r.asDict() for r in rows]}")


def histogram(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))
