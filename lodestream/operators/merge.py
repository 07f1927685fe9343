"""Merging partitions, counters over partitions, and the long table of statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.operators.clean import copies


def union(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts, by column names; columns that a part lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def merged(df: DataFrame, wanted: Column, key: str, order: list[Column | str]) -> DataFrame:
    """``df`` with ``outcome``: ``skipped`` (not wanted; it does not count as a first copy),
    ``duplicate`` or ``kept``, keys compared over all partitions."""
    ok = F.coalesce(wanted, F.lit(False))
    flagged = copies(df.withColumn("_ok", ok), [key], order, among=F.col("_ok"))
    return flagged.withColumn("outcome", F.when(~F.col("_ok"), "skipped").when(F.col("is_copy"), "duplicate").otherwise("kept")).drop("_ok", "is_copy")


def merge_counts(flags: DataFrame, by: str) -> DataFrame:
    return flags.groupBy(by).agg(F.count_if(F.col("outcome") == "kept").alias("kept"), F.count_if(F.col("outcome") == "duplicate").alias("duplicates"), F.count_if(F.col("outcome") == "skipped").alias("skipped"))


def rollup_with_missing(counts: DataFrame, expected: DataFrame, key: str, values: list[str]) -> DataFrame:
    """(key, values, missing): every expected partition, the sums of its values (0 if it has none),
    whether it is missing, and a last row with a null key for the totals."""
    sums = counts.groupBy(key).agg(*[F.sum(v).alias(v) for v in values], F.lit(True).alias("_here"))
    each = expected.select(key).distinct().join(sums, key, "left").select(key, *[F.coalesce(v, F.lit(0)).cast("bigint").alias(v) for v in values], F.col("_here").isNull().alias("missing"))
    total = each.agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(v) for v in values], F.coalesce(F.bool_or("missing"), F.lit(False)).alias("missing")).select(F.lit(None).cast(dict(each.dtypes)[key]).alias(key), *values, "missing")
    return each.unionByName(total)


def missing_partitions(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return expected.select(key).distinct().join(present.select(key), key, "left_anti")


def long_stats(counts: DataFrame, dump: str, step: str) -> DataFrame:
    """(dump, step, metric, value) from one row of counters for each partition."""
    metrics = [c for c in counts.columns if c != dump]
    return counts.select(F.col(dump).alias("dump"), F.lit(step).alias("step"), F.explode(F.map_from_arrays(F.array(*map(F.lit, metrics)), F.array(*[F.col(m).cast("bigint") for m in metrics]))).alias("metric", "value"))


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` without the keys that ``new`` has, and ``new``."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def counter_map(df: DataFrame, by: str, name: str) -> DataFrame:
    """(by, counts): a map from each value of ``name`` to its number of rows."""
    each = df.groupBy(by, name).agg(F.count("*").alias("n")).where(F.col(name).isNotNull())
    return each.groupBy(by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, "n")))).alias("counts"))


def first_per_partition(df: DataFrame, by: str, order: list[Column | str], n: int) -> DataFrame:
    """The first ``n`` rows of each partition, exactly."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def in_buckets(df: DataFrame, by: list[str], order: list[str], bucket: Column, before: int, add) -> DataFrame:
    """``add(df, keys)`` adds columns by windows over ``keys`` and ``order`` that look back at most ``before``
    rows; here it is done without a window over a whole ``by``. Rows are windowed within buckets (ranges
    of the order, such as days); only the first ``before`` rows of a bucket need others, namely the last ones of the buckets
    before, and only those meet in one partition of ``by``."""
    w = Window.partitionBy(*by, "_bucket")
    n = df.withColumn("_bucket", bucket).withColumns({"_nth": F.row_number().over(w.orderBy(*order)), "_of": F.count(F.lit(1)).over(w)})
    inner = add(n, [*by, "_bucket"]).where(F.col("_nth") > before)
    heads = add(n.where((F.col("_nth") <= before) | (F.col("_nth") > F.col("_of") - before)), by).where(F.col("_nth") <= before)
    return inner.unionByName(heads).drop("_bucket", "_nth", "_of")


def looked_up(ids: DataFrame, tables: dict[str, DataFrame], key: str) -> DataFrame:
    """The rows of ``ids`` that every table has a row for, with the tables' other columns; null and empty keys have none."""
    out = ids.where(F.nullif(F.col(key).cast("string"), F.lit("")).isNotNull())
    for t in tables.values():
        out = out.join(t, key)
    return out


def consecutive_runs(df: DataFrame, by: list[str], order: list[str], value: str, bucket: Column | None = None) -> DataFrame:
    """The rows where ``value`` differs from the one before it in its partition. ``bucket``: see :func:`in_buckets`."""

    def add(d: DataFrame, keys: list[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        return d.withColumns({"_b": F.lag(F.struct(value)).over(w)})

    marked = add(df, by) if bucket is None else in_buckets(df, by, order, bucket, 1, add)
    return marked.where(F.col("_b").isNull() | ~F.col(value).eqNullSafe(F.col("_b")[value])).drop("_b")


def trailing_frame(df: DataFrame, by: list[str], order: list[str], text: str, before: int = 2, bucket: Column | None = None) -> DataFrame:
    """``df`` with ``context``: the row's text after those of the ``before`` rows ahead of it. ``bucket``: see :func:`in_buckets`."""

    def add(d: DataFrame, keys: list[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-before, 0)
        return d.withColumn("context", F.array_join(F.collect_list(text).over(w), " "))

    return add(df, by) if bucket is None else in_buckets(df, by, order, bucket, before, add)
