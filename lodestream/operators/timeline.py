"""Timed events: rolling totals over half-open windows, time since the last event, profiles, and
decisions that hold under every interpretation.

Order ties are broken by the value so that results are the same in any run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestream.operators.merge import in_buckets

DAY_US = 24 * 3600 * 1_000_000
#: Product profiles (name, ingredient, mg a unit, least hours between, most mg in 24 h, most units in 24 h).
PROFILES = (("acetaminophen_325", "acetaminophen", 325, 4, 3250, 10), ("acetaminophen_500", "acetaminophen", 500, 6, 3000, 6), ("ibuprofen_200", "ibuprofen", 200, 4, 1200, 6))


def micros(ts: str):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def rolling(df: DataFrame, by: list[str], ts: str, value: str, span_us: int = DAY_US) -> DataFrame:
    """``df`` with ``rolling_total``: the sum over (t - span, t] of its partition. Rows are windowed in
    buckets of one span, into which the rows of the bucket before are copied, so a hot key is many tasks' work."""
    own = F.expr(f"floor(_us / {span_us})")
    twice = df.withColumn("_us", micros(ts)).withColumn("_bucket", F.explode(F.array(own, own + 1))).withColumn("_own", F.col("_bucket") == own)
    w = Window.partitionBy(*by, "_bucket").orderBy("_us").rangeBetween(-(span_us - 1), 0)
    return twice.withColumn("rolling_total", F.sum(value).over(w)).where("_own").drop("_us", "_bucket", "_own")


def since_last(df: DataFrame, by: list[str], ts: str, tie: str, bucket_us: int = DAY_US) -> DataFrame:
    """``df`` with ``hours_since_last``: hours since the row before it; null for the first. Worked out in
    buckets of time, see :func:`merge.in_buckets`."""

    def add(d: DataFrame, keys: list[str]) -> DataFrame:
        return d.withColumn("hours_since_last", (F.col("_us") - F.lag("_us").over(Window.partitionBy(*keys).orderBy("_us", tie))) / F.lit(3_600_000_000.0))

    return in_buckets(df.withColumn("_us", micros(ts)), by, ["_us", tie], F.expr(f"floor(_us / {bucket_us})"), 1, add).drop("_us")


def as_of(left: DataFrame, right: DataFrame, by: list[str], left_ts: str, right_ts: str, value: str, bucket_us: int = DAY_US) -> DataFrame:
    """``left`` with the last ``value`` of ``right`` at or before its time, of several at one time the greatest. Both
    sides are put into one ordered partition for each bucket of time, so nothing is paired that isn't
    needed; what a bucket leaves is carried to later ones by a window over buckets."""
    l = left.select(*by, F.col(left_ts).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(dict(right.dtypes)[value]).alias("_v"), F.struct(*left.columns).alias("_row"))
    r = right.select(*by, F.col(right_ts).alias("_t"), F.lit(0).alias("_side"), F.col(value).alias("_v"), F.lit(None).cast(l.schema["_row"].dataType).alias("_row"))
    both = l.unionByName(r).withColumn("_bucket", F.floor(micros("_t") / bucket_us))
    within = Window.partitionBy(*by, "_bucket").orderBy("_t", "_side", "_v").rowsBetween(Window.unboundedPreceding, 0)
    left_over = both.groupBy(*by, "_bucket").agg(F.max(F.when(F.col("_v").isNotNull(), F.struct("_t", "_v"))).alias("_m"))
    earlier = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = left_over.withColumn("_carried", F.last("_m", ignorenulls=True).over(earlier)).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], F.col("_bucket").alias("_kb"), F.col("_carried._v").alias("_carried"))
    found = both.withColumn("_last", F.last("_v", ignorenulls=True).over(within)).where("_side = 1")
    same = (F.col("_bucket") == F.col("_kb"))
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return found.join(carried, same, "left").select("_row.*", F.coalesce("_last", "_carried").alias(f"last_{value}"))


def profiles(spark) -> DataFrame:
    return spark.createDataFrame(list(PROFILES), "profile string, ingredient string, mg_per_unit int, least_hours int, most_mg_24h int, most_units_24h int")


def interpretations(doses: DataFrame, profile: DataFrame) -> DataFrame:
    """Each dose with every profile that fits: of its ingredient, and of its strength if that is given."""
    p = F.broadcast(profile)  # a few rows
    return doses.join(p, (doses["ingredient"] == p["ingredient"]) & (doses["strength_mg"].isNull() | (doses["strength_mg"] == p["mg_per_unit"]))).drop(p["ingredient"]).withColumn("dose_mg", F.col("units") * F.col("mg_per_unit"))


def decided(df: DataFrame, by: str, holds: str = "holds") -> DataFrame:
    """(by, decision): YES if all interpretations hold, NO if none does, else AMBIGUOUS; null counts
    as open."""
    g = df.groupBy(by).agg(F.bool_and(F.coalesce(F.col(holds), F.lit(False))).alias("a"), F.bool_or(F.coalesce(F.col(holds), F.lit(True))).alias("o"))
    return g.select(by, F.when(F.col("a"), "YES").when(~F.col("o"), "NO").otherwise("AMBIGUOUS").alias("decision"))


def categories(flags: dict, otherwise: str):
    """The name of the first flag that holds."""
    out = F.lit(otherwise)
    for name, c in reversed(list(flags.items())):
        out = F.when(c, F.lit(name)).otherwise(out)
    return out
