"""From dump lines to posts: parse, date range, vocabulary, projection, counters.

Defined results: a line that is no JSON object is counted in ``total`` and in ``bad_json`` and gives no
post; a time that is null or no whole number drops the line and is counted in ``bad_time``; a missing
time is 0 and so before any range. Counters do not add up to ``total`` by design of the pipeline.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.functions.text import filled, first_vocabulary
from lodestream.sources import dumps
from lodestream.sources.vocabulary import Vocabulary

FORUM = "https://www.reddit.com"


def year_bounds(first: int, last: int) -> tuple[int, int]:
    """Seconds of the first moment of a year and of the last second of another, UTC."""
    utc = dt.timezone.utc
    return int(dt.datetime(first, 1, 1, tzinfo=utc).timestamp()), int(dt.datetime(last, 12, 31, 23, 59, 59, tzinfo=utc).timestamp())


def iso_utc(seconds: Column) -> Column:
    """ISO text with +00:00; needs no session time zone."""
    return F.concat(F.date_format(F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def flagged(lines: DataFrame, vocabulary: Vocabulary, years: tuple[int, int] = (2013, 2025), text_fields: tuple[str, str] = ("title", "selftext"), crawled: str | None = None) -> DataFrame:
    """Every line with what the extraction makes of it: ``outcome`` is ``bad_json``, ``bad_time``,
    ``skipped_date``, ``skipped_medicine`` or ``kept``. The date comes before the vocabulary."""
    low, high = year_bounds(*years)
    df = dumps.parsed(lines)
    created = dumps.whole_number("created_utc")
    df = df.select("dump", "line_no", "record", created.alias("c"))
    seconds = F.when(F.col("c.absent"), F.lit(0)).otherwise(F.col("c.value"))
    title, body = (filled(dumps.text_field(f)) for f in text_fields)
    df = df.select("dump", "line_no", "record", seconds.alias("created"), title.alias("title"), body.alias("body"))
    match = first_vocabulary(F.concat("title", F.lit(" "), "body"), vocabulary.target_patterns())
    outcome = (
        F.when(F.col("record").isNull(), "bad_json").when(F.col("created").isNull(), "bad_time").when(~F.col("created").between(low, high), "skipped_date")
        .when(match.isNull(), "skipped_medicine").otherwise("kept")
    )
    sub = F.when(dumps.has_key("subreddit"), dumps.text_field("subreddit")).otherwise(F.col("dump"))
    post_id = F.when(dumps.has_key("id"), dumps.text_field("id")).otherwise("")
    link = F.coalesce(F.nullif(dumps.text_field("permalink"), F.lit("")))
    url = F.coalesce(F.nullif(dumps.text_field("url"), F.lit("")), F.concat(F.lit(FORUM), link), F.format_string(f"{FORUM}/r/%s/comments/%s", F.col("subreddit"), F.col("post_id")))
    df = df.withColumns({"outcome": outcome, "m": F.when(outcome == "kept", match), "subreddit": sub, "post_id": post_id})
    return df.select(
        "dump", "line_no", "outcome", "post_id", "subreddit", "title", "body", url.alias("url"),
        F.when(F.col("outcome").isin("kept", "skipped_medicine"), iso_utc(F.col("created"))).alias("created_time"), F.lit(crawled).cast("string").alias("crawl_timestamp"),
        F.col("m.name").alias("matched_medicine"), F.col("m.term").alias("matched_brand_or_generic"),
    )


def kept(flags: DataFrame) -> DataFrame:
    return flags.where("outcome = 'kept'").drop("outcome")


def counters(flags: DataFrame) -> DataFrame:
    """(dump, total, skipped_date, skipped_medicine, kept, bad_json, bad_time)."""
    return flags.groupBy("dump").agg(F.count("*").alias("total"), *[F.count_if(F.col("outcome") == x).alias(x) for x in ("skipped_date", "skipped_medicine", "kept", "bad_json", "bad_time")])
