"""Dumps of posts: compressed or plain JSON lines.

Spark's own text source reads ``.zst`` frames with windows up to 128 MiB; longer windows are streamed
by path in the workers, in chunks of lines, so no file is ever held in memory.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestream.plans.runtime import ship

LONGEST_WINDOW = 2**31
CHUNK_LINES = 10_000


def lines(spark: SparkSession, path: str, *, long_windows: bool = False) -> DataFrame:
    """(dump, line_no, raw_line): the non-blank lines of the files under ``path``, stripped. ``dump``
    is the file's name without extensions. A missing path raises. With ``long_windows`` lines are
    numbered per file; else the numbers are increasing within a file, not consecutive."""
    if long_windows:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zst").load(path).select("path")
        return _long(ship(spark), files)
    df = spark.read.text(path).select(F.input_file_name().alias("p"), F.monotonically_increasing_id().alias("line_no"), F.regexp_replace("value", r"(?U)^\s+|\s+$", "").alias("raw_line"))
    name = F.regexp_extract("p", r"([^/]+?)(?:\.jsonl|\.json|\.txt)?(?:\.zst|\.gz)?$", 1)
    return df.where(F.col("raw_line") != "").select(name.alias("dump"), "line_no", "raw_line")


def _long(spark: SparkSession, files: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io
        import zstandard
        from pyarrow.fs import FileSystem

        for b in batches:
            for path in b.column(0).to_pylist():
                where, name = FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
                dump = os.path.basename(name).split(".")[0]
                with where.open_input_stream(name, compression=None) as raw, zstandard.ZstdDecompressor(max_window_size=LONGEST_WINDOW).stream_reader(raw) as r:
                    rows: list[tuple] = []
                    for n, line in enumerate(io.TextIOWrapper(r, encoding="utf-8", errors="replace", newline="\n")):
                        if line.strip():
                            rows.append((dump, n, line.strip()))
                        if len(rows) >= CHUNK_LINES:
                            yield _batch(rows)
                            rows = []
                    if rows:
                        yield _batch(rows)

    return files.repartition(F.col("path")).mapInArrow(run, "dump string, line_no bigint, raw_line string")


def _batch(rows):
    d, n, t = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(d), pa.array(n, pa.int64()), pa.array(t)], ["dump", "line_no", "raw_line"])


def parsed(df: DataFrame, raw: str = "raw_line") -> DataFrame:
    """``df`` with ``record`` (variant), null where the line is no JSON object."""
    v = F.try_parse_json(F.col(raw))
    return df.withColumn("record", F.when(F.schema_of_variant(v).startswith("OBJECT"), v))


def text_field(key: str, record: str = "record"):
    """A field as text; null if absent or null."""
    return F.try_variant_get(F.col(record), f"$.{key}", "string")


def whole_number(key: str, record: str = "record"):
    """struct(value, absent): a field as a whole number: numbers lose their fraction, texts must be
    whole numbers; ``absent`` tells a missing key from a null."""
    kind = F.schema_of_variant(F.variant_get(F.col(record), f"$.{key}", "variant"))
    return F.struct(F.try_variant_get(F.col(record), f"$.{key}", "bigint").alias("value"), kind.isNull().alias("absent"))


def has_key(key: str, record: str = "record"):
    """Whether the key is there, be its value null or not."""
    return F.schema_of_variant(F.variant_get(F.col(record), f"$.{key}", "variant")).isNotNull()
