"""Encoding of texts with a public tokenizer (problem 7).

The rank file is read from a folder that is a parameter; it is never copied here. A long text is
cut before the merges, at positions where the splitting pattern always ends a piece: between a
character that is no white space and a single space followed by one. No piece of the pattern spans
such a position, so the ids of the parts put together are the ids of the whole.

Defined results: a null text and an empty text both have the empty list of ids; a text of white
space has the ids of its white space.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lodestream.plans.runtime import ship

TOKENIZERS = os.environ.get("PUBLIC_TOKENIZERS", "/opt/tokenizers")
RANKS = "byte_bpe_50k.tiktoken"
#: The pattern that belongs to the rank files (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts of more characters are encoded in parts of about this length.
PART_CHARS = 20_000
_SAFE = regex.compile(r"(?<=\S)(?= \S)")
_loaded: dict[str, object] = {}


def encoder(folder: str = TOKENIZERS, ranks: str = RANKS):
    """The encoder of a rank file, read once in each worker."""
    import tiktoken

    path = os.path.join(folder, ranks)
    if path not in _loaded:
        with open(path, "rb") as f:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[path] = tiktoken.Encoding(ranks, pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
    return _loaded[path]


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """``text`` in parts of at least ``size`` characters, each cut at a safe position."""
    at = 0
    while len(text) - at > size:
        m = _SAFE.search(text, at + size)
        if not m:
            break
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def encode_text(enc, text: str | None, size: int = PART_CHARS) -> list[int]:
    if not text:
        return []
    if len(text) <= size:
        return enc.encode_ordinary(text)
    return [i for p in parts(text, size) for i in enc.encode_ordinary(p)]


def decode_ids(enc, ids: list[int]) -> str:
    """The text of ``ids``, joined as raw bytes first: a character may be split between ids."""
    return b"".join(enc.decode_single_token_bytes(i) for i in ids).decode("utf-8", errors="strict")


def encode_column(df: DataFrame, key: str, text: str, folder: str = TOKENIZERS, ranks: str = RANKS) -> DataFrame:
    """(key, ids): ids of every row's text, in one pass without a shuffle."""
    ship(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(folder, ranks)
        for b in batches:
            ids = pa.array([encode_text(enc, t) for t in b.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), ids], ["k", "ids"])

    made = df.select(df[key].alias("k"), df[text].cast("string").alias("t")).mapInArrow(run, f"k {kind}, ids array<int>")
    return made.withColumnRenamed("k", key)


def count_tokens(df: DataFrame, text: str, out: str, folder: str = TOKENIZERS, ranks: str = RANKS) -> DataFrame:
    """``df`` without ``text`` and with ``out``, the number of ids of each text."""
    from pyspark.sql import functions as F

    ship(df.sparkSession)
    keep = [c for c in df.columns if c not in (text, out)]
    kept = df.select(F.struct(*[df[c] for c in keep]).alias("r"), df[text].cast("string").alias("t"))

    def run(batches):
        enc = encoder(folder, ranks)
        for b in batches:
            n = pa.array([len(encode_text(enc, t)) for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), n], ["r", "n"])

    made = kept.mapInArrow(run, f"r {kept.schema['r'].dataType.simpleString()}, n bigint")
    return made.select("r.*", F.col("n").alias(out))
