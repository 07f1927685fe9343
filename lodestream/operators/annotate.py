"""A resumable annotation stage around an annotator that is given as a function.

Records are keyed by id, else URL, else position in the input. What is done for the same model and
prompt is reused; failures are tried again. Work is done in chunks, each of which is appended to a log when it ends, so
a run that is killed loses at most a chunk, and the next one goes on from the log. A run of failures ends a
partition's work in a chunk, and a chunk of failures only ends the run (the rest stays open), so a dead service costs few calls. Entries that can't be
reused and were not tried again stay in the output (they do not vanish); index keys always mean the
position in the input.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.plans.runtime import cut, forget, remove, ship
from lodestream.sources.files import append_log, latest, read_log, write_json_array

RECORD = "struct<status:string,text:string,error:string,requested_model:string,model:string,response_id:string,prompt_sha256:string,annotated_at:string,attempted_at:string,usage:struct<input_tokens:int,output_tokens:int,total_tokens:int>>"
_ARROW = pa.struct([*((n, pa.string()) for n in ("status", "text", "error", "requested_model", "model", "response_id", "prompt_sha256", "annotated_at", "attempted_at")), ("usage", pa.struct([(n, pa.int32()) for n in ("input_tokens", "output_tokens", "total_tokens")]))])


def record_key(post_id: Column, url: Column, seq: Column) -> Column:
    return F.coalesce(F.nullif(post_id, F.lit("")), F.nullif(url, F.lit("")), F.concat(F.lit("index:"), seq.cast("string")))


def payload(post_id: Column, text: Column) -> Column:
    return F.to_json(F.struct(post_id.alias("post_id"), text.alias("clean_text")), {"ignoreNullFields": "false"})


def prompt_hash(prompt: str | Column) -> Column:
    return F.sha2(F.lit(prompt) if isinstance(prompt, str) else prompt, 256)


def reusable(record: Column, model: Column, hashed: Column) -> Column:
    """Completed by the same model with the same prompt; null-safe."""
    return record["status"].eqNullSafe(F.lit("completed")) & record["requested_model"].eqNullSafe(model) & record["prompt_sha256"].eqNullSafe(hashed)


def work_list(candidates: DataFrame, done: DataFrame, model: str, hashed: Column, limit: int | None = None) -> DataFrame:
    """(key, seq, payload) that still need a call with the prompt of this hash: each key once, at most ``limit``, then
    those that come first in the input."""
    ok = done.where(reusable(F.col("record"), F.lit(model), hashed)).select("key").distinct()
    todo = candidates.groupBy("key").agg(F.min("seq").alias("seq"), F.min_by("payload", "seq").alias("payload")).join(ok, "key", "left_anti")
    return todo.orderBy("seq").limit(limit) if limit is not None else todo


def annotated(work: DataFrame, annotator: Callable[[dict], dict], model: str, prompt: str, stamp: str, max_failures: int = 3) -> DataFrame:
    """(key, seq, record) of the attempts. ``annotator`` gets the payload and gives ``text``, and maybe
    ``model``, ``response_id`` and ``usage``; an exception is an error record. After ``max_failures``
    failures in a row a partition makes no more calls."""
    ship(work.sparkSession)
    hashed = work.sparkSession.range(1).select(prompt_hash(prompt)).first()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        failed = 0
        for b in batches:
            keys, seqs, out = [], [], []
            for k, s, p in zip(*[b.column(i).to_pylist() for i in range(3)]):
                if failed >= max_failures:
                    break
                base = dict.fromkeys([f.name for f in _ARROW]) | {"requested_model": model, "prompt_sha256": hashed}
                try:
                    got = annotator(json.loads(p))
                    if not (got.get("text") or "").strip():
                        raise ValueError("empty answer")
                    usage = {n: v if isinstance(v := (got.get("usage") or {}).get(n), int) else None for n in ("input_tokens", "output_tokens", "total_tokens")}
                    out.append(base | {"status": "completed", "text": got["text"], "model": got.get("model", model), "response_id": got.get("response_id"), "annotated_at": stamp, "usage": usage})
                    failed = 0
                except Exception as e:  # noqa: BLE001
                    out.append(base | {"status": "error", "error": f"{type(e).__name__}: {e}", "attempted_at": stamp})
                    failed += 1
                keys.append(k)
                seqs.append(s)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(seqs, pa.int64()), pa.array(out, _ARROW)], ["key", "seq", "record"])

    return work.select("key", F.col("seq").cast("bigint"), "payload").mapInArrow(run, f"key string, seq bigint, record {RECORD}")


def upserted(existing: DataFrame, log: DataFrame) -> DataFrame:
    """(key, record): the log's record of a key before an existing one."""
    both = existing.select("key", "record", F.lit(0).alias("rank")).unionByName(log.select("key", "record", F.lit(1).alias("rank")))
    return latest(both, "key", ["rank"]).drop("rank")


def joined(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """Candidates with their record, in no order; repeated keys share it. Keys without one are dropped."""
    return candidates.join(records.select("key", "record"), "key")


def results(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """:func:`joined` in the order of the candidates."""
    return joined(candidates, records).orderBy("seq")


def planned_calls(candidates: DataFrame, limit: int | None) -> int:
    n = candidates.count()
    return n if limit is None else min(n, limit)


def stats(candidates: DataFrame, records: DataFrame, attempts: DataFrame, model: str, hashed: Column) -> DataFrame:
    """One row: input, completed, errors, remaining (input without completed), attempted, failed, reused."""
    keyed = candidates.select("key", "seq").join(records.select("key", "record"), "key", "left")
    tried = attempts.select("key").distinct().withColumn("tried", F.lit(True))
    done = F.col("record.status").eqNullSafe("completed")
    a = keyed.join(tried, "key", "left").agg(
        F.count("*").alias("input"), F.count_if(done).alias("completed"), F.count_if(F.col("record.status").eqNullSafe("error")).alias("errors"), F.count_if(~done).alias("remaining"),
        F.count_if(reusable(F.col("record"), F.lit(model), hashed) & F.col("tried").isNull()).alias("reused"),
    )
    b = attempts.agg(F.count("*").alias("attempted"), F.count_if(F.col("record.status") == "error").alias("failed"))
    return a.crossJoin(b)  # one row each


def run(candidates: DataFrame, existing: DataFrame, log_path: str, annotator, model: str, prompt: str, stamp: str, limit: int | None = None, chunk: int = 10_000, max_failures: int = 3) -> DataFrame:
    """Work through what neither ``existing`` nor the log has, append the attempts to the log chunk by chunk,
    and give all records by key."""
    spark = candidates.sparkSession
    done = upserted(existing, read_log(spark, log_path, RECORD))
    todo = cut(work_list(candidates, done, model, prompt_hash(prompt), limit), "work")
    chunks = max(1, -(-todo.count() // chunk))
    number = F.pmod(F.xxhash64("key"), F.lit(chunks))
    for i in range(chunks):
        append_log(annotated(todo.where(number == i), annotator, model, prompt, stamp, max_failures), log_path)
        if i + 1 < chunks and _all_failed(todo.where(number == i), read_log(spark, log_path, RECORD), stamp):
            break
    forget(todo)
    return upserted(existing, read_log(spark, log_path, RECORD))


def _all_failed(chunk: DataFrame, log: DataFrame, stamp: str) -> bool:
    """Whether a chunk had attempts and each of them failed."""
    own = log.join(chunk.select("key"), "key", "left_semi")
    r = own.agg(F.count_if(F.col("record.attempted_at") == stamp).alias("bad"), F.count_if(F.col("record.annotated_at") == stamp).alias("good")).first()
    return r["bad"] > 0 and r["good"] == 0


def finish(candidates: DataFrame, records: DataFrame, path: str, log_path: str) -> None:
    """Write the results in the candidates' order as one JSON array, then delete the log: until the
    array is in place the log has everything."""
    write_json_array(joined(candidates, records), path, ["seq"])
    remove(candidates.sparkSession, log_path)


def run_all(parts: dict, **options) -> dict:
    """Each partition by itself: its result, or the error that ended it."""
    out = {}
    for name, (candidates, existing, log_path) in parts.items():
        try:
            out[name] = run(candidates, existing, log_path, **options)
        except Exception as e:  # noqa: BLE001
            out[name] = e
    return out
