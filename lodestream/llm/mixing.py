"""Mixing sources to target weights (problem 8).

Every source is cut into blocks: a hash of the key deals its records to about
``tokens / block_tokens`` blocks, so a hot source just has more blocks and no task ever orders a
whole source. A source's blocks are permuted by a hash of mix and seed; its quota of tokens takes
whole passes over the source first (each pass uses every record once), then the first blocks of the
permutation, and of the block in which the quota ends the first records in hash order. What a source
gives is therefore its quota to within one record, and no record is used more often than allowed.
Places in a permutation are sums over ranges of the hash and within each range, so no window orders all blocks of a source.

The output shards get exact numbers of blocks of every source from a multivariate-hypergeometric
splitting tree: the quota vector of a node (blocks by source) is split between its two halves of the
shards by one draw without replacement, down to single shards. A node's draw comes from its own seed; the driver
draws the top of the tree, down to ``TOP_NODES`` nodes, and tasks draw the rest below them. A shard then takes its own run of
each source's permuted blocks, so shards are disjoint, and shuffles its records locally by a hash. Runs
are written out as block numbers and joined with the blocks by number, one to one.

Only counts of blocks reach the driver: one number for each mix and source. Everything that grows
with the data (blocks, shards, records) stays in tables.

Defined results: sources compare trimmed, in lower case, with spaces and hyphens as ``_``; a record
whose source is null or in no mix, or that has no tokens (null or empty text), is never drawn; the
size of a mix is its ``size_share`` of all records' tokens, those of no source included; a source
that has too few tokens even when repeated gives all it may, the shortfall is reported and not
passed to the others; a listed source without records has a row with zeros in the report; a target
row that occurs twice counts once; rows with a null mix, source or share are ignored, a null or
negative ``max_repeats`` is 0; an empty table gives an empty mix and a report of zeros.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestream.llm.tokenization import RANKS, TOKENIZERS, count_tokens
from lodestream.plans.runtime import cut, ship

BLOCK_TOKENS = 20_000
SHARD_TOKENS = 1_000_000
#: Nodes of the tree that the driver goes down to, and blocks in a range of a permutation.
TOP_NODES, RANGE_BLOCKS = 1024, 10_000
SEED = 17


def source_key(c: Column) -> Column:
    """One spelling of a source: trimmed, lower case, spaces and hyphens as underscores."""
    return F.nullif(F.regexp_replace(F.lower(F.regexp_replace(c, r"^\s+|\s+$", "")), r"[\s\-]+", "_"), F.lit(""))


def splitting_tree(quotas: np.ndarray, shards: int, seed: int, lo: int = 0, hi: int | None = None, least: int = 1) -> list[tuple[int, int, np.ndarray]]:
    """(first shard, beyond, blocks by source) of the nodes of ``least`` shards or fewer under the node of the shards lo
    to hi, left to right: ``quotas`` split exactly, by multivariate-hypergeometric draws. A node's draw depends on
    the seed and its shards alone, so a tree may be gone down in steps."""
    out, todo = [], [(lo, shards if hi is None else hi, np.asarray(quotas, np.int64))]
    while todo:
        lo, hi, q = todo.pop()
        if hi - lo <= max(1, least):
            out.append((lo, hi, q))
            continue
        rng = np.random.default_rng((seed, lo, hi))
        mid = (lo + hi) // 2
        total = int(q.sum())
        take = total * (mid - lo) // (hi - lo)
        left = np.zeros_like(q)
        rest, pool = take, total
        for i, n in enumerate(q):  # the conditional draws, which have no bound on the population
            pool -= int(n)
            if rest and n:
                left[i] = rest if pool == 0 else _hypergeometric(rng, int(n), pool, rest)
            rest -= int(left[i])
        todo += [(mid, hi, q - left), (lo, mid, left)]
    return out


def _hypergeometric(rng, good: int, bad: int, draws: int) -> int:
    """How many of ``draws`` without replacement are good. numpy draws up to a population of 10^9; beyond it the same
    distribution is inverted, its weights worked out from the mode outwards by the ratios of neighbours."""
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, draws))
    low, high = max(0, draws - bad), min(good, draws)
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    p = good / (good + bad)
    span = int(12 * np.sqrt(draws * p * (1 - p)) + 50)  # beyond 12 deviations the weights are less than doubles tell
    k = np.arange(max(low, mode - span), min(high, mode + span) + 1, dtype=np.float64)
    steps = np.log((good - k[:-1]) / (k[1:])) + np.log((draws - k[:-1]) / (bad - draws + k[1:]))
    weight = np.concatenate([[0.0], np.cumsum(steps)])
    total = np.cumsum(np.exp(weight - weight.max()))
    return int(k[np.searchsorted(total, rng.random() * total[-1], side="right")])


def mix(docs: DataFrame, targets: DataFrame, key: str, text: str, source: str, *, block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS, seed: int = SEED, range_blocks: int = RANGE_BLOCKS, top_nodes: int = TOP_NODES, folder: str = TOKENIZERS, ranks: str = RANKS):
    """(records, report). records: mix_name, shard, position, ``key``, source, copy_no, n_tokens.
    report: mix_name, source, target_share, actual_share, quota_tokens, tokens, records,
    distinct_records, max_uses, short_tokens."""
    spark = ship(docs.sparkSession)
    sized = cut(count_tokens(docs.select(F.col(key).alias("k"), source_key(F.col(source)).alias("source"), F.col(text).alias("t")), "t", "n", folder, ranks), "sizes")
    want = (
        targets.select("mix_name", source_key(F.col("source")).alias("source"), "target_share", F.greatest(F.coalesce(F.col("max_repeats"), F.lit(0)), F.lit(0)).alias("max_repeats"), "size_share")
        .where(F.col("mix_name").isNotNull() & F.col("source").isNotNull() & F.col("target_share").isNotNull() & F.col("size_share").isNotNull())
        .dropDuplicates(["mix_name", "source"])
    )
    wanted = sorted(want.collect(), key=lambda r: (r["mix_name"], r["source"]))  # the table of targets: a row for each mix and source
    names = sorted({r["source"] for r in wanted})
    have = {r["source"]: r["n"] for r in sized.where(F.col("source").isin(names) & (F.col("n") > 0)).groupBy("source").agg(F.sum("n").alias("n")).collect()}
    everything = sized.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    n_blocks = {s: max(1, round(n / block_tokens)) for s, n in have.items()}

    kind = dict(sized.dtypes)["k"]
    parts = spark.createDataFrame([(s, n_blocks[s]) for s in sorted(n_blocks)], "source string, n_blocks bigint")
    blocked = cut(
        sized.where(F.col("n") > 0).join(F.broadcast(parts), "source")
        .select("k", "source", "n", F.expr("pmod(xxhash64(cast(k as string), 'block'), n_blocks)").alias("block")),
        "blocks",
    )
    sizes = blocked.groupBy("source", "block").agg(F.sum("n").alias("tokens"))

    plan, per_mix = [], {}
    for r in wanted:
        a = have.get(r["source"], 0)
        quota = min(round(r["target_share"] * r["size_share"] * everything), a * r["max_repeats"])
        full, rest = divmod(quota, a) if a else (0, 0)
        plan.append((r["mix_name"], r["source"], r["target_share"], r["target_share"] * r["size_share"] * everything, int(full), int(rest)))
        per_mix.setdefault(r["mix_name"], []).append((r["source"], int(full), int(rest), n_blocks.get(r["source"], 0)))
    planned = spark.createDataFrame(plan, "mix_name string, source string, target_share double, quota double, full int, rest bigint")

    # permuted blocks with their place and the tokens before them: those of earlier ranges, and those within the range
    order = F.xxhash64(F.lit(seed), F.col("mix_name"), F.col("source"), F.col("block"))
    ranges = F.greatest(F.lit(1), F.ceil(F.col("n_blocks") / range_blocks))
    placed = F.broadcast(planned).join(sizes, "source").join(F.broadcast(parts), "source").withColumn("order", order)
    placed = placed.withColumn("range", F.floor((F.col("order") / F.lit(2.0**64) + 0.5) * ranges))
    sums = placed.groupBy("mix_name", "source", "range").agg(F.count("*").alias("blocks"), F.sum("tokens").alias("range_tokens"))
    earlier = Window.partitionBy("mix_name", "source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    whole = Window.partitionBy("mix_name", "source")
    offsets = sums.select(
        "mix_name", "source", "range", F.coalesce(F.sum("blocks").over(earlier), F.lit(0)).alias("blocks_before"), F.coalesce(F.sum("range_tokens").over(earlier), F.lit(0)).alias("range_before"), F.sum("blocks").over(whole).alias("blocks")
    )
    own = Window.partitionBy("mix_name", "source", "range").orderBy("order", "block")
    within_range = placed.withColumns({"nth": F.row_number().over(own) - 1, "so_far": F.coalesce(F.sum("tokens").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    permuted = (
        within_range.join(offsets, ["mix_name", "source", "range"])
        .withColumns({"rank": F.col("blocks_before") + F.col("nth"), "tokens_before": F.col("range_before") + F.col("so_far")})
        .withColumn("copies", F.col("full") + (F.col("tokens_before") < F.col("rest")).cast("int"))
        .where("copies > 0")
    )
    permuted = cut(permuted.select("mix_name", "source", "block", "rank", "blocks", "full", F.greatest(F.col("rest") - F.col("tokens_before"), F.lit(0)).alias("rest"), "copies"), "permuted")

    # quotas of blocks by mix and source, split among the shards; the top of the tree here, the rest in tasks
    nodes = []
    counted = {(r["mix_name"], r["source"]): r["b"] for r in permuted.groupBy("mix_name", "source").agg(F.sum("copies").alias("b")).collect()}
    for m, sources in sorted(per_mix.items()):
        q = np.array([counted.get((m, x[0]), 0) for x in sources], np.int64)
        if not q.sum():
            continue
        shards = max(1, min(int(q.sum()), round(int(q.sum()) * block_tokens / shard_tokens)))
        first = np.zeros_like(q)
        for lo, hi, own_q in splitting_tree(q, shards, seed, least=-(-shards // top_nodes)):
            nodes.append((m, [x[0] for x in sources], lo, hi, [int(x) for x in own_q], [int(x) for x in first]))
            first = first + own_q

    def runs(batches):
        for b in batches:
            for m, names_, lo, hi, q, first in zip(*[c.to_pylist() for c in b.columns]):
                at = np.array(first, np.int64)
                for shard, _, own_q in splitting_tree(np.array(q, np.int64), hi, seed, lo, hi):
                    for i, x in enumerate(names_):
                        if own_q[i]:
                            n = int(own_q[i])
                            yield pa.RecordBatch.from_arrays([pa.array([m] * n), pa.array([x] * n), pa.array(np.arange(at[i], at[i] + n)), pa.array(np.full(n, shard, np.int64))], ["mix_name", "source", "number", "shard"])
                    at = at + own_q

    tree = spark.createDataFrame(nodes, "mix_name string, sources array<string>, lo bigint, hi bigint, quotas array<bigint>, first array<bigint>")
    numbers = tree.repartition(min(max(1, len(nodes)), spark.sparkContext.defaultParallelism)).mapInArrow(runs, "mix_name string, source string, number bigint, shard bigint")

    # a block's copies are numbered in permuted order, pass by pass: copy c of a block is number
    # (c - 1) * blocks + rank, so copies of one block go to different shards where there are several
    uses = (
        permuted.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .withColumn("number", (F.col("copy_no") - 1) * F.col("blocks") + F.col("rank"))
        .withColumn("part", (F.col("copy_no") > F.col("full")))
    )
    dealt = uses.join(numbers, ["mix_name", "source", "number"])
    dealt = cut(dealt.select("mix_name", "source", "block", "copy_no", F.col("shard").cast("int").alias("shard"), F.when(F.col("part"), F.col("rest")).alias("limit")), "dealt")

    within = Window.partitionBy("source", "block").orderBy(F.xxhash64(F.lit(seed), F.col("k").cast("string")), "k").rowsBetween(Window.unboundedPreceding, -1)
    ordered = blocked.withColumn("tokens_before", F.coalesce(F.sum("n").over(within), F.lit(0)))
    chosen = ordered.join(dealt, ["source", "block"]).where(F.col("limit").isNull() | (F.col("tokens_before") < F.col("limit")))
    local = Window.partitionBy("mix_name", "shard").orderBy(F.xxhash64(F.lit(seed), F.col("shard"), F.col("k").cast("string"), F.col("copy_no")), "k", "copy_no")
    records = cut(
        chosen.select("mix_name", "shard", (F.row_number().over(local) - 1).cast("bigint").alias("position"), F.col("k").cast(kind).alias(key), "source", F.col("copy_no").cast("int").alias("copy_no"), F.col("n").alias("n_tokens")),
        "mix",
    )
    uses_of = records.groupBy("mix_name", "source", key).agg(F.count("*").alias("uses"), F.sum("n_tokens").alias("n"))
    got = uses_of.groupBy("mix_name", "source").agg(F.sum("n").alias("tokens"), F.sum("uses").alias("records"), F.count("*").alias("distinct_records"), F.max("uses").alias("max_uses"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    report = planned.join(got, ["mix_name", "source"], "left").select("mix_name", "source", "target_share", F.round("quota").cast("bigint").alias("quota_tokens"), zero("tokens"), zero("records"), zero("distinct_records"), zero("max_uses"))
    sums = F.sum("tokens").over(Window.partitionBy("mix_name"))
    report = report.withColumns({"actual_share": F.when(sums > 0, F.col("tokens") / sums).otherwise(F.lit(0.0)), "short_tokens": F.greatest(F.col("quota_tokens") - F.col("tokens"), F.lit(0).cast("bigint"))})
    return records, report
