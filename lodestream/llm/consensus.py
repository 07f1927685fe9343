"""Consensus of several annotators' labels by the triplet moment method (problem 6).

For a label c let Z_i be 1 where annotator i votes c. If annotators err independently given the
truth, Cov(Z_i, Z_j) = q_i q_j, where q_i = (sensitivity - false-positive rate) * sd(truth is c): the
agreement of a pair corrected for chance. Three annotators solve one unknown: q_i^2 = M_ij M_ik / M_jk.
The weighted median over all such triplets starts a least-squares fit of q q' to M. An annotator
worse than chance gets a negative q and so a negative weight. Votes are then combined by log-odds.

Moments come from all items. The triplets are solved for the ``core`` annotators with most items: tasks add up their
moments as matrices, so what reaches the driver is one matrix for each label, whatever the number of items. Any further annotators
are solved against those of the core, by the same least squares, in one aggregation that leaves a row for each; they
stay in a table. With no more annotators than ``core`` all are in it.

Defined results: an item without a vote for one of ``labels`` has no row; a vote that is null or
not in ``labels`` counts as no vote; a run (item, annotator, run) that occurs repeatedly counts once
with its smallest label; null item or annotator: the vote is ignored; a null run is one run; ties go
to the first of ``labels``; an annotator without items in common with others has weight 0, and where
no annotator can be judged at all every vote has the same weight; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.plans.runtime import cut, ship

LABELS = ("YES", "NO", "AMBIGUOUS")
_EPS = 0.005
CORE, BROADCAST_ANNOTATORS, SALT = 500, 100_000, 16


def vote_counts(df: DataFrame, item: str, annotator: str, run: str, label: str, labels=LABELS) -> DataFrame:
    """(item, annotator, n0, n1, ...): votes for each label, each run once."""
    votes = (
        df.select(df[item].alias("item"), df[annotator].alias("annotator"), df[run].alias("run"), df[label].alias("label"))
        .where(F.col("label").isin(*labels) & F.col("item").isNotNull() & F.col("annotator").isNotNull())
        .groupBy("item", "annotator", "run")
        .agg(F.min("label").alias("label"))
    )
    return votes.groupBy("item", "annotator").agg(
        *[F.count_if(F.col("label") == F.lit(x)).alias(f"n{k}") for k, x in enumerate(labels)]
    )


def _shares(counts: DataFrame, n_labels: int) -> DataFrame:
    """(item, annotator, p0, p1, ...): the share of each label in an annotator's votes on an item."""
    total = sum((F.col(f"n{k}") for k in range(n_labels)), F.lit(0))
    return counts.select("item", "annotator", *[(F.col(f"n{k}") / total).alias(f"p{k}") for k in range(n_labels)])


def _moments(p: DataFrame, names: list, n_labels: int) -> tuple[np.ndarray, np.ndarray]:
    """Items in common (K, K) and covariances of shares (L, K, K) of the annotators ``names``."""
    spark, K = ship(p.sparkSession), len(names)
    kind = p.schema["annotator"].dataType.simpleString()
    at = spark.createDataFrame([(a, i) for i, a in enumerate(names)], f"annotator {kind}, i int")
    own = p.join(F.broadcast(at), "annotator").groupBy("item").agg(F.collect_list(F.struct("i", *[f"p{k}" for k in range(n_labels)])).alias("v"))  # at most K votes an item

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, S, A = np.zeros((K, K)), np.zeros((n_labels, K, K)), np.zeros((n_labels, K, K))
        for b in batches:
            for lo in range(0, len(b), 1000):
                lists = b.column(0).slice(lo, 1000)
                flat = lists.flatten()
                row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                col = flat.field(0).to_numpy(zero_copy_only=False)
                has = np.zeros((len(lists), K))
                has[row, col] = 1
                n += has.T @ has
                for k in range(n_labels):
                    x = np.zeros((len(lists), K))
                    x[row, col] = flat.field(k + 1).to_numpy(zero_copy_only=False)
                    S[k] += x.T @ x
                    A[k] += x.T @ has
        i, j = np.nonzero(n)
        cols = [i.astype(np.int32), j.astype(np.int32), n[i, j], *[m[k][i, j] for k in range(n_labels) for m in (S, A)]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["i", "j", "n", *[f"{x}{k}" for k in range(n_labels) for x in "sa"]])

    names_ = [f"{x}{k}" for k in range(n_labels) for x in "sa"]
    parts = own.select("v").mapInArrow(run, "i int, j int, n double, " + ", ".join(f"{c} double" for c in names_))
    t = parts.groupBy("i", "j").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names_]).toArrow()  # K * K rows
    i, j = t.column("i").to_numpy(), t.column("j").to_numpy()
    n, M, A = np.zeros((K, K)), np.zeros((n_labels, K, K)), np.zeros((n_labels, K, K))
    n[i, j] = t.column("n").to_numpy()
    for k in range(n_labels):
        M[k][i, j], A[k][i, j] = t.column(f"s{k}").to_numpy(), t.column(f"a{k}").to_numpy()
    np.fill_diagonal(n, 0)
    some = np.maximum(n, 1)
    M = np.where(n > 0, M / some - A * A.transpose(0, 2, 1) / some**2, 0.0)
    return n, M


def triplet_solve(M: np.ndarray, n: np.ndarray, least: int = 20, sweeps: int = 200) -> np.ndarray:
    """q with M_ij = q_i q_j off the diagonal, from triplets, refined by weighted least squares."""
    K = len(M)
    ok, q = (n >= least) & ~np.eye(K, dtype=bool), np.zeros(K)
    for i in range(K):
        j, k = np.nonzero(np.triu(ok & ok[i][:, None] & ok[i][None, :] & (np.abs(M) > 1e-3)))
        if len(j):
            values = M[i, j] * M[i, k] / M[j, k]
            o = np.argsort(values, kind="stable")
            w = np.cumsum((np.abs(M[j, k]) * np.minimum(np.minimum(n[i, j], n[i, k]), n[j, k]))[o])
            q[i] = np.sqrt(np.clip(values[o][np.searchsorted(w, w[-1] / 2)], 0, 0.25))
    if not q.any():
        return q
    # signs: those of the leading direction, turned so that the annotators are right on the whole
    vec = np.linalg.eigh(np.where(ok, M, 0) + np.diag(q**2))[1][:, -1]
    if (np.sign(vec) * q).sum() < 0:
        vec = -vec
    q = np.where(vec < 0, -q, q)
    w = np.where(ok, n, 0.0)
    for _ in range(sweeps):
        den = w @ q**2
        new = np.divide((w * M) @ q, den, out=np.zeros(K), where=den > 1e-9)
        q = np.clip(0.5 * q + 0.5 * new, -0.5, 0.5)
    return q


def _rest(p: DataFrame, core: DataFrame, n_labels: int, least: int = 20) -> DataFrame:
    """(annotator, q0, q1, ...) of the annotators that are not in ``core`` (annotator, q0, ...), by least squares against it."""
    inside = p.join(F.broadcast(core), "annotator")  # ``core`` rows
    there = inside.select("item", F.col("annotator").alias("other"), *[F.col(f"p{k}").alias(f"o{k}") for k in range(n_labels)], *[f"q{k}" for k in range(n_labels)])
    here = p.join(F.broadcast(core.select("annotator")), "annotator", "left_anti")
    pairs = here.join(there, "item").groupBy("annotator", "other").agg(
        F.count("*").alias("n"),
        *[F.sum(F.col(f"p{k}") * F.col(f"o{k}")).alias(f"s{k}") for k in range(n_labels)],
        *[F.sum(f"{x}{k}").alias(f"{x}{k}") for k in range(n_labels) for x in "po"],
        *[F.first(f"q{k}").alias(f"q{k}") for k in range(n_labels)],
    )
    used = pairs.where(F.col("n") >= least)

    def solved(k: int) -> Column:
        moment = F.col(f"s{k}") / F.col("n") - F.col(f"p{k}") * F.col(f"o{k}") / (F.col("n") * F.col("n"))
        den = F.sum(F.col("n") * F.col(f"q{k}") * F.col(f"q{k}"))
        return F.when(den > 1e-9, F.greatest(F.lit(-0.5), F.least(F.lit(0.5), F.sum(F.col("n") * moment * F.col(f"q{k}")) / den))).otherwise(F.lit(0.0))

    return used.groupBy("annotator").agg(*[solved(k).alias(f"q{k}") for k in range(n_labels)])


def _rates(k: int, prior: np.ndarray, flat: bool) -> tuple[Column, Column]:
    """Sensitivity and false-positive rate for label k, from the columns m (vote share) and q."""
    if flat:  # nobody can be judged: plain votes
        return F.lit(0.6), F.lit(0.4)
    clip = lambda c, lo, hi: F.greatest(F.lit(lo), F.least(F.lit(hi), c))
    delta = clip(F.col(f"q{k}") / F.lit(float(np.sqrt(prior[k] * (1 - prior[k])))), -1.0, 1.0)
    m = F.col(f"m{k}")
    return clip(m + F.lit(float(1 - prior[k])) * delta, _EPS, 1 - _EPS), clip(m - F.lit(float(prior[k])) * delta, _EPS, 1 - _EPS)


def _scored(counts: DataFrame, known: DataFrame, many: bool, prior: np.ndarray, flat: bool, n_labels: int) -> DataFrame:
    """(item, s0, s1, ...): the log-odds of each label, from a table of annotators (m0, ..., q0, ...)."""
    total = sum((F.col(f"n{k}") for k in range(n_labels)), F.lit(0))
    rates = [_rates(k, prior, flat) for k in range(n_labels)]
    weights = known.select("annotator", *[F.ln(s / f).alias(f"y{k}") for k, (s, f) in enumerate(rates)], *[F.ln((1 - s) / (1 - f)).alias(f"z{k}") for k, (s, f) in enumerate(rates)])
    if many:  # a busy annotator is many tasks' work
        salted = weights.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        joined = counts.withColumn("salt", F.pmod(F.xxhash64("item"), F.lit(SALT)).cast("int")).join(salted, ["annotator", "salt"])
    else:
        joined = counts.join(F.broadcast(weights), "annotator")  # at most BROADCAST_ANNOTATORS rows

    def score(k: int) -> Column:
        own = F.sum(F.col(f"n{k}") * F.col(f"y{k}") + (total - F.col(f"n{k}")) * F.col(f"z{k}"))
        return (own + F.lit(float(np.log(prior[k] / (1 - prior[k]))))).alias(f"s{k}")

    return joined.groupBy("item").agg(*[score(k) for k in range(n_labels)], *[F.sum(f"n{k}").alias(f"n{k}") for k in range(n_labels)], F.count("*").alias("n_annotators"))


def consensus(df: DataFrame, item: str, annotator: str, run: str, label: str, labels=LABELS, core: int = CORE, rounds: int = 4):
    """(items, annotators): a row for each item with its decision, probability and agreement, and a
    row for each annotator with its estimated reliability."""
    spark, L = ship(df.sparkSession), len(labels)
    counts = cut(vote_counts(df, item, annotator, run, label, labels), "votes")
    kind = counts.schema["annotator"].dataType.simpleString()
    p = _shares(counts, L)
    means = cut(p.groupBy("annotator").agg(F.count("*").alias("n"), *[F.avg(f"p{k}").alias(f"m{k}") for k in range(L)]), "annotators")
    n_annotators = means.count()
    rows = sorted(means.orderBy(F.desc("n"), "annotator").limit(core).collect(), key=lambda r: str(r["annotator"]))
    names = [r["annotator"] for r in rows]
    marginal = np.array([[r[f"m{k}"] for k in range(L)] for r in rows]).reshape(len(rows), L)
    n, M = _moments(p, names, L) if names else (np.zeros((0, 0)), np.zeros((L, 0, 0)))
    q = np.array([triplet_solve(M[k], n) for k in range(L)]).reshape(L, len(names))
    solved = spark.createDataFrame([(a, *[float(q[k, i]) for k in range(L)]) for i, a in enumerate(names)], f"annotator {kind}, " + ", ".join(f"q{k} double" for k in range(L)))
    if n_annotators > len(names):
        solved = cut(solved.unionByName(_rest(p, solved, L)), "solved")
    known = means.join(solved, "annotator", "left").na.fill(0.0, [f"q{k}" for k in range(L)])
    many = n_annotators > BROADCAST_ANNOTATORS
    judged = (np.abs(q) > 0.02).any(0)
    prior = np.full(L, 1 / L)
    if len(names) and judged.any():
        strong = np.abs(q).sum(0) * judged
        prior = np.clip((marginal * strong[:, None]).sum(0) / strong.sum(), 0.02, 0.96)
        prior /= prior.sum()
    flat = not judged.any()
    for step in range(rounds):
        used = prior
        probs = _probabilities(_scored(counts, known, many, used, flat, L), L)
        if flat or step == rounds - 1:
            break
        share = probs.agg(*[F.avg(f"w{k}").alias(f"w{k}") for k in range(L)]).first()
        prior = np.clip(np.array([share[k] for k in range(L)], float), 0.02, 0.96)
        prior /= prior.sum()
    best = F.greatest(*[F.col(f"w{k}") for k in range(L)])
    decision = F.coalesce(*[F.when(F.col(f"w{k}") >= best, F.lit(x)) for k, x in enumerate(labels)])
    total = sum((F.col(f"n{k}") for k in range(L)), F.lit(0))
    agree = sum((F.col(f"n{k}") * (F.col(f"n{k}") - 1) for k in range(L)), F.lit(0))
    items = probs.select(
        F.col("item").alias(item),
        decision.alias("decision"),
        best.alias("probability"),
        F.when(total > 1, agree / (total * (total - 1))).alias("agreement"),
        total.alias("n_votes"),
        "n_annotators",
    )
    hit = [_rates(k, used, flat)[0] for k in range(L)]
    size = sum((F.abs(F.col(f"q{k}")) for k in range(L)), F.lit(0.0)) / F.lit(float(np.sqrt(used * (1 - used)).sum()))
    sign = F.when(sum((F.col(f"q{k}") for k in range(L)), F.lit(0.0)) >= 0, 1).otherwise(-1)
    accuracy = sum((F.lit(float(used[k])) * hit[k] for k in range(L)), F.lit(0.0))
    return items, known.select(F.col("annotator").alias(annotator), accuracy.alias("accuracy"), (size * sign).alias("informedness"), *[h.alias(f"hit_{x.lower()}") for h, x in zip(hit, labels)])


def _probabilities(scores: DataFrame, L: int) -> DataFrame:
    """w0, w1, ...: the labels' log-odds as shares that sum to 1."""
    top = F.greatest(*[F.col(f"s{k}") for k in range(L)])
    e = scores.withColumns({f"e{k}": F.exp(F.col(f"s{k}") - top) for k in range(L)})
    z = sum((F.col(f"e{k}") for k in range(L)), F.lit(0.0))
    return e.withColumns({f"w{k}": F.col(f"e{k}") / z for k in range(L)})
