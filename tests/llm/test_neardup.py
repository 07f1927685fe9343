import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestream.llm import neardup

WORDS = [f"w{i}" for i in range(60)]


def _brute(rows, width, threshold):
    docs = {}
    for k, t in rows:
        if k is not None:
            w = re.findall(r"[^\W_]+", (t or "").lower())
            docs.setdefault(k, []).append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)})
    sim = lambda a, b: len(a & b) / len(a | b) if a and b else 0
    return {(a, b) for a, b in itertools.combinations(sorted(docs), 2) if any(sim(x, y) >= threshold - 1e-12 for x in docs[a] for y in docs[b])}


def _corpus(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            w = (rng.choice(rows)[1] or "").split()
            for _ in range(rng.randrange(0, max(2, len(w) // 6))):
                k = rng.random()
                at = rng.randrange(len(w) + 1)
                if k < 0.4 and w:
                    w[min(at, len(w) - 1)] = rng.choice(WORDS)
                elif k < 0.7:
                    w.insert(at, rng.choice(WORDS))
                elif w:
                    del w[min(at, len(w) - 1)]
        else:
            w = [rng.choice(WORDS) for _ in range(rng.choice([0, 1, 2, 3, 5, 9, 20, 40, 70, 140]))]
        rows.append((f"d{i:04d}", " ".join(w)))
    return rows


@pytest.mark.parametrize("width, threshold, seed", [(3, 0.5, 1), (3, 0.5, 2), (5, 0.8, 3), (1, 0.6, 4)])
def test_pairs_equal_brute_force(spark, width, threshold, seed):
    rows = _corpus(seed, 250) + [("null", None), ("empty", ""), ("short", "a b"), (None, "a b c d e f"), ("d0000", "other text for an old key x y z")]
    df = spark.createDataFrame(rows, "k string, t string").withColumn("c", F.lit("clash"))
    got = {(r["k_a"], r["k_b"]) for r in neardup.pairs(df, "k", "t", width, threshold).collect()}
    assert got == _brute(rows, width, threshold)


@pytest.mark.parametrize("width, threshold, hot", [(3, 0.5, 4), (3, 0.5, 25), (1, 0.6, 2)])
def test_hot_combinations_in_blocks_lose_nothing(spark, monkeypatch, width, threshold, hot):
    rng = random.Random(11)
    shared = " ".join(f"s{i}" for i in range(14))
    rows = _corpus(9, 160) + [(f"h{i:03d}", shared + " " + " ".join(rng.choice(WORDS) for _ in range(rng.choice([2, 4, 8, 16, 60])))) for i in range(120)]
    df = spark.createDataFrame(rows, "k string, t string")
    monkeypatch.setattr(neardup, "HOT_RUN", hot)
    got = {(r["k_a"], r["k_b"]) for r in neardup.pairs(df, "k", "t", width, threshold).collect()}
    want = _brute(rows, width, threshold)
    assert got == want and len(want) > 400
    monkeypatch.setattr(neardup, "TEXTS_PER_PART", 40)
    assert {(r["k_a"], r["k_b"]) for r in neardup.pairs(df, "k", "t", width, threshold).collect()} == want


def test_parts_and_slices_lose_nothing(spark, monkeypatch):
    rows = _corpus(7, 300)
    df = spark.createDataFrame(rows, "k string, t string")
    monkeypatch.setattr(neardup, "TEXTS_PER_PART", 40)
    got = {(r["k_a"], r["k_b"]) for r in neardup.pairs(df, "k", "t", 3, 0.5).collect()}
    assert got == _brute(rows, 3, 0.5)


def test_groups_and_hot_copies(spark):
    base = " ".join(WORDS[:40])
    near = base.replace("w7 ", "other ")
    rows = [(f"c{i}", base) for i in range(200)] + [("n1", near), ("x", " ".join(WORDS[20:60])), ("e", None)]
    df = spark.createDataFrame(rows, "k string, t string")
    got = {r["k"]: r for r in neardup.groups(df, "k", "t", 3, 0.5).collect()}
    assert len(got) == 203 and len({got[f"c{i}"]["class_id"] for i in range(200)}) == 1
    assert got["c0"]["n_links"] == 200 and got["n1"]["n_links"] == 200 and got["n1"]["group_id"] == got["c0"]["group_id"] != got["x"]["group_id"]
    assert got["e"]["class_id"] is None and got["e"]["n_links"] == 0
    assert neardup.pairs(df.limit(0), "k", "t").count() == 0 and neardup.groups(df.limit(0), "k", "t").count() == 0


def test_components_of_a_chain(spark):
    e = [(i, i + 1) for i in range(50)] + [(100, 101)]
    df = spark.createDataFrame(e + [(b, a) for a, b in e], "a bigint, b bigint")
    got = {r["v"]: r["label"] for r in neardup.components(df).collect()}
    assert all(got[i] == 0 for i in range(51)) and got[101] == 100


def test_a_linked_pair_cannot_miss_all_signatures():
    """The bound behind the prefixes, for random sets at the threshold."""
    rng = np.random.default_rng(5)
    scheme = neardup.Scheme(0.5)
    levels = rng.integers(0, 12, 1 << neardup.SKETCH_BITS).astype(np.uint8)
    taken = np.ones(len(scheme.starts), bool)
    for _ in range(150):
        n = int(rng.integers(1, 400))
        universe = np.unique(rng.integers(0, 2**32, 3 * n + 9, dtype=np.uint64)).astype(np.uint32)
        a = universe[:n]
        common = int(np.ceil(n * rng.uniform(0.5, 1)))
        extra = int(rng.integers(0, max(1, 2 * common - n + 1)))
        b = np.concatenate([a[:common], universe[n : n + extra]])
        if not len(b) or common / (n + extra) < 0.5:
            continue
        rows: dict = {}
        for band, group, part, texts, ln, tokens, _ in neardup._deal([a, b], levels, scheme, 1, taken):
            for t, piece in zip(texts, np.split(tokens, np.cumsum(ln)[:-1])):
                rows.setdefault((band, group), {})[int(t)] = set(piece.tolist())
        assert any(len(v) == 2 and len(v[0] & v[1]) >= min(g + 1, 3) for (_, g), v in rows.items())
