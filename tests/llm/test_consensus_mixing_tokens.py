import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestream.llm import consensus, mixing, tokenization


# ---- tokens


def test_round_trip_and_cuts_at_safe_positions():
    enc = tokenization.encoder()
    text = "Hello  world, it's 12 o'clock 😀 naïve \n\n x" * 40 + " " * 50 + "\tend "
    whole = enc.encode_ordinary(text)
    for size in (1, 7, 100, 10**6):
        assert tokenization.encode_text(enc, text, size) == whole
    assert tokenization.decode_ids(enc, whole) == text


@pytest.mark.parametrize("text, ids", [(None, []), ("", []), (" ", [220])])
def test_missing_texts_have_defined_ids(spark, text, ids):
    df = spark.createDataFrame([(7, text, "clash")], "doc_id bigint, text string, ids string")
    assert tokenization.encode_column(df, "doc_id", "text").first().asDict() == {"doc_id": 7, "ids": ids}


def test_long_text_and_empty_table(spark):
    df = spark.createDataFrame([(1, "word " * 60_000), (2, "a" * 30_000)], "doc_id bigint, text string")
    enc = tokenization.encoder()
    got = {r["doc_id"]: r["ids"] for r in tokenization.encode_column(df, "doc_id", "text").collect()}
    assert got[1] == enc.encode_ordinary("word " * 60_000) and tokenization.decode_ids(enc, got[2]) == "a" * 30_000
    assert tokenization.encode_column(df.limit(0), "doc_id", "text").count() == 0


# ---- consensus


def _votes(rng, n_items, accuracy, labels=("YES", "NO", "AMBIGUOUS")):
    truth = rng.integers(0, 3, n_items)
    rows = []
    for i, t in enumerate(truth):
        for a, acc in accuracy.items():
            if rng.random() < 0.8:
                v = t if rng.random() < acc else (t + rng.integers(1, 3)) % 3
                rows.append((i, a, 1, labels[v]))
    return [labels[t] for t in truth], rows


def test_triplets_find_accuracies_and_beat_the_majority(spark):
    rng = np.random.default_rng(0)
    accuracy = {"good": 0.92, "fine": 0.85, "coin": 1 / 3, "coin2": 1 / 3, "coin3": 1 / 3, "liar": 0.1, "so": 0.6}
    truth, rows = _votes(rng, 1500, accuracy)
    df = spark.createDataFrame(rows + rows[:50], "case_id int, model string, run_id int, d string").withColumn("item", F.lit("clash"))
    items, annotators = consensus.consensus(df, "case_id", "model", "run_id", "d")
    got = {r["case_id"]: r["decision"] for r in items.collect()}
    est = {r["model"]: r["accuracy"] for r in annotators.collect()}
    for a, acc in accuracy.items():
        assert est[a] == pytest.approx(acc, abs=0.06)
    right = np.mean([got[i] == truth[i] for i in got])
    from collections import Counter, defaultdict

    by = defaultdict(Counter)
    for i, _, _, v in rows:
        by[i][v] += 1
    majority = np.mean([by[i].most_common(1)[0][0] == truth[i] for i in by])
    assert right > majority + 0.1 and right > 0.88


def test_exact_moments_are_solved():
    q = np.array([0.4, 0.3, -0.2, 0.1, 0.0])
    M = np.outer(q, q)
    assert consensus.triplet_solve(M, np.full((5, 5), 1000.0)) == pytest.approx(q, abs=1e-3)


def test_consensus_edges(spark):
    schema = "case_id int, model string, run_id int, d string"
    empty = spark.createDataFrame([], schema)
    items, annotators = consensus.consensus(empty, "case_id", "model", "run_id", "d")
    assert items.count() == 0 and annotators.count() == 0
    rows = [(1, "a", 1, "YES"), (1, "b", 1, "NO"), (1, "c", 1, "YES"), (2, "a", 1, "INVALID"), (3, "a", None, None), (None, "a", 1, "NO"), (4, None, 1, "NO"), (5, "a", 1, "NO"), (5, "b", 1, "YES")]
    items, annotators = consensus.consensus(spark.createDataFrame(rows, schema), "case_id", "model", "run_id", "d")
    assert {r["case_id"]: r["decision"] for r in items.collect()} == {1: "YES", 5: "YES"}  # plain votes; a tie goes to the first label


def test_annotators_outside_the_core_are_judged_alike(spark, monkeypatch):
    rng = np.random.default_rng(3)
    accuracy = {"good": 0.92, "fine": 0.85, "so": 0.6, "liar": 0.1, "coin": 1 / 3, "more": 0.75}
    truth, rows = _votes(rng, 1500, accuracy)
    rows = [r for r in rows if r[1] != "more" or r[0] % 3 == 0] + [(0, "rare", 1, "YES")]
    df = spark.createDataFrame(rows, "case_id int, model string, run_id int, d string")
    whole, every = consensus.consensus(df, "case_id", "model", "run_id", "d")
    part, some = consensus.consensus(df, "case_id", "model", "run_id", "d", core=4)
    assert {r["model"]: r["accuracy"] for r in some.collect()} == pytest.approx({r["model"]: r["accuracy"] for r in every.collect()}, abs=0.06)
    a, b = ({r["case_id"]: r["decision"] for r in x.collect()} for x in (whole, part))
    assert np.mean([a[k] == b[k] for k in a]) > 0.97
    monkeypatch.setattr(consensus, "BROADCAST_ANNOTATORS", 1)  # the salted join gives the same
    salted, _ = consensus.consensus(df, "case_id", "model", "run_id", "d")
    assert {r["case_id"]: (r["decision"], r["n_votes"]) for r in salted.collect()} == {r["case_id"]: (r["decision"], r["n_votes"]) for r in whole.collect()}


# ---- mixing


def test_splitting_tree_is_exact():
    q = np.array([7, 100, 0, 13])
    out = np.array([x for _, _, x in mixing.splitting_tree(q, 6, 3)])
    assert (out.sum(0) == q).all() and out.sum(1).max() - out.sum(1).min() <= 2 and (out >= 0).all()
    # gone down in steps it is the same tree
    steps = [leaf for lo, hi, own in mixing.splitting_tree(q, 6, 3, least=3) for leaf in mixing.splitting_tree(own, hi, 3, lo, hi)]
    assert [(lo, hi) for lo, hi, _ in steps] == [(i, i + 1) for i in range(6)] and (np.array([x for _, _, x in steps]) == out).all()


def test_draws_of_any_size_have_the_right_distribution():
    rng = np.random.default_rng(5)
    for good, bad, draws in ((3 * 10**9, 10**9, 10**6), (5 * 10**12, 2 * 10**13, 10**13), (10**10, 5, 7 * 10**9), (7, 10**10, 10**10 - 3)):
        got = np.array([mixing._hypergeometric(rng, good, bad, draws) for _ in range(60)], float)
        assert (got >= max(0, draws - bad)).all() and (got <= min(good, draws)).all()
        p = good / (good + bad)
        sd = np.sqrt(draws * p * (1 - p) * (good + bad - draws) / (good + bad - 1))
        assert abs(got.mean() - draws * p) <= 5 * sd / np.sqrt(60) + 1
    # just where numpy still draws, too, both have the same mean and spread
    theirs = rng.hypergeometric(4 * 10**8, 5 * 10**8, 10**5, 400).astype(float)
    ours = np.array([mixing._hypergeometric(rng, 4 * 10**9, 5 * 10**9, 10**5) for _ in range(400)], float)
    assert abs(theirs.mean() - ours.mean()) < 40 and 0.8 < theirs.std() / ours.std() < 1.25


@pytest.fixture(scope="module")
def mixed(spark):
    rows = [(i, "one two three " * (1 + i % 5), s) for i in range(600) for s in [("Big", "big ", "BIG")[i % 3] if i % 3 or i % 2 else "small-one"]]
    rows += [(1000, None, "big"), (1001, "", "big"), (1002, "text", None), (1003, "text", "unlisted")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("n", F.lit("clash"))
    targets = [("m", "big", 0.5, 1, 0.5), ("m", "small_one", 0.4, 3, 0.5), ("m", "none", 0.1, 2, 0.5), ("m", "big", 0.5, 1, 0.5), (None, "big", 0.5, 1, 0.5), ("z", "big", 1.0, None, 0.5)]
    targets = spark.createDataFrame(targets, "mix_name string, source string, target_share double, max_repeats int, size_share double")
    return docs, mixing.mix(docs, targets, "doc_id", "text", "source", block_tokens=200, shard_tokens=800), targets


def test_mix_meets_quotas_and_caps(mixed):
    _, (records, report), _ = mixed
    got = {(r["mix_name"], r["source"]): r for r in report.collect()}
    big, small = got["m", "big"], got["m", "small_one"]
    assert big["quota_tokens"] <= big["tokens"] < big["quota_tokens"] + 20 and big["max_uses"] == 1
    assert small["max_uses"] <= 3 and (small["short_tokens"] > 0 or small["tokens"] < small["quota_tokens"] + 20)
    assert got["m", "none"]["tokens"] == 0 and got["m", "none"]["short_tokens"] > 0 and got["z", "big"]["tokens"] == 0
    assert sum(r["actual_share"] for r in got.values() if r["mix_name"] == "m") == pytest.approx(1)
    rows = records.collect()
    assert {r["source"] for r in rows} == {"big", "small_one"} and not {r["doc_id"] for r in rows} & {1000, 1001, 1002, 1003}
    places = [(r["shard"], r["position"]) for r in rows]
    assert len(set(places)) == len(places)
    for s in {r["shard"] for r in rows}:
        assert sorted(p for t, p in places if t == s) == list(range(sum(t == s for t, _ in places)))
    assert len({(r["doc_id"], r["copy_no"]) for r in rows}) == len(rows)


def test_mix_is_the_same_again_and_empty_tables_work(spark, mixed):
    docs, (records, _), targets = mixed
    again, _ = mixing.mix(docs.repartition(5), targets, "doc_id", "text", "source", block_tokens=200, shard_tokens=800)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, records.collect()))
    for ranges, top in ((1, 1), (7, 3)):  # neither ranges of the permutation nor the driver's part of the tree matter
        other, _ = mixing.mix(docs, targets, "doc_id", "text", "source", block_tokens=200, shard_tokens=800, range_blocks=ranges, top_nodes=top)
        assert sorted(map(tuple, other.collect())) == sorted(map(tuple, records.collect()))
    records, report = mixing.mix(docs.limit(0), targets, "doc_id", "text", "source")
    assert records.count() == 0 and report.agg(F.sum("tokens")).first()[0] == 0
