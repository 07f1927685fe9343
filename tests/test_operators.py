import json
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestream.functions import answers
from lodestream.operators import annotate, classify, clean, evaluate, ingest, label, merge, tags, timeline
from lodestream.sources import dumps, files, vocabulary


def _lines(spark, rows):
    return spark.createDataFrame([("d", i, json.dumps(r) if not isinstance(r, str) else r) for i, r in enumerate(rows)], "dump string, line_no bigint, raw_line string")


def test_ingest_times_absent_null_and_types(spark):
    base = {"id": "1", "title": "tylenol", "selftext": None}
    rows = [
        base | {"created_utc": 1_500_000_000}, base | {"created_utc": "1500000000"}, base | {"created_utc": 1500000000.9}, base | {"created_utc": None}, base, base | {"created_utc": "abc"},
        base | {"created_utc": 1_500_000_000, "subreddit": None}, base | {"created_utc": 1_500_000_000, "subreddit": "s", "title": "aspirin"}, "[1, 2]", "{broken", "",
        base | {"created_utc": ingest.year_bounds(2013, 2025)[0]}, base | {"created_utc": ingest.year_bounds(2013, 2025)[1] + 1},
    ]
    got = ingest.flagged(_lines(spark, rows), vocabulary.Vocabulary()).orderBy("line_no").collect()
    assert [r["outcome"] for r in got] == ["kept", "kept", "kept", "bad_time", "skipped_date", "bad_time", "kept", "skipped_medicine", "bad_json", "bad_json", "bad_json", "kept", "skipped_date"]
    assert got[0]["subreddit"] == "d" and got[6]["subreddit"] is None
    assert got[0]["created_time"] == "2017-07-14T02:40:00+00:00" and got[0]["body"] == ""
    assert got[0]["url"] == "https://www.reddit.com/r/d/comments/1"
    c = ingest.counters(ingest.flagged(_lines(spark, rows), vocabulary.Vocabulary())).first()
    assert (c["total"], c["kept"], c["skipped_date"], c["skipped_medicine"], c["bad_json"], c["bad_time"]) == (13, 5, 2, 1, 3, 2)
    assert ingest.flagged(_lines(spark, rows).limit(0), vocabulary.Vocabulary()).count() == 0


def test_clean_order_of_copies_and_empties(spark):
    df = spark.createDataFrame([("d", "1", 1, ""), ("d", "1", 2, "text"), ("d", "", 3, "x"), ("d", "", 4, "x"), ("d", None, 5, "x"), ("d", "2", 6, "y")], "dump string, post_id string, seq int, clean_text string")
    out = {r["seq"]: r["outcome"] for r in clean.cleaned(df, ["dump", "post_id"], ["seq"]).collect()}
    assert out == {1: "dropped_empty", 2: "duplicate", 3: "kept", 4: "kept", 5: "kept", 6: "kept"}
    for n in (1, 4, 17):
        assert {r["seq"]: r["outcome"] for r in clean.cleaned(df.repartition(n), ["dump", "post_id"], ["seq"]).collect()} == out


def test_merge_skips_before_it_compares(spark):
    df = spark.createDataFrame([("a", "1", False), ("b", "1", True), ("c", "1", True), ("c", "", True), ("d", "", True), ("e", "2", None)], "s string, post_id string, ok boolean")
    out = {r["s"]: r["outcome"] for r in merge.merged(df, F.col("ok"), "post_id", ["s"]).where("post_id != ''").collect()}
    assert out == {"a": "skipped", "b": "kept", "c": "duplicate", "e": "skipped"}


def test_rollup_lists_what_is_missing(spark):
    counts = spark.createDataFrame([("a", 1), ("a", 2), ("z", 5)], "k string, n int")
    want = spark.createDataFrame([("a",), ("b",)], "k string")
    got = {r["k"]: (r["n"], r["missing"]) for r in merge.rollup_with_missing(counts, want, "k", ["n"]).collect()}
    assert got == {"a": (3, False), "b": (0, True), None: (3, True)}


def test_runs_and_frames(spark):
    e = spark.createDataFrame([("u", 1, "a"), ("u", 2, "a"), ("u", 3, None), ("u", 4, None), ("u", 5, "a")], "u string, i int, v string")
    assert [r["i"] for r in merge.consecutive_runs(e, ["u"], ["i"], "v").orderBy("i").collect()] == [1, 3, 5]
    assert [r["context"] for r in merge.trailing_frame(e, ["u"], ["i"], "v").orderBy("i").collect()] == ["a", "a a", "a a", "a", "a"]
    assert merge.upserted(e, e.limit(0), ["u"]).count() == 5


def test_tags_and_axes(spark):
    texts = ["I took 500 mg 3 hours ago", "I took some this morning", "can I take 2 tablets", "how much is fine?", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["decidability"].asDict() for r in tags.tagged(df, F.col("t")).collect()]
    assert [g["decidable_axis"] for g in got] == ["rolling", "interval", "single_dose", None, None]
    assert [g["decidable"] for g in got] == [True, True, True, False, False]
    assert got[0]["has_strength"] and not got[1]["has_strength"]


#: The recorded votes of four models: decisions of five cases by run, and the expected summaries.
VOTES = {
    "m1": (["YNNNN", "NNNNN", "NAYNA", "YNYYY", "YNYYN"], "NNNYY", [0.8, 1.0, 0.4, 0.8, 0.6]),
    "m2": (["NNNNN", "NNNNN", "AAAAA", "YAYAY", "AYYYA"], "NNAYY", [1.0, 1.0, 1.0, 0.6, 0.6]),
    "m3": (["NNNNN", "NNNNN", "AAAAA", "AYYAA", "YAAYY"], "NNAAY", [1.0, 1.0, 1.0, 0.6, 0.6]),
    "m4": (["NNNNN", "NNNNN", "AAAAA", "YYYAY", "YYYYY"], "NNAYY", [1.0, 1.0, 1.0, 0.8, 1.0]),
}
NAMES = {"Y": "YES", "N": "NO", "A": "AMBIGUOUS"}


@pytest.mark.parametrize("model", VOTES)
def test_majorities_of_recorded_votes(spark, model):
    cases, want, agreement = VOTES[model]
    gold = ["NO", "NO", "AMBIGUOUS", "YES", "YES"]
    rows = [(c + 1, r + 1, NAMES[v], 0.5, 0.1 * r, None, "f", "q", gold[c], None) for c, vs in enumerate(cases) for r, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "case_id int, run_id int, parsed_decision string, decision_confidence double, decision_entropy double, decision_margin double, drug_focus string, question_text string, gold_answer string, error_category string")
    for n in (1, 4, 17):
        got = evaluate.case_summary(df.repartition(n)).orderBy("case_id").collect()
        assert [r["majority_decision"] for r in got] == [NAMES[x] for x in want]
        assert [r["agreement"] for r in got] == pytest.approx(agreement)
        assert [r["consistency_score"] for r in got] == [2 if a == 1 else 1 if a >= 0.6 else 0 for a in agreement]
        assert [r["majority_correct"] for r in got] == [int(NAMES[x] == g) for x, g in zip(want, gold)]
        assert got[0]["avg_decision_entropy"] == pytest.approx(0.2) and got[0]["avg_decision_margin"] is None and got[0]["num_runs"] == 5


def test_summary_without_valid_runs(spark):
    df = spark.createDataFrame([(1, 1, "INVALID"), (1, 2, None)], "case_id int, run_id int, parsed_decision string")
    r = evaluate.case_summary(df, firsts=(), means={}).first()
    assert (r["majority_decision"], r["agreement"], r["num_runs"]) == ("INVALID", 0.0, 2)


@pytest.mark.parametrize(
    "raw, decision, confidence",
    [
        ('{"decision": " b ", "confidence": 7.9}', "NO", 7), ('text {"decision": "A", "confidence": "7"} more', "YES", 7), ('{"decision": "YES", "confidence": 11}', "INVALID", None), ('{"decision": null, "confidence": "7.9"}', "INVALID", None),
        ("no json", "INVALID", None), (None, "INVALID", None), ("", "INVALID", None), ("[1]", "INVALID", None), ('{"decision": "C", "confidence": 0}', "AMBIGUOUS", None),
    ],
)
def test_parsed_runs(spark, raw, decision, confidence):
    r = evaluate.parsed_runs(spark.createDataFrame([(raw, None)], "raw_output string, gold_answer string")).first()
    assert (r["decision"], r["confidence"], r["right"]) == (decision, confidence, None)


def test_probability_scores(spark):
    rows = [(0.0, 0.0, 0.0), (0.5, 0.5, 0.0), (-1.0, 1.0, 1.0), (0.2, 0.3, 0.5)]
    df = spark.createDataFrame(rows, "y double, n double, a double")
    got = [r["p"] for r in df.select(answers.probability_scores(F.col("y"), F.col("n"), F.col("a")).alias("p")).collect()]
    assert got[0]["decision"] is None and got[0]["confidence"] is None
    assert [g["decision"] for g in got[1:]] == ["YES", "NO", "AMBIGUOUS"]
    assert got[1]["margin"] == 0 and got[3]["confidence"] == pytest.approx(0.5) and got[3]["normalized_entropy"] == pytest.approx(0.9372305632)


def test_prompt_and_runs(spark):
    df = spark.createDataFrame([(1, "a", None)], "case_id int, q string, f string")
    r = evaluate.runs_of(df, 3).select("run_id", evaluate.prompt("{q}/{f}!", {"q": F.col("q"), "f": F.col("f")}).alias("p")).collect()
    assert [x["run_id"] for x in r] == [1, 2, 3] and r[0]["p"] == "a/!"


def test_labels_and_checks(spark):
    sheet = spark.createDataFrame([(2, " Tylenol and Motrin "), (3, "apap?"), (4, "aspirin"), (5, None), (6, "known")], "sheet_row int, question string")
    earlier = spark.createDataFrame([(2, "known", "old"), (3, " known", "new"), (4, "apap?", None)], "sheet_row int, question string, label string")
    got = {r["sheet_row"]: (r["label"], r["source"]) for r in label.labelled(sheet, earlier).collect()}
    assert got == {2: ("Tylenol_Advil", "keyword"), 3: ("Tylenol", "keyword"), 4: ("REVIEW", "keyword"), 5: ("REVIEW", "keyword"), 6: ("new", "previous")}
    assert {(r["row"], r["problem"]) for r in label.row_gaps(sheet, "sheet_row", 3, 8).collect()} == {(7, "missing"), (8, "missing"), (2, "unexpected")}
    assert label.changed(sheet, sheet, "sheet_row", "question").count() == 0
    assert label.blank(sheet, "question").count() == 1
    label.check(sheet.limit(0), "nothing")
    with pytest.raises(ValueError):
        label.check(sheet, "rows")
    cells = spark.createDataFrame([(1, "#REF!", "ok"), (2, "x", "#DIV/0!")], "k int, a string, b string")
    assert [(r["k"], r["cell"]) for r in label.error_cells(cells, "k", ["a", "b"]).collect()] == [(1, "a"), (2, "b")]
    assert label.written_back(sheet.withColumn("label", F.lit("x")), earlier.limit(1)).where("label = 'old'").count() == 1


def test_timeline_windows(spark):
    rows = [("c", "2024-01-01 00:00:00", 1.0), ("c", "2024-01-01 12:00:00", 2.0), ("c", "2024-01-02 00:00:00", 4.0), ("c", "2024-01-02 11:59:59", 8.0)]
    df = spark.createDataFrame(rows, "k string, t string, v double").withColumn("t", F.to_timestamp("t"))
    assert [r["rolling_total"] for r in timeline.rolling(df, ["k"], "t", "v").orderBy("t").collect()] == [1, 3, 6, 14]
    assert [r["hours_since_last"] for r in timeline.since_last(df, ["k"], "t", "v").orderBy("t").collect()][:2] == [None, 12.0]
    left = df.select("k", "t")
    got = timeline.as_of(left, df.where("v < 3"), ["k"], "t", "t", "v").orderBy("t").collect()
    assert [r["last_v"] for r in got] == [1.0, 2.0, 2.0, 2.0]
    doses = spark.createDataFrame([("c", "acetaminophen", None, 2), ("c", "ibuprofen", 200, 1), ("c", "other", None, 1)], "k string, ingredient string, strength_mg int, units int")
    assert sorted(r["dose_mg"] for r in timeline.interpretations(doses, timeline.profiles(spark)).collect()) == [200, 650, 1000]
    holds = spark.createDataFrame([("a", True), ("a", True), ("b", False), ("c", True), ("c", False), ("d", None)], "k string, holds boolean")
    assert {r["k"]: r["decision"] for r in timeline.decided(holds, "k").collect()} == {"a": "YES", "b": "NO", "c": "AMBIGUOUS", "d": "AMBIGUOUS"}


def test_buckets_change_nothing(spark):
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.7 else rng.choice("abc"), rng.randrange(0, 12 * 86_400), i, rng.choice("xyz") if rng.random() < 0.9 else None) for i in range(600)] + [(None, 5, 600, "x"), (None, 90_000, 601, "x")]
    df = spark.createDataFrame(rows, "k string, s bigint, i bigint, v string").withColumn("t", F.timestamp_seconds("s")).withColumn("n", F.col("i") % 7)
    day = F.floor(F.col("s") / 86_400)
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))
    for before in (1, 2, 5):
        assert same(merge.trailing_frame(df, ["k"], ["s", "i"], "v", before), merge.trailing_frame(df, ["k"], ["s", "i"], "v", before, day))
    assert same(merge.consecutive_runs(df, ["k"], ["s", "i"], "v"), merge.consecutive_runs(df, ["k"], ["s", "i"], "v", day))
    for span in (3_600_000_000, 86_400_000_000):
        plain = Window.partitionBy("k").orderBy(F.col("s") * 1_000_000).rangeBetween(-(span - 1), 0)
        assert same(df.withColumn("rolling_total", F.sum("n").over(plain)), timeline.rolling(df, ["k"], "t", "n", span))
        hours = (F.col("s") - F.lag("s").over(Window.partitionBy("k").orderBy("s", "i"))) * 1_000_000 / F.lit(3_600_000_000.0)
        assert same(df.withColumn("hours_since_last", hours), timeline.since_last(df, ["k"], "t", "i", span))
    left, right = df.where("v = 'x'").select("k", "t", "i"), df.where("v = 'y' or v is null and n > 3").select("k", "t", "n")
    got = timeline.as_of(left, right, ["k"], "t", "t", "n", 3_600_000_000)
    want = [(l["k"], l["i"], max(((r["t"], r["n"]) for r in right.collect() if r["k"] == l["k"] and r["t"] <= l["t"]), default=(None, None))[1]) for l in left.collect()]
    assert sorted(map(str, want)) == sorted(str((r["k"], r["i"], r["last_n"])) for r in got.collect())


HITS = [
    ("When can I take another tylenol? I took two at noon.", "candidate"), ("How long should I wait after tylenol before I take more?", "candidate"), ("Can I switch from tylenol to advil tonight?", "candidate"),
    ("Can I mix tylenol with beer?", "excluded_intent"), ("Can I take another tylenol for my dog?", "excluded"), ("Tylenol is cheap here.", "no_repeat_question"), ("How much tylenol is too much?", "candidate"),
    ("I took aspirin. Can I take tylenol again?", "other_medicine"), ("", "no_repeat_question"), (None, "no_repeat_question"), ("I took advil. May I have another one now?", "candidate"),
    ("Can I take tylenol mixed with juice?", "excluded_intent"), ("Can I take tylenol mixed with advil before bed?", "candidate"),
]

# For each rule a text that it holds for; where an earlier dose is needed, its first sentence tells of it.
RULE_HITS = {
    "explicit_same_medicine_repeat_question": "Can I take another tylenol?",
    "same_medicine_interval_question": "How long after taking tylenol can I take it?",
    "when_take_same_medicine_again": "I took tylenol at noon. When can I take the tylenol tablets again?",
    "wait_after_same_medicine_dose": "How long after having tylenol should my wife wait to take it again?",
    "wait_before_same_medicine_again": "I took tylenol at 8. How long must I wait before taking some tylenol pills again?",
    "take_more_same_medicine": "I took tylenol two hours ago. Can I take a bit more of the tylenol?",
    "safe_to_take_same_medicine_again": "I took tylenol at noon. Is it safe for me to take tylenol pills again?",
    "interval_between_same_medicine_doses": "What is the minimum gap between two tylenol doses?",
    "one_brand_to_another_same_medicine": "How long after taking tylenol should someone wait to take another cheaper brand?",
    "consecutive_same_medicine_doses": "How soon before consecutive tylenol doses?",
    "same_ingredient_product_interval": "How long after taking a product with tylenol must one wait before taking another?",
    "prior_dose_then_another_dose": "I took tylenol at noon. Can I have another pill?",
    "prior_dose_then_wait_for_next": "I took tylenol at noon. How long until I have the next dose?",
    "prior_dose_then_take_now": "I took tylenol at noon. Should I take it now?",
    "switch_between_target_medicines": "Can I switch from tylenol to advil?",
    "replace_between_target_medicines": "Should I replace the tylenol with advil?",
    "take_target_instead_of_other_target": "Can I take advil instead of tylenol?",
    "alternate_between_target_medicines": "Can I alternate tylenol and advil?",
    "prior_target_then_other_target": "I took tylenol at noon. Can I take advil?",
    "interval_between_target_medicines": "How long after tylenol can I take advil?",
    "contextual_target_switch": "Tylenol instead of advil tonight, or what?",
    "contextual_explicit_repeat_question": "Is tylenol fine to take once more or again?",
    "contextual_dose_interval_question": "What about the gap between one and the other of my tylenol doses?",
    "contextual_prior_dose_followup": "I used tylenol at noon. It rained all day. We stayed in. Is it bad to take a second pill?",
    "contextual_post_level_repeat_question": "Tylenol is in the drawer. It rained all day. We stayed in. Is it bad to take a second pill?",
    "dosing_amount_question": "How much tylenol is too much?",
}
NEED_EARLIER = ("when_take_same_medicine_again", "take_more_same_medicine", "safe_to_take_same_medicine_again", "wait_before_same_medicine_again")


def test_every_rule_and_its_near_misses():
    from lodestream.sources import dose_rules

    m = classify._Matcher(classify.RuleSet())
    assert {*dose_rules.SWITCHES, *dose_rules.EXPLICIT, *dose_rules.IMPLICIT, classify.AMOUNT} <= set(RULE_HITS)
    for name, text in RULE_HITS.items():
        outcome, _, evidence, _ = m.judge("", text)
        assert (outcome, evidence and evidence["rule_id"]) == ("candidate", name), text
        missed = m.judge("", text.replace("tylenol", "water").replace("Tylenol", "Water").replace("advil", "juice"))
        assert missed[0] == ("excluded_intent" if "eplac" in text else "no_repeat_question") and missed[2] is None, text
        assert m.judge("", f"{text} With beer.")[0] in ("excluded_intent", "candidate")
        assert m.judge("After the beer", text)[0] == "excluded_intent"
    for name in NEED_EARLIER + ("prior_dose_then_another_dose", "prior_dose_then_wait_for_next", "prior_dose_then_take_now"):
        evidence = m.judge("", RULE_HITS[name].split(". ", 1)[1])[2]
        assert (evidence or {}).get("rule_id") != name


def test_evidence_of_rules():
    m = classify._Matcher(classify.RuleSet())
    e = m.judge("", "I took tylenol two hours ago. Can I take a bit more of the tylenol?")[2]
    assert e["prior_dose_text"].startswith("I took tylenol") and e["question_text"] == "Can I take a bit more of the tylenol" and e["time_expressions"] == ["two hours ago"]
    # without a time only a first dose that failed stands for the earlier one
    assert (m.judge("", "I took tylenol. Can I take a bit more of the tylenol?")[2] or {}).get("rule_id") != "take_more_same_medicine"
    assert m.judge("", "Can I take a bit more of the tylenol if the first did not work?")[2]["rule_id"] == "take_more_same_medicine"
    # the role texts are the match and the earlier dose, not the window around them
    assert m.judge("", "Can I take another tylenol. My neighbour sells aspirin by the box.")[0] == "candidate"
    assert m.judge("", "My aspirin ran out. I took tylenol at noon. Should I take it now?")[0] == "candidate"
    # only a title is a title
    assert m.judge("", "We drank wine once. It rained. Much later I slept. Can I take another tylenol?")[0] == "candidate"
    # "instead of" near another medicine gives it a role
    assert m.judge("", "I want tylenol instead of aspirin. Is that safe to take?")[:2] == ("other_medicine", ["aspirin"])
    assert m.judge("", "x" * 300_000)[0] == "no_repeat_question"


def test_classifier_cascade(spark):
    df = spark.createDataFrame([(str(i), None, t) for i, (t, _) in enumerate(HITS)], "post_id string, title string, body string").withColumn("r", F.lit("clash"))
    df = clean.normalize(df)
    got = {int(r["post_id"]): r for r in classify.classified(df).collect()}
    assert [got[i]["outcome"] for i in range(len(HITS))] == [o for _, o in HITS]
    e = got[2]["evidence"]
    assert (e["rule_id"], e["source_medicine"], e["target_medicine"], e["transition"]) == ("switch_between_target_medicines", "acetaminophen", "ibuprofen", "acetaminophen_to_ibuprofen")
    assert got[7]["other_medicines"] == ["aspirin"] and got[7]["r"] == "clash"
    assert classify.stored(classify.classified(df)).count() == sum(o == "candidate" for _, o in HITS)
    assert classify.classified(df.limit(0)).count() == 0
    assert classify.classified(df, keep=["post_id"]).columns == ["post_id", "clean_text", "outcome", "other_medicines", "evidence", "gate", "matched_dosing_terms", "decidability"]
    s = classify.summary(classify.classified(df.withColumn("sub", F.lit("s"))), "sub").first()
    assert s["input"] == len(HITS) == sum(s[c] for c in classify.COUNTERS) and s["by_other_medicine"] == {"aspirin": 1}
    assert sum(s["by_medicine"].values()) == s["candidates"] == s["decidable"] + s["undecidable"]


def test_a_killed_run_goes_on_from_its_log(spark, tmp_path):
    df = spark.range(40).select(F.col("id").cast("string").alias("key"), F.col("id").alias("seq"), F.concat(F.lit('{"post_id":"'), F.col("id"), F.lit('"}')).alias("payload"))
    calls, log = str(tmp_path / "calls"), str(tmp_path / "log")
    os.makedirs(calls)

    def dies_at(n):
        def call(payload):
            import os as o
            import uuid as u

            if n is not None and len(o.listdir(calls)) >= n:
                o._exit(1)  # the worker is killed
            open(o.path.join(calls, f"{payload['post_id']}-{u.uuid4().hex}"), "w").close()
            return {"text": "fine"}

        return call

    none = spark.createDataFrame([], f"key string, record {annotate.RECORD}")
    work = df.repartition(1)
    with pytest.raises(Exception):
        annotate.run(work, none, log, dies_at(25), "m", "p", "t1", chunk=8)
    kept = {r["key"] for r in files.read_log(spark, log, annotate.RECORD).collect()}
    assert 0 < len(kept) < 40
    before = os.listdir(calls)
    out = annotate.run(work, none, log, dies_at(None), "m", "p", "t2", chunk=8)
    again = {f.split("-")[0] for f in set(os.listdir(calls)) - set(before)}
    assert again == {str(i) for i in range(40)} - kept and out.count() == 40
    assert [r["seq"] for r in annotate.results(df.repartition(5), out).collect()] == list(range(40))
    annotate.finish(df, out, str(tmp_path / "out.json"), log)
    assert [r["seq"] for r in spark.read.json(str(tmp_path / "out.json"), multiLine=True).collect()] == list(range(40)) and not os.path.exists(log)


def _annotator():
    """A nested function: workers can't import this module."""

    def flaky(payload):
        if payload["post_id"] in ("bad1", "bad2", "bad3"):
            raise RuntimeError("down")
        return {"text": f"about {payload['clean_text']}", "usage": {"input_tokens": 3, "output_tokens": "x"}}

    return flaky


_flaky = _annotator()


def test_annotation_resumes(spark, tmp_path):
    rows = [("a", None, "t"), ("bad1", None, "t"), (None, "u", "t"), (None, None, "t")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "post_id string, url string, clean_text string, seq bigint")
    c = df.select(annotate.record_key(F.col("post_id"), F.col("url"), F.col("seq")).alias("key"), "seq", annotate.payload(F.col("post_id"), F.col("clean_text")).alias("payload"))
    assert [r["key"] for r in c.orderBy("seq").collect()] == ["a", "bad1", "u", "index:3"]
    none = spark.createDataFrame([], f"key string, record {annotate.RECORD}")
    log = str(tmp_path / "log")
    first = annotate.run(c, none, log, _flaky, "m", "p", "now")
    assert {r["key"]: r["record"]["status"] for r in first.collect()} == {"a": "completed", "bad1": "error", "u": "completed", "index:3": "completed"}
    assert [r["key"] for r in annotate.work_list(c, first, "m", annotate.prompt_hash("p")).collect()] == ["bad1"]
    assert annotate.work_list(c, first, "m", annotate.prompt_hash("other prompt")).count() == 4
    assert annotate.work_list(c, first, "m", annotate.prompt_hash("other prompt"), 2).count() == 2
    with open(tmp_path / "log" / "torn.json", "w") as f:
        f.write('{"key": "a", "rec')
    again = annotate.run(c, none, log, _flaky, "m", "p", "later")
    assert again.count() == 4
    tried = annotate.annotated(annotate.work_list(c, first, "m", annotate.prompt_hash("p")), _flaky, "m", "p", "x")
    s = annotate.stats(c, first, tried, "m", annotate.prompt_hash("p")).first()
    assert (s["completed"], s["errors"], s["remaining"], s["attempted"], s["failed"], s["reused"]) == (3, 1, 1, 1, 1, 3)
    assert annotate.joined(c, first).count() == 4 and annotate.planned_calls(c, 3) == 3
    assert isinstance(annotate.run_all({"x": (c, none.withColumnRenamed("key", "k"), log)}, annotator=_flaky, model="m", prompt="p", stamp="n")["x"], Exception)


def test_circuit_breaker(spark):
    w = spark.createDataFrame([(f"k{i}", i, json.dumps({"post_id": f"bad{i}" if i <= 3 else "ok", "clean_text": ""})) for i in range(1, 6)], "key string, seq bigint, payload string").coalesce(1)
    assert [r["record"]["status"] for r in annotate.annotated(w, _flaky, "m", "p", "x").collect()] == ["error"] * 3


def test_sources(spark, tmp_path):
    import zstandard

    with open(tmp_path / "sub.jsonl.zst", "wb") as f:
        f.write(zstandard.ZstdCompressor(write_content_size=False).compress('{"id": "1"}\n\n  {"id": "2"}  \n'.encode()))
    short = dumps.lines(spark, str(tmp_path / "*.zst")).orderBy("line_no").collect()
    assert [(r["dump"], r["raw_line"]) for r in short] == [("sub", '{"id": "1"}'), ("sub", '{"id": "2"}')]
    long = dumps.lines(spark, str(tmp_path), long_windows=True).orderBy("line_no").collect()
    assert [(r["dump"], r["line_no"], r["raw_line"]) for r in long] == [("sub", 0, '{"id": "1"}'), ("sub", 2, '{"id": "2"}')]
    df = spark.createDataFrame([(2, None), (1, "é")], "a int, b string")
    files.write_json_array(df, str(tmp_path / "x" / "out.json"), ["a"])
    assert json.load(open(tmp_path / "x" / "out.json")) == [{"a": 1, "b": "é"}, {"a": 2, "b": None}]
    assert files.read_json_array(spark, str(tmp_path / "x" / "out.json"), "a int, b string").count() == 2
    assert files.read_json_array(spark, str(tmp_path / "no.json"), "a int").count() == 0
    assert files.model_suffix("gpt-5.4-mini") == "gpt_5_4_mini"
    path = files.write_csv(df, str(tmp_path), "runs", "m-1")
    assert spark.read.option("header", True).csv(path).count() == 2
    assert files.load_prompt(" x ") == "x"
    with pytest.raises(ValueError):
        files.load_prompt("  ")
    with pytest.raises(ValueError):
        files.load_prompt(variable="SURELY_NOT_SET")
    with open(tmp_path / "v.yaml", "w") as f:
        f.write("exclude_terms: [dog]\nmedicine_terms:\n  a: [x, y]\n")
    v = vocabulary.load(str(tmp_path / "v.yaml"))
    assert v.excluded == ("dog",) and v.targets == {"a": ("x", "y")} and v.dosing == vocabulary.DOSING
    assert vocabulary.frame(spark, v.targets).count() == 2


def test_stream_of_posts(spark, tmp_path):
    from lodestream.streaming import posts

    src = tmp_path / "in"
    src.mkdir()
    row = {"id": "1", "title": "tylenol", "selftext": "I took 500 mg 3 hours ago", "created_utc": 1_500_000_000}
    (src / "sub.txt").write_text("\n".join(map(json.dumps, [row, row, row | {"id": "2", "title": "x", "selftext": ""}])) + "\n")
    q = posts.posts(posts.lines(spark, str(src)), vocabulary.Vocabulary()).writeStream.format("memory").queryName("kept_posts").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("kept_posts").collect()
    assert [(r["dump"], r["post_id"], r["decidability"]["decidable_axis"]) for r in got] == [("sub", "1", "rolling")]
