"""The registered queries of the core operators, each with its SQL equivalent where SQL can say it."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestream.functions import answers, patterns, text
from lodestream.operators import annotate, classify, clean, evaluate, ingest, label, merge, tags, timeline
from lodestream.plans.runtime import shared_dir, table
from lodestream.sources import dose_rules, dumps, files
from lodestream.sources.vocabulary import Vocabulary

V = Vocabulary()
YEARS = (2013, 2025)
AMOUNT = patterns.ported(r"[0-9]+ ?mg")
PROMPT_HASH = "5d" * 32
MODEL = "gpt-5.4-mini"


def first_copies(spark, d):
    """Posts, of each id the copy that was crawled first."""
    return merge.first_per_partition(table(spark, d, "posts"), "post_id", ["crawl_timestamp", "url"], 1)


def normalize_text(spark, d):
    return clean.normalize(table(spark, d, "posts").select("post_id", "crawl_timestamp", "title", "body")).drop("title", "body")


def vocab_first_match(spark, d):
    p = table(spark, d, "posts")
    both = F.concat(text.filled(F.col("title")), F.lit(" "), text.filled(F.col("body")))
    m = text.first_vocabulary(both, V.target_patterns())
    return p.select(m.alias("m")).where("m is not null").groupBy(F.col("m.name").alias("medicine"), F.lower("m.term").alias("term")).agg(F.count("*").alias("n"))


def vocab_unique_terms(spark, d):
    p = table(spark, d, "posts").select("post_id", "crawl_timestamp", F.array_join(text.unique_matches(text.filled(F.col("clean_text")), AMOUNT), "|").alias("terms"))
    return p.where("terms != ''")


def sentence_units(spark, d):
    p = table(spark, d, "posts").select("post_id", "crawl_timestamp", text.sentence_units(F.col("title"), F.col("body")).alias("u"))
    return p.select("post_id", "crawl_timestamp", F.size("u").cast("bigint").alias("n_units"), F.array_join("u", "|").alias("units"))


def sentence_windows(spark, d):
    p = table(spark, d, "posts").select("post_id", "crawl_timestamp", text.sentence_windows(text.sentence_units(F.col("title"), F.col("body"))).alias("w"))
    return p.select("post_id", "crawl_timestamp", F.size("w").cast("bigint").alias("n_windows"), F.array_join("w", "|").alias("windows"))


def question_windows(spark, d):
    p = table(spark, d, "posts").select("post_id", text.question_windows(text.sentence_units(F.col("title"), F.col("body")), patterns.ported(classify.QUESTION)).alias("w"))
    return p.select("post_id", F.explode("w").alias("w")).select("post_id", "w.question", "w.context")


def post_windows(spark, d):
    p = table(spark, d, "posts").select("post_id", text.post_windows(text.sentence_units(F.col("title"), F.col("body")), patterns.ported(r"\?$")).alias("w"))
    return p.select("post_id", F.explode("w").alias("w")).groupBy("post_id").agg(F.count("*").alias("n_questions"), F.sum(F.length("w.question")).alias("question_chars"), F.max(F.length("w.context")).cast("bigint").alias("context_chars"))


def match_context(spark, d):
    c = text.filled(F.col("clean_text"))
    p = table(spark, d, "posts").select("post_id", "crawl_timestamp", text.match_start(c, r"(?:last|next) dose|another").alias("at"), text.match_context(c, r"(?:last|next) dose|another", 40).alias("context"))
    return p.where("at is not null").select("post_id", "crawl_timestamp", F.col("at").cast("bigint").alias("at"), "context")


def _flags(spark, d):
    return ingest.flagged(table(spark, d, "raw_posts"), V, YEARS)


def ingest_posts(spark, d):
    return ingest.kept(_flags(spark, d)).select("dump", "line_no", "post_id", "subreddit", "title", "body", "url", "created_time", "matched_medicine", F.lower("matched_brand_or_generic").alias("matched_term"))


def ingest_counters(spark, d):
    return ingest.counters(_flags(spark, d))


def dedup_keep_first(spark, d):
    return first_copies(spark, d).select("post_id", "subreddit", "crawl_timestamp")


def clean_counters(spark, d):
    flags = clean.cleaned(clean.normalize(table(spark, d, "posts")), ["subreddit", "post_id"], ["crawl_timestamp", "url"])
    return clean.counters(flags, "subreddit")


def clean_fallbacks(spark, d):
    return clean.with_fallbacks(table(spark, d, "posts")).select("post_id", "crawl_timestamp", "title_clean", "body_clean", "clean_text")


def exclude_gate_cascade(spark, d):
    c = text.filled(F.col("clean_text"))
    anyone = F.lit(False)
    for p in V.other_patterns().values():
        anyone = anyone | c.rlike(p)
    outcome = F.when(c.rlike(patterns.words(V.excluded)), "excluded").when(anyone, "other_medicine").when(text.first_vocabulary(c, V.target_patterns()).isNull(), "no_target").otherwise("candidate")
    return table(spark, d, "posts").groupBy("subreddit", outcome.alias("outcome")).agg(F.count("*").alias("n"))


def axis_tags(spark, d):
    t = tags.tagged(table(spark, d, "posts").select("post_id", "crawl_timestamp", "clean_text"), F.col("clean_text"))
    return t.select("post_id", "crawl_timestamp", "decidability.*")


def axis_counts(spark, d):
    return tags.axis_counts(tags.tagged(table(spark, d, "posts"), F.col("clean_text")), "subreddit")


def merge_union_dedup(spark, d):
    p = tags.tagged(table(spark, d, "posts").select("post_id", "subreddit", "crawl_timestamp", "clean_text"), F.col("clean_text"))
    parts = [p.where("subreddit < 'M'"), p.where("subreddit >= 'M' or subreddit is null")]
    flags = merge.merged(merge.union(parts), F.col("decidability.decidable"), "post_id", ["subreddit", "crawl_timestamp"])
    return merge.merge_counts(flags, "subreddit")


def rollup_with_missing(spark, d):
    counts = table(spark, d, "documents").where("source is not null").groupBy("source").agg(F.count("*").alias("n_documents"), F.sum("n_chars").alias("n_chars"))
    return merge.rollup_with_missing(counts, table(spark, d, "mix_targets"), "source", ["n_documents", "n_chars"])


def missing_partitions(spark, d):
    return merge.missing_partitions(table(spark, d, "mix_targets"), table(spark, d, "documents"), "source")


def long_stats(spark, d):
    return merge.long_stats(ingest_counters(spark, d), "dump", "extract")


def counter_maps(spark, d):
    m = merge.counter_map(table(spark, d, "posts"), "subreddit", "matched_medicine")
    return m.select("subreddit", F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("counts"))


def _classified(spark, d):
    return classify.classified(first_copies(spark, d), keep=["post_id", "subreddit"])


def classifier_cascade(spark, d):
    return _classified(spark, d).select("post_id", "outcome", "evidence.rule_id", "evidence.target_medicine", "evidence.question_text", "decidability.decidable_axis")


def classifier_counts(spark, d):
    return classify.outcome_counts(_classified(spark, d), "subreddit")


def classifier_gates(spark, d):
    """The gate that a post ends at, of those before the rules, and the other medicines that play a role."""
    gate = F.when(F.col("gate").isin("words", "role", "title"), F.col("gate"))
    return _classified(spark, d).select("post_id", gate.alias("gate"), F.when(gate == "role", F.array_join("other_medicines", ",")).alias("names"))


def classifier_summary(spark, d):
    """The counters of the step, and its maps as texts."""
    r = classify.summary(_classified(spark, d), "subreddit")
    maps = [F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias(c) for c in classify.MAPS]
    return r.select(*[c for c in r.columns if c not in classify.MAPS], *maps)


def gate_counts(spark, d):
    """The counters of the step that the gates decide alone."""
    r = classify.summary(_classified(spark, d), "subreddit")
    return r.select("subreddit", "input", "flagged_excluded", (F.col("decidable") + F.col("undecidable") - F.col("candidates")).alias("open"))


def sample_lookup(spark, d):
    """The first candidates of each subreddit that can be decided, with their raw and clean rows by id."""
    p = first_copies(spark, d)
    t = tags.tagged(p, F.col("clean_text")).where("decidability.decidable")
    ids = merge.first_per_partition(t, "subreddit", ["created_time", "post_id"], 5).select("post_id")
    return merge.looked_up(ids, {"raw": p.select("post_id", "title", "body"), "clean": p.select("post_id", "clean_text")}, "post_id").select("post_id", "title", "body", "clean_text")


def targets_present(spark, d):
    p = table(spark, d, "posts")
    names = text.matching_names(text.filled(F.col("clean_text")), {n: patterns.aliases(t) for n, t in V.targets.items()})
    return p.select("post_id", "crawl_timestamp", F.array_join(names, ",").alias("names"))


def alias_matches(spark, d):
    every = [t for terms in V.targets.values() for t in terms]
    m = text.unique_matches(text.filled(F.col("clean_text")), patterns.aliases(every))
    return table(spark, d, "posts").select("post_id", "crawl_timestamp", F.array_join(m, ",").alias("terms"))


def _log(spark, d):
    return table(spark, d, "annotation_log").select(F.col("post_key").alias("key"), F.col("llm_annotation").alias("record"), "seq")


def latest_per_key(spark, d):
    return files.latest(_log(spark, d), "key", ["seq"]).select("key", "seq", "record.status", "record.annotated_at")


def _candidates(spark, d):
    p = table(spark, d, "posts")
    seq = F.xxhash64("post_id")
    return p.select(annotate.record_key(F.col("post_id"), F.col("url"), seq).alias("key"), seq.alias("seq"), annotate.payload(F.col("post_id"), F.col("clean_text")).alias("payload"))




def _last(spark, d):
    return files.latest(_log(spark, d), "key", ["seq"])


def resume_worklist(spark, d):
    return annotate.work_list(_candidates(spark, d), _last(spark, d), MODEL, F.lit(PROMPT_HASH)).select("key")


def reuse_join(spark, d):
    return annotate.joined(_candidates(spark, d).select("key").distinct(), _last(spark, d)).select("key", "record.annotated_at", "record.status", F.length("record.text").cast("bigint").alias("text_chars"))


def annotation_stats(spark, d):
    """Statistics as if the attempts that failed were those of this run."""
    c = _candidates(spark, d).groupBy("key").agg(F.min("seq").alias("seq"))
    failed = _log(spark, d).where("record.status = 'error'")
    return annotate.stats(c, _last(spark, d), failed, MODEL, F.lit(PROMPT_HASH))


def record_keys(spark, d):
    """Keys of posts that lack an id, a URL or both by turns."""
    p = first_copies(spark, d).select("post_id", "url", F.row_number().over(Window.partitionBy("subreddit").orderBy("post_id")).alias("n"))
    lacks = lambda c, k: F.when(F.col("n") % k != 0, F.col(c))
    return p.select("post_id", annotate.record_key(lacks("post_id", 2), lacks("url", 3), F.col("n")).alias("key"))


def payloads(spark, d):
    return first_copies(spark, d).select("post_id", annotate.payload(F.col("post_id"), F.regexp_replace(text.filled(F.col("clean_text")), r"[^A-Za-z0-9 .,?!]", "")).alias("payload"))


def upserted_records(spark, d):
    """Of each key the record of a later half of the log, else that of the earlier half."""
    log = _log(spark, d)
    half = lambda c: files.latest(log.where(c), "key", ["seq"])
    return annotate.upserted(half("seq % 2 = 0"), half("seq % 2 = 1")).select("key", "record.status", "record.annotated_at", "record.attempted_at")


def checkpoint_log(spark, d):
    """The log written in three parts, read back: the last record of each key."""
    path = f"{shared_dir(spark)}/log-{uuid.uuid4().hex}"
    log = _log(spark, d).where("key is not null")
    for i in range(3):
        files.append_log(log.where(F.pmod("seq", F.lit(3)) == i), path)
    return files.read_log(spark, path, annotate.RECORD).select("key", "seq", "record.status", "record.prompt_sha256", "record.usage.total_tokens")


def annotation_run(spark, d):
    """A run of the annotation over all cases with an annotator that fails for some: what each key ends with."""

    def annotator(p):
        if len(p["clean_text"] or "") % 5 == 0:
            raise ValueError("no answer")
        return {"text": f"{len(p['clean_text'])} characters", "usage": {"input_tokens": len(p["clean_text"])}}

    c = table(spark, d, "structured_cases").select(F.col("case_id").cast("string").alias("key"), F.col("case_id").alias("seq"), annotate.payload(F.col("case_id").cast("string"), F.col("question_text")).alias("payload"))
    none = spark.createDataFrame([], f"key string, record {annotate.RECORD}")
    out = annotate.run(c, none, f"{shared_dir(spark)}/run-{uuid.uuid4().hex}", annotator, MODEL, "prompt", "2024-01-01T00:00:00+00:00", chunk=5000, max_failures=1 << 30)
    return annotate.results(c, out).select("key", "record.status", "record.text", "record.error", "record.usage.input_tokens")


def json_array_roundtrip(spark, d):
    path = f"{shared_dir(spark)}/cases-{uuid.uuid4().hex}.json"
    files.write_json_array(table(spark, d, "structured_cases"), path, ["case_id"])
    return files.read_cases(spark, path)


def csv_roundtrip(spark, d):
    t = table(spark, d, "structured_cases").select("case_id", "drug_focus", F.length("question_text").alias("chars"))
    path = files.write_csv(t, f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}", "cases", MODEL)
    return spark.read.schema("case_id int, drug_focus string, chars int").option("header", True).csv(path)


def dump_lines(spark, d):
    """Raw lines written as dumps, one folder for each, and read back: how often each occurs."""
    path = f"{shared_dir(spark)}/dumps-{uuid.uuid4().hex}"
    raw = table(spark, d, "raw_posts").where(F.col("raw_line").isNotNull() & ~F.col("raw_line").rlike(r"[\r\n]"))
    raw.select("raw_line").write.option("compression", "gzip").text(path)
    return dumps.lines(spark, path).groupBy("raw_line").agg(F.count("*").alias("n"))


def sheet_labels(spark, d):
    """A sheet of cases of which a range is labelled anew and written back."""
    c = table(spark, d, "structured_cases").select(F.col("case_id").alias("sheet_row"), F.col("question_text").alias("question"), F.col("drug_focus").alias("label"))
    part = files.sheet_range(c, 100, 100_000)
    return label.written_back(c, part.select("sheet_row", label.keyword_label(F.col("question")).alias("label"))).select("sheet_row", "label")


def dose_interpretations(spark, d):
    """The strength that a post names, if any, read with every product that fits: least and most mg of two units."""
    c = text.filled(F.col("clean_text"))
    mg = F.nullif(F.regexp_extract(c, r"(?i)\b([0-9]{1,5}) ?mg\b", 1), F.lit("")).cast("int")
    doses = first_copies(spark, d).select("post_id", F.col("matched_medicine").alias("ingredient"), mg.alias("strength_mg"), F.lit(2).alias("units"))
    return timeline.interpretations(doses, timeline.profiles(spark)).groupBy("post_id").agg(F.min("dose_mg").alias("least_mg"), F.max("dose_mg").alias("most_mg"), F.count("*").alias("n_profiles"))


def axis_categories(spark, d):
    """The first of several flags that holds, by priority."""
    t = tags.tagged(first_copies(spark, d), F.col("clean_text"))
    f = {n: F.col(f"decidability.{n}") for n in ("has_strength", "has_amount", "has_time", "has_prior_dose")}
    return t.select("post_id", timeline.categories(f, "none").alias("category"))


def prompt_hashes(spark, d):
    return table(spark, d, "structured_cases").select("case_id", annotate.prompt_hash(F.trim("question_text")).alias("prompt_sha256"))


def prompts(spark, d):
    p = evaluate.prompt("Drug focus: {drug_focus}\nQuestion: {question_text}\nAnswer as JSON.", {"drug_focus": F.col("drug_focus"), "question_text": F.col("question_text")})
    return table(spark, d, "structured_cases").select("case_id", p.alias("prompt"))


def runs_cross(spark, d):
    return evaluate.runs_of(table(spark, d, "structured_cases").select("case_id", "drug_focus"), 5)


def _runs(spark, d):
    """Each run once, with its smallest raw output; runs of several models are ordered by run and model."""
    w = Window.partitionBy("case_id", "model", "run_id").orderBy(F.col("raw_output").asc_nulls_last())
    r = table(spark, d, "confidence_runs_gpt_5_4_mini").withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return r.withColumn("run_key", F.format_string("%010d|%s", "run_id", "model"))


def majority_vote(spark, d):
    s = evaluate.case_summary(_runs(spark, d), run="run_key")
    return s.select(*[c for c in s.columns if c not in ("agreement", *evaluate.MEANS.values())], F.round("agreement", 9).alias("agreement"), *[F.round(m, 6).alias(m) for m in evaluate.MEANS.values()])


def _scored(spark, d):
    """Three weights of each run, of recorded scores; null where a score is, and all 0 where the margin is least."""
    c = lambda x: F.col(f"decision_{x}")
    zero = c("margin") < 0.05
    w = {"p_yes": c("confidence"), "p_no": c("entropy") - 0.5, "p_ambiguous": c("margin") - 0.5}
    return _runs(spark, d).withColumns({k: F.when(zero, F.lit(0.0)).otherwise(v) for k, v in w.items()})


def run_rows(spark, d):
    r = evaluate.run_rows(_scored(spark, d))
    scores = ["decision_confidence", "decision_entropy", "decision_margin"]
    return r.select(*[c for c in r.columns if c not in (*scores, "raw_output", "question_text")], *[F.round(c, 6).alias(c) for c in scores])


def noisy_json_extract(spark, d):
    r = evaluate.parsed_runs(_runs(spark, d))
    return r.select("case_id", "model", "run_id", "decision", "confidence", "status", "right")


def prob_entropy_margin(spark, d):
    p = answers.probability_scores(F.col("p_yes"), F.col("p_no"), F.col("p_ambiguous"))
    r = _scored(spark, d).select("case_id", "model", "run_id", p.alias("p")).select("case_id", "model", "run_id", "p.*")
    return r.select("case_id", "model", "run_id", "decision", *[F.round(c, 6).alias(c) for c in ("confidence", "margin", "entropy", "normalized_entropy")])


def label_histogram(spark, d):
    return label.histogram(_runs(spark, d), ["model", "parse_status"])


def keyword_labels(spark, d):
    return table(spark, d, "structured_cases").select("case_id", label.keyword_label(F.col("question_text")).alias("label"))


def previous_labels(spark, d):
    c = table(spark, d, "structured_cases").select(F.col("case_id").alias("sheet_row"), F.col("question_text").alias("question"), "drug_focus", "gold_answer")
    earlier = c.where("gold_answer is not null").withColumn("label", F.col("drug_focus"))
    return label.labelled(c.select("sheet_row", "question"), earlier).select("sheet_row", "label", "source")


def completeness_check(spark, d):
    """Cases against the range they should fill, one in ten of them moved out of it."""
    c = table(spark, d, "structured_cases")
    n = c.count()
    moved = c.select(F.when(F.col("case_id") % 10 == 3, F.col("case_id") + 10_000_000).otherwise(F.col("case_id")).alias("case_id"))
    return label.row_gaps(moved, "case_id", 1, n)


def unchanged_check(spark, d):
    """Questions of cases against those of their runs, in which every seventh case's is changed."""
    runs = _runs(spark, d).groupBy("case_id").agg(F.max("question_text").alias("question_text"))
    edited = runs.withColumn("question_text", F.when(F.col("case_id") % 7 == 0, F.concat("question_text", F.lit(" (edited)"))).otherwise(F.col("question_text")))
    return label.changed(table(spark, d, "structured_cases"), edited, "case_id", "question_text")


def blank_fields(spark, d):
    return label.blank(table(spark, d, "posts"), "body_clean").select("post_id", "crawl_timestamp")


def error_cells(spark, d):
    """Cells with formula errors, in a sheet of the cases in which some cells became one."""
    c = table(spark, d, "structured_cases").select("case_id", F.when(F.col("case_id") % 31 == 0, "#REF!").otherwise(F.col("question_text")).alias("question_text"), F.when(F.col("case_id") % 47 == 0, F.concat(F.lit("="), F.lit("#DIV/0!"))).otherwise(F.col("drug_focus")).alias("drug_focus"))
    return label.error_cells(c, "case_id", ["question_text", "drug_focus"])


def topn_per_partition(spark, d):
    return merge.first_per_partition(first_copies(spark, d), "subreddit", ["created_time", "post_id"], 10).select("subreddit", "post_id", "created_time")


def sampled_cases(spark, d):
    t = tags.tagged(first_copies(spark, d), F.col("clean_text")).where("decidability.decidable")
    return merge.first_per_partition(t, "subreddit", ["created_time", "post_id"], 5).select(F.concat_ws("_", "subreddit", "post_id").alias("case_id"), F.col("clean_text").alias("cleaned_text"))


def date_range_counts(spark, d):
    e = table(spark, d, "events").where(F.col("ts").between(F.to_timestamp_ntz(F.lit("2024-01-05 00:00:00")), F.to_timestamp_ntz(F.lit("2024-01-20 23:59:59"))))
    return e.groupBy("event_type").agg(F.count("*").alias("n"))


def rolling_24h(spark, d):
    return timeline.rolling(table(spark, d, "events"), ["user_id"], "ts", "value").select("event_id", F.round("rolling_total", 4).alias("rolling_total"))


def since_last(spark, d):
    return timeline.since_last(table(spark, d, "events"), ["user_id"], "ts", "event_id").select("event_id", F.round("hours_since_last", 6).alias("hours_since_last"))


def as_of_value(spark, d):
    e = table(spark, d, "events")
    kinds = sorted(r[0] for r in e.select("event_type").distinct().collect())  # the kinds of events
    left = e.where(F.col("event_type") == kinds[0]).select("event_id", "user_id", "ts")
    right = e.where(F.col("event_type") == kinds[-1]).groupBy("user_id", "ts").agg(F.max("value").alias("value"))
    return timeline.as_of(left, right, ["user_id"], "ts", "ts", "value").select("event_id", "last_value")


def context_frame(spark, d):
    return merge.trailing_frame(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type", bucket=F.to_date("ts")).select("event_id", "context")


def run_collapse(spark, d):
    return merge.consecutive_runs(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "event_type", F.to_date("ts")).select("event_id", "user_id", "event_type")


def invariant_decisions(spark, d):
    """Per user and day, whether a limit on the rolling total holds under two readings of the values."""
    r = timeline.rolling(table(spark, d, "events"), ["user_id"], "ts", "value").select("user_id", F.col("rolling_total").alias("t"))
    both = r.select("user_id", F.explode(F.array(F.col("t") <= 400.0, F.col("t") * 1.5 <= 400.0)).alias("holds"))
    return timeline.decided(both, "user_id")


QUERIES = {
    f.__name__: f
    for f in (
        vocab_first_match, normalize_text, vocab_unique_terms, sentence_units, sentence_windows, question_windows, post_windows, match_context, ingest_posts, ingest_counters, dedup_keep_first, clean_counters, clean_fallbacks,
        exclude_gate_cascade, axis_tags, axis_counts, merge_union_dedup, rollup_with_missing, missing_partitions, long_stats, counter_maps, classifier_cascade, classifier_counts, latest_per_key, resume_worklist, reuse_join,
        annotation_stats, prompt_hashes, prompts, runs_cross, majority_vote, noisy_json_extract, prob_entropy_margin, label_histogram, keyword_labels, previous_labels, completeness_check, unchanged_check, blank_fields,
        error_cells, classifier_gates, classifier_summary, gate_counts, sample_lookup, targets_present, alias_matches, record_keys, payloads, upserted_records, checkpoint_log, annotation_run,
        json_array_roundtrip, csv_roundtrip, dump_lines, sheet_labels, dose_interpretations, axis_categories, run_rows, topn_per_partition, sampled_cases, date_range_counts, rolling_24h, since_last, as_of_value, context_frame, run_collapse, invariant_decisions,
    )
}

# ---- the same in SQL --------------------------------------------------------------------------------

_WS = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_NWS = _WS.replace("[", "[^", 1)
_WORDCHAR = r"[\p{L}\p{M}\p{N}_]"


def _norm(e: str) -> str:
    e = f"coalesce({e}, '')"
    e = rf"regexp_replace({e}, '(?i)\[([^\]]+)\]\([^)]*\)', '\1', 'g')"
    e = f"regexp_replace({e}, '(?i)https?://{_NWS}+', ' ', 'g')"
    return f"trim(regexp_replace({e}, '{_WS}+', ' ', 'g'))"


def _q(s: str) -> str:
    return s.replace("'", "''")


def _any(terms) -> str:
    """Whole words in RE2, whose own boundaries only know ASCII."""
    alt = "|".join(patterns._quoted(t) for t in terms)
    return _q(rf"(?i)(?:^|[^\p{{L}}\p{{M}}\p{{N}}_])({alt})(?:$|[^\p{{L}}\p{{M}}\p{{N}}_])")


def _re2(source: str) -> str:
    return _q("(?i)" + source.replace(r"\s", _WS))


def _ascii(terms) -> str:
    """Any of the terms, longest first, not next to an ASCII letter or digit: a boundary of RE2, but for underscores."""
    return "(?:" + "|".join(patterns._quoted(t) for t in patterns.longest_first(terms)) + ")"


_FIRST = "(select * from (select *, row_number() over (partition by post_id order by crawl_timestamp, url) as _n from posts) where _n = 1)"
_BOTH = "coalesce(title, '') || ' ' || coalesce(body, '')"
_UNITS = rf"""list_filter(list_transform(list_concat([coalesce(title, '')], string_split(regexp_replace(regexp_replace(coalesce(body, ''), '([.!?]){_WS}+', '\1' || chr(1), 'g'), '\n+', chr(1), 'g'), chr(1))),
    lambda x: regexp_replace(regexp_replace(x, '^{_WS}+', ''), '{_WS}+$', '')), lambda x: x <> '')"""


def _medicine(e: str) -> str:
    return "case " + " ".join(f"when regexp_matches({e}, '{_any(t)}') then '{n}'" for n, t in V.targets.items()) + " end"


def _term(e: str) -> str:
    return "case " + " ".join(f"when regexp_matches({e}, '{_any(t)}') then lower(regexp_extract({e}, '{_any(t)}', 1))" for n, t in V.targets.items()) + " end"


_TAGS = {n: f"regexp_matches(coalesce(clean_text, ''), '{_re2(p)}')" for n, p in tags.PATTERNS.items()}
_AXIS = "case when has_prior_dose and has_time and has_amount then 'rolling' when has_prior_dose and has_time then 'interval' when proposed_amount_stated then 'single_dose' end"
_TAGGED = f"(select *, {_AXIS} as decidable_axis from (select *, {', '.join(f'{e} as {n}' for n, e in _TAGS.items())} from posts))"
_LOW, _HIGH = ingest.year_bounds(*YEARS)
_RAW = f"""(select *, case when not ok then 'bad_json' when created is null then 'bad_time' when created not between {_LOW} and {_HIGH} then 'skipped_date'
      when medicine is null then 'skipped_medicine' else 'kept' end as outcome
   from (select *, {_medicine("b")} as medicine, {_term("b")} as term from (select *, title || ' ' || body as b from (
     select dump, line_no, j is not null as ok, j,
       case when j is null then null when not json_exists(j, '$.created_utc') then 0
            when json_type(j, '$.created_utc') = 'DOUBLE' then try_cast(trunc(cast(json_extract_string(j, '$.created_utc') as double)) as bigint)
            when json_type(j, '$.created_utc') in ('UBIGINT', 'BIGINT') then try_cast(json_extract_string(j, '$.created_utc') as bigint)
            when json_type(j, '$.created_utc') = 'BOOLEAN' then cast(json_extract_string(j, '$.created_utc') = 'true' as bigint)
            when json_type(j, '$.created_utc') = 'VARCHAR' and regexp_full_match(trim(json_extract_string(j, '$.created_utc')), '[+-]?[0-9]+') then try_cast(trim(json_extract_string(j, '$.created_utc')) as bigint) end as created,
       coalesce(json_extract_string(j, '$.title'), '') as title, coalesce(json_extract_string(j, '$.selftext'), '') as body,
       case when json_exists(j, '$.subreddit') then json_extract_string(j, '$.subreddit') else dump end as subreddit,
       case when json_exists(j, '$.id') then json_extract_string(j, '$.id') else '' end as post_id,
       nullif(json_extract_string(j, '$.url'), '') as own_url, nullif(json_extract_string(j, '$.permalink'), '') as link
     from (select dump, line_no, case when json_valid(raw_line) then case when json_type(raw_line) = 'OBJECT' then cast(raw_line as json) end end as j from raw_posts)))))"""
_COUNTERS = f"select dump, count(*) as total, {', '.join(f'count(*) filter (outcome = {chr(39)}{x}{chr(39)}) as {x}' for x in ('skipped_date', 'skipped_medicine', 'kept', 'bad_json', 'bad_time'))} from {_RAW} group by dump"
_LATEST = "(select post_key as key, seq, llm_annotation as record from (select *, row_number() over (partition by post_key order by seq desc) as _n from annotation_log where post_key is not null) where _n = 1)"
_KEYS = "(select distinct coalesce(nullif(post_id, ''), nullif(url, '')) as key from posts)"
_OK = f"(record.status = 'completed' and record.requested_model = '{MODEL}' and record.prompt_sha256 = '{PROMPT_HASH}')"
_DISTINCT_RUNS = "(select * from (select *, row_number() over (partition by case_id, model, run_id order by raw_output) as _n, printf('%010d|%s', run_id, model) as run_key from confidence_runs_gpt_5_4_mini) where _n = 1)"
_OBJECT = r"""(select *, case when json_valid(trim(raw_output)) and json_type(trim(raw_output)) = 'OBJECT' then trim(raw_output)
    when json_valid(regexp_extract(raw_output, '(?s)[{].*[}]')) then regexp_extract(raw_output, '(?s)[{].*[}]') end as o from """ + _DISTINCT_RUNS + ")"
_PARTS = {n: dose_rules.expanded(p, dose_rules.PARTS) for n, p in dose_rules.PARTS.items()}
_CLEANED = "(select post_id, subreddit, coalesce(title_clean, title, '') as title, coalesce(body_clean, body, '') as body, case when coalesce(clean_text, '') = '' then coalesce(title_clean, title, '') || ' ' || coalesce(body_clean, body, '') else clean_text end as c from " + _FIRST + ")"
_QUESTION = _re2(_PARTS["QUESTION"].replace("(?=", "(?:"))
_BREAK = r"[^\p{L}\p{M}\p{N}_]"


def _window_list(source: str) -> str:
    """(post_id, question, context) of the questions of posts, with the units around them."""
    return f"""(select post_id, case when i = 1 then left(q, 650) else right(q, 650) end as question, case when i = 1 then left(array_to_string(u[1:3], ' '), 650) else right(array_to_string(u[greatest(1, i - 2):i], ' '), 650) end as context
      from (select post_id, u, unnest(u) as q, unnest(range(1, len(u) + 1)) as i from (select post_id, {_UNITS} as u from {source})) where regexp_matches(q, '{_QUESTION}'))"""


def _role(terms) -> str:
    """Another medicine after a verb within 120 characters, or within 100 of the wording of a switch."""
    name = "(?:" + "|".join(patterns._quoted(t) for t in terms) + ")"
    n = _BREAK
    gap = lambda least: f"{n}(?:.{{0,{least}}}{n})?"  # noqa: E731  # at least one character, none of a word at its ends
    verbs = {4: "took|used", 5: "taken", 9: "swallowed", 8: "ingested", 3: "had"}
    words = {6: "switch", 9: "switching|combining|replacing", 7: "replace|combine", 10: "substitute|instead of|mixed with", 12: "substituting", 8: "mix with", 11: "mixing with"}
    before = [f"(?:^|{n})(?:{w}){gap(118 - k)}{name}(?:$|{n})" for k, w in verbs.items()] + [f"(?:^|{n})(?:{w}){gap(98 - k)}{name}(?:$|{n})" for k, w in words.items()]
    after = [f"(?:^|{n}){name}{gap(98 - k)}(?:{w})(?:$|{n})" for k, w in words.items()]
    return " or ".join(f"regexp_matches(context, '{_q('(?is)' + p)}')" for p in before + after)


def _excluded(e: str) -> str:
    both = " and ".join(f"regexp_matches({e}, '{_q('(?i)(?:^|[^A-Za-z0-9])' + _ascii(t) + '(?:$|[^A-Za-z0-9])')}')" for t in V.targets.values())
    m = lambda n: f"regexp_matches({e}, '{_re2(_PARTS[n])}')"
    return f"({m('EXCLUDED_INTENT')} or {m('TRANSITION')} and not ({both} and ({m('REPLACEMENT')} or {m('COMBINATION')} and {m('TIMING')})))"


_ANY_TARGET = _q("(?i)(?:^|[^A-Za-z0-9])" + _ascii([x for t in V.targets.values() for x in t]) + "(?:$|[^A-Za-z0-9])")
_ROLES = f"""(select post_id, string_agg(distinct name, ',' order by name) as names from (select post_id, unnest(list_filter([{', '.join(f"case when regexp_matches(question, '{_any(t)}') or {_role(t)} then '{n}' end" for n, t in V.others.items())}], lambda x: x is not null)) as name
   from {_window_list(_CLEANED)} where regexp_matches(context, '{_ANY_TARGET}')) group by post_id)"""
_GATES = f"(select p.post_id, p.subreddit, case when regexp_matches(c, '{_any(V.excluded)}') then 'words' when names is not null then 'role' when {_excluded('title')} then 'title' end as gate, names from {_CLEANED} p left join {_ROLES} r on p.post_id = r.post_id)"
_WEIGHTS = f"(select *, case when decision_margin < 0.05 then 0 else decision_confidence end as p_yes, case when decision_margin < 0.05 then 0 else decision_entropy - 0.5 end as p_no, case when decision_margin < 0.05 then 0 else decision_margin - 0.5 end as p_ambiguous from {_DISTINCT_RUNS})"
_SHARES = f"""(select *, case when y is null then null when y >= n and y >= a then 'YES' when n >= a then 'NO' else 'AMBIGUOUS' end as best, list_reverse_sort([y, n, a]) as l, -(y * ln(y + 1e-12) + n * ln(n + 1e-12) + a * ln(a + 1e-12)) as h
   from (select case_id, model, run_id, case when z > 0 then y0 / z end as y, case when z > 0 then n0 / z end as n, case when z > 0 then a0 / z end as a
     from (select *, y0 + n0 + a0 as z from (select case_id, model, run_id, greatest(0, p_yes) as y0, greatest(0, p_no) as n0, greatest(0, p_ambiguous) as a0 from {_WEIGHTS}))))"""
_CASE = "from structured_cases"
_SOURCES = list(label.SOURCES.items())
_LABEL = "case " + f"when regexp_matches(q, '(?i)\\b(?:{_SOURCES[0][1]})\\b') and regexp_matches(q, '(?i)\\b(?:{_SOURCES[1][1]})\\b') then '{_SOURCES[0][0]}_{_SOURCES[1][0]}' " + " ".join(f"when regexp_matches(q, '(?i)\\b(?:{p})\\b') then '{n}'" for n, p in _SOURCES) + f" else '{label.REVIEW}' end"

ORACLES = {
    "vocab_first_match": f"select medicine, term, count(*) as n from (select {_medicine('b')} as medicine, {_term('b')} as term from (select {_BOTH} as b from posts)) where medicine is not null group by 1, 2",
    "normalize_text": f"select post_id, crawl_timestamp, title_clean, body_clean, {_norm(chr(34) + 'title_clean' + chr(34) + ' || ' + chr(39) + ' ' + chr(39) + ' || ' + chr(34) + 'body_clean' + chr(34))} as clean_text from (select post_id, crawl_timestamp, {_norm('title')} as title_clean, {_norm('body')} as body_clean from posts)",
    "vocab_unique_terms": "select * from (select post_id, crawl_timestamp, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '|') as terms from (select post_id, crawl_timestamp, list_transform(regexp_extract_all(coalesce(clean_text, ''), '(?i)[0-9]+ ?mg'), lambda x: lower(x)) as l from posts)) where terms <> ''",
    "sentence_units": f"select post_id, crawl_timestamp, len(u) as n_units, coalesce(array_to_string(u, '|'), '') as units from (select post_id, crawl_timestamp, {_UNITS} as u from posts)",
    "sentence_windows": f"select post_id, crawl_timestamp, len(w) as n_windows, coalesce(array_to_string(w, '|'), '') as windows from (select post_id, crawl_timestamp, list_filter(l, lambda x, i: list_position(l, x) = i) as w from (select post_id, crawl_timestamp, list_transform(u, lambda x, i: case when i = len(u) then x else x || case when regexp_matches(x, '[.!?]\\s*$') then ' ' else '. ' end || u[i + 1] end) as l from (select post_id, crawl_timestamp, {_UNITS} as u from posts)))",
    "post_windows": f"select post_id, count(*) as n_questions, cast(sum(length(q)) as bigint) as question_chars, max(length(c)) as context_chars from (select post_id, array_to_string(u, ' ') as c, unnest(list_filter(u, lambda x: regexp_matches(x, '\\?$'))) as q from (select post_id, {_UNITS} as u from posts)) group by post_id",
    "match_context": "select post_id, crawl_timestamp, p as \"at\", trim(substring(c, greatest(p - 40, 0) + 1, p + length(m) + 40 - greatest(p - 40, 0))) as context from (select *, length(regexp_extract(c, '(?is)^(.*?)(?:(?:last|next) dose|another)', 1)) as p, regexp_extract(c, '(?i)(?:last|next) dose|another') as m from (select post_id, crawl_timestamp, coalesce(clean_text, '') as c from posts) where regexp_matches(c, '(?i)(?:last|next) dose|another'))",
    "ingest_posts": f"select dump, line_no, post_id, subreddit, title, body, coalesce(own_url, '{ingest.FORUM}' || link, '{ingest.FORUM}/r/' || coalesce(subreddit, 'null') || '/comments/' || coalesce(post_id, 'null')) as url, strftime(make_timestamp(created * 1000000), '%Y-%m-%dT%H:%M:%S+00:00') as created_time, medicine as matched_medicine, term as matched_term from {_RAW} where outcome = 'kept'",
    "ingest_counters": _COUNTERS,
    "dedup_keep_first": f"select post_id, subreddit, crawl_timestamp from {_FIRST}",
    "clean_counters": f"select subreddit, count(*) as input, count(*) filter (n > 1) as duplicates, count(*) filter (n = 1 and c = '') as dropped_empty, count(*) filter (n = 1 and c <> '') as kept from (select subreddit, case when post_id = '' then 1 else row_number() over (partition by subreddit, post_id order by crawl_timestamp, url) end as n, {_norm('title')} || {_norm('body')} as c from posts) group by subreddit",
    "clean_fallbacks": "select post_id, crawl_timestamp, coalesce(title_clean, title, '') as title_clean, coalesce(body_clean, body, '') as body_clean, case when coalesce(clean_text, '') = '' then coalesce(title_clean, title, '') || ' ' || coalesce(body_clean, body, '') else clean_text end as clean_text from posts",
    "exclude_gate_cascade": f"select subreddit, outcome, count(*) as n from (select subreddit, case when regexp_matches(c, '{_any(V.excluded)}') then 'excluded' when regexp_matches(c, '{_any([x for t in V.others.values() for x in t])}') then 'other_medicine' when regexp_matches(c, '{_any([x for t in V.targets.values() for x in t])}') then 'candidate' else 'no_target' end as outcome from (select subreddit, coalesce(clean_text, '') as c from posts)) group by 1, 2",
    "axis_tags": f"select post_id, crawl_timestamp, {', '.join(_TAGS)}, decidable_axis, decidable_axis is not null as decidable from {_TAGGED}",
    "axis_counts": f"select subreddit, decidable_axis, count(*) as n from {_TAGGED} group by 1, 2",
    "merge_union_dedup": f"select subreddit, count(*) filter (n = 1) as kept, count(*) filter (n > 1) as duplicates, count(*) filter (n is null) as skipped from (select subreddit, case when decidable_axis is not null then row_number() over (partition by post_id, decidable_axis is not null order by subreddit, crawl_timestamp) end as n from {_TAGGED}) group by 1",
    "rollup_with_missing": "with c as (select source, count(*) as n_documents, cast(sum(n_chars) as bigint) as n_chars from documents where source is not null group by 1), e as (select s.source, coalesce(n_documents, 0) as n_documents, coalesce(n_chars, 0) as n_chars, c.source is null as missing from (select distinct source from mix_targets) s left join c on s.source = c.source) select * from e union all select null, cast(sum(n_documents) as bigint), cast(sum(n_chars) as bigint), bool_or(missing) from e",
    "missing_partitions": "select distinct source from mix_targets where source not in (select source from documents where source is not null)",
    "long_stats": f"select dump, 'extract' as step, metric, value from (unpivot ({_COUNTERS}) on total, skipped_date, skipped_medicine, kept, bad_json, bad_time into name metric value value)",
    "counter_maps": "select subreddit, string_agg(matched_medicine || '=' || n, ',' order by matched_medicine) as counts from (select subreddit, matched_medicine, count(*) as n from posts where matched_medicine is not null group by 1, 2) group by 1",
    "latest_per_key": f"select key, seq, record.status as status, record.annotated_at as annotated_at from {_LATEST}",
    "resume_worklist": f"select key from {_KEYS} where key not in (select key from {_LATEST} where {_OK})",
    "reuse_join": f"select l.key, record.annotated_at as annotated_at, record.status as status, length(record.text) as text_chars from {_LATEST} l join {_KEYS} k on l.key = k.key",
    "question_windows": f"select post_id, question, context from {_window_list('posts')}",
    "classifier_gates": f"select post_id, gate, case when gate = 'role' then names end as names from {_GATES}",
    "gate_counts": f"select subreddit, count(*) as input, count(*) filter (gate = 'words') as flagged_excluded, cast(0 as bigint) as open from {_GATES} group by 1",
    "sample_lookup": f"select post_id, title, body, clean_text from (select *, row_number() over (partition by subreddit order by created_time, post_id) as _k from (select *, {_AXIS} as decidable_axis from (select *, {', '.join(f'{e} as {n}' for n, e in _TAGS.items())} from {_FIRST})) where decidable_axis is not null) where _k <= 5",
    "targets_present": f"select post_id, crawl_timestamp, array_to_string(list_filter([{', '.join(f'case when regexp_matches(c, {chr(39)}(?i)(?:^|[^A-Za-z0-9]){_ascii(t)}(?:$|[^A-Za-z0-9]){chr(39)}) then {chr(39)}{n}{chr(39)} end' for n, t in V.targets.items())}], lambda x: x is not null), ',') as names from (select post_id, crawl_timestamp, coalesce(clean_text, '') as c from posts)",
    "alias_matches": f"select post_id, crawl_timestamp, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ',') as terms from (select post_id, crawl_timestamp, list_transform(regexp_extract_all(coalesce(clean_text, ''), '(?i)\\b{_ascii([x for t in V.targets.values() for x in t])}\\b'), lambda x: lower(x)) as l from posts)",
    "record_keys": f"select post_id, coalesce(case when n % 2 <> 0 then nullif(post_id, '') end, case when n % 3 <> 0 then nullif(url, '') end, 'index:' || n) as key from (select *, row_number() over (partition by subreddit order by post_id) as n from {_FIRST})",
    "payloads": f"select post_id, '{{' || '\"post_id\":\"' || post_id || '\",\"clean_text\":\"' || regexp_replace(coalesce(clean_text, ''), '[^A-Za-z0-9 .,?!]', '', 'g') || '\"' || '}}' as payload from {_FIRST}",
    "upserted_records": "select key, record.status as status, record.annotated_at as annotated_at, record.attempted_at as attempted_at from (select post_key as key, llm_annotation as record, row_number() over (partition by post_key order by seq % 2 desc, seq desc) as n from annotation_log where post_key is not null) where n = 1",
    "checkpoint_log": f"select key, seq, record.status as status, record.prompt_sha256 as prompt_sha256, record.usage.total_tokens as total_tokens from {_LATEST}",
    "annotation_run": f"select cast(case_id as varchar) as key, case when n % 5 = 0 then 'error' else 'completed' end as status, case when n % 5 <> 0 then n || ' characters' end as text, case when n % 5 = 0 then 'ValueError: no answer' end as error, case when n % 5 <> 0 then cast(n as integer) end as input_tokens from (select case_id, length(coalesce(question_text, '')) as n {_CASE})",
    "json_array_roundtrip": f"select case_id, drug_focus, question_text, gold_answer, error_category {_CASE}",
    "csv_roundtrip": f"select case_id, drug_focus, cast(length(question_text) as integer) as chars {_CASE}",
    "dump_lines": f"select l as raw_line, count(*) as n from (select regexp_replace(regexp_replace(raw_line, '^{_WS}+', ''), '{_WS}+$', '') as l from raw_posts where raw_line is not null and not regexp_matches(raw_line, '[\\r\\n]')) where l <> '' group by 1",
    "sheet_labels": f"select case_id as sheet_row, case when case_id between 100 and 100000 then {_LABEL} else drug_focus end as label from (select *, coalesce(question_text, '') as q {_CASE})",
    "dose_interpretations": f"with p as (select * from (values {', '.join(f"('{i}', {mg})" for _, i, mg, *_ in timeline.PROFILES)}) t(ingredient, mg)), d as (select post_id, matched_medicine, try_cast(nullif(regexp_extract(coalesce(clean_text, ''), '(?i)\\b([0-9]{{1,5}}) ?mg\\b', 1), '') as integer) as strength from {_FIRST}) select post_id, min(2 * mg) as least_mg, max(2 * mg) as most_mg, count(*) as n_profiles from d join p on d.matched_medicine = p.ingredient and (strength is null or strength = mg) group by 1",
    "axis_categories": f"select post_id, case when has_strength then 'has_strength' when has_amount then 'has_amount' when has_time then 'has_time' when has_prior_dose then 'has_prior_dose' else 'none' end as category from (select *, {', '.join(f'{e} as {n}' for n, e in _TAGS.items())} from {_FIRST})",
    "annotation_stats": f"""select count(*) as input, count(*) filter (record.status = 'completed') as completed, count(*) filter (record.status = 'error') as errors, count(*) filter (record.status is distinct from 'completed') as remaining, count(*) filter ({_OK} and t.key is null) as reused,
      (select count(*) from annotation_log where llm_annotation.status = 'error') as attempted, (select count(*) from annotation_log where llm_annotation.status = 'error') as failed from {_KEYS} k left join {_LATEST} l on l.key = k.key left join (select distinct post_key as key from annotation_log where llm_annotation.status = 'error') t on t.key = k.key""",
    "prompt_hashes": "select case_id, sha256(trim(question_text)) as prompt_sha256 from structured_cases",
    "prompts": "select case_id, 'Drug focus: ' || coalesce(drug_focus, '') || chr(10) || 'Question: ' || coalesce(question_text, '') || chr(10) || 'Answer as JSON.' as prompt from structured_cases",
    "runs_cross": "select case_id, drug_focus, cast(r as integer) as run_id from structured_cases, range(1, 6) t(r)",
    "majority_vote": f"""with r as (select *, coalesce(parsed_decision, 'INVALID') as d from {_DISTINCT_RUNS}), v as (select case_id, d, count(*) as n, min(run_key) as f from r where d <> 'INVALID' group by 1, 2),
      m as (select case_id, arg_min(d, row(-n, f)) as majority, max(n) as top, sum(n) as valid from v group by 1),
      c as (select case_id, arg_min(row(drug_focus, question_text, gold_answer, error_category), run_key) as a, round(avg(decision_confidence), 6) as avg_decision_confidence, round(avg(decision_entropy), 6) as avg_decision_entropy, round(avg(decision_margin), 6) as avg_decision_margin, round(avg(reasoning_avg_logprob), 6) as avg_reasoning_avg_logprob, round(avg(reasoning_perplexity_like), 6) as avg_reasoning_perplexity_like, count(*) as num_runs from r group by 1)
      select c.case_id, a[1] as drug_focus, a[2] as question_text, a[3] as gold_answer, a[4] as error_category, coalesce(majority, 'INVALID') as majority_decision, round(coalesce(top / valid, 0.0), 9) as agreement,
        case when coalesce(top / valid, 0.0) = 1.0 then 2 when coalesce(top / valid, 0.0) >= 0.6 then 1 else 0 end as consistency_score, avg_decision_confidence, avg_decision_entropy, avg_decision_margin, avg_reasoning_avg_logprob, avg_reasoning_perplexity_like, cast(null as integer) as manual_verifiability_score, cast(null as varchar) as manual_error_type, num_runs,
        case when coalesce(majority, 'INVALID') = a[3] then 1 else 0 end as majority_correct from c left join m on c.case_id = m.case_id""",
    "run_rows": f"""select p.case_id, p.run_id, p.model, drug_focus, gold_answer, error_category, case when decision <> 'INVALID' then 'valid' else 'invalid_json_schema' end as parse_status, decision as parsed_decision, case when p.n between 1 and 10 then cast(p.n as integer) end as parsed_verbal_confidence,
      round(l[1], 6) as decision_confidence, round(h, 6) as decision_entropy, round(l[1] - l[2], 6) as decision_margin, cast(null as double) as reasoning_avg_logprob, cast(null as double) as reasoning_perplexity_like, decision is not distinct from gold_answer as is_correct
      from (select *, case upper(trim(json_extract_string(o, '$.decision'))) when 'A' then 'YES' when 'B' then 'NO' when 'C' then 'AMBIGUOUS' else 'INVALID' end as decision,
        case json_type(o, '$.confidence') when 'DOUBLE' then cast(trunc(cast(json_extract_string(o, '$.confidence') as double)) as bigint) when 'VARCHAR' then case when regexp_full_match(trim(json_extract_string(o, '$.confidence')), '[+-]?[0-9]+') then cast(trim(json_extract_string(o, '$.confidence')) as bigint) end
          when 'BOOLEAN' then cast(json_extract_string(o, '$.confidence') = 'true' as bigint) else try_cast(json_extract_string(o, '$.confidence') as bigint) end as n from {_OBJECT}) p join {_SHARES} w on p.case_id = w.case_id and p.model = w.model and p.run_id = w.run_id""",
    "noisy_json_extract": f"""select case_id, model, run_id, decision, case when n between 1 and 10 then cast(n as integer) end as confidence, case when decision <> 'INVALID' then 'valid' else 'invalid_json_schema' end as status, case when gold_answer is not null then decision = gold_answer end as "right"
      from (select *, case upper(trim(json_extract_string(o, '$.decision'))) when 'A' then 'YES' when 'B' then 'NO' when 'C' then 'AMBIGUOUS' else 'INVALID' end as decision,
        case json_type(o, '$.confidence') when 'DOUBLE' then cast(trunc(cast(json_extract_string(o, '$.confidence') as double)) as bigint) when 'VARCHAR' then case when regexp_full_match(trim(json_extract_string(o, '$.confidence')), '[+-]?[0-9]+') then cast(trim(json_extract_string(o, '$.confidence')) as bigint) end
          when 'BOOLEAN' then cast(json_extract_string(o, '$.confidence') = 'true' as bigint) else try_cast(json_extract_string(o, '$.confidence') as bigint) end as n from {_OBJECT})""",
    "prob_entropy_margin": f"select case_id, model, run_id, best as decision, round(l[1], 6) as confidence, round(l[1] - l[2], 6) as margin, round(h, 6) as entropy, round(h / ln(3), 6) as normalized_entropy from {_SHARES}",
    "label_histogram": f"select model, parse_status, count(*) as n from {_DISTINCT_RUNS} group by 1, 2",
    "keyword_labels": f"select case_id, {_LABEL} as label from (select case_id, coalesce(question_text, '') as q from structured_cases)",
    "previous_labels": f"select case_id as sheet_row, coalesce(l, {_LABEL}) as label, case when l is not null then 'previous' else 'keyword' end as source from (select case_id, coalesce(question_text, '') as q from structured_cases) c left join (select trim(coalesce(question_text, '')) as k, arg_max(drug_focus, case_id) as l from structured_cases where gold_answer is not null and drug_focus is not null group by 1) e on trim(q) = k",
    "completeness_check": "with c as (select distinct cast(case when case_id % 10 = 3 then case_id + 10000000 else case_id end as bigint) as k from structured_cases), n as (select count(*) as n from structured_cases) select r as row, 'missing' as problem from (select unnest(range(1, n + 1)) as r from n) where r not in (select k from c) union all select k, 'unexpected' from c, n where k not between 1 and n.n",
    "unchanged_check": f"select coalesce(s.case_id, r.case_id) as case_id, s.question_text as before, r.q as after from structured_cases s full join (select case_id, max(question_text) || case when case_id % 7 = 0 then ' (edited)' else '' end as q from {_DISTINCT_RUNS} group by 1) r on s.case_id = r.case_id where s.question_text is distinct from r.q",
    "blank_fields": "select post_id, crawl_timestamp from posts where trim(coalesce(body_clean, '')) = ''",
    "error_cells": f"select case_id, cell, value from (unpivot (select case_id, case when case_id % 31 = 0 then '#REF!' else question_text end as question_text, case when case_id % 47 = 0 then '=#DIV/0!' else drug_focus end as drug_focus from structured_cases) on question_text, drug_focus into name cell value value) where regexp_matches(value, '{_q(label.ERROR_CELL)}') order by 1, 2 limit 300",
    "topn_per_partition": f"select subreddit, post_id, created_time from (select *, row_number() over (partition by subreddit order by created_time, post_id) as _k from {_FIRST}) where _k <= 10",
    "sampled_cases": f"select subreddit || '_' || post_id as case_id, clean_text as cleaned_text from (select *, row_number() over (partition by subreddit order by created_time, post_id) as _k from (select *, {_AXIS} as decidable_axis from (select *, {', '.join(f'{e} as {n}' for n, e in _TAGS.items())} from {_FIRST})) where decidable_axis is not null) where _k <= 5",
    "date_range_counts": "select event_type, count(*) as n from events where ts between timestamp '2024-01-05 00:00:00' and timestamp '2024-01-20 23:59:59' group by 1",
    "rolling_24h": "select event_id, round(sum(value) over (partition by user_id order by epoch_us(ts) range between 86399999999 preceding and current row), 4) as rolling_total from events",
    "since_last": "select event_id, round((epoch_us(ts) - lag(epoch_us(ts)) over (partition by user_id order by ts, event_id)) / 3600000000.0, 6) as hours_since_last from events",
    "as_of_value": "with l as (select event_id, user_id, ts from events where event_type = (select min(event_type) from events)), r as (select user_id, ts, max(value) as value from events where event_type = (select max(event_type) from events) group by 1, 2) select event_id, value as last_value from l asof left join r on l.user_id = r.user_id and l.ts >= r.ts",
    "context_frame": "select event_id, string_agg(event_type, ' ') over (partition by user_id order by ts, event_id rows between 2 preceding and current row) as context from events",
    "run_collapse": "select event_id, user_id, event_type from (select *, lag(event_type) over (partition by user_id order by ts, event_id) as b, row_number() over (partition by user_id order by ts, event_id) as k from events) where k = 1 or event_type is distinct from b",
    "invariant_decisions": "select user_id, case when bool_and(t <= 400.0) and bool_and(t * 1.5 <= 400.0) then 'YES' when not bool_or(t <= 400.0) and not bool_or(t * 1.5 <= 400.0) then 'NO' else 'AMBIGUOUS' end as decision from (select user_id, sum(value) over (partition by user_id order by epoch_us(ts) range between 86399999999 preceding and current row) as t from events) group by 1",
}
