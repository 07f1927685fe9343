"""Queries of the training-data operators: each takes (spark, directory of tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestream.llm import answers, consensus, encodings, mixing, neardup, personal, residue, subjects, tokenization
from lodestream.plans.runtime import table

# the definition of p2: three words, half of the tokens
P2_WIDTH, P2_THRESHOLD = 3, 0.5
RUN = ["case_id", "model", "run_id"]


def p1_found(spark, d):
    return personal.found(table(spark, d, "posts"), "post_id", ["title", "body"], "clean_text")


def p1_masked(spark, d):
    return personal.masked(table(spark, d, "posts"), "post_id", ["title", "body"], table(spark, d, "placeholders"), "clean_text").select("post_id", "field", "masked")


def p2_found(spark, d):
    return neardup.pairs(table(spark, d, "posts"), "post_id", "clean_text", P2_WIDTH, P2_THRESHOLD)


def p2_groups(spark, d):
    return neardup.groups(table(spark, d, "posts"), "post_id", "clean_text", P2_WIDTH, P2_THRESHOLD)


def p3_found(spark, d):
    return encodings.affected(table(spark, d, "posts"), "post_id", ["title", "body"]).select("post_id", "field").distinct()


def p3_restored(spark, d):
    return encodings.restored(table(spark, d, "posts"), "post_id", ["title", "body"]).select("post_id", "field", "chain", "fixed", "restored")


def p4_found(spark, d):
    return answers.defects(table(spark, d, "confidence_runs_gpt_5_4_mini"), RUN, "question_text", "raw_output").select(*RUN, "defect")


def p5_found(spark, d):
    return residue.residue(table(spark, d, "posts"), "post_id", "body").select("post_id")


def p5_kept(spark, d):
    return residue.excluded(table(spark, d, "posts"), "post_id", "body").groupBy("subreddit").agg(F.count("*").alias("n_posts"))


def _consensus(spark, d):
    return consensus.consensus(table(spark, d, "confidence_runs_gpt_5_4_mini"), "case_id", "model", "run_id", "parsed_decision")


def p6_found(spark, d):
    return _consensus(spark, d)[0].select("case_id", "decision")


def p6_items(spark, d):
    return _consensus(spark, d)[0]


def p6_annotators(spark, d):
    return _consensus(spark, d)[1]


def p7_ids(spark, d):
    return tokenization.encode_column(table(spark, d, "documents"), "doc_id", "text")


def _mix(spark, d):
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"), "doc_id", "text", "source")


def p8_mix(spark, d):
    return _mix(spark, d)[0]


def p8_report(spark, d):
    return _mix(spark, d)[1]


def p9_found(spark, d):
    return subjects.subjects(table(spark, d, "documents"), table(spark, d, "subject_labels"), "doc_id", "text", "source", "lang")


def p9_composition(spark, d):
    return subjects.composition(table(spark, d, "documents"), p9_found(spark, d), "doc_id")


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_masked, p2_found, p2_groups, p3_found, p3_restored, p4_found, p5_found, p5_kept, p6_found, p6_items, p6_annotators, p7_ids, p8_mix, p8_report, p9_found, p9_composition)
}
#: None of these can be said in SQL; tests compare them with brute force, round trips and held-out rows.
ORACLES: dict[str, str] = {}
