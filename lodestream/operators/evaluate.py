"""Repeated-run evaluation: run rows from raw answers, and one summary for each case.

Defined results: a majority is the most frequent decision other than INVALID, of ties the one whose
first run is earliest; without valid runs it is INVALID with agreement 0. Means pass over nulls.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.functions import answers
from lodestream.plans.runtime import ship

# The two prompts.
ANSWER_PROMPT = """You are answering an over-the-counter medication dosing question.

Medication question:
{question_text}

Return your answer ONLY in valid JSON using this schema:
{
  "reasoning": "2-4 sentences explaining your reasoning",
  "decision": "A | B | C",
  "confidence": 1-10
}

Decision mapping:
A = YES
B = NO
C = AMBIGUOUS

Guidelines:
- Use AMBIGUOUS if the information is incomplete, conflicting, or not sufficient for a
confident answer.
- Do not include any text outside the JSON object.
"""
DECISION_PROMPT = """You are answering an over-the-counter medication dosing question.

Medication question:
{question_text}

Choose exactly one decision:
A
B
C

Decision mapping:
A = YES
B = NO
C = AMBIGUOUS

Decision:"""
#: The columns of a run row, in their order.
RUN_ROW = (
    "case_id", "run_id", "model", "drug_focus", "question_text", "gold_answer", "error_category", "raw_output", "parse_status", "parsed_decision",
    "parsed_verbal_confidence", "decision_confidence", "decision_entropy", "decision_margin", "reasoning_avg_logprob", "reasoning_perplexity_like", "is_correct",
)
MEANS = {
    "decision_confidence": "avg_decision_confidence", "decision_entropy": "avg_decision_entropy", "decision_margin": "avg_decision_margin",
    "reasoning_avg_logprob": "avg_reasoning_avg_logprob", "reasoning_perplexity_like": "avg_reasoning_perplexity_like",
}


def runs_of(cases: DataFrame, n: int) -> DataFrame:
    """Each case with run_id 1 to n."""
    return cases.withColumn("run_id", F.explode(F.sequence(F.lit(1), F.lit(n))))


def prompt(template: str, columns: dict[str, Column]) -> Column:
    """``template`` with each ``{name}`` replaced by a column; null counts as empty."""
    out: Column = F.lit(template)
    for name, c in columns.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(c.cast("string"), F.lit("")))
    return out


def parsed_runs(runs: DataFrame, raw: str = "raw_output", gold: str = "gold_answer") -> DataFrame:
    """``runs`` with what its raw answer says: ``decision``, ``confidence``, ``status``, ``right``."""
    obj = runs.withColumn("_o", answers.json_object(F.col(raw)))
    get = lambda k: F.try_variant_get("_o", f"$.{k}", "string")
    out = obj.withColumns({"decision": answers.decision(get("decision")), "confidence": answers.confidence(F.try_variant_get("_o", "$.confidence", "bigint"))})
    status = F.when(F.col("decision") != answers.INVALID, "valid").otherwise("invalid_json_schema")
    return out.withColumns({"status": status, "right": F.when(F.col(gold).isNotNull(), F.col("decision") == F.col(gold))}).drop("_o")


def answered(runs: DataFrame, model: str, answer: Callable[[str, str], tuple[str, float, float, float]]) -> DataFrame:
    """``runs`` (cases with run_id) with ``model``, ``raw_output``, ``p_yes``, ``p_no``, ``p_ambiguous`` and ``error``. ``answer``
    is given both prompts of a run and returns the raw answer and three weights; an exception leaves nulls and its text."""
    ship(runs.sparkSession)
    rest = runs.withColumns({"_a": prompt(ANSWER_PROMPT, {"question_text": F.col("question_text")}), "_d": prompt(DECISION_PROMPT, {"question_text": F.col("question_text")})})
    rest = rest.select(F.struct(*runs.columns).alias("r"), "_a", "_d")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for a, d in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                try:
                    raw, *weights = answer(a, d)
                    out.append((raw.strip(), *map(float, weights), None))
                except Exception as e:  # noqa: BLE001
                    out.append((None, None, None, None, f"{type(e).__name__}: {e}"))
            cols = list(zip(*out)) if out else [()] * 5
            types = [pa.string(), pa.float64(), pa.float64(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(cols, types)]], ["r", "raw_output", "p_yes", "p_no", "p_ambiguous", "error"])

    made = rest.mapInArrow(run, f"r {rest.schema['r'].dataType.simpleString()}, raw_output string, p_yes double, p_no double, p_ambiguous double, error string")
    return made.select("r.*", F.lit(model).alias("model"), "raw_output", "p_yes", "p_no", "p_ambiguous", "error")


def run_rows(runs: DataFrame, weights: tuple[str, str, str] = ("p_yes", "p_no", "p_ambiguous")) -> DataFrame:
    """The rows of runs with a raw answer and three weights, as ``RUN_ROW``. Likelihoods of the reasoning are null:
    no model gives them."""
    p = answers.probability_scores(*[F.col(w) for w in weights])
    df = parsed_runs(runs).withColumn("_p", p)
    made = {
        "parse_status": F.col("status"), "parsed_decision": F.col("decision"), "parsed_verbal_confidence": F.col("confidence"), "decision_confidence": F.col("_p.confidence"), "decision_entropy": F.col("_p.entropy"),
        "decision_margin": F.col("_p.margin"), "reasoning_avg_logprob": F.lit(None).cast("double"), "reasoning_perplexity_like": F.lit(None).cast("double"), "is_correct": F.col("decision").eqNullSafe(F.col("gold_answer")),
    }
    return df.select(*[made.get(c, F.col(c)).alias(c) for c in RUN_ROW])


def case_summary(runs: DataFrame, case: str = "case_id", run: str = "run_id", decision: str = "parsed_decision", firsts: tuple[str, ...] = ("drug_focus", "question_text", "gold_answer", "error_category"), means: dict[str, str] | None = None) -> DataFrame:
    """One row for each case: majority, agreement, consistency, correctness, first attributes, means (null for
    scores that ``runs`` lacks) and empty columns for judgements by hand."""
    means = MEANS if means is None else means
    runs = runs.withColumns({c: F.lit(None).cast("double") for c in means if c not in runs.columns})
    d = F.coalesce(decision, F.lit(answers.INVALID))
    # votes for each decision first, so that a case with a third of all runs costs no task more
    votes = runs.groupBy(case, d.alias("_d")).agg(
        F.count("*").alias("_n"), F.min(run).alias("_first"),
        *[F.min_by(F.struct(c), F.col(run)).alias(f"_f_{c}") for c in firsts],
        *[F.sum(c).alias(f"_s_{c}") for c in means], *[F.count(c).alias(f"_c_{c}") for c in means],
    )
    valid = F.col("_d") != answers.INVALID
    out = votes.groupBy(case).agg(
        F.min_by(F.when(valid, F.col("_d")), F.when(valid, F.struct((-F.col("_n")).alias("n"), "_first"))).alias("majority_decision"),
        F.max(F.when(valid, F.col("_n"))).alias("_top"), F.sum(F.when(valid, F.col("_n"))).alias("_valid"), F.sum("_n").alias("num_runs"),
        *[F.min_by(f"_f_{c}", "_first").alias(f"_f_{c}") for c in firsts],
        *[(F.sum(f"_s_{c}") / F.nullif(F.sum(f"_c_{c}"), F.lit(0))).alias(name) for c, name in means.items()],
    )
    agreement = F.coalesce(F.col("_top") / F.col("_valid"), F.lit(0.0))
    out = out.withColumns({"majority_decision": F.coalesce("majority_decision", F.lit(answers.INVALID)), "agreement": agreement})
    score = F.when(F.col("agreement") == 1.0, 2).when(F.col("agreement") >= 0.6, 1).otherwise(0)
    out = out.select(case, *[F.col(f"_f_{c}.{c}").alias(c) for c in firsts], "majority_decision", "agreement", score.alias("consistency_score"), *means.values(), F.col("num_runs").cast("bigint").alias("num_runs"))
    if "gold_answer" in firsts:
        out = out.withColumn("majority_correct", F.when(F.col("majority_decision").eqNullSafe(F.col("gold_answer")), 1).otherwise(0))
    return out.withColumns({"manual_verifiability_score": F.lit(None).cast("int"), "manual_error_type": F.lit(None).cast("string")})
