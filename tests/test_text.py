import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lodestream.functions import patterns, text

ALPHABET = "abCD .!?\n\t[]()/:-'1  é😀ß"


def _norm(s):
    s = re.sub(r"\[([^\]]+)\]\([^)]*\)", r"\1", s or "")
    return re.sub(r"\s+", " ", re.sub(r"https?://\S+", " ", s, flags=re.I)).strip(" ")


def _units(title, body):
    return [u for u in [(title or "").strip(), *(p.strip() for p in re.split(r"(?<=[.!?])\s+|\n+", body or ""))] if u]


def _windows(units):
    out = []
    for i, u in enumerate(units):
        w = u if i + 1 == len(units) else u + (" " if re.search(r"[.!?]\s*$", u) else ". ") + units[i + 1]
        if w not in out:
            out.append(w)
    return out


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text(ALPHABET, max_size=20), st.text(ALPHABET, max_size=60)), min_size=1, max_size=40))
def test_units_windows_and_normalisation_equal_plain_python(spark, rows):
    df = spark.createDataFrame([(i, t, b) for i, (t, b) in enumerate(rows)], "i int, t string, b string")
    u = text.sentence_units(F.col("t"), F.col("b"))
    for r in df.select("i", text.normalized(F.col("b")).alias("n"), u.alias("u"), text.sentence_windows(u).alias("w")).collect():
        t, b = rows[r["i"]]
        assert r["n"] == _norm(b)
        assert r["u"] == _units(t, b)
        assert r["w"] == _windows(_units(t, b))


@pytest.mark.parametrize("title, body, units", [(None, None, []), ("", "", []), ("  ", "\n\n", []), ("T", None, ["T"]), (None, "a. b", ["a.", "b"]), ("x" * 5000, "y", ["x" * 5000, "y"])])
def test_units_of_missing_and_long_texts(spark, title, body, units):
    df = spark.createDataFrame([(title, body)], "t string, b string")
    r = df.select(text.sentence_units(F.col("t"), F.col("b")).alias("u"), text.sentence_windows(text.sentence_units(F.col("t"), F.col("b"))).alias("w")).first()
    assert r["u"] == units and r["w"] == _windows(units)


def _one(spark, value, expr):
    return spark.createDataFrame([(value,)], "c string").select(expr.alias("x")).first()["x"]


def test_vocabulary_order_and_boundaries(spark):
    p = {"a": patterns.words(["can I take", "can I take more", "mg"]), "b": patterns.words(["tylenol"])}
    assert _one(spark, "Tylenol, can I take more? 500mg", text.first_vocabulary(F.col("c"), p)).asDict() == {"name": "a", "term": "can I take"}
    assert _one(spark, "500mg of TYLENOL", text.first_vocabulary(F.col("c"), p)).asDict() == {"name": "b", "term": "TYLENOL"}
    assert _one(spark, "étylenol", text.first_vocabulary(F.col("c"), p)) is None
    assert _one(spark, None, text.first_vocabulary(F.col("c"), p)) is None
    assert _one(spark, "anything", F.col("c").rlike(patterns.words([]))) is False


def test_unique_matches_keep_first_order(spark):
    assert _one(spark, "B a b A c", text.unique_matches(F.col("c"), patterns.words(["a", "b"]))) == ["b", "a"]
    assert _one(spark, "", text.unique_matches(F.col("c"), patterns.words(["a"]))) == []


def test_positions_count_characters(spark):
    assert _one(spark, "😀 now take it", text.match_start(F.col("c"), "take")) == 6
    assert _one(spark, "nothing", text.match_start(F.col("c"), "take")) is None
    assert _one(spark, "😀" * 300 + "take" + "b" * 300, text.match_context(F.col("c"), "take", 5)) == "😀" * 5 + "take" + "b" * 5
    assert _one(spark, "abab", text.rfind(F.col("c"), F.lit("ab"))) == 2
    assert _one(spark, "abab", text.rfind(F.col("c"), F.lit("x"))) == -1


def test_question_windows(spark):
    units = ["Is it ok?", "a.", "b.", "c " * 500, "May I take it?"]
    df = spark.createDataFrame([(units,), ([],)], "u array<string>")
    got = [r["w"] for r in df.select(text.question_windows(F.col("u"), patterns.ported(r"\?$")).alias("w")).collect()]
    assert [w["question"] for w in got[0]] == ["Is it ok?", "May I take it?"]
    assert got[0][0]["context"] == "Is it ok? a. b."
    assert got[0][1]["context"] == " ".join(units[2:])[-650:]
    assert got[1] == []


def test_javascript_boundaries_are_ascii(spark):
    assert _one(spark, "étylenol", F.col("c").rlike(patterns.ascii_words("tylenol"))) is True
    assert _one(spark, "my_tylenol", F.col("c").rlike(patterns.ascii_words("tylenol"))) is False


def test_longest_first():
    assert patterns.longest_first(["ab", "b", "ab", "abc", "A"]) == ["abc", "ab", "A", "b"]
