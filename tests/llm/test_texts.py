import re

import pytest
from pyspark.sql import functions as F

from lodestream.llm import answers, encodings, personal, residue, subjects

# ---- wrong encodings

CLEAN = ["Ich möchte später schlafen können", "C’était un café crème très naïf", "Я выпил две таблетки вечером", "Το φάρμακο είναι εδώ σήμερα", "Señor, ¿puedo tomar más mañana?"]


def _posts(spark, rows, schema="post_id string, title string, body string"):
    return spark.createDataFrame(rows, schema).withColumn("word", F.lit("clash"))


def test_affected_fields_and_their_originals(spark):
    garbled = [t.encode().decode(e, "replace") if e != "cp1252" else "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in t.encode()) for t, e in zip(CLEAN[:2], ("latin_1", "cp1252"))]
    garbled.append(CLEAN[2].encode("cp1251").decode("latin_1"))
    garbled.append(CLEAN[4].encode("latin_1").decode("utf-8", "replace"))
    rows = [(f"c{i}{k}", t, "plain") for i, t in enumerate(CLEAN) for k in range(3)] + [(f"g{i}", "plain ascii", f"{t} and more") for i, t in enumerate(garbled)]
    rows += [("n", None, None), ("e", "", "  "), ("g0", "plain ascii", f"{garbled[0]} and more")]
    df = _posts(spark, rows)
    every = encodings.affected(df, "post_id", ["title", "body"])
    assert sorted((r["post_id"], r["field"]) for r in every.collect()) == [(f"g{i}", "body") for i in range(4)]
    fixed = {r["post_id"]: (r["fixed"], r["restored"]) for r in encodings.restored(df, "post_id", ["title", "body"]).collect()}
    for i, c in enumerate((CLEAN[0], CLEAN[1], CLEAN[2])):
        assert fixed[f"g{i}"] == (f"{c} and more", True)
    assert encodings.affected(df.limit(0), "post_id", ["title"]).count() == 0
    # repeated records and null keys: a row for each text of a field
    twice = _posts(spark, rows + [(None, "x", garbled[0]), (None, "x", garbled[1]), (None, "x", garbled[1])])
    got = [(r["post_id"], r["fixed"]) for r in encodings.restored(twice, "post_id", ["title", "body"]).where("post_id is null").collect()]
    assert sorted(got) == sorted([(None, CLEAN[0]), (None, CLEAN[1])])


def test_accents_of_one_alphabet_are_no_proof(spark):
    right = ["Sooo müüüüüde und kaputt", "ÄÖÜÄÖ Umlaute sind toll", "très créééééé", "ÄÖÜäöüß", "Příliš žluťoučký kůň"]
    wrong = ["Ïðèâåò", "ñåãîäíÿ âå÷åðîì", "abc \ufffd\ufffd def", "x \x81y"]
    df = _posts(spark, [(f"r{i}", t, None) for i, t in enumerate(right)] + [(f"w{i}", t, None) for i, t in enumerate(wrong)])
    assert {r["post_id"] for r in encodings.affected(df, "post_id", ["title", "body"]).collect()} == {f"w{i}" for i in range(len(wrong))}


def test_direction_of_swaps(spark):
    bad = lambda t, a, b: t.encode(a).decode(b)
    rows = [("c0", "x", CLEAN[2]), ("c1", "x", "Mutter möchte Übung später"), ("c2", "x", "El señor Muñoz está aquí mañana")]
    rows += [(f"h{i}", "x", bad(CLEAN[2], "cp1251", "latin_1")) for i in range(9)]  # one text, copied
    rows += [(f"d{i}", "x", bad(CLEAN[1], "cp1252", "mac_roman") + f" {i}") for i in range(4)] + [("c3", "x", CLEAN[1])]  # more texts than the original has
    rows += [("t0", "x", bad("Mutter möchte Übung später", "cp1252", "cp1251")), ("s0", bad("mañana", "cp1252", "mac_roman") + " again", "x")]
    got = sorted((r["post_id"], r["field"]) for r in encodings.affected(_posts(spark, rows), "post_id", ["title", "body"]).collect())
    assert got == sorted([(f"h{i}", "body") for i in range(9)] + [(f"d{i}", "body") for i in range(4)] + [("t0", "body"), ("s0", "title")])


def test_forms_are_one_way():
    assert ("utf8>latin_1", "utf8", "Ã©") in encodings.garbled_forms("é")
    assert all("é" != f for _, _, f in encodings.garbled_forms("Ã©"))
    assert encodings.garbled_forms("�x") == []


# ---- residue


def test_residue_is_found_and_prose_is_not(spark):
    pages = [f"404 Not Found. The thread /t/{i:05x}a is not on this server (node {i:06x}b)." for i in range(4)]
    slots = ["I took two {{dose}} ago because of ${symptom}.", "I took two <%= amount %> ago because of [object Object].", "I took two __CITY__ ago because of {1}.", "Took null pills of undefined at NaN:NaN."]
    prose = ["I typed %s into the search, {rant over} sorry. More of that. And more. Much more.", "My null result is good. I took two ago. Thanks a lot. Bye.", "The page threw a 404. I took two pills ago because of pain. Ok. Fine."] * 20
    filler = ["Lorem ipsum dolor sit amet consectetur adipiscing.", "wip wip wip wip wip wip wip"]
    marks = ["[removed]", "[deleted]", "", "  ", None]
    bodies = pages + ["Long story. It started early. Then this: sad.\n" + pages[0]] + slots + prose + filler + marks
    df = _posts(spark, [(str(i), None, b) for i, b in enumerate(bodies)])
    got = {int(r["post_id"]) for r in residue.residue(df, "post_id", "body").collect()}
    n = len(pages) + 1 + len(slots)
    assert got == set(range(n)) | {n + len(prose), n + len(prose) + 1}
    assert residue.excluded(df, "post_id", "body").count() == len(bodies) - len(got)
    assert residue.residue(df.limit(0), "post_id", "body").count() == 0


def test_long_pages_and_embedded_notices_are_found(spark):
    denied = "Access denied. You lack permission to view /t/{0:05x}a. Reference #{0:06x}b"
    long = "Our site is down.\nWe are sorry.\nWork goes on.\nThe upstream server gave no answer.\nTicket {0:06x}c"
    own = ["My knee hurts since {0}. It was worse at night. I slept badly. What now?", "We walked {0} miles. Then it rained. Nothing helped. Any ideas?"]
    told = "The site told me to enable JavaScript, so I gave up. That was at {0} pm. I took two. Fine."
    bodies = [f"{o.format(i)}\n{denied.format(i)}" for i, o in enumerate(own * 6)] + [long.format(i) for i in range(3)] + [o.format(i) for i, o in enumerate(own * 6)] + [told.format(i) for i in range(9)]
    df = _posts(spark, [(str(i), None, b) for i, b in enumerate(bodies)])
    assert {int(r["post_id"]) for r in residue.residue(df, "post_id", "body").collect()} == set(range(15))


def test_copies_of_a_short_question_are_no_page(spark):
    short = ["Is the browser calculator for doses right? It says 3 pills.", "Can we take another one at noon? It still hurts."]
    bodies = short * 8 + ["Can we take another one at night? We had two at six. It was a long day. Nothing else helped."]
    df = _posts(spark, [(str(i), None, b) for i, b in enumerate(bodies)])
    assert residue.residue(df, "post_id", "body").count() == 0


# ---- broken answers


def _runs(n=400):
    rows = []
    for i in range(n):
        de = i % 5 == 0
        q = f"Ich habe um {i % 12}:10 zwei Tabletten genommen, darf ich noch eine nehmen?" if de else f"I took {i % 7} tablets at {i % 12} pm, can I take another one for pain {i}?"
        a = (f"Laut Frage liegen rund {i % 9} Stunden zwischen den Einnahmen. Damit wäre eine weitere Dosis von {i} mg vertretbar." if de else f"According to the question, {i % 7} tablets were used before {i % 12} pm. The spacing of {i % 9} hours is long enough, so the next dose can be taken.")
        rows.append((i, "m", 1, q, '{"reasoning":"%s","decision":"A","confidence":7}' % a))
    return rows


def test_defects_of_answers(spark):
    rows = _runs()
    q = rows[1][3]
    good = rows[1][4]
    bad = {
        1001: ("", "empty"), 1002: (None, "empty"), 1003: ('{"reasoning":" ","decision":"A"}', "empty"), 1004: (good[:70], "truncated"), 1005: ('{"reasoning":"According to the question, 3 tab","decision":"A","confidence":7}', "truncated"),
        1006: ("I'm sorry, but I can't help with that. Please speak to a doctor.", "refusal"), 1007: (q, "copied_question"), 1008: (q.lower(), "copied_question"), 1009: (rows[0][4], "other_language"),
    }
    sound = {2001: good.replace(' taken."', ' taken"'), 2002: f"```json\n{good}\n```", 2003: good.replace("According", f"You ask: '{q}' According"), 2004: good.replace('"A"', '"a"')}
    rows += [(k, "m", 1, q, v) for k, (v, _) in bad.items()] + [(k, "m", 1, q, v) for k, v in sound.items()] + [(1001, "m", 1, q, ""), (3001, "m", 1, None, "")]
    df = spark.createDataFrame(rows, "case_id int, model string, run_id int, question_text string, raw_output string").withColumn("score", F.lit("clash"))
    got = {r["case_id"]: r["defect"] for r in answers.defects(df, ["case_id", "model", "run_id"], "question_text", "raw_output").collect()}
    assert {k: got.get(k) for k in bad} == {k: d for k, (_, d) in bad.items()}
    assert {k: got[k] for k in sound if k in got} == {}
    assert got[3001] == "empty"
    assert sum(k < 1000 for k in got) <= 8  # sound recorded answers
    with pytest.warns(UserWarning, match="too few"):
        small = answers.defects(df.where("case_id in (1, 1001)"), ["case_id"], "question_text", "raw_output")
    assert {r["case_id"]: r["defect"] for r in small.collect()} == {1001: "empty"}
    assert answers.defects(df.limit(0), ["case_id"], "question_text", "raw_output").count() == 0


def test_refusals_late_in_an_answer(spark):
    rows = _runs()
    q = "I have been lifting boxes all week and my lower back hurts, I took 2 tablets at 8 am and 2 more at noon with lunch, would it be fine to take another one before bed?"
    good = rows[1][4]
    refusals = [f"You ask: '{q}' I'm sorry, but I can't help with that.", f"The question was: {q} I cannot give advice on medication. Please ask a pharmacist."]
    rows += [(1000 + i, "m", 1, q, '{"reasoning":"%s","decision":null,"confidence":5}' % a) for i, a in enumerate(refusals)] + [(2000, "m", 1, q, good.replace("According", f"You ask: '{q}' According"))]
    df = spark.createDataFrame(rows, "case_id int, model string, run_id int, question_text string, raw_output string")
    got = {r["case_id"]: r["defect"] for r in answers.defects(df, ["case_id", "model", "run_id"], "question_text", "raw_output").collect()}
    assert {k: got.get(k) for k in (1000, 1001, 2000)} == {1000: "refusal", 1001: "refusal", 2000: None}


def test_answers_in_words_that_were_never_made(spark):
    rows = _runs()
    q = rows[1][3]
    refusals = ["Answering would be irresponsible of me.", "Let us leave that to professionals.", "I'm afraid I can't offer guidance on medication.", "I'd rather not weigh in on dosing.", "That's a call for your doctor, so I won't answer."]
    foreign = ["Согласно вопросу, между приёмами прошло достаточно времени. Следующую дозу можно принять.", "質問によると、間隔は十分に空いています。次の服用をしても問題ありません。", "Σύμφωνα με την ερώτηση, έχουν περάσει αρκετές ώρες. Μπορείτε να πάρετε την επόμενη δόση."]
    raw = lambda a: '{"reasoning":"%s","decision":null,"confidence":5}' % a
    rows += [(1000 + i, "m", 1, q, raw(a)) for i, a in enumerate(refusals)] + [(2000 + i, "m", 1, q, raw(a).replace("null", '"A"')) for i, a in enumerate(foreign)]
    df = spark.createDataFrame(rows, "case_id int, model string, run_id int, question_text string, raw_output string")
    got = {r["case_id"]: r["defect"] for r in answers.defects(df, ["case_id", "model", "run_id"], "question_text", "raw_output").collect()}
    assert [got.get(2000 + i) for i in range(3)] == ["other_language"] * 3
    assert sum(got.get(1000 + i) == "refusal" for i in range(len(refusals))) >= 4
    assert sum(k < 1000 for k in got) <= 8


def test_features_of_a_batch_are_those_of_each_pair():
    rows = _runs(60)
    qs, rs = [r[3] for r in rows] + [None, "", "Why?"], [r[4] for r in rows] + [None, "", "One two " * 30_000]
    ends = answers.Ends.from_texts([answers.answer_of(r)[0] for r in rs])
    whole = answers.features(qs, rs, ends, answers.Words())
    for i, (q, r) in enumerate(zip(qs, rs)):
        one = answers.features([q], [r], ends, answers.Words())
        at = slice(whole.starts[i], whole.starts[i] + whole.sizes[i])
        assert dict(zip(one.idx, one.val.round(5))) == dict(zip(whole.idx[at], whole.val[at].round(5)))
    assert len(answers.features([], [], ends, answers.Words())) == 0


# ---- subjects


def test_subjects_of_held_out_documents(spark):
    words = {"law": ["the court heard the witness on {}", "my lawyer filed the claim on {}", "the judge put off the hearing to {}"], "food": ["the soup needs garlic on {}", "I baked bread with butter on {}", "the recipe wants salt on {}"]}
    plain = ["I took two tablets on {}.", "My knee hurts since {}.", "Thanks for reading on {}."]
    docs, labels = [], []
    for i in range(240):
        day = ["monday", "tuesday", "friday"][i % 3]
        kind = i % 4
        own = {0: [], 1: ["law"], 2: ["food"], 3: ["law", "food"]}[kind]
        text = [s.format(day) for s in plain] + [words[k][(i + j) % 3].format(day) + "." for k in own for j in (0, 1)]
        if kind == 0 and i % 8 == 0:
            text.append(words["law"][i % 3].format(day) + ".")  # one sentence alone is no subject
        docs.append((i, "\n".join(text), "Forum Dump", "en"))
        if i < 180:
            labels += [(i, k) for k in own] or [(i, None)]
    docs += [(900, None, None, None), (901, "  ", "x", "en")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, source string, lang string").withColumn("subject", F.lit("clash"))
    lab = spark.createDataFrame(labels + [(5000, "law")], "doc_id bigint, subject string")
    found = subjects.subjects(d, lab, "doc_id", "text", "source", "lang")
    got = {}
    for r in found.collect():
        got.setdefault(r["doc_id"], set()).add(r["subject"])
    want = {i: {0: set(), 1: {"law"}, 2: {"food"}, 3: {"law", "food"}}[i % 4] for i in range(180, 240)}
    assert sum(got.get(i, set()) == w for i, w in want.items()) >= 57 and not {900, 901} & set(got)
    shares = {r["subject"]: r["n_documents"] for r in subjects.composition(d, found, "doc_id").collect()}
    assert set(shares) == {"law", "food", None} and shares[None] == d.count() - len(got)
    assert subjects.subjects(d, lab.limit(0), "doc_id", "text", "source", "lang").count() == 0
    assert subjects.subjects(d.limit(0), lab, "doc_id", "text", "source", "lang").count() == 0


def test_beam_search_is_exact_where_it_is_wide():
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    E, S = rng.random((40, 4, 8)).astype(np.float32), rng.random((40, 3)).astype(np.float32)
    chain = [rng.normal(size=9 + 3 + k).astype(np.float32) for k in range(4)]
    best = subjects.decode(chain, E, S, 16)
    for d in range(40):
        def chance(labels):
            total = 0.0
            for k, w in enumerate(chain):
                x = np.concatenate([subjects._link_input(E[d : d + 1], k)[0], S[d], np.array(labels[:k], np.float32)])
                z = float(x @ w)
                total -= np.logaddexp(0, -z if labels[k] else z)
            return total

        assert tuple(best[d].astype(int)) == max(itertools.product((0, 1), repeat=4), key=chance)


# ---- personal information

CASES = [
    ("email", "Please mail orla.fenn@mail.example if you have it."), ("email", "contact: orla.fenn [at] mail [dot] example"), ("phone", "Call me on 212-555-0166 after 3 am."), ("phone", "My number is +44 7700 900 714, text is fine."),
    ("id_number", "They asked for my social, 903-85-6345, at the counter."), ("id_number", "They wanted a passport, no. XP4706136, before that."), ("address", "I live at 397 Juniper Road, Apt 3B, Altmoor and it is far."), ("address", "Deliver to rue Copper 42, Corran please."),
    ("name", "My name is Thora Varnwick, I'm new here."), ("name", "Mrs Ashgrove at the counter shrugged."),
]
OTHERS = ["I took one@10 pm and two@11:43 AM, then stopped.", "Order #371-20033 had 10 tablets in it.", "A 599 mile road trip made it worse.", "Dr. Google and St. John's wort were no help.", "My bp was 131/81 at 20:48.", "In 2019 and 2021-2022 I had it 210 times.", "", None]


def test_personal_kinds_and_masking(spark):
    rows = [(f"p{i}", None, t) for i, (_, t) in enumerate(CASES * 12)] + [(f"o{i}", "Late question", t) for i, t in enumerate(OTHERS * 12)] + [("p0", None, CASES[0][1])]
    df = _posts(spark, rows)
    df = df.withColumn("clean_text", F.trim(F.concat_ws(" ", F.coalesce("title", F.lit("")), "body")))
    got = {}
    for r in personal.found(df, "post_id", ["title", "body"], "clean_text").collect():
        got.setdefault((r["post_id"], r["field"]), set()).add(r["kind"])
    for i, (kind, t) in enumerate(CASES * 12):
        assert got.get((f"p{i}", "body")) == {kind}, t
        assert got.get((f"p{i}", "clean_text")) == {kind}, t
    assert not [k for k in got if k[0].startswith("o")]
    marks = spark.createDataFrame([("email", "<EMAIL>"), ("phone", "<PHONE>"), ("id_number", "<ID_NUMBER>"), ("address", "<ADDRESS>"), ("name", "<NAME>")], "kind string, placeholder string")
    masked = {r["post_id"]: r["masked"] for r in personal.masked(df, "post_id", ["body"], marks).collect()}
    assert masked["p0"] == "Please mail <EMAIL> if you have it." and masked["p2"] == "Call me on <PHONE> after 3 am."
    assert masked["p4"] == "They asked for my social, <ID_NUMBER>, at the counter." and masked["p8"] == "My name is <NAME>, I'm new here."
    assert re.fullmatch(r"I live at <ADDRESS> and it is far\.", masked["p6"])
    assert personal.found(df.limit(0), "post_id", ["title", "body"]).count() == 0
    assert personal.masked(df.limit(0), "post_id", ["body"], marks).count() == 0


def test_vocabulary_counts_all_records(spark):
    rows = [(str(i), None, f"the ordinary words of a post {i}") for i in range(15_000)] + [(f"n{i}", None, "My name is Quillon Zebrask, I think.") for i in range(2)]
    rows += [(f"c{i}", None, "Seldomly it rained here.") for i in range(12)]
    common, known = personal.vocabulary(personal._scan(_posts(spark, rows), "post_id", ["title", "body"], None))
    assert {"ordinary", "post", "seldomly"} <= common and "quillon" not in common
    assert "quillon" in known and "zebrask" in known and "ordinary" not in known
    assert personal.vocabulary(personal._scan(_posts(spark, rows[:0]), "post_id", ["body"], None))[0] == frozenset()


def test_expectation_maximisation_keeps_kinds_apart():
    patterns = [("2" + "----2-2-------", 300), ("2" + "-----3-3------", 300), ("2" + "----------0---", 300), ("2" + "-2-----3------", 40)]
    patterns = [(p[:15].ljust(15, "-"), n) for p, n in patterns]
    post, _ = personal.reliabilities(patterns)
    assert [post[p].argmax() for p, _ in patterns] == [2, 3, 0, 3]


def test_a_bad_labeler_is_found_out():
    # labeler 12 speaks for names wherever labelers 9 and 11, who are right elsewhere, speak against them
    pattern = lambda **v: "5" + "".join(v.get(f"v{i}", "-") for i in range(14))
    sizes = {pattern(v6="5", v3="5"): 4000, pattern(v7="5", v8="5"): 4000, pattern(v9="0", v11="0", v12="5"): 9000, pattern(v9="0", v11="0", v13="0"): 9000, pattern(v12="5", v9="0"): 500}
    post, chances = personal.reliabilities(sorted(sizes.items()))
    assert post[pattern(v12="5", v9="0")].argmax() == 0 and post[pattern(v6="5", v3="5")].argmax() == 5
    classes, chance = chances[5]
    assert chance[classes.index(0), 12, 6] > chance[classes.index(5), 12, 6]  # its vote speaks against a name


def test_what_is_found_is_masked(spark):
    texts = [t for _, t in CASES] + ["Mr Ashgrove told me.\nRegards,\nThora Varnwick", "See [mail orla.fenn@mail.example](http://x.example) or orla.fenn@mail.example again", "Thora Varnwick, Thora Varnwick and 212-555-0166 or 212-555-0166"]
    df = _posts(spark, [(f"p{i}", f"About {i}", f"{t}  Case {i % 7}.") for i, t in enumerate(texts * 6)] + [("p0", "About 0", f"{texts[0]}  Case 0.")])
    df = df.withColumn("clean_text", F.trim(F.regexp_replace(F.regexp_replace(F.concat_ws(" ", "title", "body"), r"\[([^\]]+)\]\([^)]*\)", "$1"), r"\s+", " ")))
    marks = spark.createDataFrame([(k, f"<{k.upper()}>") for k in personal.KINDS], "kind string, placeholder string")
    found = {(r["post_id"], r["field"]): 0 for r in personal.found(df, "post_id", ["title", "body"], "clean_text").collect()}
    masked = personal.masked(df, "post_id", ["title", "body"], marks, "clean_text").collect()
    assert {(r["post_id"], r["field"]) for r in masked} == set(found) and len(masked) == len(found)
    assert {f for _, f in found} == {"body", "clean_text"}
    left = [r["masked"] for r in masked if re.search(r"orla|Varnwick|555-0166|Ashgrove", r["masked"])]
    assert left == []


@pytest.mark.parametrize("text", ["", "a" * 200_000, "1 " * 100_000, "Aa " * 50_000])
def test_long_texts_end(text):
    for a, b, k in personal.candidates(text)[:50]:
        personal.judge(text, a, b, k, frozenset(), frozenset())
