"""Text that was decoded with the wrong character encoding (problem 3).

Every distinct word of the corpus with characters beyond ASCII is encoded and decoded along every
chain of encodings that is known to garble text. The table of these garbled forms is joined, by
hash, with the distinct words of every field: a word that is the garbled form of another word of
the corpus is affected, and that other word is its verified original.

Three kinds of chains differ in what a match proves. ``utf8`` (UTF-8 bytes read as something else,
once or twice) and ``loss`` (other bytes read as UTF-8, with replacement characters) lead to forms
that no language writes, so one match is proof. ``swap`` (one 8-bit encoding read as another) leads
to letters that some language writes, so the direction of a chain is decided over all words of a field
that match along it: by signs that a language doesn't write so (scripts mixed in a word, a symbol or a
capital inside it, three accented Latin letters in a row), and where those are even, by whether the originals
are in more different texts than the forms. It counts where the field has two different words, or a word of four
letters beyond ASCII, that match along the chain, or one with a plain sign whose original has none.

The plan: lengths in bytes and characters pick the fields with other than ASCII characters; their
words are cut out natively; the vocabulary is one aggregation; forms are made for distinct words
only; and the table, whose size follows the vocabulary, is joined without a forced broadcast. A word
in a third of all fields is one row of the table, so the join is on (word) against distinct words of
fields and such a word is spread by salting it ``SALT`` times.

Exact check on what the table can't know, as the original never occurs: a replacement character, a C1
control character, or five accented Latin letters in a row that no one alphabet has together are left by nothing but a
wrong decoding.

All this is worked out for different texts, each known by two 64-bit hashes; what is found is joined back to the fields
that hold the text, with the texts salted, as one may be in a third of all fields.

Defined results: null and empty fields and pure ASCII fields are never affected; records that repeat a key, a field
and its text give one row, also with a null key; a word is restored only if the chain that explains most words of its field has one
original for it; other words stay as they are and the field's ``restored`` is false.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestream.plans.runtime import cut, ship

# Encodings that UTF-8 bytes are mistaken for, that are mistaken for UTF-8, and pairs
# of 8-bit encodings mistaken for each other (bytes of the first read as the second).
UTF8_READ_AS = ("latin_1", "cp1252", "iso8859_15", "cp1250", "iso8859_2", "cp1251", "cp1253", "cp1254", "cp1257", "iso8859_9", "cp437", "cp850", "cp852", "cp866", "mac_roman", "mac_cyrillic", "koi8_r", "gbk", "big5", "shift_jis", "euc_kr", "euc_jp", "cp1255", "cp1256", "cp874")
READ_AS_UTF8 = ("latin_1", "cp1252", "iso8859_15", "cp1250", "iso8859_2", "cp1251", "cp1253", "cp1254", "cp437", "mac_roman", "koi8_r", "gbk", "shift_jis", "euc_kr", "big5")
SWAPPED = (
    ("cp1251", "latin_1"), ("cp1251", "cp1252"), ("koi8_r", "latin_1"), ("koi8_r", "cp1252"), ("koi8_r", "cp1251"), ("cp1251", "koi8_r"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("cp866", "cp1252"), ("mac_cyrillic", "cp1251"),
    ("cp1253", "latin_1"), ("cp1253", "cp1252"), ("cp1250", "cp1252"), ("cp1250", "latin_1"), ("iso8859_2", "cp1252"), ("iso8859_2", "latin_1"), ("cp1252", "cp1250"), ("cp1252", "cp1251"), ("latin_1", "cp1251"), ("cp1254", "latin_1"), ("cp1254", "cp1252"),
    ("cp1252", "mac_roman"), ("mac_roman", "cp1252"), ("mac_roman", "latin_1"), ("cp1252", "cp437"), ("cp437", "cp1252"), ("cp1252", "cp850"), ("cp850", "cp1252"), ("cp852", "cp1250"), ("cp1252", "latin_1"), ("gbk", "latin_1"), ("gbk", "cp1252"), ("shift_jis", "cp1252"), ("shift_jis", "latin_1"), ("cp1252", "gbk"), ("latin_1", "gbk"), ("euc_kr", "latin_1"), ("big5", "latin_1"),
)
TWICE = (("cp1252", "cp1252"), ("latin_1", "latin_1"), ("cp1252", "latin_1"), ("latin_1", "cp1252"), ("cp1251", "cp1251"), ("cp1250", "cp1250"), ("mac_roman", "mac_roman"), ("cp437", "cp437"), ("cp1252", "cp1251"), ("cp1252", "mac_roman"))
MULTI_BYTE = {"gbk", "big5", "shift_jis", "euc_kr", "euc_jp"}

WORD = r"[A-Za-z']*+[^\x00-\x7F][A-Za-z'\x{80}-\x{10FFFF}]*+"
_WORD = re.compile("[A-Za-z']*[^\\x00-\\x7F][A-Za-z'\\x80-\\U0010ffff]*")
# The accented letters of Latin-1 that German, French, Spanish and Catalan, Portuguese, Italian, the Nordic languages,
# Icelandic and Faroese, Czech and Slovak, Dutch and Irish write.
ALPHABETS = ("äöüß", "àâæçèéêëîïôùûüÿ", "àáçèéíïñòóúü", "àáâãçéêíóôõúü", "àèéìíîòóùú", "åæøäöéèêóòôâü", "áæðéíóöøúýþ", "áäéíóôúý", "áéëïóöúèê")
_PROOF = r"[\uFFFD\x{80}-\x{9F}]|(?iu)(?<![\xC0-\xFF])(?!(?:" + "|".join(f"[{a}]+" for a in ALPHABETS) + r")(?![\xC0-\xFF]))[\xC0-\xFF]{5}"
# What no language writes inside a word (plain), and what few do.
_PLAIN = r"[A-Za-z][\x{370}-\x{4FF}]|[\x{370}-\x{4FF}][A-Za-z]|\p{Ll}\p{Lu}|\p{L}[\xA1-\xBF\xD7\xF7\x{2C6}\x{2DC}\x{2202}-\x{22FF}\x{25CA}]\p{L}"
_FEW = r"[\xC0-\xFF]{3}"
SALT = 16
#: Up to so many rows Spark may broadcast the table of forms.
BROADCAST_FORMS = 200_000
_tables: dict[str, dict[int, str]] = {}


def _decode(data: bytes, enc: str) -> str | None:
    """``data`` in an 8-bit encoding; bytes that it leaves undefined become control characters, as
    lenient readers do."""
    if enc in MULTI_BYTE:
        return data.decode(enc, "replace")
    if enc not in _tables:
        t = {}
        for b in range(256):
            try:
                t[b] = bytes([b]).decode(enc)
            except UnicodeDecodeError:
                t[b] = chr(b)
        _tables[enc] = t
    t = _tables[enc]
    return "".join([t[b] for b in data])


def _encode(word: str, enc: str, errors: str = "strict") -> bytes | None:
    try:
        return word.encode(enc, errors)
    except UnicodeEncodeError:
        return None


def garbled_forms(word: str) -> list[tuple[str, str, str]]:
    """(chain, kind, form) for each chain that changes ``word``."""
    out, utf8 = [], _encode(word, "utf-8")
    if utf8 is None or "�" in word:
        return out
    once = {}
    for enc in UTF8_READ_AS:
        form = _decode(utf8, enc)
        once[enc] = form
        out.append((f"utf8>{enc}", "utf8", form))
    for a, b in TWICE:
        form = once[a]
        data = _encode(form, "utf-8") if form else None
        if data is not None:
            out.append((f"utf8>{a}>utf8>{b}", "utf8", _decode(data, b)))
    for enc in READ_AS_UTF8:
        data = _encode(word, enc, "strict" if enc in MULTI_BYTE else "ignore")
        if data is not None:
            form = data.decode("utf-8", "replace")
            if "�" in form:
                out.append((f"{enc}>utf8", "loss", form))
    for a, b in SWAPPED:
        data = _encode(word, a)
        if data is not None:
            form = _decode(data, b)
            if form:
                out.append((f"{a}>{b}", "swap", form))
    return [(c, k, f) for c, k, f in out if f and f != word and not f.isascii()]


def _forms_table(vocabulary: DataFrame) -> DataFrame:
    """(form, chain, kind, original, n_original): the forms of all words of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(f, c, k, w, n) for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for c, k, f in garbled_forms(w)]
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, [pa.string()] * 4 + [pa.int64()])], ["form", "chain", "kind", "original", "n_original"])

    return vocabulary.select("word", "n").mapInArrow(run, "form string, chain string, kind string, original string, n_original bigint")


def texts_of(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(k, field, text, t): the fields that hold characters beyond ASCII; t are two hashes of the text."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), df[f].cast("string").alias("text")) for f in fields]))
    some = df.where(F.greatest(F.lit(0), *[F.coalesce(F.octet_length(df[f]) - F.char_length(df[f]), F.lit(0)) for f in fields]) > 0).select(df[key].alias("k"), each.alias("e"))
    some = some.select("k", "e.*").where(F.octet_length("text") > F.char_length("text"))
    return some.withColumn("t", F.struct(F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit(7)).alias("b")))


def text_words(texts: DataFrame) -> DataFrame:
    """(t, word): the distinct words with characters beyond ASCII of each text."""
    return texts.select("t", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))).alias("word")).distinct()


def _salted(many: DataFrame, few: DataFrame, on: list[str], salt: Column, how: str = "inner") -> DataFrame:
    """A join with each row of ``few`` under every salt: a key that most rows of ``many`` have is ``SALT`` tasks' work."""
    return many.withColumn("salt", salt).join(few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))), [*on, "salt"], how).drop("salt")


def _matches(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(texts, words) of affected texts: (t, chain, n_known, n_words) and (t, word, original) along the chain."""
    words = cut(text_words(texts), "words")
    vocabulary = words.groupBy("word").agg(F.count("*").alias("n"))  # copies of a text count once
    forms = _forms_table(vocabulary).join(vocabulary.select(F.col("word").alias("form"), F.col("n").alias("n_form")), "form")
    # the forms that occur: far fewer than all forms, as the vocabulary holds them already
    plain, odd = lambda c: F.col(c).rlike(_PLAIN), lambda c: F.col(c).rlike(_PLAIN).cast("int") * 2 + F.col(c).rlike(_FEW).cast("int")
    table = cut(forms.withColumns({"sign": odd("form") - odd("original"), "sure": plain("form") & ~plain("original")}), "forms")
    few = table.withColumnRenamed("form", "word")
    if table.count() > BROADCAST_FORMS:  # its size in memory is not that of its file, by which the optimizer would judge
        few = few.hint("shuffle_hash")
    hits = _salted(words, few, ["word"], F.pmod(F.col("t.a"), F.lit(SALT)).cast("int")).select("t", "word", "chain", "kind", "original", "n_original", "n_form", "sign", "sure").distinct()
    beyond = F.length(F.regexp_replace("word", r"[\x00-\x7F’‘“”–—…]", ""))
    per_chain = hits.groupBy("t", "chain", "kind").agg(
        F.collect_list(F.struct("word", "original")).alias("found"), F.count_distinct("word").alias("n_words"), F.max(beyond).alias("longest"), F.sum("sign").alias("sign"), F.sum("n_original").alias("n_o"), F.sum("n_form").alias("n_f"), F.max("sure").alias("sure")
    )
    counted = cut(per_chain.where("kind != 'swap' or (sign > 0 or sign = 0 and n_o > n_f) and (n_words >= 2 or longest >= 4 or sure)"), "hits")
    best = counted.groupBy("t").agg(F.max_by("chain", F.struct("n_words", F.col("kind") != "swap", "chain")).alias("chain"), F.max("n_words").alias("n_known"))
    # exact check: characters that only a wrong decoding leaves
    proof = words.where(F.col("word").rlike(_PROOF)).groupBy("t").agg(F.count("*").alias("n_proof"))
    every = best.join(proof, "t", "full").select("t", "chain", F.coalesce("n_known", F.lit(0)).alias("n_known"), F.greatest(F.coalesce("n_known", F.lit(0)), F.coalesce("n_proof", F.lit(0))).alias("n_words"))
    chosen = counted.join(best.select("t", "chain"), ["t", "chain"]).select("t", F.explode("found").alias("f")).select("t", "f.*")
    return every, chosen


def affected(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, chain, n_known, n_words): the affected fields, chain null where no word's original is known."""
    ship(df.sparkSession)
    texts = texts_of(df, key, fields)
    every, _ = _matches(texts)
    where = texts.select("k", "field", "t").distinct()
    return _salted(where, every, ["t"], _spread("k")).drop("t").withColumnRenamed("k", key)


def _spread(c: str) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(SALT)).cast("int")


def restored(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, chain, text, fixed, restored): the affected fields, with every word that has one
    verified original put back; ``restored`` is true where nothing garbled is known to be left."""
    ship(df.sparkSession)
    texts = texts_of(df, key, fields)
    every, chosen = _matches(texts)
    # one original for each garbled word of a text; the more frequent of words that differ only in
    # lost characters isn't verified, so such words stay
    known = chosen.groupBy("t", "word").agg(F.count_distinct("original").alias("n"), F.min("original").alias("original"))
    maps = known.groupBy("t").agg(F.collect_list(F.when(F.col("n") == 1, F.struct("word", "original"))).alias("pairs"), F.count_if(F.col("n") > 1).alias("open"))
    found = _salted(texts.dropDuplicates(["k", "field", "t"]), every.select("t", "chain").join(maps, "t", "left"), ["t"], _spread("k"))
    kept = found.select("k", "field", "chain", "text", "pairs", F.coalesce("open", F.lit(1)).alias("open"))
    kind = dict(kept.dtypes)["k"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, pairs = b.column(3).to_pylist(), b.column(4).to_pylist()
            fixed = []
            for t, p in zip(texts, pairs):
                m = {x["word"]: x["original"] for x in p or []}
                fixed.append(_WORD.sub(lambda w: m.get(w.group(), w.group()), t) if m else t)
            done = [bool(p) and o == 0 and not re.search("[�\x80-\x9f]", f) for p, o, f in zip(pairs, b.column(5).to_pylist(), fixed)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), pa.array(fixed, pa.string()), pa.array(done, pa.bool_())], ["k", "field", "chain", "text", "fixed", "restored"])

    made = kept.mapInArrow(run, f"k {kind}, field string, chain string, text string, fixed string, restored boolean")
    return made.withColumnRenamed("k", key)
