"""Template residue and error-page text (problem 5).

Records made from one template are aligned: a value that might be residue (anything in the
brackets of a template language, or a default such as ``undefined``) is keyed by its frame, the two
words before it and the one after. Aligned frames induce slots: a frame that is filled with two or
more different values is a slot, and a variable name, position, default or blank in it is one that
was never filled. Writers' own brackets stay in one frame with one value and induce nothing. Several
defaults in one segment are slots that all kept theirs.

Page templates: a segment (a line or sentence) of any body, however long, is keyed by its words up to its
first sign of residue, with numbers, ids and paths masked. Signs are slots that hold ids or paths of a machine,
control tags of a template and the wording of errors, notices and stand-ins (a fixed list). A writer who
speaks of themselves before it tells of an error, and gives no key. A key that is in several
different texts (copies of a text are one) is of a template, and flags every body with it, as its
whole or as a part. Text of filler words only, or of one word over and over, is flagged by itself.

One pass cuts the bodies into keys and candidate values; counts of keys and frames are plain
aggregations; the flagged keys (a small table, never forced into a broadcast) are joined back.

Defined results: null, empty and blank bodies and the platform's own marks are never flagged; of a
record written twice one row comes out; with one record of a kind nothing can be
aligned, so only fillers and segments with several defaults are flagged. A page without ids, paths and
listed wording is not found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.plans.runtime import cut, ship

MIN_WORDS, SALT = 4, 16
# What platforms put in place of a body.
PLATFORM_MARKS = frozenset(("[removed]", "[deleted]", "[deleted by user]", "[removed by moderator]"))
# Words of the usual filler texts and of keyboards tried out.
FILLER_WORDS = frozenset(
    "lorem ipsum dolor sit amet consectetur consectetuer adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum vestibulum faucibus pulvinar tincidunt rhoncus mattis sagittis lacinia porttitor ornare viverra maecenas egestas pretium lobortis tortor nec vel ac leo felis nunc mauris turpis pellentesque habitant morbi tristique senectus netus malesuada fames integer vitae justo eget arcu dictum varius donec purus massa ultrices cras gravida quam blandit suscipit feugiat aenean phasellus vivamus asdf asdfgh asdfjkl jkl qwer qwerty qwertz foo bar baz qux blah xxx test hjkl zxcv".split()
)
_FUNCTION = frozenset("do in id est et ad ex ea non sit sed ut qui a ac vel nec test bar sint".split())

_VALUE = re.compile(
    r"""\{\{\s*(?P<a>[^{}\n]{1,200}?)\s*\}\}|\$\{\s*(?P<b>[^{}\n]{1,200}?)\s*\}|\#\{\s*(?P<c>[^{}\n]{1,200}?)\s*\}|<%=?\s*(?P<d>[^%<>\n]{1,200}?)\s*%>|@@(?P<e>[\w.\- ]{1,200}?)@@
    |%\((?P<f>[\w.]{1,200})\)[sdif]|\[\[\s*(?P<g>[^\[\]\n]{1,200}?)\s*\]\]|__(?P<h>[A-Za-z][\w.]{0,200}?)__|\$(?P<i>[A-Z][A-Z_.]{2,200})\$|%(?P<j>[A-Z][A-Z_.]{2,200})%
    |\[object\ (?P<o>Object)\]|<(?:INSERT|ENTER|YOUR|ADD)[ _](?P<k>[^<>\n]{1,200})>|<(?P<l>[A-Z][A-Z_ ]{2,200})>|\[(?P<m>[^\[\]()\n]{2,200})\](?!\()|\((?:insert|enter|your|add)\ (?P<n>[^()\n]{1,200})\)
    |\{%-?\s*(?:(?:if|for|unless|elif|with|include)\ )?(?P<t>[\w.\- ]{1,200}?)\s*-?%\}
    |\{(?P<p>[^{}\n"':]{1,200})\}|(?P<q>%[sd])(?![\w%])|\b(?P<r>undefined|NaN|null|None|nil|TBD|TBA|FIXME|XXX+)\b|(?P<s>_{3,})""",
    re.X,
)
_HINT = re.compile(r"[{}\[\]<@_]|%[\w(]|\$[A-Z{]|\((?:insert|enter|your|add) |undefined|NaN|null|None|nil|TB[DA]|FIXME|XXX")
_SPLIT = re.compile(r"(?<=[.!?])\s+|\n+")
_NAME = re.compile(r"[a-z][\w.\- ]*[a-z]", re.I)
_MASKED = re.compile(r"(?:(?<=\W)|^)/\S+|[0-9a-f]*\d[0-9a-f]*")
_NUMBERS = frozenset("one two three four five six seven eight nine ten".split())
_COMMON_BRACKET = frozenset("mp")  # syntaxes that people use in prose too
# Wording of errors, notices and stand-ins; ids and paths of machines; words of writers who speak of themselves.
_WORDING = re.compile(
    r"""\b(?:(?:java|type)?scripts?|no-?script|skripte?|js|browsers?|navegador|navigateur|cookies|x?html|https?(?=[ /]\d)|database|server|serveur|servidor|backend|upstream|gateway|traceback|(?:null ?pointer|un(?:caught|handled)\ )?exception|key ?error
    |access (?:is )?denied|forbidden|permission to|(?:page|file|url|thread|post|\d{3}):? (?:was )?not found|no existe|introuvable|(?:nicht|non|no|não) (?:gefunden|trovat[ao]|encontrad[ao])|bad request|too many requests|session (?:has |is )?(?:expired|timed out)
    |internal error|something went wrong|temporarily unavailable|service (?:un)?available|under maintenance|you are (?:human|not a robot)|blindtext|dummy text|filler text|placeholder|texto de relleno|texte de remplissage|testo segnaposto|content for draft
    |(?:sample|test|example) (?:post|entry|body|text)|goes (?:here|above|below)|(?:type|write|enter|insert) your|todo|error \d{3}|\d{3} error|fehler|przeglądark\w+|skrypt\w*|браузер\w*|скрипт\w*|сервер\w*|страница не найдена|ошибка \d+)\b
    |<(?:no)?script|\{%|\b(?!(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)\b)([^\W\d_]+)(?:\W+\1\b){3}|脚本|腳本|浏览器|瀏覽器|服务器|伺服器|ブラウザ|スクリプト|サーバー""".replace("\n    ", ""),
    re.I,
)
_ID = re.compile(r"(?<![\w:/.)\]])/[\w\-./]*\d|\b(?=[a-f]*\d)(?=\d*[a-f])[0-9a-f]{6,}\b", re.I)
_OWN = re.compile(r"\b(?:i|i['’][a-z]+|my|me|mine|ich|mein\w*|mir|mich|je|j['’]ai|mon|ma|yo|mi|io|mio|mia|eu|meu|minha|я|мне|мой|меня)\b", re.I)
_TOKEN = re.compile(r"(?:(?<=\W)|^)/\S+|[^\W_]+")


def page_key(segment: str) -> int | None:
    """The masked words of a segment up to its first sign of residue, as a number; None without one."""
    signs = [m.end() for m in (_WORDING.search(segment), _ID.search(segment)) if m]
    if not signs or _OWN.search(segment, 0, min(signs)):
        return None
    ws = []
    for m in _TOKEN.finditer(segment):
        if len(ws) >= MIN_WORDS and m.start() >= min(signs):
            break
        ws.append(_MASKED.sub("0", m.group().lower()))
    return xxhash.xxh3_64_intdigest(" ".join(ws)) - (1 << 63)


def _word(w: str) -> str:
    w = w.strip(".,;:!?()\"'").lower()
    return "0" if w in _NUMBERS or any(c.isdigit() for c in w) else w


def candidates(segment: str) -> list[tuple[str, str, str]]:
    """(frame, value, syntax) of the values in a segment that may be residue."""
    ms = [m for m in _VALUE.finditer(segment)]
    if not ms:
        return []
    out = []
    for m in ms:
        syntax = m.lastgroup
        value = m.group(syntax).strip().lower().replace("_", " ").removeprefix("your ").removeprefix("insert ").removesuffix(" here")
        before = _VALUE.sub(" § ", segment[max(0, m.start() - 60) : m.start()]).split()[-2:]
        after = _VALUE.sub(" § ", segment[m.end() : m.end() + 40]).split()[:1]
        if syntax not in "qrs":
            plain = value.isdigit() if syntax == "p" else False
            if not plain and not (_NAME.fullmatch(value) and len(value.split()) <= 12 and len(value) >= 3):
                continue
            if syntax == "m" and not (re.match(r"(?:YOUR|INSERT|ENTER|ADD)\b", m.group(syntax)) or m.group(syntax).isupper()):
                continue
        out.append((" ".join(map(_word, before)) + "|" + " ".join(map(_word, after)), value, syntax))
    return out


def is_filler(segment: str) -> bool:
    """A run of filler words, or of one word over and over, in a segment."""
    run = strong = again = 0
    last = ""
    for w in re.findall(r"[^\W\d_]+", segment.lower()):
        again = again + 1 if w == last else 1
        last = w
        if w in FILLER_WORDS:
            run, strong = run + 1, strong + (w not in _FUNCTION)
        else:
            run = strong = 0
        if again >= 6 or (run >= 5 and strong >= 3) or (run >= 6 and strong >= 2):
            return True
    return False


def _cut_up(df: DataFrame, key: str, text: str) -> DataFrame:
    ship(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    value = pa.struct([("frame", pa.string()), ("value", pa.string()), ("syntax", pa.string()), ("segment", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts, keys, found, filler = [], [], [], [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                t = (t or "").strip()
                if not t or t.lower() in PLATFORM_MARKS:
                    continue
                segments = [s for s in _SPLIT.split(t) if s]
                ids.append(k)
                texts.append(xxhash.xxh3_64_intdigest(t) - (1 << 63))
                keys.append([x for x in map(page_key, segments) if x is not None])
                c = []
                if _HINT.search(t):
                    c = [{"frame": f, "value": v, "syntax": x, "segment": i} for i, s in enumerate(segments) if _HINT.search(s) for f, v, x in candidates(s)]
                found.append(c)
                filler.append(any(is_filler(s) for s in segments))
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.column(0).type), pa.array(texts, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(found, pa.list_(value)), pa.array(filler, pa.bool_())], ["k", "text", "keys", "found", "filler"])

    return df.select(df[key].alias("k"), df[text].cast("string").alias("t")).mapInArrow(
        run, f"k {kind}, text bigint, keys array<bigint>, found array<struct<frame:string,value:string,syntax:string,segment:int>>, filler boolean"
    )


def residue(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, page, slots, filler): the records with residue, and which kinds were found."""
    cuts = cut(_cut_up(df, key, text).dropDuplicates(["k", "text"]), "segments")
    each = cuts.select("k", "text", F.explode(F.array_distinct("keys")).alias("key"))
    # the two smallest texts tell whether there are several, and are put together before the shuffle
    pages = cut(each.groupBy("key").agg(F.min("text").alias("one"), F.max("text").alias("other")).where("one <> other").select("key"), "pages")
    # joined by records with each key under every salt: a key that most records have is many tasks' work
    salt = F.pmod(F.xxhash64("text", "k"), F.lit(SALT)).cast("int")
    on_page = each.withColumn("salt", salt).join(pages.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))), ["key", "salt"], "left_semi").select("k", F.lit("page").alias("kind"))

    values = cuts.where(F.size("found") > 0).select("k", F.explode("found").alias("v")).select("k", "v.*")
    slots = values.groupBy("frame").agg(F.count_distinct("value").alias("n_values"), F.count_distinct("k").alias("n_k")).where("n_values >= 2 and n_k >= 2").select("frame")
    defaults = F.col("syntax").isin("o", "r", "s", "q")
    unfilled = values.join(slots, "frame", "left_semi").select("k")
    several = values.groupBy("k", "segment").agg(F.count("*").alias("n"), F.count_if(defaults).alias("n_defaults")).where("n >= 2 and n_defaults >= 2").select("k")
    # a variable name in three or more template syntaxes is one in any frame
    names = values.where(~F.col("syntax").isin("q", "r", "s", "m", "p")).groupBy("value").agg(F.count_distinct("syntax").alias("n")).where("n >= 3").select("value")
    named = values.where(~defaults).join(names, "value", "left_semi").select("k")
    in_slot = unfilled.unionByName(several).unionByName(named).withColumn("kind", F.lit("slots"))
    filler = cuts.where("filler").select("k", F.lit("filler").alias("kind"))
    every = on_page.unionByName(in_slot).unionByName(filler)
    has = lambda x: F.max(F.col("kind") == x).alias(x)
    return every.groupBy("k").agg(has("page"), has("slots"), has("filler")).withColumnRenamed("k", key)


def excluded(df: DataFrame, key: str, text: str) -> DataFrame:
    """``df`` without the records that hold residue; records with a null key stay."""
    return df.join(residue(df, key, text).select(key), key, "left_anti")
