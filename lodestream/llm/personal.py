"""Personal information inside free text (problem 1): found, and replaced by typed placeholders.

Weak supervision. One pass over the texts cuts out candidate spans with what stands around them, and
counts words; everything after it reads only those. Labelers of three sorts vote on each span for a kind
or against all: patterns (the form of an address of mail, a phone number, an identity number, a street
address, a name), gazetteers (words that are common in the corpus, words that occur as names elsewhere,
ways, goods) and contexts (what stands before and after). How often each pattern of votes occurs, over all
spans of all records, is one small aggregation; on it expectation-maximisation estimates the labelers'
reliabilities and a probability of each kind for each pattern of votes. These train the final span
classifier, a linear model over votes, hashed context words and the span's form, which decides on every span.

The vocabulary of common words and of names is counted over all records and aggregated before it is
shuffled; the classifier comes from the ``sample_spans`` spans with the smallest hashes, a bounded sample.
Spans, votes and decisions cover all records and whole texts. A field that is only the cleaned form of the
others takes over their spans, at their places, instead of being read again. Masking is one more pass over the
texts with the same model, without a shuffle of texts.

Defined results: null, empty and blank fields have no spans; a record written twice gives one row for
each field and kind; spans do not overlap: the earlier kind of ``KINDS`` wins, then the longer span;
null keys are kept as null; without any candidate span nothing is found.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm import linear
from lodestream.plans.runtime import cut, forget, ship

KINDS = ("email", "phone", "id_number", "address", "name")
SAMPLE_SPANS, BITS = 20_000, 15
BEFORE, AFTER = 44, 26
COMMON_IN, NAME_BITS = 1500, 1 << 26
PRIOR_VOTES = 100.0
DIM = 1 << BITS
NONE, EMAIL, PHONE, ID, ADDRESS, NAME = range(6)

# Words of ways, of titles, of goods and doses, of numbers.
_WAY = r"(?i:road|street|lane|avenue|boulevard|crescent|terrace|ave\.?|blvd\.?|rd\.)|(?:Mews|Gardens|Grove|Hill|Walk|Parade|Quay|Court|Drive|Square|Close|Way|Place|Row|COURT|DRIVE|SQUARE|CLOSE|WAY|PLACE|ROW|court|St\.|ST\.|st\.|Rd|RD|Ln\.|LN\.)"
_TITLES = r"mrs?|ms|miss|dr|prof|nurse|doctor|sister|pharmacist|frau|herr|señora?|mme"
_DIGIT = r"oh|zero|one|two|three|four|five|six|seven|eight|nine"
NOT_PERSONS = frozenset("google wikipedia pepper scholl scholl's john's crohn's raynaud's bell's parkinson's alzheimer's hashimoto's tourette's down's epsom pharmacy clinic hospital monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december english spanish german french reddit discord internet gateway server error access page blindtext forum website".split())

_W = r"[^\W\d_](?:[\w'’]*[^\W\d_])?"
_CAP = r"[A-ZÀ-Þ][\w'’]*[^\W\d_]"
_LOW = r"[a-zß-ÿ]{2,}"
_FULL = rf"{_W}(?: [A-Za-z]\.)? {_W}(?:-{_W})?"
_MAIL = re.compile(r"[A-Za-z0-9][\w.+\-]{0,63} ?[@＠] ?(?:[A-Za-z0-9][\w\-]* ?\. ?)+[A-Za-z]{2,}|[A-Za-z0-9][\w.+\-]{0,63} ?(?:[\[(] ?(?:at|AT) ?[\])]|(?<= )(?:AT|at)(?= )) ?[A-Za-z][\w\-]*(?: ?(?:[\[(] ?(?:dot|DOT) ?[\])]|(?<= )(?:DOT|dot)(?= )) ?[A-Za-z][\w\-]*)+")
_MAIL_HINT = re.compile(r"[@＠]|[\[( ](?:dot|DOT)[\]) ]")
_NUMBER = re.compile(
    r"(?<![\w/.:\-])(?:\d{2}[ \-]\d{5,6}[ \-][A-Z](?:[ \-]\d{3})?|[A-Z]{1,4}-?\d[\d\-]{4,14}(?:-[A-Z])?|\+?\(?\d[\d\-. ()]{5,20}\d(?: ?(?:ext\.?|EXT\.?|x) ?\d{1,5})?)(?![\w/]|:\d)"
)
_SPELLED = re.compile(rf"\b(?i:(?:(?:{_DIGIT})(?:, | |-)){{6,}}(?:{_DIGIT})\b(?: (?:ext\.?|x) ?\d{{1,5}})?)")
_PLACE = r"(?:[,\n ]+[A-Z][A-Za-z'’\-]+(?: [A-Z][A-Za-z'’\-]{2,})?)?(?:[,\n ]+(?:[A-Z]{1,2}\d[\dA-Z]? ?\d[A-Z]{2}|[A-Z]{2} \d{5}))?"
_UNIT = r"(?:apt|flat|unit|suite|apartment)\.? ?\w{1,4}"
_STREET = re.compile(rf"(?:(?i:{_UNIT}),? )?\b\d{{1,5}}[A-Za-z]? (?:[A-Za-z][\w'’\-]* ){{1,3}}(?:{_WAY})(?!\w)(?:[,\n ]+(?i:{_UNIT}))?{_PLACE}")
_STREET_HINT = re.compile(rf"\b(?:{_WAY})(?!\w)")
_LAST_WORD = re.compile(r"[\s,]+([A-Z][A-Za-z'’\-]*)\Z")
_ABROAD = re.compile(
    r"\b(?i:rue|calle(?: del?)?(?: la)?|via|rua|avenida|plaza|camino|chemin|place de) [A-Z][\w'’\-]+ \d{1,4}(?:, ?\d{0,2}[A-Z]{0,2}(?=[,\s.]|$))?" + _PLACE
    + r"|\b[A-ZÄÖÜ][\w]+?(?i:weg|stra(?:ß|ss)e|str\.|gasse|platz|allee|ufer) \d{1,4}[a-z]?(?:, ?\d{4,5} [A-Z][\w\-]+)?"
)
_LEAD = (
    r"my name is|my name's|name(?: is)?:?|signed,?|(?:kind |best )?regards,?|thanks,?|cheers,?|yours,?|sincerely,?|(?:seen|treated|written|filled|signed) by|belongs to|ask(?:ing)? for|else see|(?:bottle|box|pack|jar) of|label[^.:\n]{0,20}:|reads|"
    r"pt:|patient:?|attn:?|says|said|named|called|my (?:sister|brother|wife|husband|aunt|uncle|cousin|friend|boss|partner|neighbou?r|colleague|roommate|flatmate|landlord|dad|mum|mom|father|mother|grandmother|grandfather|daughter|son),?|from|by"
)
_VERB = r"told|said|says|asked|asking|lent|gave|wrote|answered|had|has|handed|mentioned|thinks|swears|works|lives|posting"
_AFTER = rf"here\b|next door|at the (?:counter|desk|till|front)|who|, who|found in|and then|still|about|on (?:mon|tues|wednes|thurs|fri|satur|sun)day|(?:{_VERB})\b|: |/"
_NAMED = rf"{_CAP}, {_CAP}|{_CAP}(?: [A-Z]\.)? {_CAP}(?:-{_CAP})?|{_CAP}(?:-{_CAP})?|{_LOW}(?: [a-z]\.)? {_LOW}(?:-{_LOW})?(?=$|[\n,.;:!?/]| {{2}}|  *[A-Z]| (?:on|at|about|and|asking|had|here|found|who|told|said) )"
_LED = re.compile(rf"[,:.]{{0,2}}[ \n](?P<n>{_NAMED})")
_COLON = re.compile(rf":[ \n](?P<n>{_CAP}, {_CAP}|{_CAP}(?: [A-Z]\.)? {_CAP}(?:-{_CAP})?)")
_DASH = re.compile(rf"- (?P<n>{_NAMED})")
_TITLED = re.compile(rf"\b(?i:{_TITLES})\.? (?P<n>{_CAP}(?: [A-Z]\.)?(?: {_CAP})?(?:-{_CAP})?)")
_FOLLOWED = re.compile(rf"(?<![^\s(\"'])(?P<n>[A-ZÀ-Þ][a-zß-ÿ]+(?:[ -][A-ZÀ-Þ][a-zß-ÿ]+)?)(?=(?: here,?| next door| at the \w+)? (?:{_VERB})\b|,? here\b| next door| at the (?:counter|desk|till|front))")
_FOLLOWED_LOW = re.compile(rf"(?<![\w'’])(?P<n>{_FULL})\Z")
_PAIR = re.compile(r"\b(?P<n>[A-ZÀ-Þ][^\W\d_A-Z]+(?: [A-Z]\.)?,? [A-ZÀ-Þ][^\W\d_A-Z]+(?:-[A-ZÀ-Þ][^\W\d_A-Z]+)?)(?![\w'’])")
_FOLLOW_HINT = re.compile(r" here, (?:posting|asking|writing|checking)\b| here again| next door| at the (?:counter|desk|till|front)| asking about| told me| had the same")
_TITLE_FIRST = re.compile(rf"(?i:{_TITLES})\.? (?=\w)")
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_LINK = re.compile(r"\[([^\]]+)\]\([^)]*\)")
_URL = re.compile(r"https?://\S+")

_BEFORE_PHONE = re.compile(r"\b(?:ask|call|calling|called|text|whatsapp|tel|phone|cell|mobile|ring|dial|sms|fax|my number|reach me|left|number is)\b[^.\n]{0,16}$")
_AFTER_PHONE = re.compile(r"^[^.\n]{0,6}(?:works|and hang|who answers|is my (?:cell|phone|number|mobile)|text|ask|after \d|with (?:a|my|the)|ext|for )|^ ?, text")
_BEFORE_ID = re.compile(r"\b(?:ssn|social(?: security)?(?: number)?|insurance|policy|passport|licen[cs]e|dl ?#?|patient|member|holder|nhs|health service|id|identity|tax|pension|national|medicare|account|mrn|no\.?|number)\b[^\n]{0,14}$")
_STRONG_ID = re.compile(r"\b(?:ssn|social|insurance|policy|passport|licen[cs]e|dl ?#|patient id|member|holder|nhs|health service|identity|id no|tax|pension|medicare|mrn)\b[^\n]{0,26}$")
_AFTER_ID = re.compile(r"^[: ]*(?:(?:was |is |got )?(?:refused|rejected|needed|printed|copied|denied|declined)|is what|before |on the|at the counter|if )|^: \w+ refused")
_GOODS = re.compile(r"(?:\b(?:order|lot|item|serial|batch|version|model|ref(?:erence)?|ticket|case|code|incident|invoice|parcel|tracking|isbn|barcode|thread|error|lot reads|part|page|sku)\b[^.\n]{0,6}|#)$")
_DOSE_BEFORE = re.compile(r"\b(?:bp|pressure|pulse|schedule|dose|total|took|so|weigh|lists|temperature|years?|in|was)\b[^.\n]{0,8}$")
_DOSE_AFTER = re.compile(r"^ ?(?:mg|mcg|ml|g\b|tablets|capsules|caplets|pills|times|hours|running|%|am\b|pm\b|bpm)")
_AT_HOME = re.compile(r"\b(?:live[sd]? at|lives? (?:at|in)|moved to|deliver(?:ed)? to|addr(?:ess)?:?|staying at|stuck at|near|nearest place to|went to|ship(?:ped)? to|sent to|home is|pharmacy near|place to)\W*$")
_TRIP = re.compile(r"\b(?:mile|km|hour|minute|day|dollar|mg|way|one|long)\b", re.I)
_LEAD_END = re.compile(rf"(?:\b(?:{_LEAD})|(?:^|\n|[.?!] {{1,2}})-)[ \n]$", re.I)
_STRONG_LEAD = re.compile(r"(?:\b(?:my name is|my name's|signed,?|(?:kind |best )?regards,?|(?:seen|treated|written|filled|signed) by|belongs to|ask for|else see|label[^.:\n]{0,20}:|pt:|patient:|attn:?|thanks,)|(?:^|\n|[.?!] {1,2})-)[ \n]$", re.I)
_TITLE_END = re.compile(rf"\b(?:{_TITLES})\.? $", re.I)
_AFTER_NAME = re.compile(rf"^,? ?(?:{_AFTER})", re.I)
_ID_FORM = re.compile(r"\d{3}[- ]\d{2}[- ]\d{4}|9\d{8}|[A-Z]{1,4}-?\d{3,}[\d\-]*(?:-[A-Z])?|\d{2}[- ]\d{5,6}[- ][A-Z](?:[- ]\d{3})?", re.I)
_PHONE_FORM = re.compile(r"\+\d[\d\-. ()]{8,}\d.*|(?:1[-. ])?\(?\d{3}\)?[-. ]?\d{3}[-. ]?\d{4}(?: ?(?:ext\.?|x) ?\d+)?|0\d{3,4}[ \-]?\d{6}|0\d{2} \d{4} \d{4}|\d{3}[- ]\d{4}", re.I)
_SURE_PHONE = re.compile(r"\+.*|.*\(\d{3}\).*|1[-. ]\(?\d{3}.*|0\d.*|.*ext.*", re.I)

N_LABELERS = 14
#: How much more often than by chance each labeler is first taken to vote for the right kind: contexts more than forms.
STRENGTH = (6, 4, 8, 8, 8, 5, 20, 40, 8, 20, 20, 8, 6, 12)


def _h(s: str) -> int:
    return xxhash.xxh32_intdigest(s) & (DIM - 1)


# the last words of leads, and words that must occur for a pattern to match: cheaper than the patterns themselves
_DIGITS = frozenset(_DIGIT.split("|"))
_WAYS = frozenset("road street lane avenue boulevard crescent terrace ave blvd rd mews gardens grove hill walk parade quay court drive square close way place row st ln".split())
_WAYS_ABROAD = frozenset("rue calle via rua avenida plaza camino chemin place".split())
_WAY_END = re.compile(r"(?:weg|stra(?:ß|ss)e|str|gasse|platz|allee|ufer)\b")
_TITLE_WORDS = frozenset("mr mrs ms miss dr prof nurse doctor sister pharmacist frau herr señor señora mme".split())
_FIGURE = re.compile(r"\d")
_LEAD_LAST = frozenset(
    "is name name's signed regards thanks cheers yours sincerely by to for see of label labeled labelled reads pt patient attn says said named called sister brother wife husband aunt uncle cousin friend boss partner"
    " neighbour neighbor colleague roommate flatmate landlord dad mum mom father mother grandmother grandfather daughter son from".split()
)


def _tokens(text: str) -> tuple[list[str], list[int]]:
    """Words in lower case, and where those that may end a lead do."""
    ws, leads = [], []
    for m in _TOKEN.finditer(text):
        w = m.group().lower()
        ws.append(w)
        if w in _LEAD_LAST:
            leads.append(m.end())
    return ws, leads


def candidates(text: str, tokens: tuple[list[str], list[int]] | None = None) -> list[tuple[int, int, int]]:
    """(start, end, kind of pattern) of the spans that may be personal, not overlapping; ``tokens``: what
    :func:`_tokens` gives for it."""
    out: list[tuple[int, int, int]] = []
    ws, leads = tokens or _tokens(text)
    have = set(ws)
    figures = _FIGURE.search(text) is not None
    if _MAIL_HINT.search(text):
        out += [(*m.span(), EMAIL) for m in _MAIL.finditer(text)]
    spelled = not have.isdisjoint(_DIGITS) and sum(w in _DIGITS for w in ws) >= 7
    if figures or spelled:
        for p in ([_NUMBER] if figures else []) + ([_SPELLED] if spelled else []):
            for m in p.finditer(text):
                n = m.group()
                if sum(c.isdigit() for c in n) >= 7 or not n[0].isdigit() and n[:1] not in "+(":
                    out.append((*m.span(), PHONE))
                elif re.search(r"\d{5,}", n) and re.search("[A-Z]", n):
                    out.append((*m.span(), PHONE))
    if figures:
        if not have.isdisjoint(_WAYS) and _STREET_HINT.search(text):
            out += [(*m.span(), ADDRESS) for m in _STREET.finditer(text)]
        if not have.isdisjoint(_WAYS_ABROAD) or any(_WAY_END.search(w) for w in have):
            out += [(*m.span(), ADDRESS) for m in _ABROAD.finditer(text)]
    names = [_PAIR, _FOLLOWED, _COLON] if have.isdisjoint(_TITLE_WORDS) else [_TITLED, _PAIR, _FOLLOWED, _COLON]
    out += [(*m.span("n"), NAME) for p in names for m in p.finditer(text)]
    led = [m for at in leads if (m := _LED.match(text, at))] + (list(_DASH.finditer(text)) if "- " in text else [])
    out += [(*m.span("n"), NAME) for m in led if _LEAD_END.search(text, max(0, m.start("n") - BEFORE), m.start("n"))]
    for h in _FOLLOW_HINT.finditer(text):
        lo = max(0, h.start() - 60)
        if m := _FOLLOWED_LOW.search(text[lo : h.start()]):
            out.append((lo + m.start("n"), lo + m.end("n"), NAME))
    out = [(a + len(m.group()), b, k) if k == NAME and (m := _TITLE_FIRST.match(text, a, b)) else (a, b, k) for a, b, k in out]
    if len(out) > 1:
        out.sort(key=lambda x: (x[2], x[0] - x[1], x[0]))
        kept: list[tuple[int, int, int]] = []
        for x in out:
            if all(x[1] <= k[0] or x[0] >= k[1] for k in kept):
                kept.append(x)
        out = kept
    return out


def trimmed(text: str, start: int, end: int, common: frozenset) -> tuple[int, int]:
    """A name without common words at either end, unless nothing else is left."""
    ws = [(start + m.start(), start + m.end(), m.group().lower() in common) for m in _TOKEN.finditer(text[start:end])]
    own = [w for w in ws if not w[2]]
    return (own[0][0], own[-1][1]) if own else (start, end)


def without_sentence(text: str, start: int, end: int, common: frozenset) -> tuple[int, int]:
    """A street address without the beginning of the next sentence: common words after its way."""
    while (m := _LAST_WORD.search(text, start, end)) and m.group(1).lower() in common and not _STREET_HINT.fullmatch(m.group(1)):
        end = m.start()
    return start, end


def judge(text: str, start: int, end: int, kind: int, common: frozenset, known: frozenset):
    """(votes, features) of a span: a vote is a digit for a kind, 0 for none of them, or ``-``."""
    span, before, after = text[start:end], text[max(0, start - BEFORE) : start], text[end : end + AFTER]
    lb, la = before.lower(), after.lower()
    v = ["-"] * N_LABELERS
    form = re.sub(r"[A-Z]", "A", re.sub(r"[a-z]+", "a", re.sub(r"\d", "0", span)))[:24]
    if kind == EMAIL:
        v[0] = "1"
        tail = re.split(r"\.| dot |\]|\)", span.lower())[-1].strip(" .)]")
        v[1] = "0" if re.fullmatch(r"(?:pm|am|m|mg)", tail) or re.match(r"(?:\d+|one|two|three|four)$", re.split(r"[@＠]", span)[0].strip().lower()) else "1"
        if re.search(r"(?:mail|contact|reach|write|reply|answers|photo from|login|to|if you|\()\W*\w*\W*$", lb):
            v[2] = "1"
    elif kind == PHONE:
        digits = sum(c.isdigit() for c in span)
        spelled = digits < 7 and not re.search("[A-Z]-?\\d", span) and bool(re.match(_DIGIT, span.lower()))
        if spelled:
            v[3] = "2"
        if _PHONE_FORM.fullmatch(span):
            v[4 if _SURE_PHONE.fullmatch(span) else 1] = "2"
        if _ID_FORM.fullmatch(span):
            v[5] = "3"
        if (_BEFORE_PHONE.search(lb) or _AFTER_PHONE.search(la)) and not _STRONG_ID.search(lb):
            v[6] = "2"
        if _STRONG_ID.search(lb) or _AFTER_ID.search(la):
            v[7] = "3"
        elif _BEFORE_ID.search(lb):
            v[8] = "3"
        if _GOODS.search(lb):
            v[9] = "0"
        if _DOSE_AFTER.match(la) or _DOSE_BEFORE.search(lb) and not spelled and digits < 9 or re.search(r"\d{1,2}(?:[- ]\d{1,2}){3,}|\d \d{3,4} \d{3,4}\b", span) and re.search(r"\b(?:200|325|400|500|600|650|800|1000|1500)\b", span):
            v[10] = "0"
    elif kind == ADDRESS:
        v[0] = "4"
        if _AT_HOME.search(lb):
            v[2] = "4"
        ws = span.split()
        if _TRIP.search(span) and not re.search(r"\d[^,\n]* [A-Z]", span):
            v[1] = "0"
        elif len(ws) > 3 and re.search(r"[A-Z]{2} \d{5}|[A-Z]{1,2}\d[\dA-Z]? ?\d[A-Z]{2}|\d{5}|(?i:apt|flat)", span):
            v[1] = "4"
        if re.match(r" ?(?:trip|price|fair|food|journey|drive)", la):
            v[9] = "0"
    else:
        ws = [w.lower() for w in _TOKEN.findall(span) if len(w) > 1]
        n_common = sum(w in common or w in NOT_PERSONS for w in ws)
        lower = span.islower()
        if _STRONG_LEAD.search(before):
            v[6] = "5"
        elif _LEAD_END.search(before):
            v[8] = "5"
        if _TITLE_END.search(before):
            v[7] = "5"
        if _AFTER_NAME.match(after):
            v[10] = "5"
        if re.fullmatch(r"[A-ZÀ-Þ]\w+ [A-Z]\. [A-ZÀ-Þ][\w\-]+|[A-ZÀ-Þ]\w+ [A-ZÀ-Þ]\w+-[A-ZÀ-Þ]\w+", span):
            v[3] = "5"
        if n_common:
            v[11] = "0"
        elif ws and all(w in known for w in ws):
            v[12] = "5"
        elif ws:
            v[12] = "5" if not lower and any(w in known for w in ws) else "-"
        if any(w in NOT_PERSONS or w.endswith(("'s", "’s", "n't", "'ve", "'m", "'ll", "'d")) for w in ws) or n_common == len(ws):
            v[13] = "0"
        elif len(ws) < 2 and all(v[j] == "-" for j in (6, 7, 8, 10)):
            v[9] = "0"  # a single word needs a context
        elif not n_common and ws and not lower:
            v[13] = "5"
        form = f"{len(ws)} {n_common} {lower} {span.isupper()}"
    left = re.findall(r"[^\W\d_]+|[#:@(+]|\d+", lb)[-3:]
    right = re.findall(r"[^\W\d_]+|[#:@)+,]|\d+", la)[:2]
    f = [f"k{kind}", f"f{kind} {form}", *(f"v{i}{x}" for i, x in enumerate(v) if x != "-")]
    f += [f"l{i}{w if not w.isdigit() else 0}" for i, w in enumerate(reversed(left))] + [f"r{i}{w if not w.isdigit() else 0}" for i, w in enumerate(right)]
    return f"{kind}{''.join(v)}", sorted({_h(f"{kind} {x}") for x in f})


def _count_words(text: str, tokens: list[str], spans: list[tuple[int, int, int]], outside: Counter, inside: Counter) -> None:
    """Adds the words of a text to those of texts and, where only names stand, to those of names."""
    strong = []
    for a, b, k in spans:
        if k != NAME:
            strong.append((a, b))
            if k == EMAIL:
                inside.update(w.lower() for w in _TOKEN.findall(re.split(r"[@＠\[(]| AT | at ", text[a:b])[0]) if len(w) > 2)
        else:
            before = text[max(0, a - BEFORE) : a]
            if _STRONG_LEAD.search(before) or _TITLE_END.search(before):
                strong.append((a, b))
                inside.update(w.lower() for w in _TOKEN.findall(text[a:b]) if len(w) > 2)
    if strong:
        rest, at = [], 0
        for a, b in sorted(strong):
            rest.append(text[at:a])
            at = b
        rest.append(text[at:])
        tokens = _TOKEN.findall(" ".join(rest).lower())
    outside.update(set(tokens))


class Names:
    """A set of words as ``NAME_BITS`` bits, whatever their number; with two million words another word is
    taken for one of them with a probability of about 2e-4."""

    def __init__(self, at: np.ndarray, bits: np.ndarray):
        """``bits``: the 64 bits of each place in ``at``."""
        every = np.zeros(NAME_BITS // 64, "<i8")
        every[at] = bits
        self.bits = every.tobytes()

    @staticmethod
    def places(word: str) -> list[int]:
        h = xxhash.xxh3_128_intdigest(word)
        return [(h >> (32 * i)) % NAME_BITS for i in range(4)]

    def __contains__(self, word: str) -> bool:
        return all(self.bits[x >> 3] >> (x & 7) & 1 for x in self.places(word))


def _placed(span: str, cleaned: str, near: int) -> int:
    """Where a span of a field stands in the cleaned text, at about ``near``; -1 if it was cleaned away."""
    at = cleaned.rfind(span, 0, max(0, near) + len(span) + 1)
    return at if at >= 0 else cleaned.find(span)


def read(texts: list[str | None], names: list[str], derived: bool, words: tuple[Counter, Counter] | None = None) -> list[tuple]:
    """(field, start, kind, a, b, surroundings, also) of the candidates of one record: the span is
    surroundings[a:b] and starts at ``start`` of the field; ``also`` is its place in the derived field,
    the last of ``names``, or -1. The derived field is read itself only where it isn't just the others' cleaned form.
    ``words`` are counters that the words of the fields are added to."""
    out = []
    fields = list(zip(names, texts))[: len(names) - derived]
    whole = texts[-1] if derived else None
    same, base = False, []
    if whole:
        cleaned = [_clean(t or "") for _, t in fields]
        flat = " ".join(whole.split())
        same = flat == " ".join(cleaned).strip() and flat == whole
        at = 0
        for c in cleaned:
            base.append(at)
            at += len(c) + 1
        if cleaned and not cleaned[0] and same:
            base = [x - 1 for x in base]
    for i, (f, t) in enumerate(fields + ([(names[-1], whole)] if whole and not same else [])):
        if not t:
            continue
        tokens = _tokens(t)
        spans = candidates(t, tokens)
        if words is not None and i < len(fields):
            _count_words(t, tokens[0], spans, *words)
            words[0][""] += 1  # the empty word counts the texts
        for s, e, k in spans:
            lo = max(0, s - BEFORE)
            also = _placed(_clean(t[s:e]), whole, base[i] + len(_clean(t[:s])) + 1) if same else -1
            out.append((f, s, k, s - lo, e - lo, t[lo : e + AFTER], also))
    return out


def decided(ctx: str, a: int, b: int, kind: int, common: frozenset, known: Names):
    """(a, b, votes, features) of a candidate, trimmed."""
    if kind == NAME:
        a, b = trimmed(ctx, a, b, common)
    elif kind == ADDRESS:
        a, b = without_sentence(ctx, a, b, common)
    return a, b, *judge(ctx, a, b, kind, common, known)


_READ = "k {kind}, field string, start int, kind int, a int, b int, ctx string, also int, word string, outside bigint, inside bigint"


def _scan(df: DataFrame, key: str, fields: list[str], derived: str | None) -> DataFrame:
    """The candidates of all records, and the words of each batch (rows with a null field)."""
    ship(df.sparkSession)
    names = [*fields, *([derived] if derived else [])]
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = Counter(), Counter()
            ks, rows = [], []
            texts = [b.column(i + 1).to_pylist() for i in range(len(names))]
            for k, *ts in zip(b.column(0).to_pylist(), *texts):
                own = read(ts, names, derived is not None, words)
                ks += [k] * len(own)
                rows += own
            ws = list(words[0].keys() | words[1].keys())
            cols = list(zip(*rows)) if rows else [()] * 7
            none = [None] * len(ws)
            types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int32()]
            arrays = [pa.array(ks + none, b.column(0).type), *[pa.array([*c, *none], t) for c, t in zip(cols, types)]]
            pad = [None] * len(rows)
            arrays += [pa.array(pad + ws, pa.string()), pa.array(pad + [words[0][w] for w in ws], pa.int64()), pa.array(pad + [words[1][w] for w in ws], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["k", "field", "start", "kind", "a", "b", "ctx", "also", "word", "outside", "inside"])

    rows = df.select(df[key].alias("k"), *[df[f].cast("string").alias(f"t{i}") for i, f in enumerate(names)])
    return rows.mapInArrow(run, _READ.format(kind=kind))


def vocabulary(scan: DataFrame) -> tuple[frozenset, Names]:
    """(common words, words of names) from the words that a scan counted over all records. A common word is
    in 1 of ``COMMON_IN`` texts, so there are at most ``COMMON_IN`` times the words of a mean text."""
    ship(scan.sparkSession)
    counts = cut(scan.where("word is not null").groupBy("word").agg(F.sum("outside").alias("outside"), F.sum("inside").alias("inside")), "vocabulary")
    n = (counts.where("word = ''").agg(F.sum("outside")).first()[0]) or 0
    is_common = (F.col("outside") >= max(3, n // COMMON_IN)) & (F.col("outside") > 2 * F.col("inside")) & (F.col("word") != "")
    common = frozenset(r["word"] for r in counts.where(is_common).select("word").collect())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([x for w in b.column(0).to_pylist() for x in Names.places(w)], pa.int64())], ["at"])

    names = counts.where(~is_common & (F.col("inside") > 0) & (F.col("inside") >= F.col("outside"))).select("word").mapInArrow(place, "at bigint")
    bits = names.groupBy(F.shiftright("at", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits")).toArrow()  # 16 MB at most
    known = Names(bits.column("at").to_numpy(), bits.column("bits").to_numpy())
    forget(counts)
    return common, known


def reliabilities(patterns: list[tuple[str, int]], rounds: int = 25, prior_votes: float = PRIOR_VOTES):
    """(posteriors by pattern, chances): expectation-maximisation over vote patterns. Spans that a pattern of
    one sort cut out are of a kind it leads to or of none; for each of these classes every labeler has
    a chance for each vote it may give, silence included, and a class has a share of the spans. The first posteriors come
    from ``STRENGTH``; the chances they give keep the weight of ``prior_votes`` spans whatever the number of
    spans, so with more of them the votes decide, and a labeler can turn out to be bad."""
    out: dict[str, np.ndarray] = {}
    chances = {}
    first = np.log(np.array(STRENGTH, float))
    for sort in sorted({p[0] for p, _ in patterns}):
        own = [(p, c) for p, c in patterns if p[0] == sort]
        classes = [NONE, int(sort)] + ([ID] if int(sort) == PHONE else [])
        votes = np.array([[0 if x == "-" else int(x) + 1 for x in p[1:]] for p, _ in own])
        n = np.array([c for _, c in own], float)
        lg = np.stack([np.where(votes == c + 1, first, 0.0).sum(1) for c in classes], 1)
        lg[:, 0] += 1.0  # a span that nobody speaks for is rather none
        said = np.stack([votes == v for v in range(7)], 2).astype(float)  # pattern, labeler, vote
        start = None
        for _ in range(rounds):
            post = np.exp(lg - lg.max(1, keepdims=True))
            post /= post.sum(1, keepdims=True)
            weight = post * n[:, None]
            count = np.einsum("pc,pjv->cjv", weight, said)
            share = weight.sum(0) + 1.0
            if start is None:
                start = (count + 0.5) / (count + 0.5).sum(2, keepdims=True)
            chance = (count + prior_votes * start) / (count + prior_votes * start).sum(2, keepdims=True)
            lg = np.log(share / share.sum()) + np.einsum("pjv,cjv->pc", said, np.log(chance))
        chances[int(sort)] = (classes, chance)
        for (p, _), q in zip(own, post):
            out[p] = np.zeros(6)
            out[p][classes] = q
    return out, chances


def _clean(text: str) -> str:
    return " ".join(_URL.sub(" ", _LINK.sub(r"\1", text)).split())


@dataclass(frozen=True)
class Model:
    """What decides on a candidate: the vocabulary (bounded, see :func:`vocabulary`) and DIM x 6 weights."""

    common: frozenset
    known: Names
    weights: np.ndarray | None

    def kinds(self, features: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """(kind, probability) of spans by their features; kind ``NONE`` is not personal."""
        if self.weights is None or not features:
            return np.zeros(len(features), np.int64), np.ones(len(features))
        z = linear.scores(self.weights, linear.rows(features, DIM))
        e = np.exp(z - z.max(1, keepdims=True))
        return z.argmax(1), (e / e.sum(1, keepdims=True)).max(1)


_SPANS = "k {kind}, field string, start int, stop int, votes string, features array<int>"


def _fields_of(field: str, start: int, ctx: str, a0: int, b0: int, a: int, b: int, also: int, derived: str | None) -> list[tuple[str, int, int]]:
    """(field, start, stop) of a trimmed span, in its own field and in the derived one."""
    out = [(field, start + a - a0, start + b - a0)]
    if derived and also >= 0:
        span = _clean(ctx[a:b])
        at = _clean(ctx[a0:b0]).find(span)
        if at >= 0:
            out.append((derived, also + at, also + at + len(span)))
    return out


def learned(df: DataFrame, key: str, fields: list[str], derived: str | None = None, sample_spans: int = SAMPLE_SPANS) -> tuple[Model, DataFrame]:
    """(model, spans): the span classifier for a table, and every candidate span with its votes and features."""
    spark = ship(df.sparkSession)
    scan = cut(_scan(df, key, fields, derived), "scan")
    common, known = vocabulary(scan)
    shared = spark.sparkContext.broadcast((common, known))
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, known = shared.value
        for b in batches:
            out: list[tuple] = []
            for k, f, start, x, a0, b0, ctx, also in zip(*[c.to_pylist() for c in b.columns]):
                a, e, votes, features = decided(ctx, a0, b0, x, common, known)
                out += [(k, *where, votes, features) for where in _fields_of(f, start, ctx, a0, b0, a, e, also, derived)]
            cols = list(zip(*out)) if out else [[]] * 6
            types = [b.column(0).type, pa.string(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], ["k", "field", "start", "stop", "votes", "features"])

    spans = cut(scan.where("word is null").select("k", "field", "start", "kind", "a", "b", "ctx", "also").mapInArrow(run, _SPANS.format(kind=kind)), "spans")
    forget(scan)
    patterns = sorted((r["votes"], r["count"]) for r in spans.groupBy("votes").count().collect())  # the patterns of 14 labelers' votes: some hundreds
    if not patterns:
        return Model(common, known, None), spans
    post, _ = reliabilities(patterns)
    rows = spans.select("votes", "features", F.xxhash64("features", "votes").alias("h")).distinct().orderBy("h").limit(sample_spans).collect()
    Y = np.stack([post[r["votes"]] for r in rows]).astype(np.float32)
    return Model(common, known, linear.fit(linear.rows([r["features"] for r in rows], DIM), Y, DIM, epochs=120, rate=0.1, l2=2e-5)), spans


def spans(df: DataFrame, key: str, fields: list[str], derived: str | None = None, sample_spans: int = SAMPLE_SPANS) -> DataFrame:
    """(k, field, start, stop, kind, probability) of the personal spans of all records."""
    model, found = learned(df, key, fields, derived, sample_spans)
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = found.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            best, p = m.kinds(b.column(5).to_pylist())
            out = pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), pa.array([None if x == NONE else KINDS[x - 1] for x in best], pa.string()), pa.array(p.astype(float))], ["k", "field", "start", "stop", "kind", "probability"])
            yield out.filter(pa.array(best != NONE))

    return found.mapInArrow(run, f"k {kind}, field string, start int, stop int, kind string, probability double")


def found(df: DataFrame, key: str, fields: list[str], derived: str | None = None) -> DataFrame:
    """(key, field, kind): each kind of personal information that a field holds."""
    return spans(df, key, fields, derived).select(F.col("k").alias(key), "field", "kind").distinct()


def masked(df: DataFrame, key: str, fields: list[str], placeholders: DataFrame, derived: str | None = None) -> DataFrame:
    """(key, field, text, masked): the fields that hold personal information, with placeholders instead. All
    other text is unchanged. The model is that of :func:`found`, so what is named there is masked here."""
    spark = ship(df.sparkSession)
    marks = {r["kind"]: r["placeholder"] for r in placeholders.select("kind", "placeholder").collect()}  # five rows
    model, _ = learned(df, key, fields, derived)
    shared = spark.sparkContext.broadcast(model)
    names = [*fields, *([derived] if derived else [])]
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            where, features = [], []
            texts = [b.column(i + 1).to_pylist() for i in range(len(names))]
            for r, ts in enumerate(zip(*texts)):
                for f, start, x, a0, b0, ctx, also in read(list(ts), names, derived is not None):
                    a, e, _, ft = decided(ctx, a0, b0, x, m.common, m.known)
                    where.append([(r, *w) for w in _fields_of(f, start, ctx, a0, b0, a, e, also, derived)])
                    features.append(ft)
            best, _ = m.kinds(features)
            marked: dict[tuple[int, str], list] = {}
            for ws, x in zip(where, best):
                if x != NONE:
                    for r, f, s, e in ws:
                        marked.setdefault((r, f), []).append((s, e, KINDS[x - 1]))
            rs, fs, olds, news = [], [], [], []
            for (r, f), own in marked.items():
                t = new = texts[names.index(f)][r]
                upto = len(t)
                for s, e, x in sorted(own, reverse=True):
                    if e <= upto:
                        new, upto = new[:s] + marks.get(x, f"<{x.upper()}>") + new[e:], s
                rs.append(r), fs.append(f), olds.append(t), news.append(new)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rs, pa.int64())), pa.array(fs, pa.string()), pa.array(olds, pa.string()), pa.array(news, pa.string())], ["k", "field", "text", "masked"])

    rows = df.select(df[key].alias("k"), *[df[f].cast("string").alias(f"t{i}") for i, f in enumerate(names)])
    return rows.mapInArrow(run, f"k {kind}, field string, text string, masked string").distinct().withColumnRenamed("k", key)
