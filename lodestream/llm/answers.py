"""Broken prompt and response pairs (problem 4).

A multi-label linear classifier over hashed n-grams of the whole answer and features of the pair is
trained on defects made from recorded pairs themselves: answers cut off, questions copied with small
changes, answers swapped in from questions of another language, refusals (also after the question restated
or after sentences of an answer) and empty answers put in their place, in each of the shapes that raw outputs come in.
Refusals are worded by a list, by a grammar, and by those recorded answers that a first model is sure of. Harmless changes (a missing
full stop, wrapping, the question restated before the answer, odd decisions) are made to pairs that count as
sound. Thresholds are calibrated on held-out made pairs. Pairs that a first model calls defective are
left out of the sound ones when the final model is fitted.

The training sample is bounded: ``sample_rows`` different pairs with the smallest hashes (all, if fewer). How often
words, pairs and triples of words end a sentence is counted over all different pairs, in sketches of fixed size.
Every pair is scored, in one pass without a shuffle, and features are made for a batch of pairs at a time.

Defined results: a null, blank or punctuation-only answer is one of the made shapes of ``empty``; with a
null or blank question only ``empty``, ``truncated`` and ``refusal`` can be found; of a run written
twice one row comes out, with the surer defect if its texts differ; with fewer than ``LEAST_PAIRS`` different pairs nothing
can be trained: a warning says so, and only answers without a letter or digit are found.
"""

from __future__ import annotations

import itertools
import json
import random
import re
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm import linear
from lodestream.plans.runtime import cut, forget, ship

DEFECTS = ("empty", "truncated", "refusal", "copied_question", "other_language")
SAMPLE_ROWS, LEAST_PAIRS = 12_000, 50
BITS = 16
#: Cells of the sketches of words, pairs and triples of words.
SKETCHES = (1 << 17, 1 << 19, 1 << 19)
_DENSE = 40  # feature numbers kept for the pair features
DIM = _DENSE + (1 << BITS)
_END_FEATURES = [14, 15, 16, 23, 24, 31, 32, 33]

# Frequent function words of languages, by which texts are told apart.
FUNCTION_WORDS = {
    "en": "the of and to in is it that for with was on are as at be this have from or by not but what all were when we there can an your which their if will do each how them then she many some so these would other into has more her two him see could no than been who its now did my made over i you he they me a about after more before any same since",
    "de": "der die das und ist nicht ich zu den mit auf für eine ein im dem des von sich auch es an werden aus er hat dass sie nach bei um noch wie über einen so zum war haben nur oder aber vor bis mehr durch man sein wurde wenn darf kann soll sollte bitte etwa rund sind liegen also damit deshalb lässt alles zwischen um habe bereits",
    "es": "el la de que y en un una los las del se no por con para su es al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante uno ni contra ese eso mi qué cada unas unos otra así puedo puede fue hace han sería si tomar",
    "fr": "le la les de des du et un une est en que qui dans pour pas sur au ce il elle je ne se plus par avec son sa ses mais ou nous vous sont cette à y a été être ont aux si leur donc on peut puis environ toute fait entre avant après chaque soit il l d j s c qu n ai",
    "pt": "o a os as de do da dos das e em um uma que não para com por se no na nos nas ao mais como mas foi ele ela isso esta este já são ser tem ou quando muito até também pelo pela sem cada dose são então dá seria anote leia se às cerca entre eu meu pode posso",
    "it": "il lo la gli le di del della dei e è in un una che non per con si da al alla sono ho ha anche come più ma questo questa o se quando molto ogni dopo prima tra fino può posso devo ore circa quindi così nel nella dal dalla mi ancora",
    "nl": "de het een en van in is dat op te zijn met voor niet aan er om ook als dan maar bij nog naar uit door over ze zich of tot je mijn heeft hebben wordt kan mag moet deze die dit na elke ik u wat hoe uur dus daarom",
    "pl": "i w na z do nie się że jest to jak o ale po co tak za od przez przy dla są ten ta czy mnie mam już lub być więc może można każdą dawkę należy",
}
# Ways to decline, in plain words of our own, and what may follow them.
REFUSALS = (
    "I'm sorry, but I can't help with that", "I cannot help with this request", "I can't assist with that", "Sorry, I am unable to answer this", "I am not able to answer questions about dosing",
    "I can't provide medical advice", "I cannot give advice on medication", "As an AI language model, I cannot answer this", "As a language model I'm unable to give medical advice", "I must decline to answer",
    "I have to decline this request", "I decline to answer", "I won't be able to help with that", "I will not answer this question", "I'd rather not answer that", "I would prefer not to comment on this",
    "Unfortunately I cannot provide an answer here", "Unfortunately, I'm not able to decide this", "This is outside of what I can discuss", "That request falls outside what I may answer", "For safety reasons I cannot respond to this",
    "For safety reasons no answer will be given", "I am not permitted to discuss this topic", "I'm not allowed to talk about that", "That is not something I can discuss", "That is something I do not talk about", "My apologies, I can't comment on that",
    "I apologize, but I am unable to assist", "I am not qualified to judge this", "I'm only a program, so no assessment is possible from me", "No answer can be given from my side", "I refuse to answer this", "It would not be appropriate for me to answer",
    "I do not feel comfortable answering this", "I have to stay silent on this topic", "I cannot comply with this request", "That goes against my guidelines", "Giving such advice is against my policy", "My rules do not allow me to answer this", "This question will not be answered", "I can't say anything about {x}", "I cannot judge {x} for you", "I won't assess {x}",
    "Lo siento, no puedo ayudar con eso", "No puedo dar consejos médicos", "No me es posible responder a esta pregunta", "Leider kann ich dabei nicht helfen", "Ich kann dazu keine Auskunft geben", "Ich darf diese Frage nicht beantworten",
    "Désolé, je ne peux pas répondre à cette question", "Je ne suis pas en mesure de donner un avis médical", "Desculpe, não posso ajudar com isso", "Não posso responder a esta pergunta", "Mi dispiace, non posso rispondere a questa domanda",
)
# A grammar of more ways to decline, in plain words of our own.
_WHO = ("I cannot", "I can't", "I won't", "I am unable to", "I'm not able to", "I must refuse to", "I have to decline to", "I would rather not", "I am not going to", "I shouldn't", "I'm not in a position to", "We cannot", "It isn't possible for me to")
_DO = ("answer", "respond to", "help with", "advise on", "comment on", "discuss", "judge", "assess", "weigh in on", "rule on", "say anything about", "get into", "take up")
_WHAT = ("this", "that", "your question", "this request", "questions like this", "medication decisions", "such matters", "anything medical", "doses", "it")
_SHORT = ("Pass", "No comment", "Declined", "Not answering", "I'll skip this one", "Skipped", "Refused", "No answer from me", "I'd rather pass", "Nothing to say on this")
_IMPERSONAL = ("Answering", "Responding", "Advising you", "A reply", "Any advice from me", "A verdict")
_WOULD = ("would be irresponsible", "would be inappropriate", "would be unsafe", "would be wrong of me", "would be irresponsible of me", "is not something I offer", "goes beyond what I may do", "is off limits for me", "would break my rules")
_LEAVE = ("Let us leave that to professionals", "That is better left to a doctor", "Leave this to your pharmacist", "This belongs in a doctor's office, not here", "Someone qualified has to decide that, not me", "That call is not mine to make")


def declined(rng: random.Random, q: str | None) -> str:
    """One way to decline."""
    k = rng.random()
    if k < 0.5:
        return rng.choice(REFUSALS).replace("{x}", " ".join((q or "this").split()[:6]))
    if k < 0.75:
        return f"{rng.choice(('', '', '', 'Sorry, ', 'Unfortunately, ', 'For safety reasons '))}{rng.choice(_WHO)} {rng.choice(_DO)} {rng.choice(_WHAT)}"
    if k < 0.85:
        return f"{rng.choice(_IMPERSONAL)} {rng.choice(_WOULD)}"
    return rng.choice(_LEAVE if k < 0.92 else _SHORT)


FOLLOW_UPS = ("Please speak to a doctor", "Please ask a pharmacist", "Contact a medical professional", "Consider calling your clinic", "Is there anything else I can do for you", "Please consult a professional instead", "A doctor is the right person to ask", "Let me know if something else comes up", "")

_WORD = re.compile(r"[^\W\d_]+|\d[\d.:,]*")
#: Scripts that tell a language family by themselves: first and last letter of their ranges.
SCRIPTS = (("\u0370", "\u03ff"), ("\u0400", "\u052f"), ("\u0590", "\u05ff"), ("\u0600", "\u06ff"), ("\u0900", "\u097f"), ("\u0e00", "\u0e7f"), ("\u3040", "\u30ff"), ("\u4e00", "\u9fff"), ("\uac00", "\ud7af"))
_CODES = list(FUNCTION_WORDS)
_LANGUAGE_OF: dict[str, list[int]] = {}
for _i, _words in enumerate(FUNCTION_WORDS.values()):
    for _w in set(_words.split()):
        _LANGUAGE_OF.setdefault(_w, []).append(_i)
N_LANGUAGES = len(_CODES) + len(SCRIPTS)
_REASON = re.compile(r'"reasoning"\s*:\s*(?:"((?:[^"\\]|\\.)*)("?)|(null))', re.S)
_SENTENCE_END = re.compile(r"[.!?](?:\s|$)")
_DECIDED = re.compile(r'"decision"\s*:\s*"?[A-Za-z]')


def answer_of(raw: str | None) -> tuple[str, str]:
    """(text of the answer, shape): shape is ``json``, ``cut`` (JSON that breaks off), ``text`` or
    ``none``."""
    if raw is None or not raw.strip():
        return "", "none"
    body = re.sub(r"```\w*", " ", raw).strip()
    at = body.find("{")
    if at >= 0:
        end = body.rfind("}")
        if end > at:
            try:
                obj = json.loads(body[at : end + 1], strict=False)
                if isinstance(obj, dict):
                    texts = [v for k, v in obj.items() if isinstance(v, str) and k not in ("decision", "confidence")]
                    return " ".join(texts), "json"
            except ValueError:
                pass
        m = _REASON.search(body)
        if m:
            text = m.group(1) or ""
            return re.sub(r"\\(.)", lambda e: {"n": " ", "t": " "}.get(e.group(1), e.group(1)), text), "json" if m.group(2) and body.rstrip().endswith("}") else "cut"
        if '"' in body[at:] or body[at:].strip() == "{":
            return body[at:], "cut"
    try:
        v = json.loads(body)
        return (v, "text") if isinstance(v, str) else ("", "none") if v is None or v in ([], {}) else (body, "text")
    except ValueError:
        return body, "text"


def n_words(text: str) -> int:
    return len(_WORD.findall(text))


def language_weights(w: str) -> np.ndarray:
    """What a word says for each language and script."""
    out = np.zeros(N_LANGUAGES, np.float32)
    own = _LANGUAGE_OF.get(w, ())
    for i in own:
        out[i] = 1 / len(own)
    for i, (lo, hi) in enumerate(SCRIPTS):
        if lo <= w[0] <= hi:
            out[len(_CODES) + i] = max(1.0, len(w) / 3)  # scripts without spaces have long words
    return out


class Words(dict):
    """Numbers of words, made as they come; the same word has the same hash in every worker."""

    def __init__(self) -> None:
        super().__init__()
        self.hashes, self.languages, self.known = [], [], {}
        self.table, self.spoken = np.zeros(0, np.uint64), np.zeros((0, N_LANGUAGES), np.float32)

    def __missing__(self, raw: str) -> int:
        w = re.sub(r"\d+", "0", raw)
        i = self.known.get(w)
        if i is None:
            i = self.known[w] = len(self.hashes)
            self.hashes.append(xxhash.xxh3_64_intdigest(w))
            self.languages.append(language_weights(w))
        self[raw] = i
        return i

    def of(self, texts: list[str]) -> Tokens:
        if len(self) > 500_000:
            self.clear(), self.known.clear(), self.hashes.clear(), self.languages.clear()
            self.table = self.table[:0]
        lists = [[self[w] for w in _WORD.findall(t.lower())] for t in texts]
        n = np.array([len(x) for x in lists], np.int64)
        ids = np.array(list(itertools.chain.from_iterable(lists)), np.int64)
        if len(self.table) < len(self.hashes):  # words came since the last call
            self.table = np.array(self.hashes, np.uint64)
            self.spoken = np.array(self.languages, np.float32).reshape(-1, N_LANGUAGES)
        return Tokens(self.table[ids], self.spoken[ids], np.repeat(np.arange(len(texts)), n), n)


@dataclass(frozen=True)
class Tokens:
    """The words of texts, one after the other: hashes, languages, the text of each; and the texts' lengths."""

    h: np.ndarray
    languages: np.ndarray
    row: np.ndarray
    n: np.ndarray

    @property
    def first(self) -> np.ndarray:
        return np.cumsum(self.n) - self.n

    def shares(self, chosen: np.ndarray | None = None) -> np.ndarray:
        """(texts, languages): the sums of what the words say."""
        row, x = (self.row, self.languages) if chosen is None else (self.row[chosen], self.languages[chosen])
        out = np.zeros((len(self.n), N_LANGUAGES))
        at, k = np.nonzero(x)
        if len(at):
            out = np.bincount(row[at] * N_LANGUAGES + k, x[at, k], out.size).reshape(out.shape)
        return out

    def language(self) -> np.ndarray:
        """The language of each text, -1 where none stands out."""
        x = self.shares()
        top = -np.sort(-x, axis=1)[:, :2]
        return np.where((top[:, 0] >= 1) & (top[:, 0] > 1.2 * top[:, 1]), x.argmax(1), -1)


_M1, _M2, _MASK, _EDGE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x1234567), np.uint64(0x7654321)


def _mix(*parts) -> np.ndarray:
    """One hash of several; numbers may stand among arrays."""
    out = np.zeros(1, np.uint64)
    for p in parts:
        out = (out ^ np.asarray(p, np.uint64)) * _M1
        out = (out ^ (out >> np.uint64(29))) * _M2
    return out ^ (out >> np.uint64(32))


def _keyed(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hashes by row: 40 bits of the hash after those of the row, so that rows stay together when sorted."""
    return (np.asarray(row, np.uint64) << np.uint64(40)) | (h & np.uint64((1 << 40) - 1))


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def _is_in(x: np.ndarray, sorted_: np.ndarray) -> np.ndarray:
    at = np.searchsorted(sorted_, x)
    return (sorted_[np.minimum(at, len(sorted_) - 1)] == x) if len(sorted_) else np.zeros(len(x), bool)


def _before(h: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """The hash k words earlier in the same text, or that of an edge."""
    out = np.full(len(h), _EDGE)
    if len(h) > k:
        same = row[k:] == row[:-k]
        out[k:] = np.where(same, h[:-k], _EDGE)
    return out


def _cells(h: np.ndarray, row: np.ndarray) -> list[np.ndarray]:
    """The sketch cells of each word, of the pair and of the triple that it ends."""
    one, two = _before(h, row, 1), _before(h, row, 2)
    keys = (_mix(np.uint64(1), h), _mix(np.uint64(2), one, h), _mix(np.uint64(3), two, one, h))
    offset = np.cumsum((0, *SKETCHES[:-1]))
    return [(k % np.uint64(size)).astype(np.int64) + o for k, size, o in zip(keys, SKETCHES, offset)]


class Ends:
    """How often words, pairs and triples of words occur, and how often a sentence ends with them: two
    numbers for each cell of the sketches."""

    def __init__(self, seen: np.ndarray, final: np.ndarray):
        once = seen <= 1  # what a text says of itself alone
        self.seen, self.final = np.where(once, 0, seen).astype(np.float32), np.where(once, 0, final).astype(np.float32)

    @staticmethod
    def count(texts: list[str], known: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cells, seen, final) of the sentences of texts."""
        sentences = [x for t in texts for x in re.split(r"(?<=[.!?])\s+(?=[A-ZÀ-Þ])", t)]
        t = known.of(sentences)
        last = np.zeros(len(t.h), bool)
        some = t.n > 0
        ends = (t.first + t.n - 1)[some]
        last[ends] = np.array([x.rstrip()[-1:] in (".", "!", "?") for x in sentences], bool)[some]
        cells = np.concatenate(_cells(t.h, t.row)) if len(t.h) else np.zeros(0, np.int64)
        size = sum(SKETCHES)
        seen = np.bincount(cells, minlength=size)
        final = np.bincount(cells[np.tile(last, 3)], minlength=size)
        used = np.flatnonzero(seen)
        return used, seen[used], final[used]

    @classmethod
    def from_texts(cls, texts: list[str]) -> Ends:
        cells, seen, final = cls.count(texts, Words())
        whole = np.zeros((2, sum(SKETCHES)))
        whole[0, cells], whole[1, cells] = seen, final
        return cls(*whole)

    def of(self, t: Tokens) -> np.ndarray:
        """(texts, 4): shares of the last word, pair and triple at an end of a sentence, and whether the word is known."""
        out = np.zeros((len(t.n), 4))
        some = np.flatnonzero(t.n)
        at = (t.first + t.n - 1)[some]
        if len(at):
            n, f = ([x[c[at]] for c in _cells(t.h, t.row)] for x in (self.seen, self.final))
            one = np.where(n[0] > 0, (f[0] + 0.2) / (n[0] + 1), 0.1)
            two = (f[1] + 2 * one) / (n[1] + 2)
            out[some] = np.stack([one, two, (f[2] + two) / (n[2] + 1), n[0] > 0], 1)
        return out


def features(questions: list[str | None], raws: list[str | None], ends: Ends, known: Words, at_a_time: int = 2000) -> linear.Rows:
    """:func:`_features` of a slice of the pairs at a time, which bounds memory."""
    parts = [_features(questions[i : i + at_a_time], raws[i : i + at_a_time], ends, known) for i in range(0, max(1, len(raws)), at_a_time)]
    return linear.joined(parts)


def _features(questions: list[str | None], raws: list[str | None], ends: Ends, known: Words) -> linear.Rows:
    """The features of pairs: what the pair is like (numbers below ``_DENSE``) and hashed n-grams of the answer, in which
    the words of the question are one word."""
    n = len(raws)
    parsed = [answer_of(r) for r in raws]
    texts = [t.strip() for t, _ in parsed]
    shape = np.array([x for _, x in parsed])
    both = known.of(texts + [q or "" for q in questions])
    is_a = both.row < n
    a = Tokens(both.h[is_a], both.languages[is_a], both.row[is_a], both.n[:n])
    q = Tokens(both.h[~is_a], both.languages[~is_a], both.row[~is_a] - n, both.n[n:])

    # words, pairs and triples of the answer that the question has, too
    keys_q = _distinct(_keyed(q.h, q.row))
    in_q = _is_in(_keyed(a.h, a.row), keys_q)
    covered = np.zeros(len(a.h), bool)
    for k in (1, 2):
        gram = lambda t: (_keyed(_mix(*[_before(t.h, t.row, j) for j in range(k, 0, -1)], t.h), t.row), np.arange(len(t.h)) - t.first[t.row] >= k)
        (mine, whole), (theirs, its) = gram(a), gram(q)
        hit = np.flatnonzero(whole & _is_in(mine, _distinct(theirs[its])))
        for j in range(k + 1):
            covered[hit - j] = True
    novel = ~covered & ~in_q
    count = lambda x: np.bincount(a.row[x], minlength=n)
    n_a, n_novel = a.n, count(novel)
    copied = np.divide(count(covered), n_a, out=np.zeros(n), where=n_a > 0)
    its_row = (keys_q >> np.uint64(40)).astype(np.int64)
    found = _is_in(keys_q, np.sort(_keyed(a.h, a.row)))
    of_question = np.bincount(its_row[found], minlength=n) / np.maximum(np.bincount(its_row, minlength=n), 1)

    tail = [t[-1:] for t in texts]
    closed = np.array([c != "" and c in ".!?…。\"'”)»" for c in tail], bool)
    is_in = lambda chars: np.array([c != "" and c in chars for c in tail], bool)
    one, two, three, is_known = ends.of(a).T
    mine, said = q.language(), a.shares(novel)
    has = mine >= 0
    own = np.where(has, said[np.arange(n), mine], 0.0)
    rest = said.copy()
    rest[np.arange(n)[has], mine[has]] = 0
    other = np.where(has, rest.max(1, initial=0.0), 0.0)
    some = n_a > 0
    open_ = ~closed
    dense = {
        0: np.ones(n), 1: ~some, 2: some & (n_a <= 2), 3: np.minimum(1.0, n_a / 40), 4: shape == "cut", 5: shape == "text", 6: shape == "none", 7: copied, 8: copied > 0.8, 9: of_question,
        10: (of_question > 0.75) & (n_novel <= 3), 11: np.minimum(1.0, n_novel / 10), 12: q.n > 0, 13: open_ & some, 14: (1 - two) * open_, 15: (1 - is_known) * open_, 16: (1 - one) * open_, 17: closed & ~is_in("?"), 18: is_in("?"),
        19: has & (other >= 2) & (other > 1.5 * own + 0.5), 20: np.where(has, (other - own) / np.maximum(1, n_novel), 0.0), 21: own / np.maximum(1, n_novel), 22: own >= 2, 23: open_ & (two < 0.15), 24: open_ & (two > 0.5),
        25: is_in(",;:-("), 26: (copied > 0.6) & (n_novel <= 2), 27: some & (n_novel == 0), 28: np.array([len(_SENTENCE_END.findall(t)) >= 2 for t in texts], bool), 29: (shape == "text") & (n_a < 25),
        30: some & ~np.array([bool(_DECIDED.search(r or "")) for r in raws], bool), 31: (1 - three) * open_, 32: open_ & (three > 0.6), 33: open_ & (three < 0.2),
    }
    table = np.stack([np.asarray(dense[k], np.float32) for k in range(34)], 1) if n else np.zeros((0, 34), np.float32)
    table[:, _END_FEATURES] *= 2  # they tell a cut from a missing full stop, which n-grams only learn by heart
    row, col = np.nonzero(table)

    function_word = a.languages[:, : len(_CODES)].any(1)
    h = np.where(in_q & ~function_word, _MASK, a.h)
    back = [h, _before(h, a.row, 1), _before(h, a.row, 2)]
    nth = np.arange(len(h)) - a.first[a.row]
    grams = [(_mix(np.uint64(11), back[0]), a.row), (_mix(np.uint64(12), back[1], back[0])[nth >= 1], a.row[nth >= 1]), (_mix(np.uint64(13), back[2], back[1], back[0])[nth >= 2], a.row[nth >= 2])]
    early = nth < 3
    grams.append((_mix(np.uint64(14), nth[early], a.h[early]), a.row[early]))
    left = np.flatnonzero(some & open_)
    at = (a.first + n_a - 1)[left]
    grams += [(_mix(np.uint64(15), a.h[at]), left), (_mix(np.uint64(16), _before(a.h, a.row, 1)[at], a.h[at]), left)]
    cell = np.concatenate([g for g, _ in grams]) & np.uint64((1 << BITS) - 1)
    both = _distinct((np.concatenate([r for _, r in grams]).astype(np.uint64) << np.uint64(BITS)) | cell)
    g_row, g_col = (both >> np.uint64(BITS)).astype(np.int64), (both & np.uint64((1 << BITS) - 1)).astype(np.int64) + _DENSE
    scale = 3.0 / np.maximum(3.0, np.sqrt(np.bincount(g_row, minlength=n)))
    return linear.from_triples(np.concatenate([row, g_row]), np.concatenate([col, g_col]), np.concatenate([table[row, col], scale[g_row]]), n)


def _as_raw(rng: random.Random, text: str | None) -> str:
    """``text`` in one of the shapes of a raw output."""
    kind = rng.random()
    decision = rng.choice(["A", "B", "C", None, "refused", "", "N/A", "a"])
    if kind < 0.35:
        return text if text is not None else "null"
    out = json.dumps({"reasoning": text, "decision": decision, "confidence": rng.choice([1, 5, 8, None])}, ensure_ascii=rng.random() < 0.1, indent=rng.choice([None, None, 2]))
    return f"```json\n{out}\n```" if rng.random() < 0.15 else out


def _copy(rng: random.Random, q: str) -> str:
    """``q`` with one small change, or with two."""
    return _changed(rng, _changed(rng, q)) if rng.random() < 0.3 else _changed(rng, q)


def _changed(rng: random.Random, q: str) -> str:
    k = rng.randrange(11)
    if k == 9:
        return q.rstrip("?.! ") + rng.choice([".", "...", "!", " ?"])
    if k == 10:
        return re.sub(r"[,;:]", "", q)
    if k == 0:
        return q.lower()
    if k == 1:
        return re.sub(" ", "  ", q)
    if k == 2:
        return f"{q} {q}"
    if k == 3:
        return rng.choice(["Question: ", "You asked: ", "Q: ", "The question is: "]) + q
    if k == 4:
        return q.rstrip("?.! ")
    if k == 5:
        ws = q.split()
        if ws:
            del ws[rng.randrange(len(ws))]
        return " ".join(ws)
    if k == 6:
        swap = {"I": "you", "my": "your", "me": "you", "My": "Your", "am": "are"}
        return re.sub(r"\b(I|my|me|My|am)\b", lambda m: swap[m.group()], q)
    return q.upper() if k == 7 else q


def synthetic(pairs: list[tuple[str, str]], seed: int = 5):
    """(question, raw, defect or None, whether it comes from a plainly sound pair) made from recorded
    pairs: about half of them defective."""
    rng = random.Random(seed)
    by_lang: dict[int, list[str]] = {}
    parsed = [(q, raw, *answer_of(raw)) for q, raw in pairs]
    spoken = Words().of([x[2] for x in parsed]).language()
    asked = dict(zip([q for q, _ in pairs], Words().of([q or "" for q, _ in pairs]).language()))
    for (_, _, text, _), c in zip(parsed, spoken):
        if n_words(text) > 8:
            by_lang.setdefault(int(c), []).append(text)
    langs = [c for c in by_lang if c >= 0]
    for q, raw, text, shape in parsed:
        sound = _plainly_sound(raw)
        yield q, raw, None, sound
        if n_words(text) < 9 or shape not in ("json", "text"):
            continue
        k = rng.random()
        if k < 0.3:
            yield q, _as_raw(rng, re.sub(r"[.!?]+$", "", text)), None, sound
        elif k < 0.38:
            lead = rng.choice([f"You ask: '{q}' ", f"{q} ", f"The question was: {q} ", f'"{q}" - '])
            yield q, _as_raw(rng, lead + text), None, sound
        elif k < 0.43:
            yield q, "Here is the answer:\n" + _as_raw(rng, text), None, sound
        if rng.random() < 0.3:
            whole = text[: rng.randrange(8, max(9, len(text) - 3))]
            if rng.random() < 0.4:
                whole = whole.rsplit(" ", 1)[0]
            rest = text[len(whole) :].lstrip()
            if not re.search(r"[.!?]\W*$", whole) and rest[:1] not in ".!?":  # else only an end mark is missing
                if rng.random() < 0.15:
                    whole += rng.choice([" and the", " because", ",", "...", " of the", " -"])
                yield q, _as_raw(rng, whole), "truncated", sound
        if rng.random() < 0.12 and shape == "json" and raw.rstrip().endswith("}") and raw.lstrip().startswith("{"):
            yield q, raw[: rng.randrange(len(raw) // 5, len(raw) - 1)], "truncated", sound
        if rng.random() < 0.3:
            t = declined(rng, q) + rng.choice([".", ".", "", "!"])
            f = rng.choice(FOLLOW_UPS)
            t = f"{t} {f}{'.' if f else ''}".strip()
            k = rng.random()
            if k < 0.25 and q:
                t = rng.choice([f"You ask: '{q}' ", f"{q} ", f"The question was: {q} ", f'"{q}" - ']) + t
            elif k < 0.4:
                said = re.split(r"(?<=[.!?])\s+", text)
                t = " ".join([*said[: max(1, min(2, len(said) - 1))], t])
            yield q, _as_raw(rng, t), "refusal", sound
        if rng.random() < 0.2 and q and n_words(q) > 5:
            yield q, _as_raw(rng, _copy(rng, q)), "copied_question", sound
        if rng.random() < 0.25 and q:
            mine = int(asked[q])
            others = [c for c in langs if c != mine]
            if mine >= 0 and others:
                yield q, _as_raw(rng, rng.choice(by_lang[rng.choice(others)])), "other_language", sound
        if rng.random() < 0.05:
            t = rng.choice([None, "", " ", "\n", "-", "...", ".", "--"])
            yield q, rng.choice(["", " \n", "null", "{}", '""', "```json\n```", "[]"]) if rng.random() < 0.4 else _as_raw(rng, t), "empty", sound


def _plainly_sound(raw: str | None) -> bool:
    """An answer of several sentences that comes with one of the decisions."""
    text, shape = answer_of(raw)
    return shape == "json" and n_words(text) >= 12 and len(re.findall(r"[.!?](?:\s|$)", text)) >= 2 and bool(re.search(r'"decision"\s*:\s*"\s*[A-Ca-c]\s*"', raw or ""))


def train(pairs: list[tuple[str, str]], ends: Ends, seed: int = 5):
    """(weights, thresholds) from a bounded list of recorded pairs."""
    known = Words()
    made = [m for m in synthetic(pairs, seed) if m[2] or m[3]]
    own = {r for _, r in pairs}
    recorded = [(q, r, None, False) for q, r in pairs if not _plainly_sound(r)]
    make = lambda ms: features([m[0] for m in ms], [m[1] for m in ms], ends, known)
    rng = np.random.default_rng(seed)
    x, W = make(made), None
    for step in range(3):
        Y = np.array([[d == k for k in DEFECTS] for _, _, d, _ in made], np.float32)
        held = rng.random(len(made)) < 0.25
        # ways to decline are held out as wholes: real ones are worded in other ways than ours
        way = np.array([next((k for k, t in enumerate(REFUSALS) if t[:18] in r), -1) if d == "refusal" else -1 for _, r, d, _ in made])
        held = np.where(way >= 0, way % 4 == 3, held)
        sure = held & np.array([bool(d) or sound for _, _, d, sound in made])  # thresholds rest on these
        W = linear.fit(x.take(~held), Y[~held], DIM, epochs=80 if W is None else 30, start=W)
        z = linear.scores(W, x)
        cuts = np.array([linear.best_threshold(z[sure, k], Y[sure, k] > 0) for k in range(len(DEFECTS))])
        if step == 2:
            break
        # recorded pairs that look defective aren't examples of sound ones
        bad = (Y.sum(1) == 0) & (z > np.minimum(cuts, 0.0) - 0.5).any(1) & np.array([r in own for _, r, _, _ in made])
        made, x = [m for m, b in zip(made, bad) if not b], x.take(~bad)
        if recorded:  # at first only plainly sound pairs were; now those that the model calls sound, and refusals it is sure of
            more = make(recorded)
            zs = linear.scores(W, more)
            sound = (zs < np.minimum(cuts, 0.0) - 1.5).all(1)
            refused = (zs[:, 2] > np.maximum(cuts[2], 0.0) + 2.0) & (zs.argmax(1) == 2)
            made += [m for m, ok in zip(recorded, sound) if ok] + [(q, r, "refusal", False) for (q, r, _, _), ok in zip(recorded, refused) if ok]
            x = x.and_(more.take(sound)).and_(more.take(refused))
            recorded = []
    return W, np.maximum(cuts, -2.0)


def count_ends(pairs: DataFrame) -> Ends:
    """The sketches of :class:`Ends` over the answers of all pairs, aggregated before the shuffle; at most one
    row for each cell comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for b in batches:
            parsed = [answer_of(r) for r in b.column(0).to_pylist()]
            cells, seen, final = Ends.count([t for t, x in parsed if x in ("json", "text")], known)
            yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(seen.astype(np.int64)), pa.array(final.astype(np.int64))], ["cell", "seen", "final"])

    made = pairs.select("a_").mapInArrow(run, "cell int, seen bigint, final bigint")
    t = made.groupBy("cell").agg(F.sum("seen").alias("seen"), F.sum("final").alias("final")).toArrow()
    whole = np.zeros((2, sum(SKETCHES)))
    at = t.column("cell").to_numpy()
    whole[0, at], whole[1, at] = t.column("seen").to_numpy(), t.column("final").to_numpy()
    return Ends(*whole)


def defects(df: DataFrame, keys: list[str], question: str, raw: str, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(keys, defect, score): the defective pairs, each with its one most likely defect."""
    spark = ship(df.sparkSession)
    base = df.select(*keys, F.col(question).cast("string").alias("q_"), F.col(raw).cast("string").alias("a_"))
    different = cut(base.where(F.col("q_").isNotNull() & F.col("a_").isNotNull()).select("q_", "a_").distinct(), "pairs")
    some = different.select("q_", "a_", F.xxhash64("q_", "a_").alias("h"))
    pairs = [(r["q_"], r["a_"]) for r in some.orderBy("h", "q_", "a_").limit(sample_rows).collect()]
    model = None
    if len(pairs) >= LEAST_PAIRS:
        ends = count_ends(different)
        model = (*train(pairs, ends), ends)
    elif pairs:
        warnings.warn(f"{len(pairs)} different pairs are too few to train on: only answers without letters are found", stacklevel=2)
    forget(different)
    shared = spark.sparkContext.broadcast(model)  # DIM x 5 weights and the sketches

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = shared.value, Words()
        for b in batches:
            qs, rs = b.column(1).to_pylist(), b.column(2).to_pylist()
            if m is None:
                names = [None if re.search(r"\w", answer_of(r)[0]) or answer_of(r)[1] == "cut" else "empty" for r in rs]
                score = np.zeros(len(rs))
            else:
                W, cuts, ends = m
                z = linear.scores(W, features(qs, rs, ends, known)) - cuts
                best = z.argmax(1)
                score = z[np.arange(len(rs)), best].astype(float)
                names = [DEFECTS[k] if s > 0 else None for k, s in zip(best, score)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["r", "defect", "score"])

    kept = base.select(F.struct(*keys).alias("r"), "q_", "a_")
    out = kept.mapInArrow(run, f"r {kept.schema['r'].dataType.simpleString()}, defect string, score double")
    found = out.where("defect is not null").select("r.*", "defect", "score")
    return found.groupBy(*keys).agg(F.max_by("defect", F.struct("score", "defect")).alias("defect"), F.max("score").alias("score"))
