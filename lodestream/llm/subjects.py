"""Subject areas of documents (problem 9).

A chain of classifiers over term, source and structure features. Terms (hashed words and pairs of
words) score every sentence for every subject; as a document has a subject only if at least two of
its sentences belong to it, the sentence model is trained by alternation: the best two sentences of
a document with a subject count as belonging to it, the sentences of documents without it as not. The
chain then decides on each subject in turn from the document's best, second and third sentence score,
their sum and number, the number of sentences, the source and language, and the subjects decided
before, so that co-occurrence counts. The chain is fitted on scores of sentences that the scoring
model was not fitted on, which calibrates it. A beam search takes the most probable combination.

The training sample is bounded: ``sample_docs`` labelled documents with the smallest hashes (all, if
fewer), documents without a subject included. Every document is decided on, in one pass.

Defined results: null and blank texts have no subject and no row; a label for an unknown document is
ignored; a document labelled with null has no subject; sentences that repeat in a text count once;
with fewer than ``LEAST_DOCS`` labelled documents
no document gets a subject, and a warning says so.
"""

from __future__ import annotations

import re
import warnings
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.llm import linear
from lodestream.plans.runtime import cut, ship

SAMPLE_DOCS, LEAST_DOCS, BITS, BEAM = 4000, 10, 15, 8
DIM = 1 << BITS
#: Texts that are scored at a time.
TEXTS_AT_A_TIME = 4000
_SPLIT = re.compile(r"(?<=[.!?…])\s+|\n+|\s[-–—]{1,2}\s|;\s+")
_WORD = re.compile(r"[^\W\d_]+|\d")


class Words(dict):
    """Hashes of words, made as they come; digits are one word."""

    def __missing__(self, w: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[w] = xxhash.xxh32_intdigest("0" if w.isdigit() else w)
        return h


@dataclass(frozen=True)
class Sentences:
    """The different sentences of at least three words of texts: (sentence, term) in the order of sentences, the text of
    each sentence, and how many a text has."""

    terms: np.ndarray
    starts: np.ndarray
    doc: np.ndarray
    n: np.ndarray


def sentences(texts: list[str], known: Words) -> Sentences:
    lists, doc = [], []
    for d, t in enumerate(texts):
        own = [ws for x in _SPLIT.split(t.lower()) if len(ws := _WORD.findall(x)) >= 3]
        if len(own) > 1:
            own = dict.fromkeys(map(tuple, own))
        lists += own
        doc += [d] * len(own)
    size = np.array([len(x) for x in lists], np.int64)
    h = np.array([known[w] for x in lists for w in x], np.uint64)
    of = np.repeat(np.arange(len(lists)), size)
    # features of a sentence: its distinct words and pairs of neighbours
    pair = np.flatnonzero(of[1:] == of[:-1]) if len(of) else np.zeros(0, np.int64)
    two = (h[pair] * np.uint64(0x9E3779B1) + h[pair + 1] * np.uint64(0x85EBCA77)) >> np.uint64(7)
    key = np.concatenate([(of.astype(np.uint64) << np.uint64(BITS)) | (h & np.uint64(DIM - 1)), (of[pair].astype(np.uint64) << np.uint64(BITS)) | (two & np.uint64(DIM - 1))])
    key.sort()
    key = key[np.r_[True, key[1:] != key[:-1]]] if len(key) else key
    count = np.bincount((key >> np.uint64(BITS)).astype(np.int64), minlength=len(lists))
    doc_ = np.array(doc, np.int64)
    return Sentences((key & np.uint64(DIM - 1)).astype(np.int32), np.cumsum(count) - count, doc_, np.bincount(doc_, minlength=len(texts)))


def _scores(W: np.ndarray, x: Sentences) -> np.ndarray:
    """(sentences, subjects): sums over their terms, and a constant."""
    return linear.scores(W, linear.Rows(x.terms, np.ones(len(x.terms), np.float32), x.starts)) + W[DIM - 1]


class Marks:
    """Sources and languages that the training documents have, each with a number; others are 0."""

    def __init__(self, rows: list[tuple[str | None, str | None]], at_most: int = 200):
        count = lambda xs: {v: i + 1 for i, (v, _) in enumerate(Counter(xs).most_common(at_most))}
        self.sources, self.langs = count(self.norm(s) for s, _ in rows), count(self.norm(la)[:2] for _, la in rows)

    @staticmethod
    def norm(v: str | None) -> str:
        return re.sub(r"[\s\-]+", "_", (v or "").strip().lower())

    def structure(self, n: np.ndarray, sources: list[str | None], langs: list[str | None]) -> np.ndarray:
        """(documents, features): a constant, the number of sentences, source and language."""
        a, b = len(self.sources) + 1, len(self.langs) + 1
        x = np.zeros((len(n), 3 + a + b), np.float32)
        x[:, 0], x[:, 1], x[:, 2] = 1.0, np.minimum(1.0, n / 20), n <= 4
        at = np.arange(len(n))
        x[at, 3 + np.array([self.sources.get(self.norm(s), 0) for s in sources], np.int64)] = 1.0
        x[at, 3 + a + np.array([self.langs.get(self.norm(la)[:2], 0) for la in langs], np.int64)] = 1.0
        return x


def _evidence(z: np.ndarray, doc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(documents, subjects, 8): best, second and third probability, their sum, how many are high, and the best
    two scores themselves."""
    K = z.shape[1]
    p = 1 / (1 + np.exp(-np.clip(z, -20, 20)))
    top, best = np.zeros((3, len(n), K), np.float32), np.full((2, len(n), K), -8.0, np.float32)
    first = np.cumsum(n) - n
    for k in range(K):
        o = np.lexsort((-z[:, k], doc))  # within each document the best first
        for r in range(3):
            has = n > r
            at = o[first[has] + r]
            top[r, has, k] = p[at, k]
            if r < 2:
                best[r, has, k] = z[at, k]
    add = lambda v: np.stack([np.bincount(doc, v[:, k], len(n)) for k in range(K)], 1)
    best = np.clip(best, -8, 8) / 4
    return np.stack([*top, np.minimum(add(p), 5) / 5, np.minimum(add((p > 0.5).astype(np.float32)), 4) / 4, top[0] * top[1], *best], axis=2).astype(np.float32)


def _fit_sentences(x: Sentences, Y: np.ndarray, rounds: int = 3) -> np.ndarray:
    """(DIM + 1, subjects) from documents' labels, by alternation; each round goes on from the weights of the last."""
    owner = x.doc
    count = np.diff(np.append(x.starts, len(x.terms)))
    row = np.concatenate([np.repeat(np.arange(len(count)), count), np.arange(len(count))])
    data = linear.from_triples(row, np.concatenate([x.terms, np.full(len(count), DIM - 1)]), np.ones(len(row)), len(count))
    begin = np.r_[0, np.cumsum(x.n)]
    W = None
    # start: all sentences of a document share its labels, rarely weighted
    target = Y[owner].astype(np.float32)
    weight = np.where(target > 0, 0.5, 1.0).astype(np.float32)
    for r in range(rounds):
        W = linear.fit(data, target, DIM, epochs=35 if W is None else 20, rate=0.15, l2=3e-4, weight=weight, start=W)
        z = linear.scores(W, data)
        target = np.zeros_like(target)
        weight = np.ones_like(target)
        for d in range(len(x.n)):
            a, b = begin[d], begin[d + 1]
            if a == b:
                continue
            order = np.argsort(-z[a:b], axis=0)
            for k in range(Y.shape[1]):
                if Y[d, k]:
                    best = a + order[:2, k]
                    target[best, k] = 1.0
                    more = a + order[2:, k]
                    sure = z[more, k] > 0
                    target[more[sure], k] = 1.0
                    weight[more[~sure & (z[more, k] > -2)], k] = 0.2
                else:
                    weight[a + order[0, k], k] = 0.3  # one sentence alone may well belong to a subject
    return linear.fit(data, target, DIM, epochs=40, rate=0.15, l2=2e-4, weight=weight, start=W)


def _fit_chain(E: np.ndarray, S: np.ndarray, Y: np.ndarray) -> list[np.ndarray]:
    """Weights of each link: evidence of all subjects for the own first, structure, labels before."""
    chain = []
    for k in range(Y.shape[1]):
        X = np.concatenate([_link_input(E, k), S, Y[:, :k].astype(np.float32)], axis=1)
        chain.append(_fit_dense(X, Y[:, k].astype(np.float32)))
    return chain


def _fit_dense(X: np.ndarray, y: np.ndarray, epochs: int = 500, rate: float = 0.1, l2: float = 2e-4) -> np.ndarray:
    """A logistic regression on few features, by full-batch Adam."""
    w, m, s = (np.zeros(X.shape[1], np.float32) for _ in range(3))
    for t in range(1, epochs + 1):
        g = X.T @ ((1 / (1 + np.exp(-np.clip(X @ w, -30, 30))) - y) / max(1, len(y))) + l2 * w
        m = 0.9 * m + 0.1 * g
        s = 0.999 * s + 0.001 * g * g
        w -= (rate / (1 - 0.9**t)) * m / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return w


def _link_input(E: np.ndarray, k: int) -> np.ndarray:
    """The subject's own evidence and the strongest of the others."""
    others = np.delete(E, k, axis=1)
    rest = others[:, :, 1].max(1, keepdims=True) if others.shape[1] else np.zeros((len(E), 1), np.float32)
    return np.concatenate([E[:, k], rest], axis=1)


def decode(chain: list[np.ndarray], E: np.ndarray, S: np.ndarray, width: int = BEAM) -> np.ndarray:
    """(documents, labels): the most probable combination of labels of each document, by beam search along the
    chain; all documents advance one link at a time. Of equal ones the combination with fewer labels wins."""
    n = len(E)
    score, on = np.zeros((n, 1), np.float64), np.zeros((n, 1, len(chain)), np.float32)
    for k, w in enumerate(chain):
        own = _link_input(E, k)
        base = own @ w[: own.shape[1]] + S @ w[own.shape[1] : own.shape[1] + S.shape[1]]
        z = base[:, None] + on[:, :, :k] @ w[own.shape[1] + S.shape[1] :]
        no, yes = score - np.logaddexp(0, z), score - np.logaddexp(0, -z)
        score = np.concatenate([no, yes], 1)
        on = np.concatenate([on, on], 1)
        on[:, no.shape[1] :, k] = 1
        keep = np.argsort(-score, axis=1, kind="stable")[:, :width]
        score, on = np.take_along_axis(score, keep, 1), np.take_along_axis(on, keep[:, :, None], 1)
    return on[:, 0] > 0


@dataclass(frozen=True)
class Model:
    sentences: np.ndarray
    chain: list[np.ndarray]
    marks: Marks

    def decide(self, texts: list[str], sources: list[str | None], langs: list[str | None], known: Words) -> np.ndarray:
        """(documents, labels); a text without sentences has none."""
        x = sentences(texts, known)
        E = _evidence(_scores(self.sentences, x), x.doc, x.n)
        return decode(self.chain, E, self.marks.structure(x.n, sources, langs)) & (x.n > 0)[:, None]


def train(rows: list[tuple[str, str | None, str | None, set[str]]], names: list[str], seed: int = 3) -> Model:
    """A model from (text, source, lang, subjects)."""
    known = Words()
    Y = np.array([[n in labels for n in names] for _, _, _, labels in rows])
    marks = Marks([(s, la) for _, s, la, _ in rows])
    every = sentences([r[0] or "" for r in rows], known)
    # equal texts are on one side, so that no sentence's scores come from a model that was fitted on its copy; with
    # very few different texts a side would lack whole subjects, so rows are split at random there
    order = {t: i for i, t in enumerate(sorted({r[0] or "" for r in rows}, key=lambda t: xxhash.xxh64_intdigest(t, seed)))}
    few = len(order) < 20 * len(names)
    fold = np.random.default_rng(seed).random(len(rows)) < 0.5 if few else np.array([order[r[0] or ""] % 2 == 0 for r in rows])
    E = np.zeros((len(rows), len(names), 8), np.float32)
    for side in (fold, ~fold):
        if side.any() and (~side).any():
            W = _fit_sentences(sentences([r[0] or "" for r, x in zip(rows, side) if not x], known), Y[~side])
            x = sentences([r[0] or "" for r, on in zip(rows, side) if on], known)
            E[side] = _evidence(_scores(W, x), x.doc, x.n)
    S = marks.structure(every.n, [r[1] for r in rows], [r[2] for r in rows])
    return Model(_fit_sentences(every, Y), _fit_chain(E, S, Y), marks)


def subjects(docs: DataFrame, labels: DataFrame, key: str, text: str, source: str, lang: str, label: str = "subject", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(key, subject): the subjects of every document."""
    spark = ship(docs.sparkSession)
    names = sorted(r[0] for r in labels.where(F.col(label).isNotNull()).select(label).distinct().collect())  # the names of the subjects
    own = labels.groupBy(F.col(key).alias("k")).agg(F.collect_set(label).alias("labels"))
    some = own.orderBy(F.xxhash64("k"), "k").limit(sample_docs)
    base = docs.select(docs[key].alias("k"), docs[text].cast("string").alias("t"), docs[source].cast("string").alias("s"), docs[lang].cast("string").alias("l"))
    taken = base.where("t is not null").join(F.broadcast(some), "k").dropDuplicates(["k"]).orderBy(F.xxhash64("k"), "k").collect() if names else []  # sample_docs rows
    if names and len(taken) < LEAST_DOCS:
        warnings.warn(f"{len(taken)} labelled documents are too few to train on: no subjects are found", stacklevel=2)
    model = train([(r["t"], r["s"], r["l"], set(r["labels"])) for r in taken], names) if len(taken) >= LEAST_DOCS else None
    shared = spark.sparkContext.broadcast(model)  # DIM x subjects weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, known = shared.value, Words()
        table = pa.array(names, pa.string())
        for whole in batches:
            for at in range(0, len(whole) if m is not None else 0, TEXTS_AT_A_TIME):
                b = whole.slice(at, TEXTS_AT_A_TIME)
                doc, k = np.nonzero(m.decide(*[b.column(i).to_pylist() for i in (1, 2, 3)], known))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(doc)), table.take(pa.array(k))], ["k", "subject"])

    kind = dict(base.dtypes)["k"]
    made = base.where(F.col("t").isNotNull() & (F.trim("t") != "")).mapInArrow(run, f"k {kind}, subject string")
    return made.distinct().withColumnRenamed("k", key)


def composition(docs: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """(subject, n_documents, share): how many documents have each subject, and no subject (null). ``found`` is
    written once and read for both."""
    found = cut(found, "subjects")
    n = docs.select(key).distinct().count()
    by = found.groupBy("subject").agg(F.count("*").alias("n_documents"))
    none = found.select(key).distinct().agg((F.lit(n) - F.count("*")).alias("n_documents")).select(F.lit(None).cast("string").alias("subject"), "n_documents")
    return by.unionByName(none).withColumn("share", F.col("n_documents") / F.lit(max(1, n)))
