"""Near-duplicate texts by token-combination prefixes (problem 2).

The tokens of a text are its distinct sequences of ``width`` consecutive words (runs of letters and
digits of the lower-cased text). Two texts are linked where the Jaccard similarity of their tokens is
at least ``threshold``. The join is exact: candidates come from signatures that a linked pair can't
avoid sharing, and are then verified on the tokens.

Signatures. Tokens have one global order, rare before frequent, by counts over all texts in a sketch
whose size follows the number of tokens up to 16 MB (an estimate: the order only steers cost, never the result). Each token belongs to a
class by its frequency, and to a group of its class by a hash. A rare token is a signature by itself;
of frequent classes the combinations of 2 or 3 tokens of one group are. Of a text's n tokens in that
order a prefix is taken. If a linked pair shared no signature, it would share less than k tokens of
each group of class k within the prefix, so at least sum(max(0, tokens in group - k + 1)) of the
prefix would be missing from the partner; the prefix is extended until that sum exceeds what a
linked partner can miss. (Of the two texts take the one whose prefix ends first in the global order:
what it shares lies in the other's prefix, too.) The partner of a text of n tokens has at least
``threshold`` * n, so texts are dealt to bands of sizes, within which the number of groups is fixed
such that the full set always suffices; bands of small sizes use single tokens only.

Work is dealt by (band, group, part) of signatures: a row holds a text's few tokens of that group
and a parity bitmap of all its tokens. The part comes from a hash of the combination's rarest token,
and there are more parts as there are more texts, so that one task handles a bounded number. The
combinations are made, sorted and compared inside the task, in numpy, in slices of bounded size; the
bits in which two bitmaps differ are a lower bound of the tokens in which the texts differ, so most
pairs end there and are never written. A combination of more than ``HOT_RUN`` texts (a sentence that a
million texts share) is not compared in its task: its texts, sorted by size, are cut into blocks, and pairs of blocks whose
sizes can match at all are compared in tasks of their own. Nothing is capped or dropped.

Texts with the same tokens form a class, and only classes are joined, so copies cost nothing; pairs of
texts are expanded at the end, where they are asked for (:func:`pairs`); :func:`groups` gives one
row for each text instead, with its class, its group and the number of links of its class.

Defined results: null, empty and short texts (less than ``width`` words) have no tokens and no links,
and each is a group by itself; a key written twice with one text counts once, with two texts it is
linked by either; null keys are ignored; exactly ``threshold`` counts as linked.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestream.plans.runtime import cut, forget, ship

WIDTH, THRESHOLD = 5, 0.8
#: Cells of the sketch of frequencies: one for each ``TOKENS_PER_CELL`` tokens, within these bounds.
SKETCH_BITS, MOST_SKETCH_BITS, TOKENS_PER_CELL = 22, 24, 8
#: Texts with one combination that are compared in the task that finds them; more are compared in blocks of so many.
HOT_RUN = 20_000
#: Tokens of at most so many texts are single signatures, of at most so many pairs; others triples.
SINGLE_UP_TO, PAIR_UP_TO = 8, 64
#: Bands of sizes are powers of 2 and of single tokens only below this, and grow by 4 from it.
LEAST_BAND = 32
#: A task gets about this many texts of one group of a band, and works on slices of its combinations.
TEXTS_PER_PART, TEXTS_PER_SLICE = 500_000, 40_000
PAIRS_AT_A_TIME = 1_000_000
#: Texts that are dealt, and rows whose combinations are made, at a time.
TEXTS_AT_A_TIME, ROWS_AT_A_TIME = 2_000, 100_000
_WORD = re.compile(r"[^\W_]+")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class Tokens:
    """Distinct hashed tokens of texts; words are hashed once in each worker."""

    def __init__(self, width: int):
        self.width, self.known = width, {}

    def of(self, text: str | None) -> np.ndarray:
        ws = _WORD.findall((text or "").lower())
        if len(ws) < self.width:
            return np.zeros(0, np.uint64)
        if len(self.known) > 1_000_000:
            self.known.clear()
        known = self.known
        hs = np.empty(len(ws), np.uint64)
        for i, w in enumerate(ws):
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            hs[i] = h
        n = len(ws) - self.width + 1
        t = hs[:n].copy()
        for k in range(1, self.width):
            t = (t ^ (t >> np.uint64(29))) * _M2 + hs[k : k + n] * _M1
        t ^= t >> np.uint64(32)
        t *= _M1
        return np.unique(t ^ (t >> np.uint64(31)))


def _class_of(tokens: np.ndarray) -> int:
    """A number of 64 bits for a set of tokens: the same set has the same in any run."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def _sets(df: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(k, c, n, tokens): every text's class and tokens, the latter as numbers of 4 bytes."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Tokens(width)
        for b in batches:
            sets = [make.of(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([_class_of(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()), pa.array([s.astype(np.uint32).tobytes() for s in sets], pa.binary())],
                ["k", "c", "n", "tokens"],
            )

    kind = df.schema[key].dataType.simpleString()
    rows = df.where(df[key].isNotNull()).select(df[key].alias("k"), df[text].cast("string").alias("t"))
    return rows.mapInArrow(run, f"k {kind}, c bigint, n int, tokens binary")


def _frequencies(classes: DataFrame, n_tokens: int) -> np.ndarray:
    """Estimated number of texts of each sketch cell, as 2 * log2 (bytes): at most 16 MB."""
    bits = int(min(MOST_SKETCH_BITS, max(SKETCH_BITS, math.ceil(math.log2(max(1, n_tokens / TOKENS_PER_CELL))))))
    span = 1 << (bits - 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for b in batches:
            for t in b.column(0).to_pylist():
                counts[np.frombuffer(t, np.uint32) & np.uint32((1 << bits) - 1)] += np.uint32(1)
        cells = np.flatnonzero(counts).astype(np.int32)
        part = cells >> (bits - 5)
        for p in range(32):
            c = cells[part == p]
            if len(c):
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([c.tobytes()], pa.binary()), pa.array([counts[c].tobytes()], pa.binary())], ["part", "cells", "counts"])

    def add(t):
        p = t.column(0)[0].as_py()
        total = np.zeros(span, np.int64)
        for c, n in zip(t.column(1).to_pylist(), t.column(2).to_pylist()):
            total[np.frombuffer(c, np.int32) - p * span] += np.frombuffer(n, np.uint32)
        level = np.ceil(2 * np.log2(np.maximum(total, 1))).astype(np.uint8)
        return pa.Table.from_arrays([pa.array([p], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["part", "levels"])

    made = classes.select("tokens").mapInArrow(run, "part int, cells binary, counts binary")
    levels = np.zeros(1 << bits, np.uint8)
    for r in made.groupBy("part").applyInArrow(add, "part int, levels binary").collect():  # 32 rows
        levels[r["part"] * span : (r["part"] + 1) * span] = np.frombuffer(r["levels"], np.uint8)
    return levels


class Scheme:
    """Bands, classes and groups for a threshold."""

    def __init__(self, threshold: float):
        self.t = threshold
        small = [1 << b for b in range(int(math.log2(LEAST_BAND)) + 1)]
        self.starts = np.array(small + [LEAST_BAND * 4**b for b in range(1, 16)], np.int64)

    def band(self, n):
        return np.searchsorted(self.starts, n, side="right") - 1

    def bounds(self, band: int) -> tuple[int, int]:
        return int(self.starts[band]), int(self.starts[band + 1])

    def triple_groups(self, band: int) -> int:
        """0: single tokens only. Of a pair with sizes a <= b at least t * a tokens are common, and
        without a common signature at most 1 + 2 * groups are."""
        s = int(self.starts[band])
        most = (math.ceil(self.t * s - 1e-9) - 2) // 2
        return 0 if s < LEAST_BAND or most < 1 else min(most, max(8, s // 8))

    def may_miss(self, n: np.ndarray, band: int) -> np.ndarray:
        """The most tokens of a text of n that a linked partner may lack, in a band: of the two the
        smaller is in the band, so a partner is no smaller than the band and than t * n."""
        partner = np.maximum(self.starts[band], np.ceil(n * self.t - 1e-9))
        partner = np.minimum(partner, n)
        return (n - np.ceil((n + partner) * (self.t / (1 + self.t)) - 1e-9)).astype(np.int64)


def _mix(tokens: np.ndarray) -> np.ndarray:
    m = tokens.astype(np.uint64) * _M2
    return m ^ (m >> np.uint64(31))


def _words(band_start: int) -> int:
    """64-bit words of the bitmaps of a band: some more bits than its larger texts have tokens."""
    return 2 if band_start < LEAST_BAND else min(96, 6 * max(1, band_start // 64))


def _bitmaps(doc: np.ndarray, tokens: np.ndarray, n_docs: int, words: int) -> np.ndarray:
    """(n_docs, words): the parity of each text's tokens in 64 * words cells."""
    cell = ((tokens.astype(np.uint64) * _M1) >> np.uint64(33)) % np.uint64(64 * words)
    out = np.zeros((n_docs, words), np.uint64)
    np.bitwise_xor.at(out, (doc, (cell >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (cell & np.uint64(63)))
    return out


def _deal(sets: list[np.ndarray], levels: np.ndarray, scheme: Scheme, n_parts: int, taken: np.ndarray):
    """(band, group, part, texts, tokens in each, tokens, bitmaps of the texts) for a batch of texts.
    Group 0 has single tokens, group 1 pairs, later ones triples. ``taken``: bands with any text."""
    size = np.array([len(x) for x in sets], np.int64)
    low = scheme.band(np.maximum(1, np.ceil(size * scheme.t - 1e-9)))
    high = scheme.band(np.maximum(1, size))
    for band in np.flatnonzero(taken):
        texts = np.flatnonzero((size > 0) & (low <= band) & (band <= high))
        if not len(texts):
            continue
        n = size[texts]
        doc = np.repeat(np.arange(len(texts)), n)
        tokens = np.concatenate([sets[i] for i in texts])
        bitmaps = _bitmaps(doc, tokens, len(texts), _words(int(scheme.starts[band])))
        level = levels[tokens & np.uint32(len(levels) - 1)]
        mixed = _mix(tokens)
        m = scheme.triple_groups(int(band))
        if m:
            k = np.where(level <= 2 * math.log2(SINGLE_UP_TO), 1, np.where(level <= 2 * math.log2(PAIR_UP_TO), 2, 3))
            group = np.where(k <= 2, k - 1, 2 + (mixed % np.uint64(m)).astype(np.int64))
        else:
            k, group = np.ones(len(tokens), np.int64), np.zeros(len(tokens), np.int64)
        o = np.lexsort((tokens, level, doc))  # the global order within each text
        doc, tokens, level, k, group, mixed = doc[o], tokens[o], level[o], k[o], group[o], mixed[o]
        by = np.lexsort((np.arange(len(doc)), group, doc))
        change = np.flatnonzero(np.r_[True, (doc[by][1:] != doc[by][:-1]) | (group[by][1:] != group[by][:-1])])
        nth = np.empty(len(doc), np.int64)
        nth[by] = np.arange(len(doc)) - np.repeat(change, np.diff(np.r_[change, len(doc)]))
        covers = (nth >= k - 1).astype(np.int64)
        first = np.cumsum(n) - n
        covered = np.cumsum(covers) - covers  # before each token, within its text
        covered -= np.repeat(covered[first], n)
        keep = covered < np.repeat(scheme.may_miss(n, int(band)) + 1, n)
        by = by[keep[by]]  # by text and group, in the global order
        doc, tokens, group, mixed, k = doc[by], tokens[by], group[by], mixed[by], k[by]
        change = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (group[1:] != group[:-1])])
        length = np.diff(np.r_[change, len(doc)])
        enough = length >= k[change]
        for g in np.unique(group[change[enough]]):
            own = np.flatnonzero(enough & (group[change] == g))
            c, ln = change[own], length[own]
            for part in range(n_parts):
                if n_parts > 1:  # those where a token that may be a combination's first is of the part
                    flat = np.repeat(c, ln) + _ramp(ln)
                    lead = _ramp(ln) <= np.repeat(ln - k[c], ln)
                    hit = lead & (((mixed[flat] >> np.uint64(7)) & np.uint64(n_parts - 1)) == part)
                    some = np.add.reduceat(hit, np.cumsum(ln) - ln) > 0
                    cc, ll = c[some], ln[some]
                else:
                    cc, ll = c, ln
                if len(cc):
                    yield int(band), int(g), part, texts[doc[cc]], ll, tokens[np.repeat(cc, ll) + _ramp(ll)], bitmaps[doc[cc]]


def _ramp(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the lengths, one after the other."""
    return np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _combinations(flat, start, length, k: int, slices: int, nth: int, part: int, n_parts: int):
    """(signatures, rows): the combinations of k tokens of each row whose first token is of the part
    and of the nth slice."""
    sigs, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
    for L in np.unique(length):
        if L < k:
            continue
        every = np.flatnonzero(length == L)
        for lo in range(0, len(every), ROWS_AT_A_TIME):
            r = every[lo : lo + ROWS_AT_A_TIME]
            T = flat[start[r][:, None] + np.arange(L)]
            M = _mix(T[:, : L - k + 1])
            mine = ((M >> np.uint64(7)) & np.uint64(n_parts - 1)) == part
            mine &= (M >> np.uint64(33)) % np.uint64(slices) == nth
            for lead in range(L - k + 1):
                at = np.flatnonzero(mine[:, lead])
                if not len(at):
                    continue
                cols = T[at].astype(np.uint64)
                h0 = (cols[:, lead] + np.uint64(1)) * _M1
                h0 ^= h0 >> np.uint64(29)
                for rest in itertools.combinations(range(lead + 1, L), k - 1):
                    h = h0
                    for j in rest:
                        h = (h + cols[:, j] + np.uint64(1)) * _M1
                        h = h ^ (h >> np.uint64(29))
                    sigs.append(h)
                    rows.append(r[at].astype(np.int32))
    return np.concatenate(sigs), np.concatenate(rows)


def _similar(a, b, sizes_a, sizes_b, maps_a, maps_b, scheme: Scheme):
    """Of pairs of rows (a of one set, b of another) those that pass the bounds on size and bitmaps."""
    sa, sb = sizes_a[a], sizes_b[b]
    ok = np.minimum(sa, sb) >= scheme.t * np.maximum(sa, sb) - 1e-9
    a, b, both = a[ok], b[ok], (sa + sb)[ok]
    slack = (both - 2 * np.ceil(both * (scheme.t / (1 + scheme.t)) - 1e-9)).astype(np.int32)
    half = maps_a.shape[1] // 2
    for cols in (range(half), range(half, maps_a.shape[1])):  # most pairs end at the first half
        bits = np.zeros(len(a), np.int32)
        for w in cols:
            bits += np.bitwise_count(maps_a[a, w] ^ maps_b[b, w])
        slack = slack - bits
        ok = slack >= 0
        a, b, slack = a[ok], b[ok], slack[ok]
    return a, b


def _ordered(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distinct pairs of numbers, the smaller first."""
    return np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)


def _matches(ids, sizes, bitmaps, flat, length, k: int, scheme: Scheme, band: int, part: int, n_parts: int, hot: list, hot_run: int):
    """Pairs of rows that share a combination of k tokens and pass the bounds on size and bitmaps.
    Of each pair the smaller text is in the band: pairs of larger ones are made in their own. The rows of each different
    run of more than ``hot_run`` are put into ``hot`` instead of being compared."""
    start = np.cumsum(length, dtype=np.int64) - length
    large = (sizes >= scheme.bounds(band)[1]).astype(np.uint64)
    if large.all():
        return
    slices = max(1, math.ceil(len(ids) / TEXTS_PER_SLICE))
    known = set()
    for nth in range(slices):
        s, r = _combinations(flat, start, length, k, slices, nth, part, n_parts)
        s = (s & ~np.uint64(1)) | large[r]  # larger texts after those of the band
        o = np.argsort(s)
        s, r = s[o], r[o]
        key = s >> np.uint64(1)
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        n = np.diff(np.r_[begin, len(key)])
        for at in np.flatnonzero(n > hot_run):
            rows = np.unique(r[begin[at] : begin[at] + n[at]])
            digest = xxhash.xxh3_128_digest(rows.tobytes())  # the combinations of one sentence have the same texts
            if digest not in known:
                known.add(digest)
                hot.append(rows)
        begin, n = begin[n <= hot_run], n[n <= hot_run]
        begin, n = begin[n > 1], n[n > 1]
        # each entry of the band is paired with those after it in its run, in slices of bounded size
        entry = np.repeat(begin, n) + _ramp(n)
        after = np.repeat(begin + n, n) - entry - 1
        use = (after > 0) & ((s[entry] & np.uint64(1)) == 0)
        entry, after = entry[use], after[use]
        ends, lo = np.cumsum(after), 0
        while lo < len(entry):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PAIRS_AT_A_TIME)))
            cnt = after[lo:hi]
            x = np.repeat(entry[lo:hi], cnt)
            a, b = r[x], r[x + 1 + _ramp(cnt)]
            lo = hi
            ok = a != b
            a, b = _similar(a[ok], b[ok], sizes, sizes, bitmaps, bitmaps, scheme)
            yield _ordered(ids[a], ids[b])


def _blocks(rows: np.ndarray, sizes: np.ndarray, scheme: Scheme, size: int) -> list[tuple[np.ndarray, list[int]]]:
    """A run's rows by size in blocks of ``size``, each with the later blocks (and itself) that it may match."""
    rows = rows[np.argsort(sizes[rows], kind="stable")]
    parts = [rows[i : i + size] for i in range(0, len(rows), size)]
    top = [int(sizes[p[-1]]) for p in parts]
    return [(p, [j for j in range(i, len(parts)) if top[i] >= scheme.t * sizes[parts[j][0]] - 1e-9]) for i, p in enumerate(parts)]


def _block_pairs(x: tuple, y: tuple | None, scheme: Scheme, band: int):
    """Pairs between two blocks (ids, sizes, bitmaps), or within one, of which the smaller text is in the band."""
    same = y is None
    y = x if same else y
    beyond = scheme.bounds(band)[1]
    step = max(1, PAIRS_AT_A_TIME // max(1, len(y[0])))
    for lo in range(0, len(x[0]), step):
        a = np.repeat(np.arange(lo, min(lo + step, len(x[0]))), len(y[0]))
        b = np.tile(np.arange(len(y[0])), len(a) // len(y[0]))
        ok = (a < b) if same else np.ones(len(a), bool)
        ok &= (x[1][a] < beyond) | (y[1][b] < beyond)
        a, b = _similar(a[ok], b[ok], x[1], y[1], x[2], y[2], scheme)
        ok = x[0][a] != y[0][b]
        yield _ordered(x[0][a[ok]], y[0][b[ok]])


def class_pairs(classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a < b: candidates among the classes (c, n, tokens), each once."""
    spark = classes.sparkSession
    scheme = Scheme(threshold)
    edges = [int(x) for x in scheme.starts]
    band_of = F.size(F.filter(F.array(*[F.lit(x) for x in edges]), lambda x: x <= F.col("n"))) - 1
    seen = classes.groupBy(band_of.alias("band")).agg(F.count("*").alias("count"), F.sum("n").alias("tokens")).collect()  # a row for each band
    counts = {r["band"]: r["count"] for r in seen}
    levels = _frequencies(classes, sum(r["tokens"] for r in seen))
    taken = np.array([b in counts for b in range(len(edges))])
    n_parts = 1 << max(0, math.ceil(math.log2(max(1, sum(counts.values()) / TEXTS_PER_PART))))
    shared = spark.sparkContext.broadcast(levels)  # at most 16 MB
    hot_run = HOT_RUN

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lv = shared.value
        for whole in batches:
            for at in range(0, len(whole), TEXTS_AT_A_TIME):
                b = whole.slice(at, TEXTS_AT_A_TIME)
                ids = np.array(b.column(0).to_pylist(), np.int64)
                sets = [np.frombuffer(t, np.uint32) for t in b.column(1).to_pylist()]
                size = np.array([len(x) for x in sets], np.int32)
                rows = [(band, group, part, ids[x].tobytes(), size[x].tobytes(), maps.tobytes(), ln.astype(np.int32).tobytes(), tokens.tobytes()) for band, group, part, x, ln, tokens, maps in _deal(sets, lv, scheme, n_parts, taken)]
                cols = list(zip(*rows)) if rows else [[]] * 8
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, [pa.int32()] * 3 + [pa.binary()] * 5)], ["band", "grp", "part", "ids", "sizes", "maps", "lens", "tokens"])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {3: np.int64, 4: np.int32, 5: np.uint64, 6: np.int32, 7: np.uint32}
        cols: dict[int, list] = {i: [] for i in kinds}
        band = group = part = words = 0
        for b in batches:  # copied batch by batch, so that no batch is held
            if len(b):
                band, group, part = (b.column(i)[0].as_py() for i in range(3))
                for i, kind in kinds.items():
                    cols[i].append(np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in b.column(i)]))
        words = _words(int(scheme.starts[band]))
        whole = {i: np.concatenate(cols.pop(i)) for i in kinds}
        maps = whole.pop(5).reshape(-1, words)
        ids, sizes, hot = whole[3], whole[4], []
        for a, b in _matches(ids, sizes, maps, whole[7], whole[6], min(group + 1, 3), scheme, band, part, n_parts, hot, hot_run):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *[pa.nulls(len(a), f.type) for f in hot_fields]], names)
        for run, rows in enumerate(hot):
            name = f"{band} {group} {part} {run}"
            for i, (own, with_) in enumerate(_blocks(rows, sizes, scheme, hot_run)):
                # a block is written once; what pairs it takes part in follows from its number and the list
                row = [None, None, band, name, i, with_, ids[own].tobytes(), sizes[own].astype(np.int32).tobytes(), maps[own].tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, [pa.int64(), pa.int64(), *[f.type for f in hot_fields]])], names)

    hot_fields = [pa.field("band", pa.int32()), pa.field("run", pa.string()), pa.field("block", pa.int32()), pa.field("with_", pa.list_(pa.int32())), pa.field("ids", pa.binary()), pa.field("sizes", pa.binary()), pa.field("maps", pa.binary())]
    names = ["a", "b", *[f.name for f in hot_fields]]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: r["block"])
        if rows:
            words = _words(int(scheme.starts[rows[0]["band"]]))
            blocks = [(np.frombuffer(r["ids"], np.int64), np.frombuffer(r["sizes"], np.int32), np.frombuffer(r["maps"], np.uint64).reshape(-1, words)) for r in rows]
            for a, b in _block_pairs(blocks[0], blocks[1] if len(blocks) > 1 else None, scheme, rows[0]["band"]):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    dealt = classes.select("c", "tokens").mapInArrow(deal, "band int, grp int, part int, ids binary, sizes binary, maps binary, lens binary, tokens binary")
    found = cut(dealt.groupBy("band", "grp", "part").applyInArrow(match, "a bigint, b bigint, band int, run string, block int, with_ array<int>, ids binary, sizes binary, maps binary"), "matches")
    pairs = found.where("a is not null").select("a", "b")
    blocks = found.where("run is not null").select("band", "run", "block", "with_", "ids", "sizes", "maps")
    # a block goes to the pairs that its own list names, and to those of the lists of earlier blocks
    lists = blocks.select("run", F.col("block").alias("i"), F.explode("with_").alias("j"))
    sides = lists.select("run", "i", "j", F.col("i").alias("block")).union(lists.where("i <> j").select("run", "i", "j", F.col("j").alias("block")))
    work = blocks.drop("with_").join(sides, ["run", "block"])
    more = work.groupBy("run", "i", "j").applyInArrow(compare, "a bigint, b bigint")
    return pairs.unionByName(more).distinct()


def links(df: DataFrame, key: str, text: str, width: int = WIDTH, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(members, pairs). members: (k, c, n) the class of each text with tokens. pairs: (a, b,
    similarity) the linked classes, a < b."""
    sets = cut(_sets(df, key, text, width), "tokens")
    # a class's number comes from its tokens alone, so it is the same in any run
    members = cut(sets.where("n > 0").select("k", "c", "n").distinct(), "members")
    classes = sets.where("n > 0").groupBy("c").agg(F.first("tokens").alias("tokens"), F.first("n").alias("n"))
    classes = cut(classes, "classes")
    forget(sets)
    candidates = cut(class_pairs(classes, threshold), "candidates")
    # verify on the tokens: those of candidates only, as numbers of 4 bytes
    wanted = candidates.select(F.col("a").alias("c")).union(candidates.select("b")).distinct()
    some = classes.join(wanted, "c", "left_semi")
    half = candidates.join(some.select(F.col("c").alias("a"), F.col("tokens").alias("ta")), "a")
    both = half.join(some.select(F.col("c").alias("b"), F.col("tokens").alias("tb")), "b").select("a", "b", "ta", "tb")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sims = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                u, v = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                common = len(np.intersect1d(u, v, assume_unique=False))
                sims.append(common / (len(u) + len(v) - common))
            keep = np.array(sims) >= threshold - 1e-12
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sims, pa.float64())], ["a", "b", "similarity"]).filter(pa.array(keep, pa.bool_()))

    found = cut(both.mapInArrow(verify, "a bigint, b bigint, similarity double"), "links")
    forget(classes)
    return members.select("k", "c", "n"), found


def pairs(df: DataFrame, key: str, text: str, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """(key_a, key_b): all linked pairs of different keys, the smaller key first. Its rows are as
    many as there are pairs; :func:`groups` stays linear where copies abound."""
    members, found = links(df, key, text, width, threshold)
    m = members.select("k", "c")
    x = m.select(F.col("k").alias("x"), F.col("c").alias("a"))
    y = m.select(F.col("k").alias("y"), F.col("c").alias("b"))
    between = found.select("a", "b").join(x, "a").join(y, "b").select("x", "y")
    within = x.join(y, x["a"] == y["b"]).where(F.col("x") < F.col("y")).select("x", "y")
    every = between.unionByName(within).where(F.col("x") != F.col("y"))
    return every.select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b")).distinct()


def groups(df: DataFrame, key: str, text: str, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """(key, class_id, group_id, n_links): one row for each key; a group is what links connect, its
    id is its smallest class; n_links counts the other keys that the key is linked with. Keys without
    tokens have nulls and no links."""
    members, found = links(df, key, text, width, threshold)
    size = members.groupBy("c").agg(F.count_distinct("k").alias("copies"))
    sides = found.select("a", "b").union(found.select("b", "a"))
    far = sides.join(size.withColumnRenamed("c", "b"), "b").groupBy(F.col("a").alias("c")).agg(F.sum("copies").alias("far"))
    labels = components(sides)
    per_class = size.join(far, "c", "left").join(labels.select(F.col("v").alias("c"), "label"), "c", "left")
    per_class = per_class.select("c", F.coalesce("label", "c").alias("group_id"), (F.col("copies") - 1 + F.coalesce("far", F.lit(0))).alias("n_links"))
    own = members.groupBy("k").agg(F.min("c").alias("c"))
    everyone = df.where(df[key].isNotNull()).select(df[key].alias("k")).distinct()
    out = everyone.join(own, "k", "left").join(per_class, "c", "left")
    return out.select(F.col("k").alias(key), F.col("c").alias("class_id"), "group_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def components(sides: DataFrame) -> DataFrame:
    """(v, label): the smallest vertex of each component of the edges (a, b), given in both
    directions. Labels spread along edges and jump to their label's label, so the rounds follow the
    logarithm of the diameter in practice; every round is a written table."""
    edges = cut(sides.select("a", "b").distinct(), "edges")
    labels = cut(edges.groupBy(F.col("a").alias("v")).agg(F.least(F.col("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("v").alias("b"), F.col("label").alias("l")), "b").groupBy("a").agg(F.min("l").alias("l"))
        step = labels.join(near.withColumnRenamed("a", "v"), "v").select("v", "label", F.least("label", "l").alias("new"))
        jump = step.join(labels.select(F.col("v").alias("new"), F.col("label").alias("far")), "new", "left")
        after = cut(jump.select("v", F.col("label").alias("old"), F.least("new", F.coalesce("far", "new")).alias("label")), "labels")
        changed = after.where("old <> label").limit(1).count()
        forget(labels)
        labels = after.select("v", "label")
        if not changed:
            return labels
