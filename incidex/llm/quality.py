"""Quality scores by a generalised additive model with pairwise interactions.

A text becomes a handful of numbers (``FEATURES``): lengths, shares of
character classes, repetition of words, lines and phrases.  Every feature has
a lookup table over its bins, and so have a few pairs of features; a text's
logit is the sum of the entries its bins point to.  The tables are learned by
cyclic boosting: round after round, each feature in turn gets a shallow tree
(at most ``LEAVES`` ranges of its bins) fitted to what all tables together
still miss, at a small learning rate.  The pairs whose two-way trees explain
most of the rest are boosted after the single features.  Rounds stop where a
part of the sample that does not train gets worse.

Fitting uses a bounded sample of labelled rows (``SAMPLE`` rows, drawn by the
hash of the key; labels of the sample's keys are the only thing broadcast, and
only feature numbers reach the driver).  Scoring reads whole texts; it is one
bin lookup and one addition for each table, vectorised over the batch.

Null and empty texts have features of zero and are scored like any other text.
Rows with a null key or label do not train; an id with several labels or texts
trains with each different pair of them.  Without labelled rows the score is
0.5; with one class only it is that class's.  Scoring is a column expression
on the text alone, so ties, repeated rows, empty tables and other columns play
no part.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000
BINS = 48           # of a feature
PAIR_BINS = 12      # of each feature of a pair
PAIRS = 12
ROUNDS = 240
PAIR_ROUNDS = 80
LEAVES = 4
RATE = 0.08
LEAST_ROWS = 12     # rows of a leaf
RIDGE = 1.0
PATIENCE = 25
SLICE_CHARS = 1 << 18

FEATURES = ["log_chars", "log_words", "word_length", "letters", "upper", "digits", "blanks", "stops", "marks",
            "high_bytes", "marked_words", "upper_words", "titles", "long_words", "short_words", "distinct_words",
            "repeated_next", "repeated_pairs", "repeated_eights", "top_word", "lines", "line_length", "repeated_lines",
            "sentence_length", "worst_marks", "worst_repeats"]

# classes of the bytes of UTF-8
_LOWER, _UPPER, _DIGIT, _BLANK, _STOP, _MARK, _HIGH = range(7)
_CLASS = np.array([_LOWER if 0x61 <= c <= 0x7A else _UPPER if 0x41 <= c <= 0x5A else _DIGIT if 0x30 <= c <= 0x39
                   else _BLANK if c <= 0x20 else _STOP if chr(c) in ".,;:?'\"-()" else _HIGH if c >= 0x80 else _MARK
                   for c in range(256)], np.uint8)
_ENDS = re.compile(r"[.!?](?=\s|$)")
_MARKED = re.compile(r"[^\w\s.,;:?'\"()-]")


def _repeats(items: list) -> float:
    """Share of the items that stood before."""
    return 1 - len(set(items)) / len(items) if items else 0.0


def features(text: str | None) -> list[float]:
    """The numbers of ``FEATURES`` for the whole text."""
    if not text:
        return [0.0] * len(FEATURES)
    counts = np.zeros(7, np.int64)
    for at in range(0, len(text), SLICE_CHARS):
        b = np.frombuffer(text[at:at + SLICE_CHARS].encode("utf-8", "replace"), np.uint8)
        counts += np.bincount(_CLASS[b], minlength=7)
    size = max(1, int(counts.sum()))
    words = text.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    marked = [bool(_MARKED.search(w)) for w in words]
    keys = [hash(w) for w in words]
    ids = np.unique(np.array(keys, np.int64), return_inverse=True)[1] if words else np.zeros(0, np.int64)
    top = int(np.bincount(ids).max(initial=0)) if len(ids) else 0
    next_same = (ids[1:] == ids[:-1]) if len(ids) > 1 else np.zeros(0, bool)
    pairs = ids[1:] * n + ids[:-1] if len(ids) > 1 else ids[:0]
    eights = ids[: len(ids) // 8 * 8].reshape(-1, 8)
    lines = [x for x in text.split("\n") if x.strip()]
    # the worst stretch of 32 words: junk may fill only a part of a text
    step = 32
    stretches = np.arange(0, len(words), step)
    worst_marks = worst_repeats = 0.0
    if len(words):
        width = np.diff(np.append(stretches, len(words)))
        worst_marks = float((np.add.reduceat(np.array(marked, float), stretches) / width).max())
        same = np.append(next_same, False).astype(float)
        worst_repeats = float((np.add.reduceat(same, stretches) / width).max())
    return [math.log1p(size), math.log1p(len(words)), float(lengths.mean()) if len(words) else 0.0,
            (counts[_LOWER] + counts[_UPPER]) / size, counts[_UPPER] / max(1, counts[_LOWER] + counts[_UPPER]),
            counts[_DIGIT] / size, counts[_BLANK] / size, counts[_STOP] / size, counts[_MARK] / size, counts[_HIGH] / size,
            sum(marked) / n, sum(map(str.isupper, words)) / n, sum(map(str.istitle, words)) / n,
            float((lengths > 12).mean()) if len(words) else 0.0, float((lengths <= 2).mean()) if len(words) else 0.0,
            1 - _repeats(keys), float(next_same.mean()) if len(next_same) else 0.0,
            1 - len(np.unique(pairs)) / len(pairs) if len(pairs) else 0.0,
            _repeats([e.tobytes() for e in eights]), top / n, math.log1p(len(lines)),
            math.log1p(len(text) / max(1, len(lines))), _repeats(lines), math.log1p(len(words) / (1 + len(_ENDS.findall(text)))),
            worst_marks, worst_repeats]


def feature_matrix(texts: pa.Array) -> np.ndarray:
    return np.array([features(t.as_py()) for t in texts], np.float64).reshape(len(texts), len(FEATURES))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


# -- trees on bins ---------------------------------------------------------------
def _leaf(g, h):
    return g / (h + RIDGE)


def best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins; gain 0 where none helps."""
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    if not len(gl):
        return 0.0, 0
    ga, ha, na = g.sum(), h.sum(), n.sum()
    gain = gl * _leaf(gl, hl) + (ga - gl) * _leaf(ga - gl, ha - hl) - ga * _leaf(ga, ha)
    gain[(nl < LEAST_ROWS) | (na - nl < LEAST_ROWS)] = 0
    at = int(gain.argmax())
    return float(gain[at]), at + 1


def range_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Values over the bins of a tree with at most ``leaves`` ranges, best cut first."""
    parts = [(0, len(g))]
    cuts = [best_cut(g, h, n)]
    while len(parts) < leaves:
        x = max(range(len(parts)), key=lambda i: cuts[i][0])
        gain, at = cuts[x]
        if gain <= 1e-9:
            break
        a, b = parts[x]
        parts[x:x + 1] = [(a, a + at), (a + at, b)]
        cuts[x:x + 1] = [best_cut(g[i:j], h[i:j], n[i:j]) for i, j in parts[x:x + 2]]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = _leaf(g[a:b].sum(), h[a:b].sum())
    return out


def square_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values over a square of bins of a tree that cuts one side, then each half on the other."""
    best_gain, best = 0.0, np.zeros_like(g)
    for turn in (False, True):
        gg, hh, nn = (x.T if turn else x for x in (g, h, n))
        for cut in range(1, len(gg)):
            out, gain = np.zeros_like(gg), -gg.sum() * _leaf(gg.sum(), hh.sum())
            for half in (slice(0, cut), slice(cut, None)):
                a, b, c = gg[half].sum(axis=0), hh[half].sum(axis=0), nn[half].sum(axis=0)
                _, at = best_cut(a, b, c)
                for side in (slice(0, at), slice(at, None)):
                    gs, hs, ns = a[side].sum(), b[side].sum(), c[side].sum()
                    if ns >= LEAST_ROWS:
                        out[half, side] = _leaf(gs, hs)
                        gain += gs * _leaf(gs, hs)
            if gain > best_gain:
                best_gain, best = gain, out.T if turn else out
    return best_gain, best


@dataclass
class AdditiveModel:
    edges: list[np.ndarray]                 # inner bin edges of each feature
    base: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1: one table entry added for each feature and pair."""
        total = np.full(len(x), self.base)
        for f, t in enumerate(self.tables):
            total += t[np.searchsorted(self.edges[f], x[:, f], side="right")]
        if self.pairs:
            used = {f for i, j, _ in self.pairs for f in (i, j)}
            bins = {f: np.searchsorted(self.pair_edges[f], x[:, f], side="right") for f in used}
            for i, j, t in self.pairs:
                total += t[bins[i], bins[j]]
        return sigmoid(total)


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.arange(1, bins) / bins)) for c in x.T]


def _loss(logit: np.ndarray, y: np.ndarray) -> float:
    return float(np.logaddexp(0, np.where(y > 0, -logit, logit)).mean()) if len(y) else 0.0


def fit_additive(x: np.ndarray, y: np.ndarray, part: np.ndarray) -> AdditiveModel:
    """Learn from rows where ``part`` is true; the others tell when to stop."""
    rate = y.mean() if len(y) else 0.5
    model = AdditiveModel(_edges(x, BINS) if len(x) else [np.zeros(0)] * x.shape[1])
    model.base = float(np.log(np.clip(rate, 1e-6, 1 - 1e-6) / np.clip(1 - rate, 1e-6, 1 - 1e-6)))
    if not len(y) or not 0 < rate < 1:
        return model
    if part.all() or not part.any() or not 0 < y[part].mean() < 1:
        part = np.ones(len(y), bool)
    watch = ~part if not part.all() else part
    logit = np.full(len(y), model.base)
    yt = y[part]

    def boost(bins: list[np.ndarray], sizes: list[int], grow, rounds: int) -> list[np.ndarray]:
        """Cyclic rounds over all tables; those of the best round on the watched rows."""
        nonlocal logit
        inner = [b[part] for b in bins]
        number = [np.bincount(b, minlength=s) for b, s in zip(inner, sizes, strict=True)]
        tables = [np.zeros(s) for s in sizes]
        best, best_tables, best_logit, since = _loss(logit[watch], y[watch]), [t.copy() for t in tables], logit.copy(), 0
        for _ in range(rounds):
            for f, (b, s) in enumerate(zip(inner, sizes, strict=True)):
                p = sigmoid(logit[part])
                g = np.bincount(b, yt - p, s)
                h = np.bincount(b, p * (1 - p), s)
                step = RATE * np.clip(grow(g, h, number[f], f), -4, 4)
                tables[f] += step
                logit += step[bins[f]]
            now = _loss(logit[watch], y[watch])
            if now < best - 1e-6:
                best, best_tables, best_logit, since = now, [t.copy() for t in tables], logit.copy(), 0
            elif (since := since + 1) >= PATIENCE:
                break
        logit = best_logit
        return best_tables

    bins = [np.searchsorted(e, c, side="right") for e, c in zip(model.edges, x.T, strict=True)]
    model.tables = boost(bins, [len(e) + 1 for e in model.edges], lambda g, h, n, _: range_tree(g, h, n), ROUNDS)

    # pairs: the two-way trees with the largest gain on what is left
    model.pair_edges = _edges(x, PAIR_BINS)
    small = [np.searchsorted(e, c, side="right") for e, c in zip(model.pair_edges, x.T, strict=True)]
    width = [len(e) + 1 for e in model.pair_edges]
    p = sigmoid(logit[part])
    g, h = yt - p, p * (1 - p)
    found = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            if width[i] > 1 and width[j] > 1:
                cell, shape = small[i][part] * width[j] + small[j][part], (width[i], width[j])
                square = [np.bincount(cell, v, width[i] * width[j]).reshape(shape) for v in (g, h, None)]
                found.append((square_tree(*square)[0], -i, -j))
    chosen = [(-i, -j) for gain, i, j in sorted(found, reverse=True)[:PAIRS] if gain > 0]
    cells = [small[i] * width[j] + small[j] for i, j in chosen]
    shapes = [(width[i], width[j]) for i, j in chosen]
    tables = boost(cells, [a * b for a, b in shapes],
                   lambda g, h, n, f: square_tree(*(v.reshape(shapes[f]) for v in (g, h, n)))[1].ravel(), PAIR_ROUNDS)
    model.pairs = [(i, j, t.reshape(s)) for (i, j), t, s in zip(chosen, tables, shapes, strict=True)]
    return model


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, label: Column, sample: int = SAMPLE) -> AdditiveModel:
    """Fit a model of ``label`` (a boolean column of ``labels``) from a bounded sample of labelled rows."""
    known = labels.select(F.col(key).alias("key"), label.cast("int").alias("y")).dropna().distinct()
    n = known.count()
    draw = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / (1 << 30)
    drawn = known.where(draw < min(1.0, sample / max(n, 1))).limit(2 * sample)   # a bounded number of rows
    rows = (docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
            .join(F.broadcast(drawn), "key").groupBy("key", "y", F.xxhash64("text").alias("h")).agg(F.min("text").alias("text")))

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array(list(feature_matrix(batch.column(0))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([x, *batch.columns[1:]], names=["x", "y", "draw"])

    got = (rows.select("text", "y", F.pmod(F.xxhash64("key", F.lit(3)), F.lit(1 << 20)).alias("draw"))
           .mapInArrow(numbers, "x array<double>, y int, draw long").limit(4 * sample).toPandas())
    got = got.assign(k=got["x"].map(tuple)).sort_values(["draw", "y", "k"], kind="stable")   # any order of arrival, one model
    x = np.array(got["x"].tolist(), np.float64).reshape(len(got), len(FEATURES))
    return fit_additive(x, got["y"].to_numpy(np.float64), got["draw"].to_numpy() % 6 != 0)


def predict_quality(text: Column | str, model: AdditiveModel) -> Column:
    """Probability (double) that the whole text is of class 1."""

    @F.arrow_udf("double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(model.score(feature_matrix(texts)), pa.float64())

    return predict(F.col(text) if isinstance(text, str) else text)
