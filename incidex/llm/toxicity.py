"""Toxicity by a classifier chain.

The categories are predicted one after the other by logistic models on the
presence of word features (words, their beginnings, runs of signs).  Each
model also sees the probabilities of the categories before it.  Those come
from out-of-fold predictions in training, so a later model learns how far an
earlier one can be trusted on texts it has not seen.

Training uses a bounded sample of labelled rows (``SAMPLE_PER_CLASS`` for each
combination of labels, weighted back to all labelled rows).  Features are
chosen per category by chi-square over that sample; the sample's ids are the
only thing broadcast.  Prediction reads whole texts.

Null and empty texts have no features and get the base rates.  Rows with a null
key or label do not train; a category without both classes gets its base rate
(0 without rows).  Repeated rows of an id train once for each combination of
labels, with the first of its texts in order.
Prediction is a column expression on the text alone, so other columns and
empty tables play no part.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidex.llm.common import write_shared
from incidex.llm.memory import release_others

SAMPLE_PER_CLASS = 6_000
FEATURES = 256
BITS = 20
FOLDS = 3
REMEMBERED = 400_000
RIDGE = 0.5
_TOKENS = re.compile(r"\w+|[^\w\s]{2,}")


def token_features(token: str) -> tuple[int, ...]:
    """Hashed features of a token: itself and its beginnings of 4 to 6 characters."""
    names = {"=" + token[:64], *("^" + token[:n] for n in (4, 5, 6) if len(token) >= n)}
    return tuple({zlib.crc32(x.encode("utf-8", "replace")) >> (32 - BITS) for x in names})


class Features(dict):
    """Features of each token, restricted to the wanted ones; remembered by the worker."""

    def __init__(self, wanted: dict[int, int] | None = None):
        super().__init__()
        self.wanted = wanted

    def __missing__(self, token: str) -> tuple[int, ...]:
        f = token_features(token)
        self[token] = f = f if self.wanted is None else tuple(self.wanted[x] for x in f if x in self.wanted)
        return f

    def of(self, text: str | None) -> list[int]:
        if len(self) > REMEMBERED:
            self.clear()
        tokens = set(_TOKENS.findall((text or "").lower()))
        return sorted({f for fs in map(self.__getitem__, tokens) if fs for f in fs})


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    b = np.zeros(x.shape[1])
    rate = np.clip((w * y).sum() / max(w.sum(), 1e-12), 1e-6, 1 - 1e-6)
    b[-1] = np.log(rate / (1 - rate))
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    if y.min(initial=1) == y.max(initial=0):
        return b
    for _ in range(rounds):
        p = sigmoid(x @ b)
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (w * (y - p)) - ridge * b)
        b += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-4:
            break
    return b


@dataclass
class Chain:
    names: list[str]
    wanted: dict[int, int]            # hashed feature -> column
    weights: list[np.ndarray] = field(default_factory=list)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the categories, one column each."""
        earlier = np.zeros((len(x), 0))
        for b in self.weights:
            p = sigmoid(np.hstack([x, earlier]) @ b[:-1] + b[-1])
            earlier = np.hstack([earlier, p[:, None]])
        return earlier


def fit_chain(x: np.ndarray, labels: np.ndarray, w: np.ndarray, fold: np.ndarray,
              names: list[str], wanted: dict[int, int]) -> Chain:
    """Models in order; later ones see out-of-fold probabilities of earlier ones."""
    chain, earlier = Chain(names, wanted), np.zeros((len(x), 0))
    for c in range(labels.shape[1]):
        seen, y = np.hstack([x, earlier]), labels[:, c]
        out = np.zeros(len(x))
        for f in range(FOLDS):
            b = fit_logistic(seen[fold != f], y[fold != f], w[fold != f])
            out[fold == f] = sigmoid(seen[fold == f] @ b[:-1] + b[-1])
        chain.weights.append(fit_logistic(seen, y, w))
        earlier = np.hstack([earlier, out[:, None]])
    return chain


def fit(docs: DataFrame, labels: DataFrame, key: str, text: str, categories: dict[str, Column],
        sample: int = SAMPLE_PER_CLASS) -> Chain:
    """Fit a chain for ``categories`` (name -> boolean column of ``labels``, in chain order)."""
    names = list(categories)
    flags = [c.cast("int").alias(f"y{i}") for i, c in enumerate(categories.values())]
    known = labels.select(F.col(key).alias("key"), *flags).dropna()
    ys = [f"y{i}" for i in range(len(names))]
    sizes = {tuple(r[y] for y in ys): r["n"] for r in known.groupBy(*ys).agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / (1 << 30)
    weight = F.lit(1.0)
    for values, n in sizes.items():   # at most 2 ** categories
        here = F.lit(True)
        for y, v in zip(ys, values, strict=True):
            here &= F.col(y) == v
        weight = F.when(here, max(1.0, n / sample)).otherwise(weight)
    # a bounded number of rows: broadcast so that texts are not shuffled
    drawn = known.withColumn("weight", weight).where(draw * F.col("weight") < 1).limit(2 * sample * max(1, len(sizes)))
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).join(F.broadcast(drawn), "key")
    rows = rows.groupBy("key", "weight", *ys).agg(F.min("text").alias("text"))   # one row an id keeps the sample bounded
    rows = write_shared(rows.select("text", F.pmod(F.xxhash64("key", F.lit(7)), F.lit(FOLDS)).cast("int").alias("fold"), "weight", *ys),
                        "toxicity-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_others("toxicity")
        every = Features()
        n = np.zeros((1 + len(ys), 1 << BITS), np.int64)
        total = np.zeros(1 + len(ys), np.int64)
        for batch in batches:
            own = [batch.column(3 + i).to_pylist() for i in range(len(ys))]
            for x, t in enumerate(batch.column(0)):
                f = every.of(t.as_py())
                for i, y in enumerate([1, *(o[x] for o in own)]):
                    if y:
                        n[i, f] += 1
                        total[i] += 1
        at = np.flatnonzero(n[0])
        yield pa.RecordBatch.from_pydict({"feature": np.append(at, -1)} | {f"n{i}": np.append(n[i, at], total[i]) for i in range(len(n))})

    fields = ", ".join(f"n{i} long" for i in range(1 + len(ys)))
    counted = write_shared(rows.mapInArrow(count, f"feature long, {fields}").groupBy("feature")
                           .agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(1 + len(ys))]), "toxicity-features")
    total = counted.where("feature < 0").first()
    chosen: dict[int, int] = {}
    if total:
        for i in range(1, 1 + len(ys)):
            rate = total[f"n{i}"] / max(1, total["n0"])
            if 0 < rate < 1:
                off = F.col(f"n{i}") - F.col("n0") * rate
                best = (counted.where("feature >= 0 and n0 >= 5").withColumn("chi", off * off / F.col("n0"))
                        .orderBy(F.desc("chi"), "feature").limit(FEATURES).select("feature").collect())
                for r in best:
                    chosen.setdefault(r["feature"], len(chosen))

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_others("toxicity")
        some = Features(chosen)
        for batch in batches:
            f = pa.array([some.of(t.as_py()) for t in batch.column(0)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([f, *batch.columns[1:]], names=["f", *batch.schema.names[1:]])

    got = rows.mapInArrow(present, "f array<int>, fold int, weight double, " + ", ".join(f"{y} int" for y in ys)).toPandas()
    got = got.sort_values(["fold", "weight", *ys], kind="stable")
    x = np.zeros((len(got), len(chosen)))
    for i, f in enumerate(got["f"]):
        x[i, f] = 1
    return fit_chain(x, got[ys].to_numpy(float).reshape(len(got), len(ys)), got["weight"].to_numpy(float),
                     got["fold"].to_numpy(), names, chosen)


def predict_toxicity(text: Column | str, chain: Chain) -> Column:
    """``struct`` with a probability for every category of the whole text."""
    fields = ", ".join(f"`{n}`: double" for n in chain.names)

    @F.arrow_udf(f"struct<{fields}>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release_others("toxicity")
        some = Features(chain.wanted)
        for texts in batches:
            x = np.zeros((len(texts), len(chain.wanted)), np.float32)
            for i, t in enumerate(texts):
                x[i, some.of(t.as_py())] = 1
            p = chain.predict(x)
            yield pa.StructArray.from_arrays([pa.array(p[:, c], pa.float64()) for c in range(len(chain.names))],
                                             names=chain.names)

    return predict(F.col(text) if isinstance(text, str) else text)
