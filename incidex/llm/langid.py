"""Language identification by the nearest centroid.

A text becomes a normalised TF-IDF vector of hashed letter 3-grams (bytes of
the lower-cased text, everything but letters as blanks).  Inverse document
frequencies come from all training rows.  Each language gets several centroids
by spherical k-means on a bounded sample of its rows (``SAMPLE_PER_LANGUAGE``).
A text gets the language of the centroid with the largest cosine.  Rejection
is by distance: a text whose nearest centroid is farther than a share of the
farthest training text of that centroid's language is rejected, and so is a
text without letters (``und``).

Null, empty and letterless texts give ``und`` with score 0; ties go to the
first language in sorted order; without training rows every text is ``und``.
Whole texts count, whatever their length.  Prediction is a column expression
on the text alone, so other columns, repeated rows and empty tables play no
part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidex.llm.memory import release_others

BITS = 14
SAMPLE_PER_LANGUAGE = 800
CLUSTERS = 3
REJECT_SHARE = 0.3
UNKNOWN = "und"
CHUNK_CHARS = 1 << 20
_LETTER = regex.compile(r"\p{L}")
_NO_LETTERS = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashed 3-grams of the whole text and how often each occurs."""
    total = None
    for at in range(0, max(len(text), 1), CHUNK_CHARS):
        part = text[at:at + CHUNK_CHARS].lower().encode("utf-8", "replace")
        b = np.frombuffer(b" " + part.translate(_NO_LETTERS) + b" ", np.uint8).astype(np.uint32)
        code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        code = code[code != 0x202020]
        n = np.bincount((code * np.uint32(2654435761)) >> np.uint32(32 - BITS), minlength=1 << BITS)
        total = n if total is None else total + n
    at = np.flatnonzero(total)
    return at, total[at]


def unit_vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, n = ngram_counts(text)
    v = (1 + np.log(n)) * idf[at]
    return at, v / max(np.sqrt((v * v).sum()), 1e-12)


@dataclass
class LanguageModel:
    languages: list[str]      # of each centroid, sorted
    centroids: np.ndarray     # one row each, unit length
    nearest_allowed: np.ndarray   # smallest cosine that is not rejected
    idf: np.ndarray

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, cosine (0 to 1) and whether the text is rejected."""
        if not text or not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0, True
        at, v = unit_vector(text, self.idf)
        near = self.centroids[:, at] @ v
        x = int(near.argmax())
        score = float(min(max(near[x], 0.0), 1.0))
        return self.languages[x], score, bool(score < self.nearest_allowed[x])


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids and each row's cosine to its own; farthest-first start."""
    first = x.sum(axis=0)
    chosen = [int((x @ first).argmax())]
    for _ in range(1, min(k, len(x))):
        chosen.append(int((x @ x[chosen].T).max(axis=1).argmin()))
    c = x[chosen].copy()
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        new = np.stack([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.allclose(new, c):
            break
        c = new
    return c, (x @ c.T).max(axis=1)


def fit(docs: DataFrame, text: str, language: str, sample: int = SAMPLE_PER_LANGUAGE,
        clusters: int = CLUSTERS) -> LanguageModel:
    """Learn from all rows of ``docs`` with a language and a text with letters."""
    known = (docs.select(F.col(text).cast("string").alias("text"), F.col(language).cast("string").alias("language"))
             .where("language is not null and text is not null"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_others("langid")
        found, rows = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for t in batch.column(0):
                found[ngram_counts(t.as_py())[0]] += 1
                rows += 1
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"gram": np.append(at, -1), "n": np.append(found[at], rows)})

    counts = known.select("text").mapInArrow(frequencies, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(1 << BITS)
    rows = 0
    for gram, n in counts:  # at most 2 ** BITS + 1 rows
        if gram < 0:
            rows = n
        else:
            found[gram] = n
    idf = np.log((1 + rows) / (1 + found)) + 1

    sizes = known.groupBy("language").agg(F.count("*").alias("n"))
    share = F.least(F.lit(1.0), F.lit(sample) / F.col("n"))
    drawn = (known.withColumn("draw", F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / (1 << 30))
             .join(F.broadcast(sizes), "language").where(F.col("draw") < share)   # one row a language
             .select("language", "text"))

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, at, values = [], [], []
            for name, t in zip(batch.column(0), batch.column(1), strict=True):
                t = t.as_py()
                if _LETTER.search(t):
                    x, v = unit_vector(t, idf)
                    lang.append(name.as_py())
                    at.append(x.astype(np.int32))
                    values.append(v.astype(np.float32))
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(at, pa.list_(pa.int32())),
                                              pa.array(values, pa.list_(pa.float32()))], names=["language", "at", "v"])

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.iloc[:2 * sample]   # draws are by hash: equal texts may be drawn together
        x = np.zeros((len(rows), 1 << BITS), np.float32)
        for i, (at, v) in enumerate(zip(rows["at"], rows["v"], strict=True)):
            x[i, at] = v
        c, own = spherical_kmeans(x, clusters)
        return pd.DataFrame({"language": rows["language"].iloc[0], "cluster": range(len(c)),
                             "centroid": [row.tolist() for row in c], "farthest": float(own.min())})

    # copies of one text are one training vector
    found = (drawn.dropDuplicates(["language", "text"]).mapInArrow(vectors, "language string, at array<int>, v array<float>")
             .groupBy("language").applyInPandas(cluster, "language string, cluster int, centroid array<float>, farthest double")
             .collect())  # a few rows a language
    found = sorted(found, key=lambda r: (r["language"], r["cluster"]))
    c = np.array([r["centroid"] for r in found], np.float32).reshape(len(found), 1 << BITS)
    return LanguageModel([r["language"] for r in found], c,
                         np.array([REJECT_SHARE * r["farthest"] for r in found]), idf)


def predict_language(text: Column | str, model: LanguageModel) -> Column:
    """``struct<lang: string, score: double, rejected: boolean>`` of the whole text."""

    @F.arrow_udf("struct<lang: string, score: double, rejected: boolean>")
    def predict(texts: pa.Array) -> pa.Array:
        release_others("langid")
        out = [model.predict(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64()),
                                           pa.array([x[2] for x in out], pa.bool_())], names=["lang", "score", "rejected"])

    return predict(F.col(text) if isinstance(text, str) else text)
