"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts are cut at safe boundaries (:mod:`incidex.llm.pieces`), so a text of any
length becomes short pieces.  Pieces not met before are encoded in batches
balanced by bytes; the lengths of the pieces add up to the text's length.  No
token ids leave the tokenizer.  A worker remembers the lengths of a bounded
number of short pieces.

Null texts count as empty: 0 tokens.  Special strings inside a text are
handled as the library does by default.  Ties, repeated rows and other columns
play no part: this is a column expression on one text column, one value a row.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from incidex.llm.memory import held
from incidex.llm.pieces import Slots, by_bytes, safe_pieces, texts_by_size

BATCH_BYTES = 1 << 18
REMEMBERED = 600_000
REMEMBERED_CHARS = 16 * REMEMBERED


class PieceCounter:
    """Lengths of pieces under one tokenizer file."""

    def __init__(self, path: str, batch_bytes: int = BATCH_BYTES, remembered: int = REMEMBERED):
        self.batch_bytes, self.remembered = batch_bytes, remembered
        if path.endswith(".model"):
            import sentencepiece
            m = sentencepiece.SentencePieceProcessor(model_file=path)
            self.cut = lambda text: [text]  # its normaliser looks across blanks
            self.lengths = lambda batch: [len(x) for x in m.encode(batch, num_threads=1)]
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            import tokenizers
            t = tokenizers.Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            self.cut = safe_pieces
            self.lengths = lambda batch: [len(x) for x in t.encode_batch_fast(batch, add_special_tokens=False)]
        self._forget()

    def _forget(self):
        self.slots, self.known, self.chars = Slots(), np.zeros(0, np.int64), 0

    @property
    def nbytes(self) -> int:
        return 160 * len(self.slots) + 2 * self.chars + self.known.nbytes

    def count(self, texts: list[str | None]) -> np.ndarray:
        if len(self.slots) > self.remembered or self.chars > REMEMBERED_CHARS:
            self._forget()
        cut = [self.cut(t) if t else [] for t in texts]
        sizes = np.array([len(c) for c in cut], np.int64)
        slots = np.fromiter(map(self.slots.__getitem__, chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        if new := self.slots.new:
            fresh = [n for batch in by_bytes(new, self.batch_bytes) for n in self.lengths(batch)]
            self.known = np.concatenate([self.known, np.array(fresh, np.int64)])
            self.chars += sum(map(len, new))
            self.slots.new = []
        ends = np.concatenate([[0], np.cumsum(self.known[slots])])
        at = np.concatenate([[0], np.cumsum(sizes)])
        return np.diff(ends[at])


def token_count(text: Column | str, tokenizer: str) -> Column:
    """Number of tokens of the whole text under the tokenizer file ``tokenizer``
    (``.json``: tokenizers, ``.model``: sentencepiece), without added tokens."""

    @F.arrow_udf("long")
    def lengths(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = held("token_counts", tokenizer, lambda: PieceCounter(tokenizer))
        for texts in batches:
            out = [counter.count(part) for part in texts_by_size(texts, 4 * BATCH_BYTES)]
            yield pa.array(np.concatenate(out) if out else [], pa.int64())

    return lengths(F.col(text) if isinstance(text, str) else text)
