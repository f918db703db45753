"""Byte-level BPE encoding and decoding with a segment tree over pair ranks.

Every word of the pre-tokenizer starts as its bytes.  A segment tree holds,
for each adjacent pair, ``rank * width + position`` (infinity where the pair
cannot merge).  The root is the leftmost pair of the lowest rank: it is merged
and the pair itself, its left and its right neighbour are updated in
logarithmic time, until the root is infinite.

Short words of a batch run through equal-sized trees in step, one array row a
word; a long word has a tree of its own.  Distinct words are encoded once per
batch and a bounded number is remembered by the worker.

Null texts count as empty and give an empty id array; decoding a null array
gives an empty text.  Both directions are column expressions on one column, so
ties, repeated rows, empty tables and other columns play no part.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from incidex.llm.memory import held
from incidex.llm.pieces import PieceStore, Slots, gather, safe_pieces, texts_by_size

# fixed value: how the byte-level pre-tokenizer cuts words
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
REMEMBERED_BYTES = 64 << 20    # of a worker
SHORT = 64
CHUNK_CHARS = 1 << 19
INF = np.iinfo(np.int64).max


def printable_bytes() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    out, spare = {}, 0x100
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return out


class SegmentTreeBpe:
    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec["added_tokens"]
        if spec["normalizer"] or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or model.get("ignore_merges"):
            raise ValueError(f"not a plain byte-level BPE file: {path}")
        if any(a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added tokens with matching options are not handled: {path}")
        vocab: dict[str, int] = model["vocab"]
        shown = printable_bytes()
        self.special = {a["content"]: a["id"] for a in added}
        self.cut_special = regex.compile("|".join(regex.escape(x) for x in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.words = regex.compile(WORD_PATTERN)
        self.first = np.array([vocab[shown[b]] for b in range(256)], np.int64)
        self.n = 1 + max([*vocab.values(), *self.special.values()])
        # merges: sorted keys left * n + right -> rank, merged id
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[x] * self.n + vocab[y] for x, y in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = np.append(keys[order], INF)
        self.ranks = np.append(order, 0).astype(np.int64)
        merged = np.array([vocab[x + y] for x, y in pairs], np.int64)
        self.merged_by_rank = merged
        self.pair = {int(k): i for i, k in enumerate(keys)}
        self.store = PieceStore(safe_pieces, self.encode_pieces, REMEMBERED_BYTES)

    @property
    def nbytes(self) -> int:
        tables = (self.first, self.keys, self.ranks, self.merged_by_rank)
        return self.store.nbytes + sum(t.nbytes for t in tables) + 120 * len(self.pair)

    # -- merging ---------------------------------------------------------
    def _pair_values(self, left, right, width: int, pos):
        """``rank * width + pos`` of the pairs, infinity where there is no merge."""
        key = left * self.n + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at] * width + pos, INF)

    def merge_in_step(self, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each short word, and all ids: equal trees, one array row a
        word, point updates in step."""
        n, size = len(rows), np.array([len(r) for r in rows])
        width = 1 << max(1, int(size.max() - 1).bit_length())  # one leaf a symbol: the pair it begins
        flat = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(n, width)
        ids = self.first[flat]
        pos = np.arange(width)
        nxt = np.broadcast_to(pos + 1, (n, width)).copy()
        prv = np.broadcast_to(pos - 1, (n, width)).copy()
        alive = pos < size[:, None]
        tree = np.full((n, 2 * width), INF, np.int64)
        has = pos[:-1] + 1 < size[:, None]
        tree[:, width:2 * width - 1] = np.where(has, self._pair_values(ids[:, :-1], ids[:, 1:], width, pos[:-1]), INF)
        level = width
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level = half
        active = np.flatnonzero(tree[:, 1] != INF)
        while len(active):
            root = tree[active, 1]
            i, rank = root % width, root // width
            j = nxt[active, i]
            k = nxt[active, j]
            ids[active, i] = self.merged_by_rank[rank]
            alive[active, j] = False
            nxt[active, i] = k
            inside = k < size[active]
            prv[active[inside], k[inside]] = i[inside]
            # the pair that begins at i, the one that began at j, the one that ends at i
            value = np.full(len(active), INF, np.int64)
            if inside.any():
                r = active[inside]
                value[inside] = self._pair_values(ids[r, i[inside]], ids[r, k[inside]], width, i[inside])
            self._update(tree, active, i, value, width)
            self._update(tree, active, j, INF, width)
            h = prv[active, i]
            some = h >= 0
            if some.any():
                r, hh = active[some], h[some]
                self._update(tree, r, hh, self._pair_values(ids[r, hh], ids[r, i[some]], width, hh), width)
            active = active[tree[active, 1] != INF]
        return alive.sum(axis=1), ids[alive]

    @staticmethod
    def _update(tree, rows, leaf, value, width):
        node = leaf + width
        tree[rows, node] = value
        while width > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            width >>= 1

    def merge_alone(self, word: bytes) -> np.ndarray:
        """Ids of one long word by a tree of its own."""
        ids = self.first[np.frombuffer(word, np.uint8)].tolist()
        n, pair, count = len(ids), self.pair, self.n
        width = 1 << max(1, (n - 1).bit_length())
        inf = 1 << 62
        tree = [inf] * (2 * width)
        for i in range(n - 1):
            r = pair.get(ids[i] * count + ids[i + 1])
            if r is not None:
                tree[width + i] = r * width + i
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(leaf, value):
            node = leaf + width
            tree[node] = value
            while node > 1:
                node >>= 1
                a, b = tree[2 * node], tree[2 * node + 1]
                tree[node] = a if a < b else b

        def value(i, j):
            r = pair.get(ids[i] * count + ids[j])
            return inf if r is None else r * width + i

        while tree[1] != inf:
            rank, i = divmod(tree[1], width)
            j = nxt[i]
            k = nxt[j]
            ids[i], ids[j], nxt[i] = int(self.merged_by_rank[rank]), -1, k
            put(j, inf)
            if k < n:
                prv[k] = i
                put(i, value(i, k))
            else:
                put(i, inf)
            if prv[i] >= 0:
                put(prv[i], value(prv[i], i))
        return np.array([x for x in ids if x >= 0], np.int64)

    def merge_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each word's ids begin, their number, and all ids."""
        begin, number = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        parts, total = [], 0
        size = np.array([len(w) for w in words], np.int64)
        for x in np.flatnonzero(size > SHORT):
            ids = self.merge_alone(words[x])
            begin[x], number[x], total = total, len(ids), total + len(ids)
            parts.append(ids)
        low = 0
        for high in (2, 4, 6, 8, 12, 16, 24, 32, SHORT):
            rows = np.flatnonzero((size > low) & (size <= high))
            low = high
            for at in range(0, len(rows), 4_000):
                some = rows[at:at + 4_000]
                n, ids = self.merge_in_step([words[x] for x in some])
                number[some] = n
                begin[some] = total + np.cumsum(n) - n
                total += len(ids)
                parts.append(ids)
        return begin, number, np.concatenate(parts) if parts else np.zeros(0, np.int64)

    # -- texts -----------------------------------------------------------
    def _pretokens(self, piece: str) -> list[str]:
        if not any(x in piece for x in self.special):
            return self.words.findall(piece)
        out, at = [], 0
        for m in self.cut_special.finditer(piece):
            out += self.words.findall(piece[at:m.start()])
            out.append(m.group())
            at = m.end()
        return out + self.words.findall(piece[at:])

    def encode_pieces(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces, and where each piece's ids end (from 0)."""
        cut = [self._pretokens(p) for p in new]
        words = Slots()
        index = np.fromiter(map(words.__getitem__, chain.from_iterable(cut)), np.int64)
        plain = [w.encode() if w not in self.special else b"" for w in words.new]
        begin, number, ids = self.merge_words(plain)
        for s in self.special:
            if s in words:
                begin[words[s]], number[words[s]] = len(ids), 1
                ids = np.append(ids, self.special[s])
        flat, ends = gather(ids, begin[index], number[index])
        return flat, ends[np.concatenate([[0], np.cumsum([len(c) for c in cut])])]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of the texts, one after the other."""
        return self.store.encode(texts)


class ByteVocabulary:
    """What each id of a byte-level vocabulary stands for."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        back = {c: b for b, c in printable_bytes().items()}
        special = {a["id"]: a["content"].encode() for a in spec["added_tokens"]}
        tokens = {i: bytes(back[c] for c in t) for t, i in spec["model"]["vocab"].items() if i not in special} | special
        self.nbytes = 16 * len(tokens)
        self.by_id = pa.array([tokens.get(i, b"") for i in range(1 + max(tokens))], pa.large_binary())

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> list[str]:
        """Texts of the id lists ``ids[offsets[x]:offsets[x + 1]]``; bytes that are no
        UTF-8 become U+FFFD."""
        joined = self.by_id.take(pa.array(ids))
        ends = np.frombuffer(joined.buffers()[1], np.int64, len(ids) + 1)
        data = joined.buffers()[2]
        data = data.to_pybytes() if data is not None else b""
        at = ends[offsets]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:], strict=True)]


def load(path: str, kind: type = SegmentTreeBpe):
    """The worker's own encoder or vocabulary of a file, read once."""
    return held("bpe", (path, kind), lambda: kind(path))


def _encoded(model: SegmentTreeBpe, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Offsets and ids of consecutive texts, about ``CHUNK_CHARS`` characters a time."""
    for some in texts_by_size(texts, CHUNK_CHARS):
        yield model.encode(some)


def _joined(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.ListArray:
    sizes = np.concatenate([np.zeros(1, np.int64), *(np.diff(at) for at, _ in parts)])
    flat = np.concatenate([np.zeros(0, np.int32), *(ids for _, ids in parts)])
    return pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(flat, pa.int32()))


def bpe_encode(text: Column | str, tokenizer: str) -> Column:
    """Token ids (``array<int>``) of the whole text under the byte-level BPE file."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield _joined(list(_encoded(load(tokenizer), texts)))

    return encode(F.col(text) if isinstance(text, str) else text)


def bpe_round_trip(text: Column | str, tokenizer: str) -> Column:
    """``struct<ids: array<int>, text: string>``: the ids of the whole text, and the text
    that they stand for.  One worker holds both tables, ids cross to it once."""

    @F.arrow_udf("struct<ids: array<int>, text: string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts, back = [], []
            for at, ids in _encoded(load(tokenizer), texts):
                parts.append((at, ids))
                back.append(pa.array(load(tokenizer, ByteVocabulary).decode(at, ids), pa.string()))
            back = pa.concat_arrays(back) if back else pa.array([], pa.string())
            yield pa.StructArray.from_arrays([_joined(parts), back], names=["ids", "text"])

    return both(F.col(text) if isinstance(text, str) else text)


def bpe_decode(ids: Column | str, tokenizer: str) -> Column:
    """The text that the ids stand for, special tokens included."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            vocabulary = load(tokenizer, ByteVocabulary)
            lengths = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            yield pa.array(vocabulary.decode(np.concatenate([[0], np.cumsum(lengths)]), flat), pa.string())

    return decode(F.col(ids) if isinstance(ids, str) else ids)
