"""Byte-level BPE encoding and decoding.

Each match of the split pattern is encoded by itself. A segment tree over its byte positions holds, at the leaf of
every live part, the rank of the pair this part forms with its right neighbour, joined with the position; an inner
node holds the smaller of its two children, so the root is the leftmost pair of minimum rank. A merge changes two
leaves and closes one, each in a logarithmic number of steps, so that a match of n bytes takes O(n log n) however
long it is.

Null and empty texts give no ids. Rows are independent of each other: repeated rows give repeated results, an empty
table an empty result.
"""

import base64
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from credara.llm import common

VOCABULARY = "byte_bpe_50k.tiktoken"
# Encoded matches that a Python worker remembers, and characters it works on at once.
CACHE = 200_000
CHUNK = 1_000_000
# Matches up to this many bytes are encoded side by side, so many at once, longer ones by themselves.
SIDE_BY_SIDE = 32
ROWS = 8_000

_NONE = 1 << 62
_AT = (1 << 32) - 1
_FAR = np.int32(2**31 - 1)


class Encoder:
    """Ranks of byte strings and the split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = Splitter(pattern)
        # every way to put a token together from two others, as sorted keys
        keys, found = array("q"), array("i")
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    found.append(rank)
        order = np.argsort(np.frombuffer(keys, np.int64))
        self._pair_keys = np.append(np.frombuffer(keys, np.int64)[order], _NONE)
        self._pair_ranks = np.append(np.frombuffer(found, np.int32)[order], np.int32(0))
        self._bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self._forget()

    def _forget(self) -> None:
        self._index: dict[str, int] = {}
        self._new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._end = 0
        self._ids = np.empty(0, np.int32)
        self._start = np.empty(0, np.int64)
        self._count = np.empty(0, np.int64)

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        size = 1 << (n - 1).bit_length()
        end = list(range(1, n + 1))   # end of the live part that starts here
        before = list(range(-1, n))   # start of the live part to the left; before[n] closes the row
        leaves = [_NONE] * size
        for i in range(n - 1):
            rank = ranks.get(piece[i:i + 2])
            if rank is not None:
                leaves[i] = rank << 32 | i
        tree = [0] * size + leaves
        for i in range(size - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])

        def put(leaf: int, value: int) -> None:
            i = leaf + size
            tree[i] = value
            while i > 1:
                value = min(value, tree[i ^ 1])
                i >>= 1
                if tree[i] == value:
                    return
                tree[i] = value

        while (root := tree[1]) != _NONE:
            at = root & _AT
            middle = end[at]
            right = end[middle]
            end[at] = right
            before[right] = at
            put(middle, _NONE)
            rank = ranks.get(piece[at:end[right]]) if right < n else None
            put(at, _NONE if rank is None else rank << 32 | at)
            left = before[at]
            if left >= 0:
                rank = ranks.get(piece[left:right])
                put(left, _NONE if rank is None else rank << 32 | left)
        ids, at = [], 0
        while at < n:
            ids.append(ranks[piece[at:end[at]]])
            at = end[at]
        return ids

    def _pairs(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leaf values for neighbours ``left, right`` (tokens, -1: none) at positions ``at``."""
        keys = left.astype(np.int64) << 32 | right
        keys[(left < 0) | (right < 0)] = -1
        found = np.searchsorted(self._pair_keys, keys)
        return np.where(self._pair_keys[found] == keys, self._pair_ranks[found] * SIDE_BY_SIDE + at, _FAR)

    def encode_side_by_side(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many short matches, one after the other, and how many each has: one tree for each row."""
        n = np.array([len(p) for p in pieces])
        size = 1 << (int(n.max()) - 1).bit_length()
        raw = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(-1, size)
        place = np.arange(size, dtype=np.int32)
        # one spare column at either end stands for the edge
        token = np.full((len(pieces), size + 2), -1, np.int32)
        token[:, 1:-1] = np.where(place < n[:, None], self._bytes[raw], -1)
        after = np.tile(np.arange(1, size + 3, dtype=np.int16), (len(pieces), 1))
        before = after - 2
        tree = np.full((len(pieces), 2 * size), _FAR, np.int32)
        tree[:, size:] = self._pairs(token[:, 1:-1], token[:, 2:], place)
        for i in range(size - 1, 0, -1):
            np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1], out=tree[:, i])

        def put(rows: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
            i = leaf + size
            tree[rows, i] = value
            for _ in range(size.bit_length() - 1):
                value = np.minimum(value, tree[rows, i ^ 1])
                i = i >> 1
                tree[rows, i] = value

        rows = np.flatnonzero(tree[:, 1] != _FAR)
        while len(rows):
            root = tree[rows, 1]
            at = root % SIDE_BY_SIDE + 1
            middle = after[rows, at]
            right = after[rows, middle]
            token[rows, at] = root // SIDE_BY_SIDE
            token[rows, middle] = -1
            after[rows, at] = right
            before[rows, right] = at
            left = before[rows, at]
            put(rows, middle - 1, np.full(len(rows), _FAR, np.int32))
            put(rows, at - 1, self._pairs(token[rows, at], token[rows, right], at - 1))
            some = left > 0
            r, k = rows[some], left[some]
            put(r, k - 1, self._pairs(token[r, k], token[r, at[some]], k - 1))
            rows = rows[tree[rows, 1] != _FAR]
        live = token >= 0
        return token[live], live.sum(axis=1)

    def _learn(self, pieces: list[str]) -> None:
        """Encode matches that are not remembered."""
        short: dict[int, list[str]] = {}
        for piece in pieces:
            raw = piece.encode()
            if (whole := self.ranks.get(raw)) is not None:
                self._remember([piece], np.array([whole], np.int32), np.array([1]))
            elif len(raw) <= SIDE_BY_SIDE:
                short.setdefault((len(raw) - 1).bit_length(), []).append(piece)
            else:
                ids = np.array(self.encode_piece(raw), np.int32)
                self._remember([piece], ids, np.array([len(ids)]))
        for group in short.values():
            for i in range(0, len(group), ROWS):
                some = group[i:i + ROWS]
                self._remember(some, *self.encode_side_by_side([p.encode() for p in some]))
        self._ids, self._start, self._count = (np.concatenate(x) for x in zip(
            (self._ids, self._start, self._count), *self._new))
        self._new = []

    def _remember(self, pieces: list[str], ids: np.ndarray, count: np.ndarray) -> None:
        known = len(self._index)
        self._index.update(zip(pieces, range(known, known + len(pieces))))
        self._new.append((ids, self._end + np.cumsum(count) - count, count))
        self._end += len(ids)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, whole."""
        split = [self.split.findall(t) for t in texts]
        pieces = [p for s in split for p in s]
        if not pieces:
            return [np.empty(0, np.int32) for _ in texts]
        at = list(map(self._index.get, pieces))
        if None in at:
            if len(self._index) > CACHE:
                self._forget()
            self._learn([p for p in dict.fromkeys(pieces) if p not in self._index])
            at = list(map(self._index.get, pieces))
        at = np.array(at)
        count = self._count[at]
        ends = np.cumsum(count)
        ids = self._ids[np.repeat(self._start[at] - ends + count, count) + np.arange(ends[-1])]
        last = np.cumsum([len(s) for s in split])
        return np.split(ids, np.concatenate([[0], ends])[last][:-1])

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()

    def encode_chunks(self, texts: list[str]):
        """As ``encode_all``, some texts at a time."""
        chunk, length = [], 0
        for text in texts:
            chunk.append(text)
            length += len(text)
            if length >= CHUNK:
                yield from self.encode_all(chunk)
                chunk, length = [], 0
        yield from self.encode_all(chunk)


class Splitter:
    """``findall`` of a pattern; the known pattern runs in the standard library's engine, which is much faster, on
    texts without the characters that its classes take differently."""

    # white space, numbers and late scripts whose classes differ between the engines
    UNLIKE = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe\u0558-\U0010ffff]")
    LIKE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")

    def __init__(self, pattern: str):
        self.exact = regex.compile(pattern)
        self.known = pattern == public_tokenizers.PATTERN

    def findall(self, text: str) -> list[str]:
        fast = self.known and not self.UNLIKE.search(text)
        return (self.LIKE if fast else self.exact).findall(text)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for each Python worker and vocabulary."""
    return Encoder(read_ranks(path), pattern)


@lru_cache(maxsize=2)
def tokens(path: str) -> dict[int, bytes]:
    """The bytes each id stands for."""
    return {rank: token for token, rank in read_ranks(path).items()}


def decode_ids(ids, path: str) -> bytes:
    return b"".join(map(tokens(path).__getitem__, ids))


def encode(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
           keep: bool = False) -> DataFrame:
    """``doc_id, ids array<int>`` for each row, with ``keep`` also ``row``, a struct of all its columns; the vocabulary at
    ``path`` must exist on every node."""
    path = path or public_tokenizers.path(VOCABULARY)
    source, kept = common.texts(docs), []
    common.bound_batches(docs.sparkSession, common.ROW_BATCH_BYTES)
    if keep:
        # the text goes to Python once
        others = [c for c in docs.columns if c != "text"]
        source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct(*others).alias("others"))
        kept = ["text", "others"]

    def run(batches):
        coder = encoder(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _lists(list(coder.encode_chunks(texts))), *map(batch.column, kept)],
                ["doc_id", "ids", *kept])

    fields = [source.schema["doc_id"], T.StructField("ids", T.ArrayType(T.IntegerType())), *[source.schema[c] for c in kept]]
    coded = common.map_batches(source, run, T.StructType(fields))
    if keep:
        row = [F.col("text") if c == "text" else F.col("others")[c].alias(c) for c in docs.columns]
        coded = coded.select("doc_id", "ids", F.struct(*row).alias("row"))
    return coded


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """Adds ``decoded binary``, the bytes that ``ids`` stand for."""
    path = path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        for batch in batches:
            ids = batch.column("ids")
            decoded = pa.array([decode_ids(row.values.to_numpy().tolist() if row.is_valid else (), path)
                                for row in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*batch.schema.names, "decoded"])

    return common.map_batches(
        encoded, run, T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())]))


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))
