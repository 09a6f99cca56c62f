"""Token counts at every prefix of a text, for BPE pieces with scores and byte fallback.

Among all ways to cut a prefix into pieces, the one the merges produce is the only one in which every two neighbours
stay apart when they are merged alone. So the last piece of a prefix follows from the last pieces of shorter ones:
the piece that ends there, keeps its own shape under the merges, and stays apart from the last piece before it. The
count of a prefix is that of the prefix before its last piece plus one (plus the bytes of a character outside the
vocabulary). No piece has a word mark after another character, so the text falls into parts at the word marks, each
with its own small table; a text's table is the running sum of its parts.

Null and empty texts have no tokens. Rows are independent of each other.
"""

import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from credara.llm import common

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
# Remembered by a Python worker: parts of texts (two generations of about this many) and tested pairs of pieces.
CACHE = 300_000
# Characters worked on at once, and the longest parts that are counted side by side.
CHUNK = 2_000_000
SIDE_BY_SIDE = 32

_MARK = "▁"
_NEVER = float("-inf")
_LAST = 1 << 62
_PARTS = re.compile(f"{_MARK}+[^{_MARK}]*|[^{_MARK}]+")


class PrefixCounts:
    """Prefix tables for one vocabulary: ``scores`` of ordinary pieces; a higher score merges first."""

    def __init__(self, scores: dict[str, float]):
        if any(_MARK in piece.lstrip(_MARK) for piece in scores):
            raise ValueError("a piece holds a word mark after another character")
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.whole = {piece for piece in scores if self.merge(piece) == [piece]}
        self._totals: dict[str, int] = {}
        self._older: dict[str, int] = {}
        # pieces that the merges give back whole, numbered; the number of any other character lies above
        self._names = sorted(self.whole | {c for piece in scores for c in piece if c in scores})
        self._numbers = {name: i for i, name in enumerate(self._names)}
        self._tested = np.array([_LAST], np.int64)
        self._apart = np.array([False])
        self._tested_here: dict[tuple[str, str], bool] = {}
        self._grow_trie()

    def _grow_trie(self) -> None:
        nodes, ends = {(0, ""): 0}, [-1]
        for name, number in self._numbers.items():
            node = 0
            for c in name:
                node = nodes.setdefault((node, c), len(nodes))
                if node == len(ends):
                    ends.append(-1)
            ends[node] = number
        del nodes[0, ""]
        keys = np.array([node << 21 | ord(c) for node, c in nodes], np.int64)
        order = np.argsort(keys)
        self._edges = np.append(keys[order], _LAST)
        self._to = np.append(np.fromiter(nodes.values(), np.int64, len(nodes))[order], 0)
        self._piece_at = np.array(ends, np.int64)

    def merge(self, text: str) -> list[str]:
        """The merges themselves, best score first and leftmost among equals: for a piece or a pair of pieces."""
        parts, scores = list(text), self.scores
        found = [scores.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
        while found and (best := max(found)) != _NEVER:
            i = found.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del found[i]
            if i < len(found):
                found[i] = scores.get(parts[i] + parts[i + 1], _NEVER)
            if i:
                found[i - 1] = scores.get(parts[i - 1] + parts[i], _NEVER)
        return parts

    def _stay_apart(self, a: str, b: str) -> bool:
        found = self._tested_here.get((a, b))
        if found is None:
            if len(self._tested_here) >= CACHE:
                self._tested_here = {}
            found = self._tested_here[a, b] = self.merge(a + b) == [a, b]
        return found

    def part_counts(self, part: str) -> list[int]:
        """Tokens of part[:1], part[:2], ... for a part without an inner word mark after another character."""
        whole, longest, last, counts = self.whole, self.longest, [""], [0]
        for end in range(1, len(part) + 1):
            for start in range(max(0, end - longest), end):
                piece = part[start:end]
                if (piece in whole or end - start == 1) and (not start or self._stay_apart(last[start], piece)):
                    last.append(piece)
                    counts.append(counts[start] + (1 if piece in whole else len(piece.encode())))
                    break
        return counts[1:]

    def _name(self, number: int) -> str:
        return self._names[number] if number < len(self._names) else chr(number - len(self._names))

    def _all_apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a << 32 | b
        at = np.searchsorted(self._tested, keys)
        new = np.unique(keys[self._tested[at] != keys])
        if len(new):
            if len(self._tested) > 4 * CACHE:
                self._tested, self._apart, new = self._tested[-1:], self._apart[-1:], np.unique(keys)
            names = [(self._name(k >> 32), self._name(k & 0xFFFFFFFF)) for k in new.tolist()]
            apart = np.array([self.merge(x + y) == [x, y] for x, y in names])
            place = np.searchsorted(self._tested, new)
            self._tested, self._apart = np.insert(self._tested, place, new), np.insert(self._apart, place, apart)
            at = np.searchsorted(self._tested, keys)
        return self._apart[at]

    def counts_side_by_side(self, parts: list[str]) -> np.ndarray:
        """The tables of many short parts, one in each row: column i is the count of the first i characters."""
        n = np.array([len(p) for p in parts])
        width = int(n.max())
        codes = np.frombuffer("".join(p.ljust(width, "\0") for p in parts).encode("utf-32-le"), np.uint32)
        codes = codes.reshape(-1, width).astype(np.int64)
        ending: list[list] = [[] for _ in range(width + 1)]
        for start in range(width):
            rows = np.flatnonzero(n > start)
            node = np.zeros(len(rows), np.int64)
            for end in range(start + 1, min(start + self.longest, width) + 1):
                keys = node << 21 | codes[rows, end - 1]
                at = np.searchsorted(self._edges, keys)
                found = self._edges[at] == keys
                if end == start + 1:
                    lone = np.where(found, self._piece_at[self._to[at]], -1)
                    ending[end].append((start, rows, np.where(lone < 0, codes[rows, start] + len(self._names), lone)))
                    rows, node = rows[found], self._to[at[found]]
                else:
                    rows, node = rows[found], self._to[at[found]]
                    piece = self._piece_at[node]
                    some = piece >= 0
                    ending[end].append((start, rows[some], piece[some]))
                more = n[rows] > end
                rows, node = rows[more], node[more]
                if not len(rows):
                    break
        last = np.zeros((len(parts), width + 1), np.int64)
        counts = np.zeros((len(parts), width + 1), np.int64)
        lone_bytes = lambda c: 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
        for end in range(1, width + 1):
            opened = np.ones(len(parts), bool)
            for start, rows, piece in ending[end]:  # from the longest piece to the shortest
                some = opened[rows]
                rows, piece = rows[some], piece[some]
                if start and len(rows):
                    apart = self._all_apart(last[rows, start], piece)
                    rows, piece = rows[apart], piece[apart]
                known = piece < len(self._names)
                last[rows, end] = piece
                counts[rows, end] = counts[rows, start] + np.where(known, 1, lone_bytes(piece - len(self._names)))
                opened[rows] = False
        return counts

    def _learn(self, parts: list[str]) -> None:
        """Count parts that are not remembered."""
        if len(self._totals) >= CACHE:
            self._older, self._totals = self._totals, {}
        widths: dict[int, list[str]] = {}
        for part in parts:
            found = self._older.get(part)
            if found is not None:
                self._totals[part] = found
            else:
                widths.setdefault((len(part) + 3) // 4, []).append(part)
        for width, some in widths.items():
            if width > SIDE_BY_SIDE // 4:
                self._totals.update((p, self.part_counts(p)[-1]) for p in some)
            else:
                for i in range(0, len(some), 50_000):
                    block = some[i:i + 50_000]
                    table = self.counts_side_by_side(block)
                    self._totals.update(zip(block, table[np.arange(len(block)), [len(p) for p in block]].tolist()))

    def count_all(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        split = [_PARTS.findall(self._marked(t)) for t in texts]
        new = {p for parts in split for p in parts if p not in self._totals}
        if new:
            self._learn(sorted(new))
        get, counts = self._totals.get, []
        for parts in split:
            found = list(map(get, parts))
            if None in found:  # remembered before, but of an older generation now
                self._learn([p for p in set(parts) if p not in self._totals])
                found = list(map(self._totals.get, parts))
            counts.append(sum(found))
        return counts

    def count_chunks(self, texts: list[str]):
        """As ``count_all``, some texts at a time."""
        chunk, length = [], 0
        for text in texts:
            chunk.append(text)
            length += len(text)
            if length >= CHUNK:
                yield from self.count_all(chunk)
                chunk, length = [], 0
        yield from self.count_all(chunk)

    @staticmethod
    def _marked(text: str) -> str:
        return _MARK + text.replace(" ", _MARK) if text else ""

    def count_part(self, part: str) -> int:
        found = self._totals.get(part)
        return self.part_counts(part)[-1] if found is None else found

    def count(self, text: str) -> int:
        return self.count_all([text])[0]

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of text[:0], text[:1], ..., text: one number more than characters."""
        counts, before = [0], 0
        for part in _PARTS.findall(self._marked(text)):
            counts += [before + c for c in self.part_counts(part)]
            before = counts[-1]
        # the first mark is the library's own: it has no character in the text
        return np.array([0, *counts[2:]], np.int64)

    def fitting(self, text: str, limit: int) -> int:
        """Characters of the longest prefix with at most ``limit`` tokens."""
        before, chars = 0, -1
        for part in _PARTS.findall(self._marked(text)):
            total = before + self.count_part(part)
            if total > limit:
                break
            before, chars = total, chars + len(part)
        else:
            return len(text)
        # a longer prefix may need fewer tokens than a shorter one, but only inside the part that passes the limit
        # can the boundary lie: the counts at part ends never fall
        inside = [i for i, c in enumerate(self.part_counts(part), 1) if before + c <= limit]
        return max(0, chars + (inside[-1] if inside else 0))


def read_scores(path: str) -> dict[str, float]:
    """Ordinary pieces of a model file."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    skip = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    return {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size()) if not skip(i)}


@lru_cache(maxsize=2)
def prefix_counter(path: str) -> PrefixCounts:
    """One counter for each Python worker and model."""
    return PrefixCounts(read_scores(path))


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, fitting_chars``: the last is the longest prefix within ``limit``."""
    path = path or public_tokenizers.path(MODEL)

    def run(batches):
        counter = prefix_counter(path)
        for batch in batches:
            rows = batch.column("text").to_pylist()
            n = list(counter.count_chunks(rows))
            fit = [len(t) if k <= limit else counter.fitting(t, limit) for t, k in zip(rows, n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(t.encode()) for t in rows], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([k > limit for k in n]), pa.array(fit, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "fitting_chars"])

    return common.texts(docs).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fitting_chars long")
