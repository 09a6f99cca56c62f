"""Windows that occur more than once in a corpus: the part that phrase automata and the run-length index share.

A window is a fixed number of units (words or bytes) of one text. Comparing all windows would move many times the
corpus, so windows are routed by an anchor: the gram of least hash inside the window. Equal windows have equal
anchors, and neighbouring windows mostly share one, so few anchors stand for all windows.

1. The anchors of each document, once each with their number, are sorted by anchor; those that occur only once are
   dropped.
2. Around every other anchor, the stretch of text that its windows cover goes to the anchor's group, once for each
   document with all its places: a text that says the same word a million times is one row. A stretch that repeats an
   earlier one of its group is settled at once; groups of several different stretches go, some at a time, to a matcher
   (the automata, the index), which finds the windows that occurred before.
3. A group whose different stretches outgrow a task's memory is settled window by window instead, by a 128-bit hash,
   sorted over all tasks: no group has to fit anywhere.
4. The removed places go back to their documents. Texts are shuffled once: both joins with them use one exchange.

Rows are told apart by a hash of doc_id and text; a null doc_id stands after all others, in the order of a hash of its
text, and rows that repeat doc_id and text are one document.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from credara.llm import common

# Bytes of different stretches that a task matches at once, and the most of one group that it holds.
MATCH_BYTES = 1_500_000
GROUP_BYTES = 3_000_000
_ROWS = 200_000
_LOW = np.uint64((1 << 24) - 1)
# Texts are read in pieces of this many units, so that a place fits the low bits.
PIECE = 1 << 22


@dataclass(frozen=True)
class Kind:
    """What a window is made of."""

    window: int                                                  # units
    gram: int                                                    # units of an anchor, a power of two
    units: Callable[[bytes], list | bytes]                       # of a text
    hashes: Callable[[list | bytes], np.ndarray]                 # one number for each unit
    cut: Callable[[list | bytes, int, int], bytes]               # units start to stop as bytes
    joint: bytes                                                 # between kept runs
    within_document: bool                                        # does an earlier place of the same document count?
    match: Callable[[list["Stretch"]], Iterator[tuple["Stretch", int]]]   # stretch, place of a window seen before
    match_bytes: int = MATCH_BYTES
    group_bytes: int = GROUP_BYTES


@dataclass
class Stretch:
    """A different stretch of a group, in order of first appearance, and where the same document repeats it."""

    key: int
    doc: int
    at: int
    content: bytes
    places: list[tuple[int, int]]                                # row, at


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` units (a power of two)."""
    out, done, factor = hashes, 1, 0x9E3779B97F4A7C15
    while done < size:
        out = out[:-done] * np.uint64(pow(factor, done, 1 << 64)) + out[done:]
        done *= 2
    return _mix(out)


def anchors(kind: Kind, units: list | bytes) -> tuple[np.ndarray, ...]:
    """``hash, place, first window, last window`` of each anchor of a text: each window has one."""
    width, parts = kind.window - kind.gram + 1, []
    for begin in range(0, max(0, len(units) - kind.window + 1), PIECE):
        some = units[begin:begin + PIECE + kind.window - 1]
        g = grams(kind.hashes(some), kind.gram)
        least = (g & ~_LOW) | np.arange(len(g), dtype=np.uint64)  # the leftmost of equal ones
        done = 1
        while 2 * done <= width:
            least = np.minimum(least[:-done], least[done:])
            done *= 2
        if done < width:
            least = np.minimum(least[:done - width], least[width - done:])
        place = (least & _LOW).astype(np.int64)  # never falls from one window to the next
        first = np.flatnonzero(np.diff(place, prepend=-1))
        last = np.append(first[1:], len(place)) - 1
        at = place[first]
        parts.append((g[at].view(np.int64), at + begin, first + begin, last + begin))
    return tuple(np.concatenate(p) for p in zip(*parts)) if parts else (np.empty(0, np.int64),) * 4


def _source(docs: DataFrame) -> DataFrame:
    """``doc, doc_id, row, text``: ``doc`` orders documents, ``row`` tells rows apart."""
    late = F.lit(1 << 62) + F.xxhash64("text").bitwiseAND(F.lit((1 << 61) - 1))
    return common.texts(docs).select(
        F.coalesce("doc_id", late).alias("doc"), "doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")


def _all_anchors(kind: Kind, source: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            found, docs, size = [], [], 0
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist()):
                key, times = np.unique(anchors(kind, kind.units(text.encode()))[0], return_counts=True)
                found.append((key, times))
                docs.append(np.full(len(key), doc, np.int64))
                size += len(key)
                if size > _ROWS:
                    yield _anchor_batch(found, docs)
                    found, docs, size = [], [], 0
            if docs:
                yield _anchor_batch(found, docs)

    return source.select("doc", "text").mapInArrow(run, "anchor long, doc long, times long")


def _anchor_batch(found, docs) -> pa.RecordBatch:
    keys, times = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, docs, times)], ["anchor", "doc", "times"])


def _repeated(kind: Kind, sorted_anchors: DataFrame) -> DataFrame:
    """``doc, anchor`` of anchors that occur again, from rows sorted by anchor and document."""
    def run(batches):
        held = tuple(np.empty(0, np.int64) for _ in range(3))
        known = None  # an anchor already found to repeat, whose rows may go on
        for batch in batches:
            key, doc, times = (np.concatenate([h, batch.column(c).to_numpy()])
                               for h, c in zip(held, ("anchor", "doc", "times")))
            if not len(key):
                continue
            start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            stop = np.append(start[1:], len(key))
            again = (stop - start > 1) | (times[start] > 1) if kind.within_document else doc[start] != doc[stop - 1]
            again |= key[start] == known if known is not None else False
            known = int(key[-1]) if again[-1] else None
            # the last group may go on: its rows wait unless it repeats already (then they are of one document)
            keep = len(key) if again[-1] else int(start[-1])
            held = tuple(x[keep:] for x in (key, doc, times))
            chosen = np.repeat(again, stop - start)[:keep]
            yield pa.RecordBatch.from_arrays([pa.array(doc[:keep][chosen]), pa.array(key[:keep][chosen])], ["doc", "anchor"])

    return sorted_anchors.mapInArrow(run, "doc long, anchor long")


def _stretches(kind: Kind, joined: DataFrame) -> DataFrame:
    """``key, doc, row, at, more, content`` around the repeated anchors of each text: the first place, the others."""
    names = ["key", "doc", "row", "at", "more", "content"]

    def run(batches):
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("doc", "row", "text"))
            out, size = [], 0
            for doc, row, text, repeated in zip(*columns, batch.column("repeated")):
                if not repeated.is_valid:
                    continue
                units = kind.units(text.encode())
                key, _, first, last = anchors(kind, units)
                chosen = np.isin(key, repeated.values.to_numpy())
                places: dict[tuple[int, bytes], list[int]] = {}
                for k, a, b in zip(key[chosen].tolist(), first[chosen].tolist(), (last[chosen] + kind.window).tolist()):
                    places.setdefault((k, kind.cut(units, a, b)), []).append(a)
                for (k, content), at in places.items():
                    out.append((k, doc, row, at[0], at[1:], content))
                    size += len(content) + 8 * len(at)
                if size > MATCH_BYTES:
                    yield _batch(out, names, _STRETCH_TYPES)
                    out, size = [], 0
            if out:
                yield _batch(out, names, _STRETCH_TYPES)

    return joined.mapInArrow(run, "key long, doc long, row long, at long, more array<long>, content binary")


_STRETCH_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary())
_SETTLED = ["route", "more", "doc", "row", "at", "stop", "late"]
_SETTLED_TYPES = (*(pa.int64(),) * 6, pa.bool_())
_SETTLED_SCHEMA = "route long, more long, doc long, row long, at long, stop long, late boolean"


def _batch(rows, names, types) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((),) * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _runs(places: list[int], window: int):
    """Window places of one stretch, in order, as covered runs of units."""
    start = stop = None
    for p in places:
        if start is None:
            start, stop = p, p + window
        elif p <= stop:
            stop = p + window
        else:
            yield start, stop
            start, stop = p, p + window
    if start is not None:
        yield start, stop


class _Settler:
    """Reads stretches sorted by group, document and place; gives covered runs, or windows that are settled later."""

    def __init__(self, kind: Kind):
        self.kind = kind
        self.key, self.group, self.group_bytes, self.over = None, {}, 0, False
        self.waiting, self.waiting_bytes = [], 0
        self.out = []

    def _size(self, content: bytes) -> int:
        return len(self.kind.units(content))

    def _covered(self, doc: int, row: int, start: int, stop: int) -> None:
        self.out.append((doc, 0, doc, row, start, stop, False))

    def _window_rows(self, doc: int, row: int, at: int, content: bytes) -> None:
        units = self.kind.units(content)
        for i in range(len(units) - self.kind.window + 1):
            h = xxhash.xxh3_128_intdigest(self.kind.cut(units, i, i + self.kind.window))
            self.out.append(((h >> 64) - 2**63, (h & 2**64 - 1) - 2**63, doc, row, at + i, at + i + self.kind.window, True))

    def add(self, key: int, doc: int, row: int, at: int, more: list[int], content: bytes) -> None:
        if key != self.key:
            self.close()
            self.key = key
        if self.kind.within_document:
            for a in more:  # the same stretch stands earlier in this very text
                self._covered(doc, row, a, a + self._size(content))
            more = []
        if self.over:
            for a in (at, *more):
                self._window_rows(doc, row, a, content)
            return
        first = self.group.get(content)
        if first is None:
            self.group[content] = Stretch(key, doc, at, content, [(row, a) for a in (at, *more)])
            self.group_bytes += len(content)
            if self.group_bytes > self.kind.group_bytes:
                # covered runs given before stay right: an equal stretch came first, and its windows are settled below
                for s in self.group.values():
                    for r, a in s.places:
                        self._window_rows(s.doc, r, a, s.content)
                self.group, self.over = {}, True
        elif first.doc < doc or self.kind.within_document and (first.doc, first.at) < (doc, at):
            for a in (at, *more):
                self._covered(doc, row, a, a + self._size(content))
        else:
            first.places += [(row, a) for a in (at, *more)]

    def close(self) -> None:
        if len(self.group) > 1:
            self.waiting += self.group.values()
            self.waiting_bytes += self.group_bytes
            if self.waiting_bytes > self.kind.match_bytes:
                self.match()
        self.key, self.group, self.group_bytes, self.over = None, {}, 0, False

    def match(self) -> None:
        found: dict[int, list[int]] = {}
        for stretch, place in self.kind.match(self.waiting):
            found.setdefault(id(stretch), []).append(place)
        for s in self.waiting:
            if places := found.get(id(s)):
                for start, stop in _runs(sorted(places), self.kind.window):
                    for row, at in s.places:
                        self._covered(s.doc, row, at + start, at + stop)
        self.waiting, self.waiting_bytes = [], 0

    def given(self):
        out, self.out = self.out, []
        return _batch(out, _SETTLED, _SETTLED_TYPES)


def _settled(kind: Kind, sorted_stretches: DataFrame) -> DataFrame:
    def run(batches):
        settler = _Settler(kind)
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "doc", "row", "at", "more", "content"))):
                settler.add(*row)
                if len(settler.out) > _ROWS:
                    yield settler.given()
            yield settler.given()
        settler.close()
        settler.match()
        yield settler.given()

    return sorted_stretches.mapInArrow(run, _SETTLED_SCHEMA)


def _places(kind: Kind, sorted_rows: DataFrame) -> DataFrame:
    """``doc, row, at, stop``: covered runs as they are, and late windows that are not the first of their kind."""
    def run(batches):
        same = first = None
        for batch in batches:
            out = []
            for route, more, doc, row, at, stop, late in zip(*(batch.column(c).to_pylist() for c in _SETTLED)):
                if not late:
                    out.append((doc, row, at, stop))
                elif (route, more) != same:
                    same, first = (route, more), (doc, at)
                elif first[0] < doc or kind.within_document and first < (doc, at):
                    out.append((doc, row, at, stop))
            yield _batch(out, ["doc", "row", "at", "stop"], (pa.int64(),) * 4)

    return sorted_rows.mapInArrow(run, "doc long, row long, at long, stop long")


def repeated_windows(kind: Kind, docs: DataFrame) -> DataFrame:
    """``doc_id, n, removed, kept``: every row's number of units, the runs that windows seen before cover, the rest."""
    ws = common.workspace(docs)
    source = _source(docs)
    every = _all_anchors(kind, source).repartition("anchor").sortWithinPartitions("anchor", "doc")
    repeated = _repeated(kind, every).groupBy("doc").agg(F.collect_set("anchor").alias("repeated"))
    repeated = ws.save("repeated_anchors", repeated)
    near = _stretches(kind, source.join(repeated.hint("shuffle_hash"), "doc", "left"))
    settled = _settled(kind, near.repartition("key").sortWithinPartitions("key", "doc", "at", "row"))
    covered = _places(kind, settled.repartition("route").sortWithinPartitions("route", "more", "doc", "at"))
    lists = covered.groupBy("doc").agg(F.collect_list(F.struct("row", "at", "stop")).alias("covered"))
    return _applied(kind, source.join(lists.hint("shuffle_hash"), "doc", "left"))


def _applied(kind: Kind, joined: DataFrame) -> DataFrame:
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches):
        for batch in batches:
            doc_ids, rows, texts, n, removed, kept = (batch.column("doc_id"), batch.column("row").to_pylist(),
                                                      batch.column("text").to_pylist(), [], [], [])
            for row, text, covered in zip(rows, texts, batch.column("covered").to_pylist()):
                units = kind.units(text.encode())
                runs = []
                for c in sorted((c["at"], c["stop"]) for c in covered or () if c["row"] == row):
                    if runs and c[0] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], c[1])
                    else:
                        runs.append([*c])
                n.append(len(units))
                removed.append([{"start": a, "stop": b} for a, b in runs])
                left = [kind.cut(units, a, b) for a, b in zip([0, *(b for _, b in runs)], [*(a for a, _ in runs), len(units)])
                        if a < b]
                kept.append(kind.joint.join(left))
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(n, pa.int64()), pa.array(removed, spans), pa.array(kept, pa.binary())],
                ["doc_id", "n", "removed", "kept"])

    return joined.mapInArrow(run, "doc_id long, n long, removed array<struct<start:long,stop:long>>, kept binary")
