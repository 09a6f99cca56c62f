"""Substring deduplication on bytes with a run-length index.

Stretches of text that share an anchor (see ``shared_windows``) are written one after the other, and the
Burrows-Wheeler transform of the whole is kept as its runs: start, letter, rank of the letter, and the suffix-array
samples of the first and the last row. Stretches are then streamed through the index from right to left, many side by
side: a step follows the transform inside a run of the wanted letter, or else jumps to the end of the nearest run of
that letter above or below, whichever agrees longer with the text. That gives the matching statistics. Where the match
is as long as a window, the window belongs to a class of equal ones, and it is marked if the class begins earlier.

The text is UTF-8, so byte 0xFF never occurs and parts the stretches. Suffixes are sorted by their first 128 bytes,
more than a window needs.

Matches never cross documents; overlapping ones count; windows are judged on the input. A window is removed if it also
starts at an earlier place of the same document or in one with a smaller doc_id. Null and empty texts, and texts
shorter than a window, lose nothing. Rows that repeat doc_id and text are one document, and a null doc_id stands after
all others.
"""

import numpy as np
from pyspark.sql import DataFrame

from credara.llm import shared_windows

WINDOW_BYTES = 100
ANCHOR_BYTES = 32
_PART = 0xFF
_DEPTH = 128


def _names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Dense names of pairs, in the order of the pairs."""
    return _ranks(left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64))


def _ranks(values: np.ndarray) -> np.ndarray:
    """Dense ranks: equal values share one, so the sort need not be stable."""
    order = np.argsort(values)
    ranks = np.empty(len(values), np.int32)
    ranks[order] = _numbers(values[order])
    return ranks


def _numbers(ordered: np.ndarray) -> np.ndarray:
    """From 0 on, one number for each stretch of equal values."""
    fresh = np.zeros(len(ordered), np.int32)
    fresh[1:] = ordered[1:] != ordered[:-1]
    return np.cumsum(fresh, dtype=np.int32)


def _shifted(x: np.ndarray, by: int) -> np.ndarray:
    return np.concatenate([x[by:], np.zeros(by, x.dtype)])


class RunLengthIndex:
    """The run-compressed transform of some stretches, with the samples at the ends of runs."""

    def __init__(self, stretches: list[bytes], window: int = WINDOW_BYTES):
        if not _DEPTH // 2 <= window <= _DEPTH:
            raise ValueError("windows between half the sorting depth and the whole of it")
        self.window = window
        lengths = np.array([len(s) for s in stretches])
        self.stop = np.cumsum(lengths + 1) - 1
        self.start = self.stop - lengths
        pad = bytes([_PART])
        self.text = np.frombuffer(pad.join(stretches) + pad * _DEPTH, np.uint8)
        self._build()

    def _build(self) -> None:
        text, n = self.text, len(self.text)
        eight = np.zeros(n, np.uint64)
        for k in range(8):
            eight = eight << np.uint64(8) | _shifted(text, k).astype(np.uint64)
        name = _ranks(eight)
        # names of substrings of 8, 16, 32 and 64 bytes: equal names, equal bytes
        self.levels, size = [(8, name)], 8
        while size < _DEPTH // 2:
            name = _names(name, _shifted(name, size))
            size *= 2
            self.levels.append((size, name))
        whole = name.astype(np.uint64) << np.uint64(32) | _shifted(name, size).astype(np.uint64)
        rows = np.argsort(whole, kind="stable")
        # classes of equal windows, by the first place of each
        first, rest = name[rows], _shifted(name, self.window - size)[rows]
        class_start = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (rest[1:] != rest[:-1])]))
        class_sizes = np.diff(class_start, append=n)
        self.first_of_row = np.repeat(np.minimum.reduceat(rows, class_start).astype(np.int32), class_sizes)
        letters = text[rows - 1]
        self.run_of_row = _numbers(letters)
        self.run_start = np.flatnonzero(np.concatenate([[True], letters[1:] != letters[:-1]]))
        run_stop = np.append(self.run_start[1:], n)
        self.run_letter = letters[self.run_start]
        self.first_sample, self.last_sample = rows[self.run_start], rows[run_stop - 1]
        self.run_last = run_stop - 1
        # runs by letter: how many of the letter stand before each, and where the letter's rows begin
        self.by_letter = np.argsort(self.run_letter, kind="stable")
        sizes = (run_stop - self.run_start)[self.by_letter]
        before = np.cumsum(sizes) - sizes  # letters in order: this counts smaller letters, too
        self.run_target = np.empty(len(before), np.int64)
        self.run_target[self.by_letter] = before
        self.place = self.run_letter[self.by_letter].astype(np.int64) << 32 | self.run_start[self.by_letter]

    def _agreement(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes the suffixes at ``a`` and ``b`` share, counted up to the sorting depth."""
        a, b, last = a.copy(), b.copy(), len(self.text) - 1
        shared = np.zeros(len(a), np.int64)
        for size, name in reversed(self.levels):
            same = name[np.minimum(a, last)] == name[np.minimum(b, last)]
            a, b, shared = a + size * same, b + size * same, shared + size * same
        going = np.ones(len(a), bool)
        for _ in range(7):
            going &= self.text[np.minimum(a, last)] == self.text[np.minimum(b, last)]
            a, b, shared = a + going, b + going, shared + going
        return shared

    def earlier_windows(self):
        """``stretch, place`` of the windows that stand at an earlier place of the text, too."""
        many = np.argsort(self.start - self.stop, kind="stable")  # longest first: those that go on come first
        stop, length = self.stop[many], (self.stop - self.start)[many]
        row = np.zeros(len(many), np.int64)  # of the transform, inside the range that agrees longest with the text
        _, wide = self.levels[-1]
        shift = self.window - self.levels[-1][0]
        for step in range(int(length.max(initial=0))):
            n = int(np.searchsorted(-length, -step, "left"))  # stretches longer than step
            at = stop[:n] - 1 - step
            letter, q = self.text[at], row[:n]
            run = self.run_of_row[q]
            follows = self.run_letter[run] == letter
            target = self.run_target[run] + q - self.run_start[run]
            jump = np.flatnonzero(~follows)
            if len(jump):
                wanted, here = letter[jump].astype(np.int64), q[jump]
                below = np.searchsorted(self.place, wanted << 32 | here)
                has_above = (below > 0) & (self.place[below - 1] >> 32 == wanted)
                has_below = below < len(self.place)
                has_below &= self.place[np.minimum(below, len(self.place) - 1)] >> 32 == wanted
                up = self.by_letter[np.maximum(below - 1, 0)]
                down = self.by_letter[np.minimum(below, len(self.place) - 1)]
                own = at[jump] + 1
                gain_up = np.where(has_above, self._agreement(own, self.last_sample[up]), -1)
                gain_down = np.where(has_below, self._agreement(own, self.first_sample[down]), -1)
                upward = gain_up >= gain_down
                chosen = np.where(upward, up, down)
                at_row = np.where(upward, self.run_last[chosen], self.run_start[chosen])
                target[jump] = self.run_target[chosen] + at_row - self.run_start[chosen]
            row[:n] = target
            if step + 1 >= self.window:
                first = self.first_of_row[target]
                long = (wide[at] == wide[first]) & (wide[at + shift] == wide[first + shift])
                marked = np.flatnonzero(long & (first < at))
                yield from zip(many[marked].tolist(), (at[marked] - self.start[many[marked]]).tolist())


def mark(stretches: list[shared_windows.Stretch], window: int = WINDOW_BYTES):
    """``stretch, place`` of every window that an earlier stretch, or an earlier place of the same, holds."""
    index = RunLengthIndex([s.content for s in stretches], window)
    for number, place in index.earlier_windows():
        yield stretches[number], place


_LETTERS = np.random.default_rng(17).integers(0, 2**63, 256, np.uint64)

KIND = shared_windows.Kind(
    window=WINDOW_BYTES, gram=ANCHOR_BYTES, units=lambda text: text,
    hashes=lambda text: _LETTERS[np.frombuffer(text, np.uint8)], cut=lambda text, start, stop: text[start:stop], joint=b"",
    within_document=True, match=mark)


def remove_repeated(docs: DataFrame, kind: shared_windows.Kind = KIND) -> DataFrame:
    """``doc_id, n, removed, kept``: bytes of each row, the runs of bytes removed, and the bytes that stay."""
    return shared_windows.repeated_windows(kind, docs)

