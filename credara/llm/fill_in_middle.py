"""Fill-in-middle transformation with an indexable skip list.

A text is a sequence of units (code points, or the matches of a pattern and the stretches between them). The units are
the nodes of a skip list: a node is in lane k with probability ``SPARSE ** -k``, and every lane says of each link how
many units and how many code points it passes over. A search for a rank goes down from the sparsest lane and takes
each link whose accumulated unit width does not pass the rank; where it ends, the accumulated code-point width is the
place to cut. Both cut ranks are found in this way, in a number of links that grows with the logarithm of the text.

The cuts and the form depend on the document's id alone, so they are the same in every run and on every executor.
Every row is transformed for itself: nothing is shuffled, and a task holds one text at a time.

Nulls: a null text counts as empty; a null doc_id is treated as an id of its own, written as nothing. Empty texts, and
texts that hold one of the marks, stay plain. Repeated rows give equal rows. Very long texts take some twenty bytes a code
point while their lanes are built. An empty table gives no row.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from credara.llm import common

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Share of the documents, in percent, that stay plain, and of the others those that begin with the suffix.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
# One node in so many goes up to the next lane.
SPARSE = 16


class SkipList:
    """Units and their widths in code points; lanes are arrays, as the list never changes after it is built."""

    def __init__(self, widths: np.ndarray, seed: int = 0):
        """``widths``: code points of each unit."""
        self.n, self.length = len(widths), int(np.sum(widths, dtype=np.int64))
        coins = np.random.default_rng(seed)
        # lane: units passed and code points passed by each link, and which link of the lane below ends where it ends
        self.lanes = [(None, np.asarray(widths, np.int32), None)]
        units, points = np.arange(1, self.n + 1), np.cumsum(widths, dtype=np.int64)
        while len(units) > SPARSE:
            chosen = np.flatnonzero(coins.integers(0, SPARSE, len(units)) == 0)
            units, points = units[chosen], points[chosen]
            self.lanes.append((np.diff(units, prepend=0), np.diff(points, prepend=0), chosen))

    def code_points(self, rank: int) -> int:
        """Code points before unit ``rank``."""
        return self._descend(rank, by_units=True)[1]

    def units(self, place: int) -> int:
        """Units that end at or before code point ``place``."""
        return self._descend(place, by_units=False)[0]

    def _descend(self, wanted: int, by_units: bool) -> tuple[int, int]:
        """Accumulated units and code points when no lane has a link that stays within ``wanted``."""
        passed, place, link = 0, 0, 0
        for lane in range(len(self.lanes) - 1, -1, -1):
            units, points, under = self.lanes[lane]
            while link < len(points):
                u, p = (1 if units is None else int(units[link])), int(points[link])
                if (passed + u if by_units else place + p) > wanted:
                    break
                passed, place, link = passed + u, place + p, link + 1
            link = int(under[link - 1]) + 1 if lane and link else 0
        return passed, place


def widths_of(text: str, unit: re.Pattern | None) -> np.ndarray:
    """Code points of each unit; without a pattern every code point is a unit."""
    if unit is None:
        return np.ones(len(text), np.int32)
    edges = {0, len(text)}
    for match in unit.finditer(text):
        edges.update(match.span())
    return np.diff(sorted(edges)).astype(np.int32)


def draws(doc_id: int | None) -> list[int]:
    """Four numbers that only depend on the id."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def transform(doc_id: int | None, text: str, unit: re.Pattern | None = None) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle, and the text in its new order."""
    h1, h2, h3, h4 = draws(doc_id)
    widths = widths_of(text, unit)
    if not text or h3 % 100 >= 100 - PLAIN_PERCENT or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return len(widths), "plain", None, None, text
    units = SkipList(widths, h4)
    first, second = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    cut, end = units.code_points(first), units.code_points(second)
    prefix, middle, suffix = text[:cut], text[cut:end], text[end:]
    if h4 % 100 < SPM_PERCENT:
        return units.n, "spm", cut, end - cut, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return units.n, "psm", cut, end - cut, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text that was transformed. A text with marks of its own stays plain, so the first of each mark is ours."""
    if form == "plain":
        return output
    first, second = (SUFFIX, PREFIX) if form == "spm" else (PREFIX, SUFFIX)
    one, rest = output[len(first):].split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    return prefix + middle + suffix


def fill_in_middle(docs: DataFrame, unit: str | None = None) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` for each row; ``unit`` is a pattern or nothing for code
    points."""
    def run(batches):
        pattern = re.compile(unit) if unit else None
        for batch in batches:
            ids = batch.column("doc_id")
            rows = [transform(i, t.as_py(), pattern) for i, t in zip(ids.to_pylist(), batch.column("text"))]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, kinds)]
            yield pa.RecordBatch.from_arrays(
                [ids, *columns], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return common.texts(docs).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(transformed: DataFrame) -> DataFrame:
    """``transformed`` with ``restored``, the text rebuilt from ``output`` and ``form``."""
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches):
        for batch in batches:
            texts = [restore(o.as_py(), f.as_py()) for o, f in zip(batch.column("output"), batch.column("form"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns] + [pa.array(texts, pa.string())], [*columns, "restored"])

    return transformed.select(*columns).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, restored string")
