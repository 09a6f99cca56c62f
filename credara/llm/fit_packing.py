"""Best-fit packing of token sequences in bulk-synchronous rounds.

A document is its token ids and one end id. One that is longer than a sequence is cut into full pieces and one shorter
first piece; full pieces are sequences of their own. The shorter pieces are sorted by length over all tasks, so that a
piece is known by its place: pieces of one length are a run of places. Sequences with the same gap are runs of numbers
in the same way. A round

* opens sequences, if a piece is longer than every gap: one for each such piece of more than half a sequence, or else
  as many as the pieces of the largest length need;
* sweeps from the largest value to the smallest, putting gaps on a stack and giving each run of pieces the gap on top,
  which is the smallest that holds it (its successor). A sequence takes as many pieces of that length as its gap holds;
  where a run meets fewer gaps, or more, than it needs, rank decides: lower places and numbers first;
* shortens the gaps it has filled. They are swept again in the next round, until no piece is left.

Only runs are swept, never rows: there are at most ``capacity - 1`` lengths, a match uses up either a length or a whole
run of gaps, and what is left of a gap is less than half of it, so a run is matched at most ten times at the usual
capacity. The plan has some ten thousand rows whatever the input and is broadcast; a piece finds its sequence by its
place. Rows are sorted once, by two numbers each.

Nulls: a null text counts as empty, that is one end id; a null doc_id is kept. Repeated rows are packed each for
itself. Ties (equal lengths) are in the order the rows were read. An empty table gives no row.
"""

import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer
import tiktoken

from credara.llm import common
from credara.llm.bpe_segment_tree import read_ranks
from credara.operators.keys import key_from_position, with_position

VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
CAPACITY, END_ID = 1024, 2


class Encoder:
    """Ids of a vocabulary file as its library gives them.

    The same merges in another engine take a fifth of the time; texts whose white space is too long for that engine's
    pattern go to the file's own library. Tests compare both.
    """

    def __init__(self, path: str, ranks_path: str):
        self.library = Tokenizer.from_file(path)
        added = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.engine = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                        mergeable_ranks=read_ranks(ranks_path), special_tokens=added)

    def encode(self, text: str) -> list[int]:
        try:
            return self.engine.encode(text, allowed_special="all")
        except ValueError:
            return self.library.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def encoder(path: str, ranks_path: str) -> Encoder:
    """One encoder for each Python worker and vocabulary."""
    return Encoder(path, ranks_path)


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document: whole ones but for the first."""
    first = length % capacity or min(length, capacity)
    return [(0, first), *((at, capacity) for at in range(first, length, capacity))]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None,
           ranks_path: str | None = None, ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` of every piece."""
    path = path or public_tokenizers.path(VOCABULARY)
    ranks_path = ranks_path or public_tokenizers.path(RANKS)

    def run(batches):
        coder = encoder(path, ranks_path)
        for batch in batches:
            rows, kept = [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                own = np.array([*coder.encode(text), end_id], "<u4")
                for k, (start, length) in enumerate(cut(len(own), capacity)):
                    part = own[start:start + length]
                    rows.append((doc, k, start, length, zlib.crc32(part.tobytes())))
                    kept.append(part)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, kinds)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if ids:
                columns.append(pa.array([p.astype(np.int32) for p in kept], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * ids
    return common.texts(docs).mapInArrow(run, schema)


class Plan:
    """Which places go where: ``rows`` of (length, first place, next place, pieces a sequence, first sequence,
    offset)."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.rows, self.rounds, self.sequences = capacity, [], 0, 0
        place, self.left = 0, {}
        for length in sorted(counts):
            self.left[length] = (place, counts[length])
            place += counts[length]
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        while self.left:
            self.rounds += 1
            self._open()
            self._sweep()

    def _open(self) -> None:
        largest = max(self.gaps, default=0)
        beyond = {s: n for s, (_, n) in self.left.items() if s > largest}
        if beyond:
            halves = sum(n for s, n in beyond.items() if 2 * s > self.capacity)
            longest = max(beyond)
            opened = halves or -(-beyond[longest] // (self.capacity // longest))
            self.gaps.setdefault(self.capacity, []).append((self.sequences, opened))
            self.sequences += opened

    def _sweep(self) -> None:
        stack, after = [], {}
        for value in range(self.capacity, 0, -1):
            stack += [(value, *run) for run in reversed(self.gaps.get(value, []))]
            if value in self.left:
                self._fill(value, stack, after)
        for gap, first, n in stack:
            after.setdefault(gap, []).append((first, n))
        self.gaps = {gap: sorted(runs) for gap, runs in after.items() if gap}

    def _fill(self, length: int, stack: list, after: dict) -> None:
        place, left = self.left.pop(length)
        while left and stack:
            gap, first, n = stack.pop()
            each = gap // length
            taken = min(left, n * each)
            self.rows.append((length, place, place + taken, each, first, self.capacity - gap))
            whole, rest = divmod(taken, each)
            if whole:
                after.setdefault(gap - each * length, []).append((first, whole))
            if rest:
                after.setdefault(gap - rest * length, []).append((first + whole, 1))
            used = whole + (rest > 0)
            if used < n:
                stack.append((gap, first + used, n - used))
            place, left = place + taken, left - taken
        if left:
            self.left[length] = (place, left)


_PLAN = "length long, from_place long, to_place long, each long, first long, base long"


def place(cut_pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut_pieces`` with their ``sequence_id`` and ``offset``; ``cut_pieces`` has at least ``length``.

    Sequences of one full piece have negative numbers, the others count from 0.
    """
    ws, spark, columns = common.workspace(cut_pieces), cut_pieces.sparkSession, cut_pieces.columns
    held = ws.save("pieces", cut_pieces.withColumn("_row", F.monotonically_increasing_id()))
    full = held.where(F.col("length") == capacity).select(
        *columns, (-F.col("_row") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = held.where(F.col("length") < capacity)
    # at most capacity - 1 rows
    counts = {r.length: r["count"] for r in short.groupBy("length").count().collect()}
    rows = spark.createDataFrame(Plan(counts, capacity).rows, _PLAN).withColumnRenamed("length", "_length")
    ranked = key_from_position(ws.save("ranked", with_position(short, ["length", "_row"])), "_place")
    at, k = F.col("_place") - 1, F.col("_place") - 1 - F.col("from_place")
    placed = ranked.join(F.broadcast(rows), (F.col("length") == F.col("_length")) & (at >= F.col("from_place"))
                         & (at < F.col("to_place")))
    return full.unionByName(placed.select(
        *columns, (F.col("first") + F.floor(k / F.col("each"))).alias("sequence_id"),
        (F.col("base") + k % F.col("each") * F.col("length")).alias("offset")))


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None,
         ranks_path: str | None = None, ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece, and ``ids`` if asked for."""
    return place(pieces(docs, capacity, end_id, path, ranks_path, ids), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids, starts`` from ``pack(..., ids=True)``: the tokens of each sequence and where its pieces
    begin. A sequence holds ``capacity`` tokens at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.offset").alias("starts"))
