"""SimHash near-duplicates by pivot distance tables.

A text's fingerprint is the majority of the 64-bit hashes of its word shingles, bit by bit. For every distinct
fingerprint the Hamming distances to a fixed set of reference fingerprints (pivots) are computed. By the triangle
inequality two fingerprints at most r bits apart differ by at most r in every such distance, so pairs with a larger
difference in any coordinate are discarded and only the survivors are compared bit by bit.

The pivots come in families: one base, and for each of r + 2 bands of bits several that differ from the base inside
the band only. How far a family's distances lie from the base's distance depends on that band alone. Two fingerprints
at most r bits apart agree on at least two bands, hence on all relative distances of two families: joining on those
of any two families finds every pair. Fingerprints are made distinct first, so copies never meet in a group. Where
more than ``BUCKET`` distinct fingerprints share a key, no pairs are formed: each is linked to the points at most half
the radius away, and whoever shares such a point is within the radius (radius 2; exact as well, and linear).

Words are the runs between ASCII white space, A-Z lowered. A text without words (null and empty ones) has fingerprint
zero and is linked like any other. A null doc_id is no component's name unless all its members are null.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from credara.llm import common
from credara.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
BUCKET = 64
_CHUNK = 200_000


def fingerprint(text: str, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    found = text.encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - words + 1)
    last = ends[min(words, len(found)) - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):  # a very long text never has all its bits unpacked at once
        some = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at:min(n, at + _CHUNK)].tolist(), last[at:at + _CHUNK])],
                        np.uint64)
        ones += np.unpackbits(some.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def signatures(docs: DataFrame, words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id, row_key, fp`` for each row; ``fp`` is the fingerprint as a signed number."""
    def run(batches):
        for batch in batches:
            rows = batch.column("text").to_pylist()
            fps = np.array([fingerprint(t, words, seed) for t in rows], np.uint64).view(np.int64)
            keys = [common.row_key_of(i, t) for i, t in zip(batch.column("doc_id").to_pylist(), rows)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(keys), pa.array(fps)],
                                             ["doc_id", "row_key", "fp"])

    return common.map_batches(common.texts(docs), run, "doc_id long, row_key string, fp long")


class Pivots:
    """Reference fingerprints for a radius, and what follows from the distances to them."""

    def __init__(self, max_bits: int = MAX_BITS):
        bands = max_bits + 2
        edges = [64 * i // bands for i in range(bands + 1)]
        base, pivots, self.families = 0x9E3779B97F4A7C15, [0x9E3779B97F4A7C15], []
        for low, high in zip(edges, edges[1:]):
            first = len(pivots)
            for j in range(1, 1 << (high - low - 1).bit_length()):
                # the bits of the band whose place has an odd number of ones in common with j
                pivots.append(base ^ sum(1 << low + b for b in range(high - low) if (b & j).bit_count() & 1))
            self.families.append(slice(first, len(pivots)))
        self.pivots = np.array(pivots, np.uint64)

    def distances(self, fps: np.ndarray) -> np.ndarray:
        return np.bitwise_count(fps.view(np.uint64)[:, None] ^ self.pivots).astype(np.int8)

    def keys(self, fps: np.ndarray) -> list[np.ndarray]:
        """One key for every two families: equal where the relative distances of both are equal."""
        table = self.distances(fps)
        relative = table - table[:, :1]
        mixed = []
        with np.errstate(over="ignore"):
            for number, family in enumerate(self.families):
                h = np.full(len(fps), number + 1, np.uint64)
                for column in relative[:, family].T:
                    h = (h ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                    h ^= h >> np.uint64(29)
                mixed.append(h)
            pairs = [(i, j) for j in range(len(mixed)) for i in range(j)]
            return [(mixed[i] * np.uint64(0xBF58476D1CE4E5B9) + mixed[j]).view(np.int64) for i, j in pairs]

    def linked(self, a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
        """Which pairs are within the radius: by coordinates first, then bit by bit."""
        near = np.abs(self.distances(a) - self.distances(b)).max(axis=1, initial=0) <= max_bits
        near[near] = np.bitwise_count(a[near].view(np.uint64) ^ b[near].view(np.uint64)) <= max_bits
        return near


def _keyed(distinct: DataFrame, max_bits: int) -> DataFrame:
    def run(batches):
        pivots = Pivots(max_bits)
        for batch in batches:
            fps = batch.column("fp").to_numpy()
            for keys in pivots.keys(fps):
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps)], ["key", "fp"])

    return common.map_batches(distinct.select("fp"), run, "key long, fp long")


def _links_of_sorted(rows: DataFrame, max_bits: int, most: int) -> DataFrame:
    """Links inside groups of at most ``most`` rows that lie one after the other."""
    def run(batches):
        pivots = Pivots(max_bits)
        held_keys, held = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            keys = np.concatenate([held_keys, batch.column("key").to_numpy()])
            fps = np.concatenate([held, batch.column("fp").to_numpy()])
            for apart in range(1, min(most, len(keys))):
                same = keys[:-apart] == keys[apart:]
                if not same.any():
                    break
                # pairs of earlier batches were compared then: one end at least is new
                same[:max(0, len(held) - apart)] = False
                a, b = fps[:-apart][same], fps[apart:][same]
                for at in range(0, len(a), _CHUNK):
                    x, y = a[at:at + _CHUNK], b[at:at + _CHUNK]
                    near = pivots.linked(x, y, max_bits)
                    yield pa.RecordBatch.from_arrays([pa.array(x[near]), pa.array(y[near])], ["a", "b"])
            held_keys, held = keys[-most:], fps[-most:]

    return common.map_batches(rows.select("key", "fp"), run, "a long, b long")


def _links_by_middle(fps: DataFrame) -> DataFrame:
    """Links within two bits among many fingerprints: two of them share a point at most one bit from both."""
    flips = np.concatenate([[0], np.uint64(1) << np.arange(64, dtype=np.uint64)]).astype(np.uint64).view(np.int64)
    around = F.explode(F.array(*map(F.lit, flips.tolist())))
    points = fps.select("fp", around.alias("flip")).select(F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), "fp")
    shared = points.groupBy("point").agg(F.min("fp").alias("first"), F.max("fp").alias("last")).where("first < last")
    return points.join(shared, "point").where("fp <> first").select(F.col("fp").alias("a"), F.col("first").alias("b"))


def links(ws, distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints that connect all within ``max_bits`` of each other."""
    keyed = ws.save("pivot_keys", _keyed(distinct, max_bits))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = ws.save("shared_keys", keyed.join(sizes, "key"))
    if max_bits != 2:  # groups beyond the bucket size are linked by middle points only at a radius of 2
        most = shared.agg(F.max("n")).first()[0] or 1
        return _links_of_sorted(shared.repartition("key").sortWithinPartitions("key", "fp"), max_bits, most)
    few, many = shared.where(F.col("n") <= BUCKET), shared.where(F.col("n") > BUCKET)
    found = _links_of_sorted(few.repartition("key").sortWithinPartitions("key", "fp"), max_bits, BUCKET)
    if many.isEmpty():
        return found
    return found.unionByName(_links_by_middle(many.select("fp").distinct()))


def near_groups(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, row_key, fingerprint, component_id, kept``.

    """
    ws = common.workspace(docs)
    rows = ws.save("fingerprints", signatures(docs, words, seed))
    distinct = ws.save("distinct_fingerprints", rows.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first")))
    roots = components(ws, links(ws, distinct, max_bits))
    members = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first")
    firsts = members.groupBy("root").agg(F.min("first").alias("best"))
    named = ws.save("component_names", members.join(firsts, "root").select(
        "fp", F.col("best.doc_id").alias("component_id"), F.col("best.row_key").alias("best_key")))
    return rows.join(named, "fp").select(
        "doc_id", "row_key", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        (F.col("row_key") == F.col("best_key")).alias("kept"))
