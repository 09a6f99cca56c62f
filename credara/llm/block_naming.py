"""Exact deduplication by deterministic block naming.

A text (A-Z lowered) is cut into blocks of a fixed number of bytes. The distinct blocks are sorted and numbered: equal
blocks share an integer name, different ones never do. Neighbouring names are then paired, the distinct pairs sorted
and numbered, and so on until one name is left for each text. Two texts are equal exactly if they have the same number
of blocks and the same last name; no hash decides.

The content of a block is shuffled once, compressed (equal blocks compress to equal bytes, different ones to different
ones), after each task has made its blocks distinct. Blocks are routed by a hash of eight bytes, which is all that
texts carry further. Should two different blocks share a hash, they are told apart by their content, in a pass that
reads such blocks only. Names are the sorted place inside a shuffle partition, so no single task sees all of them, and
a round's names are stored before they are used. The number of rounds is the logarithm of the longest text.

Null counts as the empty text; empty texts are equal to each other. A null doc_id sorts before all others: it stays
only in a group without any other doc_id. Of rows that repeat the same doc_id and text, one stays. Texts of any length
are cut into blocks one after the other. An empty table gives no row.
"""

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from credara.llm import common

BLOCK_BYTES = 4096
# Hash values that route blocks to tasks.
ROUTES = 1 << 63


def exact_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES, routes: int = ROUTES) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, row_key, text_sha256, n_blocks, name, keep_id, keep_key,
    group_size, kept``."""
    ws = common.workspace(docs)
    source = common.texts(docs)
    listed = ws.save("block_lists", _block_lists(source, block_bytes, routes)
                     .withColumn("row", F.monotonically_increasing_id()))
    named = _name_blocks(ws, source, listed, block_bytes, routes)
    identity = ws.save("identities", _reduce(ws, named))
    return _groups(listed.select("row", "doc_id", "row_key", "text_sha256", "n_blocks"), identity)


def _blocks(text: bytes, size: int) -> list[bytes]:
    return [text[i:i + size] for i in range(0, len(text), size)] or [b""]


def _lowered(batch) -> list[bytes]:
    return pc.cast(pc.ascii_lower(batch.column("text")), pa.binary()).to_pylist()


def _route(block: bytes, routes: int) -> int:
    return xxhash.xxh64_intdigest(block) % routes


def _block_lists(source: DataFrame, size: int, routes: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            raw = batch.column("text").to_pylist()
            low = _lowered(batch)
            ways = [[_route(b, routes) for b in _blocks(t, size)] for t in low]
            keys = [common.row_key_of(i, t) for i, t in zip(batch.column("doc_id").to_pylist(), raw)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys), pa.array([hashlib.sha256(t).hexdigest() for t in low]),
                 pa.array([len(w) for w in ways], pa.int32()), pa.array(ways, pa.list_(pa.int64()))],
                ["doc_id", "row_key", "text_sha256", "n_blocks", "routes"])

    return common.map_batches(
        source, run, "doc_id long, row_key string, text_sha256 string, n_blocks int, routes array<long>")


def _distinct_blocks(source: DataFrame, size: int, routes: int) -> DataFrame:
    """``route, block`` of the different blocks, compressed."""
    def run(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            blocks = list({b for t in _lowered(batch) for b in _blocks(t, size)})
            yield pa.RecordBatch.from_arrays(
                [pa.array([_route(b, routes) for b in blocks], pa.int64()),
                 pa.array([packer.compress(b) for b in blocks], pa.binary())], ["route", "block"])

    return common.map_batches(source, run, "route long, block binary").distinct()


def _numbered(distinct: DataFrame, *keys: str) -> DataFrame:
    """Sorted inside each shuffle partition; the partition and the place there make the name."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def _name_blocks(ws, source: DataFrame, listed: DataFrame, size: int, routes: int) -> DataFrame:
    """``row, n_blocks, names`` with the names of a text's blocks in order."""
    distinct = _distinct_blocks(source, size, routes)
    names = ws.save("block_names", _numbered(distinct, "route", "block").select("route", "name"))
    # one row for a route, and how many different blocks it stands for
    lone = ws.save("routes", names.groupBy("route").agg(F.min("name").alias("name"), F.count(F.lit(1)).alias("alike")))
    places = listed.select("row", "n_blocks", F.posexplode("routes").alias("place", "route"))
    found = places.join(lone.select("route", "name"), "route")
    shared = lone.where("alike > 1").select("route")
    if not shared.isEmpty():
        # names below zero, so that they differ from those of lone blocks
        told = _numbered(distinct.join(shared, "route", "left_semi").repartition("route"), "route", "block")
        told = ws.save("shared_blocks", told.withColumn("name", -F.col("name") - 1))
        content = _shared_blocks(source, listed, told, size, routes).select("row", "place", F.col("name").alias("told"))
        found = (found.join(content, ["row", "place"], "left")
                 .withColumn("name", F.coalesce("told", "name")).drop("told"))
    return _gather(found)


def _shared_blocks(source: DataFrame, listed: DataFrame, shared: DataFrame, size: int,
                   routes: int) -> DataFrame:
    """``row, place, name`` of the blocks whose route stands for several different blocks, by content."""
    def run(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            raw = batch.column("text").to_pylist()
            keys = [common.row_key_of(i, t) for i, t in zip(batch.column("doc_id").to_pylist(), raw)]
            rows = [(k, place, _route(b, routes), packer.compress(b)) for k, t in zip(keys, _lowered(batch))
                    for place, b in enumerate(_blocks(t, size))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.string(), pa.int32(), pa.int64(), pa.binary()))], ["row_key", "place", "route", "block"])

    content = common.map_batches(source, run, "row_key string, place int, route long, block binary")
    told = content.join(shared, ["route", "block"]).select("row_key", "place", "name").distinct()
    return listed.select("row", "row_key").join(told, "row_key").select("row", "place", "name")


def _gather(places: DataFrame) -> DataFrame:
    """Names of each text in order of their places; a text's list is as long as its blocks."""
    return (places.groupBy("row", "n_blocks")
            .agg(F.sort_array(F.collect_list(F.struct("place", "name"))).alias("at"))
            .select("row", "n_blocks", F.col("at.name").alias("names")))


def _reduce(ws, named: DataFrame) -> DataFrame:
    """Name neighbouring pairs until every text has one name: ``row, name``."""
    done, level = [], 0
    current = ws.save("names0", named)
    while True:
        done.append(current.where(F.size("names") == 1).select("row", F.col("names")[0].alias("name")))
        rest = current.where(F.size("names") > 1)
        if rest.isEmpty():
            break
        level += 1
        pairs = F.transform(F.sequence(F.lit(0), F.expr("(size(names) - 1) div 2")), lambda i: F.struct(
            F.get("names", 2 * i).alias("a"), F.coalesce(F.get("names", 2 * i + 1), F.lit(-1)).alias("b")))
        places = rest.select("row", "n_blocks", F.posexplode(pairs).alias("place", "pair")).select(
            "row", "n_blocks", "place", "pair.a", "pair.b")
        numbered = _numbered(places.select("a", "b").distinct().repartition("a", "b"), "a", "b")
        names = ws.save(f"pairs{level}", numbered)
        current = ws.save(f"names{level}", _gather(places.join(names, ["a", "b"])))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _groups(listed: DataFrame, identity: DataFrame) -> DataFrame:
    rows = listed.join(identity, "row")
    best = F.max(F.struct(F.col("doc_id").isNotNull(), "doc_id", "row_key", "row"))
    groups = rows.groupBy("n_blocks", "name").agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select("n_blocks", "name", F.col("best.doc_id").alias("keep_id"),
                           F.col("best.row_key").alias("keep_key"), F.col("best.row").alias("keep_row"), "group_size")
    return (rows.join(groups, ["n_blocks", "name"])
            .select("doc_id", "row_key", "text_sha256", "n_blocks", "name", "keep_id", "keep_key", "group_size",
                    (F.col("row") == F.col("keep_row")).alias("kept")))
