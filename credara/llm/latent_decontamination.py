"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into segments of ``SPAN`` words. Their TF-IDF matrix, with document frequencies counted over
the whole corpus, is reduced by a distributed randomised SVD: random projection, one power iteration and the two small
Gram matrices that make the factors orthonormal; products are joins and sums over the entries. Every document is read
as overlapping passages of two spans, so that each segment of a copied item lies in one passage whole. A passage's
latent vector is compared with those of all segments; pairs above a cosine are candidates. A word counts once in a
segment or passage, however often it is repeated there. Beside the cosine, which other words of a passage can dilute,
every place that shares ``GRAM`` words in a row with an item (or all words of a shorter one) is a candidate, too: no
verbatim copy depends on its surroundings. A candidate counts if the
longest common subsequence of the item and the words around the passage covers most of the item, or, for looser
paraphrases, a good part of it and nearly all of the answer as well (the last sentence, or what follows the last
question mark). A match of the last check names document and item.

Items are dealt into blocks of at most ``SEGMENTS`` segments and ``BLOCK_WORDS`` words (or one longer item), each with a
latent space of its own, and ``PASS_BLOCKS`` of them are searched in one pass over the documents: that bounds what is sent
to the tasks. A space has half as many directions as its block has segments (``rank_of``), so that segments share
directions and a passage is near an item whose words it replaces in part. All documents, passages with a feature and
segments are compared.

Null and empty texts contain nothing; items without words match nothing. Repeated rows, of either table, give
repeated results once for each pair of distinct row and item. Empty tables give an empty result.
"""

import re
import zlib
from collections import Counter
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from credara.llm import common

SPAN = 24
# Directions of a latent space: half the segments of a full block; small blocks keep more.
RANK = 192
LEAST_RANK = 32
OVERSAMPLING = 8
COSINE = 0.65
NEAR_VERBATIM = 0.8
PARAPHRASE = 0.6
ANSWER = 0.8
# Bounds of a block of more than one item.
SEGMENTS = 512
BLOCK_WORDS = 8192
# Blocks that are searched in one pass over the documents.
PASS_BLOCKS = 8
# Words in more than this share of all documents are no features, unless a segment has hardly any others.
COMMON = 0.05
LEAST_FEATURES = 6
# Words in a row that make a place a candidate whatever its cosine: an item keeps about as many if a fifth of its words
# are replaced.
GRAM = 4
# Characters worked on at once, and passages whose vectors are: few enough to stay in a core's cache.
CHUNK = 1_000_000
PASSAGES = 256

_WORDS = re.compile(r"[^\W_]+")


@cache
def _spaces() -> tuple[bytes, np.ndarray]:
    """For each byte, and each code point, itself inside of words and a space outside."""
    points = np.full(0x110000, 32, "<u4")
    for word in _WORDS.finditer("".join(map(chr, range(0x110000)))):
        points[word.start():word.end()] = range(word.start(), word.end())
    return bytes(p if p < 128 else 32 for p in points[:256].tolist()), points


def words_of(text: str | None) -> list[str]:
    """Letters and digits in a row, lower case."""
    text = (text or "").lower()
    some, points = _spaces()
    if text.isascii():
        return text.encode().translate(some).decode().split()
    return points[np.frombuffer(text.encode("utf-32-le"), "<u4")].tobytes().decode("utf-32-le").split()


def rank_of(segments: int) -> int:
    """Directions for a block of so many segments."""
    return min(segments, RANK, max(LEAST_RANK, segments // 2))


def answer_words(text: str) -> list[str]:
    """Words after the last question mark, or else of the last sentence."""
    after = text.rpartition("?")[2]
    if "?" in text and words_of(after):
        return words_of(after)
    return next((w for part in reversed(re.split(r"[.!?\n]", text)) if (w := words_of(part))), [])


def segments_of(words: list[str]) -> list[list[str]]:
    """Pieces of ``SPAN`` words; the last one ends where the words end."""
    starts = [*range(0, len(words) - SPAN, SPAN), max(0, len(words) - SPAN)] if words else []
    return [words[s:s + SPAN] for s in dict.fromkeys(starts)]


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, a bit for each place of ``a``."""
    places: dict[str, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for word in b:
        hit = row & places.get(word, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


# -- the benchmark, in blocks


def _items(benchmark: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id"), batch.column("text"), pa.array([words_of(t) for t in texts], pa.list_(pa.string()))],
                ["item_id", "text", "words"])

    source = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(run, "item_id long, text string, words array<string>").where("size(words) > 0").distinct()


def _blocks(items: DataFrame) -> list[DataFrame]:
    """Items dealt by a hash into as many blocks as it takes for each to be small or a single item."""
    n = 1
    while True:
        block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
        sizes = items.groupBy(block.alias("block")).agg(
            F.sum(F.size("words")).alias("words"), F.sum(F.ceil(F.size("words") / SPAN)).alias("segments"),
            F.count(F.lit(1)).alias("items"))
        if sizes.where(((F.col("words") > BLOCK_WORDS) | (F.col("segments") > SEGMENTS)) & (F.col("items") > 1)).isEmpty():
            return [items.where(block == i) for i in range(n)]
        n *= 2


# -- document frequencies


def _frequencies(docs: DataFrame, vocabulary: set[str]) -> dict[str, int]:
    """The number of documents that hold each of the words of some blocks."""
    def run(batches):
        total = Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total.update(vocabulary.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                         ["word", "n"])

    counts = common.map_batches(docs.select("text"), run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {r.word: r.n for r in counts.collect()}


def _features(items: list[tuple[int, str]], counts: dict[str, int], total: int) -> dict[str, float]:
    """Inverse document frequencies of the words that are features."""
    kept = set()
    for _, text in items:
        for segment in segments_of(words_of(text)):
            rare = {w for w in segment if counts.get(w, 0) <= COMMON * total}
            kept |= rare if len(rare) >= LEAST_FEATURES else set(segment)
    return {w: float(np.log((total + 1) / (counts.get(w, 0) + 0.5)) + 0.01) for w in sorted(kept)}


# -- randomised SVD


def _entries(items: DataFrame, idf: DataFrame) -> DataFrame:
    """``segment, word, w``: the TF-IDF matrix, rows of length one."""
    def run(batches):
        for batch in batches:
            rows = [(f"{i}:{zlib.crc32(t.encode())}:{k}", w)
                    for i, t, ws in zip(*(batch.column(c).to_pylist() for c in ("item_id", "text", "words")))
                    for k, segment in enumerate(segments_of(ws)) for w in sorted(set(segment))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.string(), pa.string()))], ["segment", "word"])

    raw = items.mapInArrow(run, "segment string, word string").join(idf, "word").select(
        "segment", "word", F.col("idf").alias("w"))
    norms = raw.groupBy("segment").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm")).where("norm > 0")
    return raw.join(norms, "segment").select("segment", "word", (F.col("w") / F.col("norm")).alias("w"))


def _rows(batch) -> np.ndarray:
    column = batch.column("v")
    return column.flatten().to_numpy().reshape(len(column), -1)


def _times(entries: DataFrame, vectors: DataFrame, on: str, by: str) -> DataFrame:
    """The matrix (or its transpose) times a table of row vectors: ``by, v``. A block's rows are few."""
    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            weighted = batch.column("w").to_numpy()[:, None] * _rows(batch)
            for key, row in zip(batch.column(by).to_pylist(), weighted):
                sums[key] = sums[key] + row if key in sums else row
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.list_(pa.float64()))],
                                         [by, "v"])

    return (entries.join(vectors, on).select(by, "w", "v").repartition(by)
            .mapInArrow(run, f"{by} string, v array<double>"))


def _gram(vectors: DataFrame, width: int) -> np.ndarray:
    """VᵀV of a table of row vectors, a matrix of ``width`` squared."""
    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            v = _rows(batch)
            total += v.T @ v
        yield pa.RecordBatch.from_arrays([pa.array(range(width)), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    rows = vectors.select("v").coalesce(8).mapInArrow(run, "i long, row array<double>")
    out = np.zeros((width, width))
    # the rows are those of one block; one matrix from each of a few partitions, row by row
    for r in rows.toLocalIterator():
        out[r.i] += r.row
    return out


def _turned(vectors: DataFrame, key: str, matrix: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            v = _rows(batch) @ matrix
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(list(v), pa.list_(pa.float64()))], [key, "v"])

    return vectors.select(key, "v").mapInArrow(run, f"{key} string, v array<double>")


def latent_words(ws, entries: DataFrame, rank: int = RANK) -> DataFrame:
    """``word, v``: right singular vectors of the matrix, ``rank`` numbers for each word."""
    width = rank + OVERSAMPLING

    def random(batches):
        for batch in batches:
            v = [np.random.default_rng(zlib.crc32(w.encode())).standard_normal(width) for w in batch.column("word").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(v, pa.list_(pa.float64()))], ["word", "v"])

    z = entries.select("word").distinct().mapInArrow(random, "word string, v array<double>")
    y = ws.save("svd_range", _times(entries, z, "word", "segment"))
    z = ws.save("svd_power", _times(entries, y, "segment", "word"))
    y = ws.save("svd_range", _times(entries, z, "word", "segment"))
    q = _turned(y, "segment", _whitener(_gram(y, width), width))
    b = ws.save("svd_small", _times(entries, q, "segment", "word"))
    return ws.save("svd_words", _turned(b, "word", _whitener(_gram(b, width), rank)))


def _whitener(gram: np.ndarray, rank: int) -> np.ndarray:
    """What turns row vectors with this Gram matrix into orthonormal columns, largest directions first."""
    values, directions = np.linalg.eigh(gram)
    order = np.argsort(values)[::-1][:rank]
    values, directions = values[order], directions[:, order]
    scale = np.where(values > 1e-9 * max(values.max(initial=0), 1e-300), 1 / np.sqrt(np.maximum(values, 1e-300)), 0)
    return directions * scale


# -- search


class Texts:
    """The words of some documents as numbers, in spans."""

    def __init__(self, texts: list[str], index: dict[str, int]):
        self.words = [words_of(t) for t in texts]
        self.counts = counts = np.array([len(w) for w in self.words], int)
        spans = -(-counts // SPAN)
        self.first = np.cumsum(spans) - spans
        self.ids = np.fromiter(map(index.get, (w for ws in self.words for w in ws), repeat(-1)), np.int64, counts.sum())
        self.place = np.arange(len(self.ids)) - np.repeat(np.cumsum(counts) - counts, counts)
        self.span = np.repeat(self.first, counts) + self.place // SPAN
        self.document = np.repeat(np.arange(len(counts)), spans)
        # a passage is a span and the next one of the same document
        self.follows = np.ones(int(spans.sum()), bool)
        self.follows[(self.first + spans - 1)[spans > 0]] = False
        known = self.ids >= 0
        self.held_id, self.held_span = self.ids[known], self.span[known]
        # each word of a span once, and whether the next span of the passage repeats it
        size = max(1, len(index))
        each = np.unique(self.held_span * size + self.held_id)
        self.each_span, self.each_id = each // size, each % size
        after = np.minimum(np.searchsorted(each, each + size), len(each) - 1)
        self.again = (each[after] == each + size) & self.follows[self.each_span]


def _runs(ids: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` numbers."""
    h = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    for k in range(n if len(h) else 0):
        h = (h ^ ids[k:k + len(h)].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h


class Runs:
    """Places that share words in a row with an item, for all items of a pass."""

    def __init__(self, items: list[tuple[int, int, list[str]]], index: dict[str, int]):
        found: dict[int, set] = {}
        for block, n, words in items:
            length = min(GRAM, len(words))
            hashes = _runs(np.array([index[w] for w in words], np.int64), length).tolist()
            found.setdefault(length, set()).update((h, block, n) for h in hashes)
        self.tables = {}
        for length, some in found.items():
            owners: dict[int, list] = {}
            for h, block, n in sorted(some):
                owners.setdefault(h, []).append((block, n))
            seen = np.zeros(1 << 20, bool)
            seen[np.array(list(owners), np.uint64) >> np.uint64(44)] = True
            self.tables[length] = owners, np.packbits(seen)

    def candidates(self, texts: Texts) -> dict[int, dict[tuple[int, int, int], None]]:
        """For each block ``document, item, first word of the passage``."""
        out: dict[int, dict] = {}
        known = np.concatenate([[0], np.cumsum(texts.ids >= 0)])
        left = np.repeat(texts.counts, texts.counts) - texts.place
        for length, (owners, packed) in self.tables.items():
            hashes = _runs(texts.ids, length)
            at = np.arange(len(hashes))
            at = at[(known[length:] - known[:len(hashes)] == length) & (left[:len(hashes)] >= length)]
            at = at[np.unpackbits(packed).view(bool)[hashes[at] >> np.uint64(44)]]
            spans = texts.span[at]
            for h, span in dict.fromkeys(zip(hashes[at].tolist(), spans.tolist())):
                d = int(texts.document[span])
                for block, n in owners.get(h, ()):
                    out.setdefault(block, {})[d, n, int(span - texts.first[d]) * SPAN] = None
        return out


class Retriever:
    """The items of one block in latent space."""

    def __init__(self, items: list[tuple[int, str]], idf: dict[str, float], latent: dict[str, list[float]], cosine: float):
        self.ids, self.cosine = [i for i, _ in items], cosine
        self.words = [words_of(t) for _, t in items]
        self.times = [Counter(w) for w in self.words]
        self.answers = [answer_words(t) for _, t in items]
        self.index = {w: i for i, w in enumerate(sorted(set(latent)))}
        self.table = np.array([np.array(latent[w]) * idf[w] for w in self.index], np.float32).reshape(len(self.index), -1)
        cut = [(n, s) for n, w in enumerate(self.words) for s in segments_of(w)]
        self.item_of = np.array([n for n, _ in cut], int)
        self.queries = _unit(np.array([self._sum(s) for _, s in cut], np.float32).reshape(len(cut), -1))

    def _sum(self, words: list[str]) -> np.ndarray:
        return self.table[[self.index[w] for w in sorted(set(words)) if w in self.index]].sum(axis=0)

    def number(self, index: dict[str, int]) -> None:
        """Learn the numbers by which ``Texts`` names words."""
        self.row = np.array([self.index.get(w, -1) for w in index], np.int32)

    def candidates(self, texts: Texts):
        """``document, item, first word of the passage, cosine`` for some documents."""
        total = len(texts.follows)
        held = np.bincount(texts.held_span[self.row[texts.held_id] >= 0], minlength=total + 1)[:total + 1]
        # a passage without any feature has no direction
        enough = np.flatnonzero(held[:-1] + held[1:] * texts.follows)
        row = self.row[texts.each_id]
        some = row >= 0
        row, span, again = row[some], texts.each_span[some], texts.again[some]
        for at in range(0, len(enough), PASSAGES):
            some = enough[at:at + PASSAGES]
            low, high = np.searchsorted(span, (some[0], some[-1] + 2))
            whole = self._sums(row[low:high], span[low:high] - some[0], some[-1] + 2 - some[0])
            twice = again[low:high]
            repeated = self._sums(row[low:high][twice], span[low:high][twice] - some[0], len(whole))
            here = some - some[0]
            near = _unit(whole[here] - repeated[here] + whole[here + 1] * texts.follows[some, None]) @ self.queries.T
            p, s = np.nonzero(near >= self.cosine)
            d = texts.document[some[p]]
            start = (some[p] - texts.first[d]) * SPAN
            yield from zip(d.tolist(), self.item_of[s].tolist(), start.tolist(), near[p, s].tolist())

    def _sums(self, row: np.ndarray, span: np.ndarray, n: int) -> np.ndarray:
        """For each of ``n`` spans the sum of its rows of the table."""
        sums = np.zeros((n, self.table.shape[1]), np.float32)
        if len(row):
            starts = np.flatnonzero(np.diff(span, prepend=-1))
            sums[span[starts]] = np.add.reduceat(self.table[row], starts)
        return sums

    def cosine_of(self, words: list[str], n: int) -> float:
        """The best cosine of a passage and the segments of an item."""
        return float((self.queries[self.item_of == n] @ _unit(self._sum(words)[None])[0]).max())

    def matches(self, texts: Texts, shared_runs: dict[tuple[int, int, int], None]):
        """``document, item_id, cosine, share of the item, share of the answer`` of confirmed pairs, the best of each."""
        best: dict[tuple[int, int], tuple] = {}
        seen = set()
        for d, n, start, cosine in self.candidates(texts):
            seen.add((d, n, start))
            if shares := self.confirmed(texts.words[d], n, start):
                best[d, n] = max(best.get((d, n), (0.0, 0.0, 0.0)), (*shares, cosine))
        for d, n, start in shared_runs:
            if (d, n, start) in seen or best.get((d, n), ())[:2] == (1.0, 1.0):
                continue  # nothing can be better
            if shares := self.confirmed(texts.words[d], n, start):
                cosine = self.cosine_of(texts.words[d][start:start + 2 * SPAN], n)
                best[d, n] = max(best.get((d, n), (0.0, 0.0, -1.0)), (*shares, cosine))
        for (d, n), (shared, answered, cosine) in sorted(best.items()):
            yield d, self.ids[n], cosine, shared, answered

    def confirmed(self, words: list[str], n: int, start: int) -> tuple[float, float] | None:
        """Share of the item and of its answer around a passage, if they make a match."""
        item, answer = self.words[n], self.answers[n]
        around = words[max(0, start - len(item)):start + 2 * SPAN + len(item)]
        times = self.times[n]
        missing = times.keys() - around
        # no subsequence can be long enough; each missing word counts at least once
        if len(item) - len(missing) < PARAPHRASE * len(item):
            return None
        if len(item) - sum(times[w] for w in missing) < PARAPHRASE * len(item):
            return None
        shared = common_subsequence(item, around) / len(item)
        if shared < PARAPHRASE:
            return None
        answered = common_subsequence(answer, around) / len(answer) if answer else 0.0
        return (shared, answered) if shared >= NEAR_VERBATIM or answered >= ANSWER else None


def _unit(v: np.ndarray) -> np.ndarray:
    norms = np.sqrt((v * v).sum(axis=1, keepdims=True))
    return np.divide(v, norms, out=np.zeros_like(v), where=norms > 1e-6)


def contaminated(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``doc_id, row_key, item_id, cosine, item_share, answer_share``: a row for each document and item it contains."""
    ws = common.workspace(docs)
    source = common.texts(docs)
    total = source.count()
    items = ws.save("items", _items(benchmark))
    blocks, out = _blocks(items), None
    for at in range(0, len(blocks), PASS_BLOCKS):
        lists = [[(r.item_id, r.text) for r in b.select("item_id", "text").collect()] for b in blocks[at:at + PASS_BLOCKS]]
        counts = _frequencies(source, {w for some in lists for _, text in some for w in words_of(text)})
        retrievers = []
        for block, some in zip(blocks[at:], lists):
            if some:
                idf = _features(some, counts, total)
                table = docs.sparkSession.createDataFrame(list(idf.items()), "word string, idf double")
                entries = ws.save("entries", _entries(block, table))
                rank = rank_of(sum(len(segments_of(words_of(text))) for _, text in some))
                latent = {r.word: r.v for r in latent_words(ws, entries, rank).collect()}
                retrievers.append(Retriever(some, idf, latent, cosine))
        one = _search(source, retrievers)
        out = one if out is None else out.unionByName(one)
    return out


def _search(source: DataFrame, retrievers: list[Retriever]) -> DataFrame:
    schema = "doc_id long, row_key string, item_id long, cosine double, item_share double, answer_share double"
    types = (pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
    index = {w: i for i, w in enumerate(sorted({w for r in retrievers for words in r.words for w in words}))}
    for r in retrievers:
        r.number(index)
    runs = Runs([(b, n, words) for b, r in enumerate(retrievers) for n, words in enumerate(r.words)], index)

    def run(batches):
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id").to_pylist()
            rows, at = [], 0
            while at < len(texts):
                size, stop = 0, at
                while stop < len(texts) and (size < CHUNK or stop == at):
                    size += len(texts[stop])
                    stop += 1
                some = Texts(texts[at:stop], index)
                shared = runs.candidates(some)
                rows += [(ids[at + d], common.row_key_of(ids[at + d], texts[at + d]), *match)
                         for b, retriever in enumerate(retrievers) for d, *match in retriever.matches(some, shared.get(b, {}))]
                at = stop
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                                             [c.split()[0] for c in schema.split(", ")])

    return common.map_batches(source, run, schema)
