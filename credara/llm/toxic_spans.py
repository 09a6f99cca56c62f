"""Toxicity by a linear-chain conditional random field over the words of a text.

The field has two states for each word, clean and toxic. Features are the word (lower case), its beginnings and its
end; neighbouring states are tied by four weights. Forward-backward gives each word's probability of being toxic
(its marginal); the marginals of a text add up to a document score, and the words above one half are its offending
spans. A text is one chain, whatever its length: it is laid out in rows of ``STRETCH`` words, and messages are carried
exactly from row to row.

Labels are known for documents only. Words are labelled from them: in a toxic document, those whose form or
beginning occurs in toxic documents far more often than in clean ones. Training uses at most ``TRAINING_ROWS``
documents of either label (a bounded sample, chosen by a hash of the id), texts of up to ``TRAINING_CHARS``
characters, and fits the weights piece by piece, on stretches of ``STRETCH`` words with and without signs; scoring covers every row and whole texts. Documents whose crc32(doc_id as text) is divisible by 5 are
never learned from, so that they measure the result.

Null and empty texts have no words and get the score of a text without any sign. Without a label of either kind every
score is that of the labels seen, or zero. Repeated label rows of a document count once, as toxic if any says so; null
labels are ignored. Rows are scored by their text alone.
"""

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from credara.llm import common

TRAINING_ROWS = 2500
TRAINING_CHARS = 8_000
STRETCH = 64
FEATURE_BITS = 18
EPOCHS = 6
# Words a Python worker remembers the weight of, those it learns at once, and characters it works on at once.
CACHE = 400_000
LEARNED = 10_000
CHUNK = 500_000

_WORDS = re.compile(r"[^\W\d_]+")


def is_held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _shapes(word: str) -> list[str]:
    """The word and its beginnings: what can mark it as toxic."""
    return [word, *(word[:k] + "-" for k in (4, 5, 6) if len(word) > k)]


def _features(word: str) -> list[int]:
    """One number for each of six features; a short word repeats its own."""
    word = word.lower()
    parts = (word, word[:4] + "-", word[:5] + "-", word[:6] + "-", "-" + word[-3:], "*")
    return [zlib.crc32(p.encode()) & (1 << FEATURE_BITS) - 1 for p in parts]


def _marginals(gain: np.ndarray, tie: np.ndarray, inside: np.ndarray):
    """Forward-backward over rows of stretches.

    ``gain`` is the weight of state toxic over clean at each place, ``tie[i, j]`` that of state j after i, ``inside``
    the places that hold a word. Returns the marginals, and the expected number of each transition.
    """
    rows, length = gain.shape
    step, up = np.exp(tie), np.exp(np.clip(gain, -30, 30))
    ahead, behind = np.empty((length, 2, rows)), np.ones((length, 2, rows))
    ahead[0, 0], ahead[0, 1] = 1, up[:, 0]
    ahead[0] /= ahead[0].sum(axis=0)
    for t in range(1, length):
        a = step.T @ ahead[t - 1]
        a[1] *= up[:, t]
        ahead[t] = a / a.sum(axis=0)
    for t in range(length - 2, -1, -1):
        b = behind[t + 1].copy()
        b[1] *= up[:, t + 1]
        b = step @ b
        # after the last word nothing follows
        behind[t] = np.where(inside[:, t + 1], b / b.sum(axis=0), 1.0)
    both = ahead * behind
    marginal = (both[:, 1] / both.sum(axis=1)).T
    pairs = np.zeros((2, 2))
    for t in range(1, length):
        joint = ahead[t - 1][:, None] * step[:, :, None] * behind[t][None] * np.stack([np.ones(rows), up[:, t]])[None]
        joint = joint / joint.sum(axis=(0, 1))
        pairs += (joint * inside[:, t]).sum(axis=2)
    return marginal, pairs


def _next(ratio, step: np.ndarray):
    """Message ratio (toxic over clean) that a place hands to the next one, from its own."""
    return (step[0, 1] + ratio * step[1, 1]) / (step[0, 0] + ratio * step[1, 0])


def _previous(ratio, step: np.ndarray):
    """Message ratio that a place hands to the one before it."""
    return (step[1, 0] + ratio * step[1, 1]) / (step[0, 0] + ratio * step[0, 1])


def _behind(up: np.ndarray, step: np.ndarray, last: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Messages from the right at each place; ``end`` is the one that comes in after place ``last``."""
    length = len(up)
    behind = np.empty_like(up)
    behind[length - 1] = end
    for t in range(length - 2, -1, -1):
        behind[t] = np.where(t < last, _previous(up[t + 1] * behind[t + 1], step), end)
    return behind


def _whole(up: np.ndarray, step: np.ndarray) -> list[np.ndarray]:
    """The product of gains and transitions over each column of ``up``, every place in use: four numbers a column."""
    zero = np.zeros(up.shape[1])
    a, b, c, d = zero + 1, zero, zero, up[0]
    for t in range(1, len(up)):
        a, b = a * step[0, 0] + b * step[1, 0], (a * step[0, 1] + b * step[1, 1]) * up[t]
        c, d = c * step[0, 0] + d * step[1, 0], (c * step[0, 1] + d * step[1, 1]) * up[t]
        if t % 4 == 0:
            size = a + b + c + d
            a, b, c, d = a / size, b / size, c / size, d / size
    return [a, b, c, d]


def _only_marginals(gain: np.ndarray, tie: np.ndarray, last: np.ndarray, goes_on: np.ndarray) -> np.ndarray:
    """As ``_marginals``, with the two states as one ratio: fast enough for every word of a corpus.

    Rows with ``goes_on`` are full and continued by the next row, as one chain: each is summed up as a matrix, the
    messages between rows are carried through these, first to last and back, and then all rows are worked on at once.
    """
    step = np.exp(tie)
    up = np.ascontiguousarray(np.exp(np.clip(gain, -30, 30)).T.astype(np.float32))
    length, rows = up.shape
    start, end = np.ones(rows), np.ones(rows)
    full = np.flatnonzero(goes_on)
    if len(full):
        a, b, c, d = (np.ones(rows) for _ in range(4))
        a[full], b[full], c[full], d[full] = _whole(up[:, full].astype(float), step)
        continued = np.concatenate([[False], goes_on[:-1]])
        tails = np.flatnonzero(~goes_on & continued)
        some = up[:, tails].astype(float)
        into = np.ones(rows)
        into[tails] = some[0] * _behind(some, step, last[tails], np.ones(len(tails)))[0]
        # chains by their number of rows, longest first: those with a row at place k are the first ones
        first = np.flatnonzero(goes_on & ~continued)
        count = tails - first + 1
        order = np.argsort(-count, kind="stable")
        first, tails, count = first[order], tails[order], count[order]
        many = np.searchsorted(-count, -np.arange(count[0] + 1), side="left")  # chains of more than k rows
        for k in range(1, count[0]):
            r = first[:many[k]] + k - 1
            start[r + 1] = _next((b[r] + start[r] * d[r]) / (a[r] + start[r] * c[r]), step)
            r = tails[:many[k]] - k
            end[r] = _previous(into[r + 1], step)
            into[r] = (c[r] + end[r] * d[r]) / (a[r] + end[r] * b[r])
    step = step.astype(np.float32)
    ahead = np.empty_like(up)
    ahead[0] = up[0] * start
    for t in range(1, length):
        ahead[t] = up[t] * _next(ahead[t - 1], step)
    odds = (ahead * _behind(up, step, last, end.astype(np.float32))).T
    return odds / (1 + odds)


@dataclass
class Model:
    weights: np.ndarray       # of features for state toxic
    tie: np.ndarray           # of transitions
    scale: np.ndarray         # constant, largest marginal, expected toxic words: to a document's log odds

    def __post_init__(self):
        self._known: dict[str, float] = {}

    def __getstate__(self):
        return self.weights, self.tie, self.scale

    def __setstate__(self, state):
        self.weights, self.tie, self.scale = state
        self._known = {}

    def _learn(self, words: list[str]) -> None:
        if len(self._known) > CACHE:
            self._known = {}
        for i in range(0, len(words), LEARNED):
            some = words[i:i + LEARNED]
            at = np.array([_features(w) for w in some])
            self._known.update(zip(some, self.weights[at].sum(axis=1).tolist()))

    def words(self, texts: list[str]) -> list[np.ndarray]:
        """The marginal of every word of each text."""
        split = [_WORDS.findall(t) for t in texts]
        flat = [w for words in split for w in words]
        if not flat:
            return [np.empty(0) for _ in texts]
        gains = list(map(self._known.get, flat))
        if None in gains:
            new = list({w for w, g in zip(flat, gains) if g is None})
            if len(self._known) + len(new) > CACHE:
                new = list(set(flat))
            self._learn(new)
            gains = list(map(self._known.get, flat))
        counts = np.array([len(w) for w in split])
        gain, at, last, goes_on = _stretches(np.array(gains, np.float32), counts)
        marginal = _only_marginals(gain, self.tie, last, goes_on)[at]
        return np.split(marginal, np.cumsum(counts)[:-1])

    def scores(self, texts: list[str]):
        """Score and offending spans of each text, some texts at a time."""
        chunk, length = [], 0
        for i, text in enumerate(texts):
            chunk.append(text)
            length += len(text)
            if length >= CHUNK or i == len(texts) - 1:
                marginals = self.words(chunk)
                score = self.document_scores(marginals)
                for t, m, s in zip(chunk, marginals, score.tolist()):
                    bad = set(np.flatnonzero(m > 0.5).tolist())
                    spans = [x.span() for k, x in enumerate(_WORDS.finditer(t)) if k in bad] if bad else []
                    yield s, spans
                chunk, length = [], 0

    def document_scores(self, marginals: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-(_document_signs(marginals) @ self.scale)))


def _stretches(values: np.ndarray, counts: np.ndarray):
    """Rows of ``STRETCH`` places for texts of ``counts`` words: the values, each word's place, each row's last one, and
    whether the text goes on in the next row."""
    start = np.cumsum(counts) - counts
    within = np.arange(len(values)) - np.repeat(start, counts)
    rows_of = -(-counts // STRETCH)
    first = np.cumsum(rows_of) - rows_of
    at = np.repeat(first, counts) + within // STRETCH, within % STRETCH
    rows = np.zeros((int(rows_of.sum()), STRETCH), values.dtype)
    rows[at] = values
    last = np.bincount(at[0], minlength=len(rows)) - 1
    goes_on = np.ones(len(rows), bool)
    goes_on[(first + rows_of - 1)[rows_of > 0]] = False
    return rows, at, last, goes_on


def _document_signs(marginals: list[np.ndarray]) -> np.ndarray:
    most = np.array([m.max(initial=0) for m in marginals])
    return np.stack([np.ones(len(most)), most, np.log1p([m.sum() for m in marginals])], axis=1)


def _toxic_shapes(split: list[list[str]], toxic: np.ndarray) -> set[str]:
    """Words and beginnings far more frequent in toxic documents: those of a fair share of them, and rarer ones as
    long as they explain toxic documents that no other does (else words of a few copied documents would count)."""
    clean: Counter = Counter()
    where: dict[str, set[int]] = {}
    for i, (words, label) in enumerate(zip(split, toxic)):
        shapes = {s for w in set(words) for s in _shapes(w)}
        if label:
            for s in shapes:
                where.setdefault(s, set()).add(i)
        else:
            clean.update(shapes)
    n = max(1, int((toxic == 0).sum())), max(1, int((toxic == 1).sum()))
    where = {s: d for s, d in where.items() if len(d) >= 3 and len(d) / n[1] > 25 * (clean[s] + 0.3) / n[0]}
    chosen = {s for s, d in where.items() if len(d) >= max(4, 0.02 * n[1])}
    open_docs = set(np.flatnonzero(toxic == 1).tolist()).difference(*(where[s] for s in chosen))
    while where:
        best = max(where, key=lambda s: (len(where[s] & open_docs), len(where[s]), s))
        if len(where[best] & open_docs) < max(3, 0.004 * n[1]):
            break
        chosen.add(best)
        open_docs -= where.pop(best)
    return chosen


def fit(rows: list[tuple[str, int]], odds: float) -> Model:
    """A model from texts and labels; ``odds`` are those of a toxic document in the corpus' labels."""
    rows = sorted(set(rows))
    toxic = np.array([label for _, label in rows], int)
    rng = np.random.default_rng(7)
    weights, tie = np.zeros(1 << FEATURE_BITS), np.zeros((2, 2))
    if len(set(toxic.tolist())) < 2:
        return Model(weights, tie, np.array([0.0 if not len(toxic) else 20.0 * toxic[0] - 10.0, 0, 0]))
    split = [[w.lower() for w in _WORDS.findall(t)] for t, _ in rows]
    shapes = _toxic_shapes(split, toxic)
    marks: dict[str, bool] = {}
    for word in {w for words in split for w in words}:
        marks[word] = not shapes.isdisjoint(_shapes(word))
    # clean stretches far outnumber the others: each epoch takes all labelled ones and as many others
    numbers = {w: i for i, w in enumerate(marks)}
    table = np.array([_features(w) for w in marks] or np.empty((0, 6)), int)
    counts = np.array([len(w) for w in split])
    flat = np.array([numbers[w] for words in split for w in words], int)
    target = np.array([marks[w] for words in split for w in words], bool) & np.repeat(toxic == 1, counts)
    number, at, last, _ = _stretches(flat, counts)
    labels = np.zeros(number.shape, bool)
    labels[at] = target
    inside = np.arange(STRETCH) <= last[:, None]
    signs = np.flatnonzero(labels.any(axis=1))
    others = np.flatnonzero(~labels.any(axis=1))
    square, square_tie = np.full(len(weights), 1e-6), np.full((2, 2), 1e-6)
    for _ in range(EPOCHS if len(signs) else 0):
        some = np.concatenate([signs, rng.choice(others, min(len(others), 3 * len(signs)), replace=False)])
        rng.shuffle(some)
        for i in range(0, len(some), 256):
            r = some[i:i + 256]
            features, here = table[number[r]], inside[r]
            gain = np.where(here, weights[features].sum(axis=2), 0)
            marginal, pairs = _marginals(gain, tie, here)
            error = np.where(here, labels[r] - marginal, 0)
            slope = np.bincount(features[here].ravel(), np.repeat(error[here], features.shape[2]), len(weights))
            slope -= 1e-3 * weights * (slope != 0)
            square += slope ** 2
            weights += 0.5 * slope / np.sqrt(square)
            seen = np.zeros((2, 2))
            y, both = labels[r].astype(int), here[:, 1:]
            np.add.at(seen, (y[:, :-1][both], y[:, 1:][both]), 1)
            slope = seen - pairs
            square_tie += slope ** 2
            tie += 0.1 * slope / np.sqrt(square_tie)
    model = Model(weights, tie, np.zeros(3))
    marginals = [m for i in range(0, len(rows), 500) for m in model.words([t for t, _ in rows[i:i + 500]])]
    signs = _document_signs(marginals)
    share = odds / (1 + odds)
    each = np.where(toxic == 1, share / (toxic == 1).sum(), (1 - share) / (toxic == 0).sum())
    model.scale = _logistic(signs, toxic, each)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, each: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton steps, slightly held back."""
    scale, hold = np.zeros(x.shape[1]), np.diag([1e-6, 1e-5, 1e-5])
    for _ in range(60):
        p = 1 / (1 + np.exp(-(x @ scale)))
        slope = x.T @ (each * (y - p)) - hold @ scale
        bend = (x * (each * p * (1 - p))[:, None]).T @ x + hold
        scale = scale + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return scale


def train(docs: DataFrame, labels: DataFrame, max_rows: int = TRAINING_ROWS, max_chars: int = TRAINING_CHARS) -> Model:
    """Fit a model on at most ``max_rows`` different rows of either label."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
             .where(~is_held_out(F.col("doc_id"))))
    share = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    source = common.texts(docs).where(F.length("text") <= max_chars).withColumn("chosen", F.xxhash64("doc_id", "text"))
    # hashes are ranked alone; an id may stand on any number of rows
    labelled = source.select("doc_id", "chosen").join(known, "doc_id").distinct()
    picked = None
    for label in (0, 1):
        some = labelled.where(F.col("toxic") == label).orderBy("chosen", "doc_id").limit(max_rows)
        picked = some if picked is None else picked.unionByName(some)
    sample = (source.join(F.broadcast(picked), ["doc_id", "chosen"]).dropDuplicates(["doc_id", "chosen"])
              .select("text", "toxic"))
    rows = [(r[0], r[1]) for r in sample.toLocalIterator()]
    return fit(rows, share.get(1, 0) / max(1, share.get(0, 0)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, spans`` for each row: spans are code points, the end exclusive."""
    def run(batches):
        for batch in batches:
            found = list(model.scores(batch.column("text").to_pylist()))
            spans = pa.array([[{"start": a, "stop": b} for a, b in s] for _, s in found],
                             pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s for s, _ in found], pa.float64()), spans],
                ["doc_id", "score", "spans"])

    return common.map_batches(
        common.texts(docs), run, "doc_id long, score double, spans array<struct<start:long,stop:long>>")


def keep_clean(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` scored below ``limit``, all columns."""
    common.bound_batches(docs.sparkSession, common.ROW_BATCH_BYTES)

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array([s < limit for s, _ in model.scores(texts)], pa.bool_()))

    return common.map_batches(docs, run, docs.schema)
