"""Main text of web pages by a recurrent block labeller.

A page is read into its leaf blocks: runs of text between block-level tags, each with the path of open tags. A block
becomes a vector of hashed path parts (tags, classes, ids, roles), hashed words and a few measures. A bidirectional
LSTM in numpy reads all blocks of the page, so each is judged with the whole page as context, and labels it main text
or not. Main blocks, in page order, make the page's text.

The labeller is trained here, on a bounded sample of pages whose own structure tells the answer (``TRAINING_PAGES``
pages of up to ``TRAINING_CHARS`` characters, chosen by a hash of the id): what lies in ``article`` or ``main`` and in
no part that names itself as something else. Variations of these pages with other names for their parts, and with
notices, sidebars, forms and comments put in, teach it to do without those two tags. Extraction covers every page and
all of its blocks.

The sample is taken among the pages whose structure tells the answer. Where no page of a table does, nothing is learned:
main text is then every block that lies in no part that names itself as something else.

Null and empty pages, and pages without main blocks, give the empty text. Broken mark-up is read as far as it goes.
Rows are independent of each other.
"""

import html
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from credara.llm import common

TRAINING_PAGES = 240
TRAINING_CHARS = 60_000
HIDDEN = 12
PATH_BUCKETS = 64
WORD_BUCKETS = 24
EPOCHS = 10
_WIDTH = PATH_BUCKETS + WORD_BUCKETS + 4

# Element names by their meaning in HTML.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "section select summary table tbody td textarea tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Names by which parts of pages say what they are.
MAIN_PARTS = frozenset("article main".split())
OTHER_PARTS = frozenset(
    "ad ads advert adverts advertisement aside banner breadcrumb breadcrumbs button comment comments cookie cookies "
    "consent dialog disqus footer form header menu modal nav navbar navigation newsletter notice notices pagination "
    "popup promo promotion related replies reply respond select share sharing sidebar social sponsor sponsored "
    "subscribe textarea toolbar widget".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|template|title)\b.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>?|<[!?/][^>]*+>?""", re.S | re.I)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_PARTS = re.compile(r"[a-z0-9]+")


@lru_cache(maxsize=50_000)
def _part(tag: str, attributes: str) -> tuple[str, ...]:
    """A tag and the names it carries."""
    names = {f"{kind[0].lower()}:{name}" for kind, value in _NAMES.findall(attributes)
             for name in _PARTS.findall(value.lower())}
    return tag, *sorted(names)


def leaf_blocks(page: str) -> list[tuple[tuple[tuple[str, ...], ...], str, float]]:
    """``(path, text, share of linked characters)`` of each block with text, in page order."""
    blocks, stack, pieces, linked, path = [], [], [], 0, ()

    def flush():
        nonlocal pieces, linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                blocks.append((path, text, min(1.0, linked / len(text))))
        pieces, linked = [], 0

    def read(text: str):
        nonlocal linked, path
        if not pieces:
            path = tuple(part for part, _ in stack)
        pieces.append(text)
        if any(part[0] == "a" for part, _ in stack):
            linked += len(text)

    at = 0
    for token in _TOKEN.finditer(page):
        start, stop = token.span()
        if start > at:
            read(page[at:start])
        at = stop
        tag = token[3]
        if not tag:
            continue
        tag, closing = tag.lower(), token[2]
        is_block = tag in BLOCK_TAGS
        if closing:
            if is_block:
                flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0][0] == tag:
                    del stack[i:]
                    break
                if not is_block and stack[i][1]:
                    break  # an inline end tag does not reach beyond its block
            continue
        if is_block:
            flush()
            # a block closes an open paragraph, a list item the one before it
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0][0] == "p" or tag == "li" and stack[i][0][0] == "li":
                    del stack[i:]
                    break
                if stack[i][1]:
                    break
        elif tag == "br" and pieces:
            pieces.append(" ")
        if tag not in VOID_TAGS:
            stack.append((_part(tag, token[4]), is_block))
    if at < len(page):
        read(page[at:])
    flush()
    return blocks


def _names(path) -> set[str]:
    return {name.split(":")[-1] for part in path for name in part}


def known_labels(blocks) -> np.ndarray | None:
    """Which blocks are main text by the names of their parts; None where no part is named as main."""
    paths = [_names(path) for path, _, _ in blocks]
    if not any(p & MAIN_PARTS for p in paths):
        return None
    return np.array([bool(p & MAIN_PARTS) and not p & OTHER_PARTS for p in paths], float)


@lru_cache(maxsize=20_000)
def _path_vector(path) -> np.ndarray:
    vector = np.zeros(PATH_BUCKETS, np.float32)
    for name in {n for part in path for n in part}:
        h = zlib.crc32(name.encode())
        vector[h % PATH_BUCKETS] += 1 if h >> 16 & 1 else -1
        vector[(h >> 8) % PATH_BUCKETS] += 1 if h >> 17 & 1 else -1
    return vector


def vectors(blocks) -> np.ndarray:
    """One row for each block."""
    out = np.zeros((len(blocks), _WIDTH), np.float32)
    for row, (path, text, linked) in zip(out, blocks):
        row[:PATH_BUCKETS] = _path_vector(path)
        words = text.split()
        hashed = np.bincount([zlib.crc32(w.encode()) % WORD_BUCKETS for w in words], minlength=WORD_BUCKETS)
        row[PATH_BUCKETS:-4] = hashed / len(words)
        stops = sum(text.count(c) for c in ".,;:!?")
        row[-4:] = np.log1p(len(text)) / 5, np.log1p(len(words)) / 4, linked, min(1.0, 5 * stops / len(text))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """A bidirectional LSTM with one output for each block."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.p, self.learned = {}, False
        for side in ("f", "b"):
            self.p[f"x{side}"] = rng.normal(0, 0.15, (_WIDTH, 4 * HIDDEN))
            self.p[f"h{side}"] = rng.normal(0, 0.15, (HIDDEN, 4 * HIDDEN))
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN:2 * HIDDEN] = 1  # remember at first
            self.p[f"c{side}"] = bias
            self.p[f"o{side}"] = rng.normal(0, 0.15, HIDDEN)
        self.p["o"] = np.zeros(1)

    def _run(self, x: np.ndarray, inside: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """Hidden states for ``x`` (blocks, pages, width); outside a page the state stands still."""
        p, (length, pages, _) = self.p, x.shape
        into = x @ p[f"x{side}"] + p[f"c{side}"]
        h, c, out = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN)), np.zeros((length, pages, HIDDEN))
        for t in range(length) if side == "f" else range(length - 1, -1, -1):
            gates = into[t] + h @ p[f"h{side}"]
            i, f, o = (_sigmoid(gates[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN:])
            now = inside[t][:, None]
            c2 = f * c + i * g
            tc = np.tanh(c2)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, tc, now))
            h, c = np.where(now, o * tc, h), np.where(now, c2, c)
            out[t] = h
        return out

    def chances(self, x: np.ndarray, inside: np.ndarray) -> np.ndarray:
        p = self.p
        return _sigmoid(self._run(x, inside, "f") @ p["of"] + self._run(x, inside, "b") @ p["ob"] + p["o"])

    def slopes(self, x: np.ndarray, inside: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean log loss, by backpropagation through the page."""
        p, kept = self.p, {"f": [], "b": []}
        hidden = {s: self._run(x, inside, s, kept[s]) for s in kept}
        chance = _sigmoid(hidden["f"] @ p["of"] + hidden["b"] @ p["ob"] + p["o"])
        error = np.where(inside, chance - y, 0) / inside.sum()
        out = {"o": np.array([error.sum()])}
        for s in kept:
            out[f"o{s}"] = np.einsum("tp,tph->h", error, hidden[s])
            gx, gh, gc = (np.zeros_like(p[f"{k}{s}"]) for k in "xhc")
            dh, dc = np.zeros(hidden[s].shape[1:]), np.zeros(hidden[s].shape[1:])
            for t, h, c, i, f, o, g, tc, now in reversed(kept[s]):
                dh = dh + error[t][:, None] * p[f"o{s}"]
                d = np.where(now, dh, 0)
                dc2 = np.where(now, dc, 0) + d * o * (1 - tc * tc)
                gates = np.concatenate([dc2 * g * i * (1 - i), dc2 * c * f * (1 - f), d * tc * o * (1 - o),
                                        dc2 * i * (1 - g * g)], axis=1)
                gx += x[t].T @ gates
                gh += h.T @ gates
                gc += gates.sum(axis=0)
                dh = np.where(now, gates @ p[f"h{s}"].T, dh)
                dc = np.where(now, dc2 * f, dc)
            out |= {f"x{s}": gx, f"h{s}": gh, f"c{s}": gc}
        return out

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> None:
        self.learned = bool(pages)
        rng = np.random.default_rng(5)
        mean, square = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step = 0
        pages = sorted(pages, key=lambda page: len(page[1]))
        for _ in range(epochs):
            for at in rng.permutation(range(0, len(pages), 24)):
                x, inside, y = _padded(pages[at:at + 24])
                step += 1
                for k, slope in self.slopes(x, inside, y).items():
                    mean[k] = 0.9 * mean[k] + 0.1 * slope
                    square[k] = 0.99 * square[k] + 0.01 * slope ** 2
                    self.p[k] = self.p[k] - 0.02 * (mean[k] / (1 - 0.9 ** step)) / (
                        np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)

    def main_texts(self, pages: list[str]) -> list[str]:
        """The main text of each page."""
        read = [leaf_blocks(p) for p in pages]
        if not self.learned:
            return ["\n".join(text for path, text, _ in blocks if not _names(path) & OTHER_PARTS) for blocks in read]
        texts = [""] * len(pages)
        order = sorted((i for i in range(len(pages)) if read[i]), key=lambda i: len(read[i]))
        at = 0
        while at < len(order):
            longest = at  # pages of about one length together, some blocks at a time
            while longest < len(order) and (longest - at) * len(read[order[longest]]) < 20_000:
                longest += 1
            some = order[at:max(longest, at + 1)]
            at += len(some)
            x, inside, _ = _padded([(vectors(read[i]), np.zeros(len(read[i]))) for i in some])
            for i, chance in zip(some, self.chances(x, inside).T):
                texts[i] = "\n".join(text for (_, text, _), c in zip(read[i], chance) if c >= 0.5)
        return texts


def _padded(pages):
    length = max(len(y) for _, y in pages)
    x = np.zeros((length, len(pages), _WIDTH))
    inside, labels = np.zeros((length, len(pages)), bool), np.zeros((length, len(pages)))
    for i, (rows, y) in enumerate(pages):
        x[:len(y), i], inside[:len(y), i], labels[:len(y), i] = rows, True, y
    return x, inside, labels


# Other names for the parts of a page, for variations: main parts, and parts that are not main text.
_AS_MAIN = tuple(map(_part, ("div", "section", "div", "main", "div", "article"), (
    'class="content"', 'class="post"', 'class="entry-content"', "", 'id="story"', 'class="body"')))
_AS_OTHER = tuple(map(_part, ("div", "header", "aside", "div", "form", "section", "div", "footer", "div", "ul"), (
    'class="menu"', "", 'class="sidebar"', 'class="cookie-notice"', "", 'class="comments" id="comments"',
    'class="advert"', 'class="site-footer"', 'class="related"', 'class="breadcrumb"')))


def _varied(rng, blocks, labels, strange):
    """A page with other names for its main part and other parts put in around and inside it."""
    main = _AS_MAIN[rng.integers(len(_AS_MAIN))]
    out, y = [], []

    def other(count):
        part = _AS_OTHER[rng.integers(len(_AS_OTHER))]
        inside_main = rng.random() < 0.3
        for _ in range(count):
            _, text, linked = strange[rng.integers(len(strange))]
            head = (_part("html", ""), _part("body", "")) + ((main,) if inside_main else ())
            out.append((head + (part, _part(("p", "li", "div", "h2")[rng.integers(4)], "")), text, linked))
            y.append(0.0)

    other(rng.integers(0, 4))
    for (path, text, linked), label in zip(blocks, labels):
        if label and rng.random() < 0.04:
            other(1)
        if label:
            path = tuple(main if set(_names([part])) & MAIN_PARTS else part for part in path)
        out.append((path, text, linked))
        y.append(label)
    other(rng.integers(0, 6))
    return out, np.array(y)


def train(pages: DataFrame, max_pages: int = TRAINING_PAGES, max_chars: int = TRAINING_CHARS) -> Labeller:
    """Fit a labeller on at most ``max_pages`` pages that name their main part."""
    common.bound_batches(pages.sparkSession)

    def labelled(batches):
        for batch in batches:
            told = [known_labels(leaf_blocks(page)) is not None for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("chosen").filter(pa.array(told, pa.bool_()))], ["chosen"])

    known = pages.where(F.length("html") <= max_chars).select("html", F.xxhash64("page_id", "html").alias("chosen"))
    # hashes are ranked alone: every task sends its best ones, and pages would be many times as large
    told = known.select("chosen", "html").mapInArrow(labelled, "chosen long")
    best = told.distinct().orderBy("chosen").limit(max_pages)
    sample = known.join(F.broadcast(best), "chosen").dropDuplicates(["chosen"]).orderBy("chosen")
    return fit([row.html for row in sample.collect()])


def fit(pages: list[str]) -> Labeller:
    labeller, rng, known = Labeller(), np.random.default_rng(11), []
    for page in pages:
        blocks = leaf_blocks(page)
        labels = known_labels(blocks)
        if labels is not None:
            known.append((blocks, labels))
    # texts of both kinds fill the parts put in: comments read like main text
    strange = [b for blocks, labels in known for b, label in zip(blocks, labels) if not label or rng.random() < 0.2]
    examples = [(vectors(b), y) for b, y in known]
    for blocks, labels in known if strange else []:
        for _ in range(2):
            b, y = _varied(rng, blocks, labels, strange)
            examples.append((vectors(b), y))
    labeller.fit([e for e in examples if len(e[1])])
    return labeller


def extract(pages: DataFrame, labeller: Labeller) -> DataFrame:
    """``page_id, url, text`` for each row."""
    common.bound_batches(pages.sparkSession)

    def run(batches):
        for batch in batches:
            texts = labeller.main_texts(batch.column("html").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                             ["page_id", "url", "text"])

    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                          F.coalesce("html", F.lit("")).alias("html"))
    return source.mapInArrow(run, "page_id long, url string, text string")
