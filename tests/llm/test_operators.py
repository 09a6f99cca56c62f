"""Each operator against a plain restatement, on tables with every awkward case at once and on empty ones."""

import dataclasses
import html
import re
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

from credara.llm import (
    block_labeller, block_naming, bpe_segment_tree, common, components, latent_decontamination, queries,
    repeated_phrases, run_length_index, secret_ownership, shared_windows, simhash_pivots, token_counts, toxic_spans)
from credara.sources.workspace import Workspace


def found(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# -- SimHash


@pytest.mark.parametrize("bucket", [64, 1])
def test_near_groups(documents, corpus, bucket, monkeypatch):
    monkeypatch.setattr(simhash_pivots, "BUCKET", bucket)
    rows = corpus + [(None, "a b"), (None, "lonely text without an id")]
    got = simhash_pivots.near_groups(documents(rows))
    assert found(got, "doc_id", "fingerprint", "component_id") == Counter(brute.near_groups(rows))
    kept = Counter(r.component_id for r in got.where("kept").select("component_id", "row_key").distinct().collect())
    # 5 stands for two documents, and null for any that have no other name
    assert {n for name, n in kept.items() if name not in (None, 5)} == {1}


def test_fingerprints_far_apart_do_not_link_and_chains_do(spark):
    fps = [0, 3, 15, 63, 1 << 63, (1 << 63) | 7, 0xFFFF, 0xFFFF ^ (1 << 40) ^ (1 << 20)]
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    pairs = simhash_pivots.links(Workspace(spark), spark.createDataFrame(signed, "fp long")).collect()
    linked = {frozenset((a % 2**64, b % 2**64)) for a, b in pairs}
    assert linked == {frozenset((x, y)) for x in fps for y in fps if 0 < (x ^ y).bit_count() <= 2}


@pytest.mark.parametrize("max_bits", [1, 3])
def test_large_keys_are_linked_at_other_radii(spark, max_bits, monkeypatch):
    monkeypatch.setattr(simhash_pivots, "BUCKET", 2)
    fps = [n << 3 for n in range(40)] + [(1 << 50) + n for n in range(9)]
    pairs = simhash_pivots.links(Workspace(spark), spark.createDataFrame([(f,) for f in fps], "fp long"), max_bits).collect()
    linked = {frozenset(p) for p in pairs}
    assert linked == {frozenset((x, y)) for x in fps for y in fps if 0 < (x ^ y).bit_count() <= max_bits}


def test_pivot_coordinates_never_discard_a_link():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 500, np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 500, np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 500, np.uint64))
    pivots = simhash_pivots.Pivots()
    assert pivots.linked(a.view(np.int64), b.view(np.int64), 2).all()
    same = np.array([x == y for x, y in zip(pivots.keys(a.view(np.int64)), pivots.keys(b.view(np.int64)))])
    assert same.any(axis=0).all()


def test_components_of_a_long_chain(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    roots = {r.node: r.root for r in components.components(Workspace(spark), pairs).collect()}
    assert roots == {**{i: 0 for i in range(1, 61)}, 101: 100}


# -- repeated windows


@pytest.mark.parametrize("group_bytes", [3_000_000, 300])
def test_repeated_phrases(documents, corpus, group_bytes):
    kind = dataclasses.replace(repeated_phrases.KIND, group_bytes=group_bytes, match_bytes=500)
    got = queries.removed_digests(repeated_phrases.remove_repeated(documents(corpus), kind), "n_words")
    assert found(got, "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(brute.phrases(corpus))


@pytest.mark.parametrize("group_bytes", [3_000_000, 300])
def test_run_length_index(documents, corpus, group_bytes):
    kind = dataclasses.replace(run_length_index.KIND, group_bytes=group_bytes, match_bytes=500)
    got = queries.removed_digests(run_length_index.remove_repeated(documents(corpus), kind), "n_bytes",
                                  F.size("removed").alias("n_spans"))
    assert found(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == Counter(brute.substrings(corpus))


def test_null_ids_stand_after_all_others(documents):
    text = " ".join(f"w{i}" for i in range(30))
    got = repeated_phrases.remove_repeated(documents([(None, text), (9, text), (None, text), (None, "short")]))
    assert found(got, "doc_id", "n", F.size("removed")) == {(9, 30, 0): 1, (None, 30, 1): 2, (None, 1, 0): 1}


def test_index_finds_all_earlier_windows():
    rng = np.random.default_rng(3)
    base = bytes(rng.choice(list(b"ab c"), 300).tolist())
    parts = []
    for _ in range(50):
        at = int(rng.integers(0, 150))
        part = bytearray(base[at:at + int(rng.integers(100, 150))])
        if rng.random() < 0.5:
            part[int(rng.integers(len(part)))] = 120
        parts.append(bytes(part))
    seen, want = set(), set()
    for i, part in enumerate(parts):
        for p in range(len(part) - 99):
            if part[p:p + 100] in seen:
                want.add((i, p))
            seen.add(part[p:p + 100])
    assert set(run_length_index.RunLengthIndex(parts).earlier_windows()) == want


@pytest.mark.parametrize("kind", [repeated_phrases.KIND, run_length_index.KIND])
def test_every_window_has_one_anchor(kind, monkeypatch):
    monkeypatch.setattr(shared_windows, "PIECE", 500)
    text = " ".join(f"w{i * i % 37}" for i in range(900)).encode()
    units = kind.units(text)
    key, at, first, last = shared_windows.anchors(kind, units)
    assert [w for a, b in zip(first, last) for w in range(a, b + 1)] == list(range(len(units) - kind.window + 1))
    assert ((first <= at) & (at + kind.gram <= last + kind.window)).all() and len(key) == len(at)


# -- tokenizers

ODD = ["", "  a  b\n\n\t x 　 z\x1c\x1d\x85q", "a" * 2500, "▁▁ x▁y  ", "<s>é‽<|endoftext|> 漢字🙂🙂 ẞ ²½",
       "1234567 89's 'll don't DON'T", " " * 40 + "x", "ab" * 700, "Straße naïve ça été", "\x00\x1f​́e"]


def test_byte_bpe_equals_the_library(documents, corpus):
    ranks = bpe_segment_tree.read_ranks(public_tokenizers.path(bpe_segment_tree.VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = corpus + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "no id")]
    got = queries.token_digests(bpe_segment_tree.decode(bpe_segment_tree.encode(documents(rows))))
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(t or "")))
    assert found(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == Counter(want)


def test_segment_tree_alone_and_side_by_side_agree():
    coder = bpe_segment_tree.encoder(public_tokenizers.path(bpe_segment_tree.VOCABULARY), public_tokenizers.PATTERN)
    pieces = [bytes(np.random.default_rng(i).integers(97, 103, 2 + i % 31).tolist()) for i in range(200)]
    ids, counts = coder.encode_side_by_side(pieces)
    split = np.split(ids, np.cumsum(counts)[:-1])
    whole = [p for p in pieces if p in coder.ranks]
    assert all(a.tolist() == coder.encode_piece(p) for a, p in zip(split, pieces) if p not in whole)


def test_fast_splitter_equals_the_pattern():
    splitter = bpe_segment_tree.Splitter(public_tokenizers.PATTERN)
    for code in range(0x558):
        for text in (f"a{chr(code)}1", f" {chr(code)}", f"{chr(code)}  {chr(code)}!", f"x \n{chr(code)}"):
            assert splitter.findall(text) == splitter.exact.findall(text), hex(code)


def test_token_counts_equal_the_library(documents, corpus):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    rows = corpus + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "no id")]
    got = token_counts.count_tokens(documents(rows), limit=50)
    want = Counter((i, len((t or "").encode()), n, n > 50) for i, t in rows for n in [len(library.encode(t or ""))])
    assert found(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_prefix_counts_and_budgets():
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    counter = token_counts.prefix_counter(public_tokenizers.path(token_counts.MODEL))
    for text in ("Hello  wörld 漢z", "a b  c", " x", "unbelievable", ""):
        want = [len(library.encode(text[:i])) for i in range(len(text) + 1)]
        assert counter.prefix_counts(text).tolist() == want
        for limit in range(12):
            assert counter.fitting(text, limit) == max(i for i, n in enumerate(want) if n <= limit)


# -- pages


def page(*parts):
    return "<!DOCTYPE html><html><head><title>T</title><script>a='<p>x</p>'</script></head><body>" + "".join(parts) + "</body>"


@pytest.fixture(scope="module")
def labeller(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    return block_labeller.train(pages)


def test_pages_of_the_table(spark, labeller):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in block_labeller.extract(pages, labeller).collect()}
    for row in pages.collect():
        inside = re.search("(?s)<article>(.*?)</article>", row.html)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", inside))
        assert got[row.page_id] == "\n".join(p for p in parts if p)


def test_parts_with_other_names(labeller):
    text = page('<header><h1>Site</h1></header><div class="menu"><ul><li><a href=x>Home</a><li><a href=y>News</a></ul></div>',
                '<div class="content"><h1>Title here</h1><p>The and that was of the thing, with an &eacute; other.',
                '<p>Reading   on\nthe&nbsp;same.</p><div class="ad">Buy now the thing</div></div>',
                '<div class="comments"><p>I like that the and of it, was good.</p></div><form><p>Your name</p></form>')
    assert labeller.main_texts([text]) == ["Title here\nThe and that was of the thing, with an é other.\nReading on the same."]


def test_awkward_pages(spark, labeller):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<"), (4, "u", "<a href='x>y"), (5, "u", "<!-- open"), (5, "u", "<!-- open"),
            (6, "u", page("<nav>" + "<ul><li>x" * 3000)), (7, "u", page("<script>" + "x" * 500_000))]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string")
    got = block_labeller.extract(pages, labeller).collect()
    assert Counter((r.page_id, r.url) for r in got) == Counter((i, u) for i, u, _ in rows)
    assert all(r.text == "" for r in got if r.page_id in (1, 2, 5, 7))
    assert block_labeller.extract(pages.limit(0), labeller).count() == 0
    block_labeller.train(pages.limit(0)).main_texts([page("<p>untrained")])


def test_the_sample_is_taken_among_pages_that_name_their_main_part(spark, monkeypatch):
    monkeypatch.setattr(block_labeller, "fit", lambda pages: pages)
    told = [page(f"<article><p>Text {i}</p></article>") for i in range(6)]
    rows = [(i, t) for i, t in enumerate(told + told[:1] + [page(f"<div><p>Other {i}</p></div>") for i in range(200)])]
    pages = spark.createDataFrame([*rows, (None, None)], "page_id long, html string")
    assert sorted(block_labeller.train(pages, max_pages=10)) == sorted(told + told[:1])
    assert len(block_labeller.train(pages, max_pages=4)) == 4


def test_pages_without_any_named_main_part_keep_what_is_not_named_otherwise(spark):
    text = page("<nav><p>Menu</p></nav><div><p>One</p><p>Two</p></div><footer><p>End</p></footer>")
    pages = spark.createDataFrame([(1, text)], "page_id long, html string")
    assert block_labeller.train(pages).main_texts([text, ""]) == ["One\nTwo", ""]


def test_gradient_of_the_labeller():
    rng, labeller = np.random.default_rng(2), block_labeller.Labeller()
    x, inside, y = block_labeller._padded([(rng.normal(size=(n, block_labeller._WIDTH)), rng.integers(0, 2, n)) for n in (3, 5)])

    def loss():
        chance = labeller.chances(x, inside)
        return -np.where(inside, np.log(np.where(y == 1, chance, 1 - chance)), 0).sum() / inside.sum()

    for name, slope in labeller.slopes(x, inside, y).items():
        at = tuple(0 for _ in slope.shape)
        before = labeller.p[name].copy()
        values = []
        for step in (1e-5, -1e-5):
            labeller.p[name] = before.copy()
            labeller.p[name][at] += step
            values.append(loss())
        labeller.p[name] = before
        assert slope[at] == pytest.approx((values[0] - values[1]) / 2e-5, abs=1e-6), name


# -- secrets

LEAKS = ["password: token: abcdefgh", "x API_KEY = 'aB3_./+=-9' é AKIA" + "Z" * 16, "AKIASHORT secret=abc", "f" * 23 + " " + "0a" * 12,
         "tokentoken=" + "ab12" * 7 + "\npasswd:\"zzzzzz\"", "PASSWORD=ſecret TOKEN=\x20\x20abcdef", "é" * 5 + "secret= abcdef12", ""]


def test_base_spans(documents, corpus):
    rows = corpus + [(500 + i, t) for i, t in enumerate(LEAKS)] + [(None, "token=abcdefghij"), (None, None)] + [(500, LEAKS[0])]
    got = secret_ownership.digests(secret_ownership.scan(documents(rows)))
    assert found(got, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == Counter(brute.secrets(rows))


def test_ownership_separates_copied_from_live(documents):
    copied, live = "Zx9" * 8, "Qw7" * 8
    rows = [(i, f"see {copied} here") for i in range(6)] + [(6, f"mine {live}"), (9, f"again {live}")]
    got = {r.doc_id: r.spans for r in secret_ownership.digests(secret_ownership.scan(documents(rows))).collect()}
    assert got == {**{i: "" for i in range(6)}, 6: "owned:5:29", 9: "owned:6:30"}


def test_the_automaton_locates_what_the_counts_confirm(monkeypatch):
    """Counts alone remove nothing: every occurrence comes out of the automaton, the first document's stays."""
    rng = np.random.default_rng(5)
    stretch = lambda key, doc, text: shared_windows.Stretch(key, doc, 0, text, [(doc, 0)])
    stretches = []
    for key in range(6):
        docs = sorted(rng.integers(0, 9, 12).tolist())
        stretches += [stretch(key, d, " ".join(f"{key}{c}" for c in rng.choice(list("ab"), 8)).encode()) for d in docs]
    first: dict = {}
    expected = []
    for s in stretches:
        found = s.content.split()
        for i in range(len(found) - 3):
            if first.setdefault(tuple(found[i:i + 4]), s.doc) < s.doc:
                expected.append((id(s), i))
    got = [(id(s), i) for s, i in repeated_phrases.locate(stretches, window=4)]
    assert sorted(got) == sorted(expected) and len(set(got)) == len(got) > 0

    class Blind:
        """An automaton that takes all patterns and finds none."""

        def __init__(self):
            self.real = real()

        def __len__(self):
            return len(self.real)

        def add_word(self, *word):
            self.real.add_word(*word)

        def make_automaton(self):
            self.real.make_automaton()

        def iter(self, text):
            return iter(())

    real = repeated_phrases.ahocorasick.Automaton
    monkeypatch.setattr(repeated_phrases.ahocorasick, "Automaton", Blind)
    assert not list(repeated_phrases.locate(stretches, window=4))


# -- toxicity


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    got = queries.op8_toxic_spans(spark, folder).where("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = got.join(labels, "doc_id").collect()
    right = sum(r.predicted == r.toxic for r in rows) / len(rows)
    hits = [r.predicted for r in rows if r.toxic]
    assert right > 0.96 and sum(hits) > 0.85 * len(hits)


def test_labels_of_held_out_rows_are_never_learned(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("toxic", F.when(toxic_spans.is_held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, other = (toxic_spans.train(docs, x) for x in (labels, turned))
    assert (one.weights == other.weights).all()


def test_toxic_edge_cases(documents, corpus, spark):
    rows = [(i, t) for i, t in corpus] + [(2000 + i, "you utter fool and " + t) for i, t in corpus if t and i is not None]
    labels = spark.createDataFrame([(i, int(i >= 2000)) for i, _ in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxic_spans.train(documents(rows), labels)
    got = toxic_spans.score(documents(rows + [(None, None)]), model).collect()
    assert len(got) == len(rows) + 1 and all(0 <= r.score <= 1 for r in got)
    kept = toxic_spans.keep_clean(documents(rows), model)
    assert kept.columns == documents(rows).columns and 0 < kept.count() < len(rows)
    for labels_of_one_kind in (labels.limit(0), labels.where("toxic = 0")):
        model = toxic_spans.train(documents(rows), labels_of_one_kind)
        assert all(r.score < 0.5 or not labels_of_one_kind.count() for r in toxic_spans.score(documents(rows), model).collect())
    assert toxic_spans.score(documents([]), model).count() == 0


def test_the_toxicity_sample_is_bounded_in_rows_and_not_used_up_by_long_ones(documents, spark, monkeypatch):
    monkeypatch.setattr(toxic_spans, "fit", lambda rows, odds: rows)
    ids = spark.range(400).where(~toxic_spans.is_held_out(F.col("id"))).limit(61).collect()
    (hot,), *others = ids
    rows = [(hot, f"text {k % 90}") for k in range(180)] + [(i, "long " * 100) for i, in others[:50]]
    rows += [(i, f"short {i}") for i, in others[50:]]
    labels = spark.createDataFrame([(hot, 0)] + [(i, 1) for i, in others], "doc_id long, toxic int")
    got = toxic_spans.train(documents(rows), labels, max_rows=10, max_chars=100)
    assert Counter(label for _, label in got) == {0: 10, 1: 10} and len(set(got)) == 20
    assert {t for t, label in got if label} == {f"short {i}" for i, in others[50:]}


def test_marginals_agree_with_enumeration():
    rng = np.random.default_rng(0)
    gain, tie = rng.normal(size=(1, 5)), rng.normal(size=(2, 2))
    weight, toxic = 0, np.zeros(5)
    for code in range(32):
        y = [code >> t & 1 for t in range(5)]
        w = np.exp(sum(gain[0][t] * y[t] for t in range(5)) + sum(tie[y[t], y[t + 1]] for t in range(4)))
        weight, toxic = weight + w, toxic + w * np.array(y)
    inside = np.ones((1, 5), bool)
    assert toxic_spans._marginals(gain, tie, inside)[0][0] == pytest.approx(toxic / weight)
    alone = toxic_spans._only_marginals(gain, tie, np.array([4]), np.array([False]))
    assert alone[0] == pytest.approx(toxic / weight, abs=1e-5)


def _one_chain(gain, tie):
    """Forward-backward over one chain, a word at a time, with logarithms."""
    ahead, behind = np.zeros((len(gain), 2)), np.zeros((len(gain), 2))
    own = np.stack([np.zeros(len(gain)), np.clip(gain, -30, 30)], axis=1)
    ahead[0] = own[0]
    for t in range(1, len(gain)):
        ahead[t] = np.logaddexp(*(ahead[t - 1][:, None] + tie)) + own[t]
    for t in range(len(gain) - 2, -1, -1):
        behind[t] = np.logaddexp(*(tie + own[t + 1] + behind[t + 1]).T)
    both = ahead + behind
    return 1 / (1 + np.exp(both[:, 0] - both[:, 1]))


def test_a_text_is_one_chain_whatever_its_length():
    rng = np.random.default_rng(1)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), 5)) for _ in range(300)]
    tie = np.array([[2.5, -2.0], [-1.5, 3.0]])
    model = toxic_spans.Model(rng.normal(0, 0.5, 1 << toxic_spans.FEATURE_BITS), tie, np.array([-4, 3.0, 0.5]))
    lengths = [1, 0, 63, 64, 65, 128, 129, 10_000, 640, 2, 700, 0]
    texts = [" ".join(rng.choice(vocabulary, n)) for n in lengths]
    spelled = [[float(sum(model.weights[toxic_spans._features(w)])) for w in t.split()] for t in texts]
    expected = [_one_chain(np.array(g), tie) if g else np.empty(0) for g in spelled]
    for got, want in zip(model.words(texts), expected):
        assert got == pytest.approx(want, abs=1e-4)
    signs = [(1, max(m, default=0), np.log1p(sum(m))) for m in expected]
    scores = [1 / (1 + np.exp(-np.dot(x, model.scale))) for x in signs]
    spans = [[x.span() for x, m in zip(re.finditer(r"\w+", t), ms) if m > 0.5] for t, ms in zip(texts, expected)]
    for (score, found), want, where in zip(model.scores(texts), scores, spans):
        assert score == pytest.approx(want, abs=1e-3) and found == where
    assert model.words(["", ""])[0].size == 0


def test_messages_carry_strong_signs_over_many_rows():
    gain = np.full(1000, -0.01)
    gain[0], gain[-1] = 200, -200
    tie = np.array([[6.0, -6.0], [-6.0, 6.0]])
    rows, at, last, goes_on = toxic_spans._stretches(gain.astype(np.float32), np.array([1000]))
    got = toxic_spans._only_marginals(rows, tie, last, goes_on)[at]
    assert np.isfinite(got).all() and got == pytest.approx(_one_chain(gain, tie), abs=1e-3)


# -- decontamination


def test_benchmark_items_are_found_and_others_left(documents, corpus, spark):
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()
    bench = spark.createDataFrame([(r.item_id, r.text, "x") for r in items] + [(900, None, ""), (901, "", ""), (None, "one", "")],
                                  "item_id long, text string, word string")
    planted = [(3000 + r.item_id, f"{corpus[k % 30][1] or ''} {r.text} {corpus[(k + 7) % 30][1] or ''}") for k, r in enumerate(items)]
    loose = [r for r in items if len(r.text.split()) > 30][:5]
    for r in loose:  # every eighth word changed
        planted.append((4000 + r.item_id, " ".join("changed" if i % 8 == 7 else w for i, w in enumerate(r.text.split()))))
    got = latent_decontamination.contaminated(documents(corpus + planted + planted[:1] + [(None, items[0].text)]), bench).collect()
    pairs = {(r.doc_id, r.item_id) for r in got}
    assert {(3000 + r.item_id, r.item_id) for r in items} | {(4000 + r.item_id, r.item_id) for r in loose} <= pairs
    assert (None, items[0].item_id) in pairs and all(d is None or d >= 3000 for d, _ in pairs)


def test_items_beside_a_repeated_word_are_found(documents, spark):
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = sorted((r.item_id, r.text) for r in bench.collect())
    rows = []
    for k, (i, text) in enumerate(items):
        word = max(latent_decontamination.words_of(items[k - 1][1]), key=len)
        rows.append((1000 + i, f"{f'{word} ' * 70}{text}{f' {word}' * 70}"))  # a word of another item
        edited = [f"changed{n}" if n % 6 == 5 else w for n, w in enumerate(latent_decontamination.words_of(text))]
        rows.append((2000 + i, f"{f'{word} ' * 70}{' '.join(edited)}{f' {word}' * 70}"))
        rows.append((3000 + i, f"{word} " * 140))
    short = [(800, "ja no"), (801, "Quorum!")]
    rows += [(4000, f"{'quo ' * 90}ja no{' quo' * 90}"), (4001, f"{'ja ' * 90}quorum{' no' * 90}"), (4002, "no ja no quo rum")]
    both = bench.select("item_id", "text").unionByName(spark.createDataFrame(short, "item_id long, text string"))
    pairs = set(found(latent_decontamination.contaminated(documents(rows), both), "doc_id", "item_id"))
    planted = {(at + i, i) for i, _ in items for at in (1000, 2000)}
    assert planted | {(4000, 800), (4001, 801), (4002, 800)} <= pairs
    assert not any(3000 <= d < 4000 for d, _ in pairs)


def test_decontamination_of_empty_tables(documents, corpus, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert latent_decontamination.contaminated(documents(corpus), none).count() == 0
    some = spark.createDataFrame([(1, "what is it that the item asks")], "item_id long, text string")
    assert latent_decontamination.contaminated(documents([]), some).count() == 0


def test_many_blocks_give_the_same_matches(documents, corpus, spark, monkeypatch):
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    rows = corpus + [(3000 + r.item_id, r.text) for r in bench.collect()]
    whole = found(latent_decontamination.contaminated(documents(rows), bench), "doc_id", "item_id")
    monkeypatch.setattr(latent_decontamination, "BLOCK_WORDS", 600)
    monkeypatch.setattr(latent_decontamination, "PASS_BLOCKS", 2)
    assert found(latent_decontamination.contaminated(documents(rows), bench), "doc_id", "item_id") == whole


def test_blocks_of_short_items_are_bounded_in_segments(spark):
    rng = np.random.default_rng(3)
    sizes = [*rng.integers(5, 13, 600).tolist(), 24, 25, 48, 49]
    texts = [" ".join(f"w{n}" for n in rng.integers(0, 3000, size)) for size in sizes]
    items = latent_decontamination._items(spark.createDataFrame(list(enumerate(texts)), "item_id long, text string"))
    blocks = [[r.words for r in b.collect()] for b in latent_decontamination._blocks(items)]
    assert sum(map(len, blocks)) == len(texts)
    counts = [sum(len(latent_decontamination.segments_of(w)) for w in b) for b in blocks if len(b) > 1]
    assert max(counts) <= latent_decontamination.SEGMENTS
    ranks = [latent_decontamination.rank_of(n) for n in range(1, 2000)]
    assert ranks[:32] == list(range(1, 33)) and max(ranks) == latent_decontamination.RANK
    assert all(2 * rank <= n for n, rank in enumerate(ranks, 1) if n >= 64)


def test_short_items_are_found_in_ordinary_hosts(documents, spark):
    read = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(120)
    words = [w for w in (latent_decontamination.words_of(r.text) for r in read.collect()) if len(w) > 90]
    rng, items, rows = np.random.default_rng(4), [], []
    for k in range(400):
        item = words[k % len(words)][(at := int(rng.integers(0, 70))):at + int(rng.integers(5, 13))]
        items.append((k, " ".join(item)))
        host = words[int(rng.integers(0, len(words)))]
        rows.append((1000 + k, f"{' '.join(host[:30])} {' '.join(item)} {' '.join(host[30:60])}"))
    source = spark.createDataFrame(items, "item_id long, text string")
    pairs = set(found(latent_decontamination.contaminated(documents(rows), source), "doc_id", "item_id"))
    assert {(1000 + k, k) for k, _ in items} <= pairs


def _every_pair(rows: list[tuple], items: list[tuple]) -> set[tuple]:
    """Brute force: the subsequence and answer checks of every item at every passage of every document."""
    flat = latent_decontamination.Retriever(items, {"": 1.0}, {"": [1.0]}, 2.0)
    return {(d, flat.ids[n]) for d, text in rows for n in range(len(items))
            if any(flat.confirmed(words, n, at) for words in [latent_decontamination.words_of(text)]
                   for at in range(0, len(words), latent_decontamination.SPAN))}


def test_paraphrases_against_all_pairs(documents, spark, monkeypatch):
    """Words replaced and clauses swapped: at least 0.9 of all pairs that pass the checks, by the cosine alone as well."""
    rng = np.random.default_rng(11)
    read = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").limit(80)
    hosts = [words for r in read.collect() if len(words := latent_decontamination.words_of(r.text)) > 80]
    items = sorted((r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect())
    assert sum(len(latent_decontamination.segments_of(latent_decontamination.words_of(t))) for _, t in items) > latent_decontamination.RANK
    rows = []
    for i, text in items:
        words = latent_decontamination.words_of(text)
        head, tail = words[:-len(latent_decontamination.answer_words(text))], latent_decontamination.answer_words(text)
        strange = rng.choice([w for words in hosts for w in words], len(head)).tolist()
        size = max(1, len(head) // 6)
        clauses = [head[k:k + size] for k in range(0, len(head), size)]
        for k in range(0, len(clauses) - 1, 3):
            clauses[k], clauses[k + 1] = clauses[k + 1], clauses[k]
        for at, body in ((1000, [s if k % 3 == 2 else w for k, (w, s) in enumerate(zip(head, strange))]),
                         (3000, [s if k % 4 == 3 else w for k, (w, s) in enumerate(zip(head, strange))]),
                         (5000, [w for clause in clauses for w in clause])):
            host = hosts[int(rng.integers(0, len(hosts)))]
            rows.append((at + i, " ".join([*host[:40], *body, *tail, *host[40:80]])))
    rows += [(9000 + k, " ".join(words)) for k, words in enumerate(hosts)]
    want = _every_pair(rows, items)
    assert len(want) > 500
    bench = spark.createDataFrame(items, "item_id long, text string")
    pairs = set(found(latent_decontamination.contaminated(documents(rows), bench), "doc_id", "item_id"))
    assert pairs <= want and len(pairs) >= 0.97 * len(want)
    monkeypatch.setattr(latent_decontamination.Runs, "candidates", lambda self, texts: {})
    alone = set(found(latent_decontamination.contaminated(documents(rows), bench), "doc_id", "item_id"))
    print("recall", len(pairs) / len(want), "by the cosine alone", len(alone) / len(want), "of", len(want))
    assert alone <= want and len(alone) >= 0.9 * len(want)


def test_words_of_ascii_and_other_texts():
    for text in ("", "A_b c-9\x00d\x1fe\x7f", "ÄÖ_ß x²y ٣a", "".join(map(chr, range(128))),
                 "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))):
        assert latent_decontamination.words_of(text) == re.findall(r"[^\W_]+", text.lower())
    assert latent_decontamination.words_of(None) == []


def test_common_subsequence():
    rng = np.random.default_rng(8)
    for _ in range(30):
        a, b = (rng.integers(0, 5, n).astype(str).tolist() for n in rng.integers(0, 14, 2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert latent_decontamination.common_subsequence(a, b) == table[-1, -1]


# -- exact


@pytest.mark.parametrize("block_bytes", [4096, 7])
def test_exact_groups(documents, corpus, block_bytes):
    rows = corpus + [(None, "a b"), (None, "only without an id"), (None, "only without an id")]
    got = block_naming.exact_groups(documents(rows), block_bytes)
    assert found(got, "doc_id", "keep_id", "group_size", "text_sha256") == Counter(brute.exact(rows))
    assert set(r[0] for r in got.groupBy("n_blocks", "name").agg(F.sum(F.col("kept").cast("int"))).select("sum(CAST(kept AS INT))").collect()) == {1}


def test_blocks_that_share_a_route_keep_their_names_apart(documents, corpus):
    got = block_naming.exact_groups(documents(corpus), 50, routes=3)
    assert found(got, "doc_id", "keep_id", "group_size", "text_sha256") == Counter(brute.exact(corpus))


def test_empty_tables(documents):
    none = documents([])
    assert simhash_pivots.near_groups(none).count() == 0
    assert repeated_phrases.remove_repeated(none).count() == 0
    assert run_length_index.remove_repeated(none).count() == 0
    assert bpe_segment_tree.decode(bpe_segment_tree.encode(none)).count() == 0
    assert token_counts.count_tokens(none).count() == 0
    assert secret_ownership.digests(secret_ownership.scan(none)).count() == 0
    assert block_naming.exact_groups(none).count() == 0


def test_keep_and_drop_rows(documents, corpus):
    rows = corpus + [(None, "a b"), (None, "a b")]
    docs = documents(rows).withColumn("row_key_", F.lit(1))
    keys = docs.where("doc_id IN (3, 5) OR doc_id IS NULL").select(
        common.row_key(F.col("doc_id"), F.col("text")).alias("row_key"))
    chosen = {r for r in rows if r[0] in (3, 5, None)}
    kept, left = common.keep_rows(docs, keys), common.drop_rows(docs, keys)
    assert kept.columns == left.columns == docs.columns
    # a null text and an empty one under the same id are one document
    assert found(kept, "doc_id", F.coalesce("text", F.lit(""))) == Counter({(i, t or "") for i, t in chosen})
    assert found(left, "doc_id", "text") == Counter(r for r in rows if r not in chosen)


def test_run_length_index_finds_the_run_and_the_class_of_a_row_without_a_search():
    index = run_length_index.RunLengthIndex([b"abcdefgh" * 30, b"xy" + b"abcdefgh" * 20, b"abcdefgh" * 14])
    rows = np.arange(len(index.text))
    assert (index.run_of_row == np.searchsorted(index.run_start, rows, "right") - 1).all()
    assert len(index.first_of_row) == len(rows) and (np.bincount(index.first_of_row) > 0).sum() < len(rows)
