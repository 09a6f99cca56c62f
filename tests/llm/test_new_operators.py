"""Fill-in-middle, conversation repair and packing against plain restatements."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import brute
from compare import connect, duckdb_table, spark_table
from credara.llm import conversation_repair, fill_in_middle, fit_packing, queries

SF = "/root/testdata/sf0.01"


def found(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


# -- fill in middle


def middle(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]
    i, j = sorted(x % (len(text) + 1) for x in h[:2])
    p, m, s = text[:i], text[i:j], text[j:]
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc_id, len(text), "plain", None, None, brute.sha(text), brute.sha(text)
    spm = h[3] % 100 < 20
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(text), "spm" if spm else "psm", len(p), len(m), brute.sha(out), brute.sha(text)


def test_fill_in_middle(documents, corpus, tmp_path, spark):
    odd = [(900 + k, t) for k, t in enumerate(["<P", "<<P", "a<S>b", "<M>", "P>S>M>", "<", "😀" * 50, "é\0x", "<S" * 40, "<P<S<M"] * 9)]
    rows = corpus + odd + [(None, "no id " * 30), (None, None)]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_fill_in_middle(spark, str(tmp_path))
    columns = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert got.columns == columns
    assert found(got, *columns) == Counter(middle(*r) for r in rows)
    forms = Counter(r.form for r in got.collect())
    assert min(forms.get(f, 0) for f in ("plain", "psm", "spm")) > 5


def test_fill_in_middle_equals_its_sql(spark):
    sql = entry.oracle_sql()["op11_fill_in_middle"]
    assert spark_table(entry.queries()["op11_fill_in_middle"](spark, SF)) == duckdb_table(connect(SF), sql)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 300, 9000])
def test_skip_list_finds_every_rank(n):
    rng = np.random.default_rng(n)
    for widths in (np.ones(n, int), rng.integers(1, 9, n), rng.integers(0, 3, n)):
        units = fill_in_middle.SkipList(widths, seed=n)
        ends = np.concatenate([[0], np.cumsum(widths)])
        for rank in {0, n, *rng.integers(0, n + 1, 60).tolist()}:
            assert units.code_points(rank) == ends[rank]
        for place in rng.integers(0, units.length + 1, 60).tolist():
            assert units.units(place) == np.searchsorted(ends, place, "right") - 1
    # a search follows few links
    assert sum(len(lane[1]) for lane in units.lanes[1:]) <= n / 8 + 20


def test_units_of_a_pattern(documents):
    texts = ["one two  three\nfour" * 5, "  ", "word", ""]
    got = fill_in_middle.fill_in_middle(documents(list(enumerate(texts))), r"\S+")
    for r in got.collect():
        text = texts[r.doc_id]
        assert fill_in_middle.restore(r.output, r.form) == text and r.n == len(re.findall(r"\S+|\s+", text))
        if r.form != "plain":
            edges = {0, *(m.end() for m in re.finditer(r"\S+|\s+", text))}
            assert {r.prefix_chars, r.prefix_chars + r.middle_chars} <= edges


# -- conversations


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(name.encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def repaired(rows):
    """gaps, blank, duplicate, truncated, illegal, cost, audit, digest by trying all edits, row by row."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).hexdigest()))
    seen, units, faults = set(), [], Counter()
    for _, _, role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None
        seen.add((role, text))
        faults[fault] += 1
        units.append((role[:1], fault))
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(units, units[1:]))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(maxsize=None)
    def best(i, state, inserted=0):
        ways = [(0, "")] if i == len(units) and state in ("", "a") else []
        if i < len(units):
            initial, fault = units[i]
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                if (state, initial) in follow:
                    cost, audit = best(i + 1, follow[state, initial])
                    ways.append((cost + more, "K" + audit))
                for new in "ua":
                    if (state, new) in follow:
                        cost, audit = best(i + 1, new)
                        ways.append((cost + 2 + more, "R" + audit))
            cost, audit = best(i + 1, state)
            ways.append((cost + 3, "D" + audit))
        if inserted < 3:
            for new in "ua":
                if (state, new) in follow:
                    cost, audit = best(i, new, inserted + 1)
                    ways.append((cost + 2, "I" + audit))
        return min(ways, default=(10 ** 9, ""))

    cost, audit = best(0, "")
    out, state, at = [], "", 0
    for letter in audit:
        own = rows[at] if letter != "I" else None
        if letter == "K":
            state = units[at][0]
            out.append(f"{own[2]}:{own[3]}")
        elif letter in "RI":
            state = "a" if state == "u" else "u"
            out.append(f"{'user' if state == 'u' else 'assistant'}:{own[3] if own else ''}")
        at += letter != "I"
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, brute.sha("\n".join(out)))


def expected(rows):
    groups = defaultdict(list)
    for row in damaged(rows):
        groups[row[0]].append(row)
    return {conv: repaired(groups[conv]) for conv in {r[0] for r in rows}}


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def awkward(rng, conversations, longest):
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "User", "umpire"]
    texts = ["Yes.", "No!", "Why?", "Well", "So. ", "  ", "", None, "\t\n", "Fine.\n", "é.", "Then\xa0", "a" * 3000 + "."]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 2, None, 0]), rng.choice(roles), rng.choice(texts) and
                         rng.choice(texts) and f"{rng.choice(texts) or ''}{rng.choice(['', str(turn) + '.', str(turn)])}"))
    rows += rows[:9] + [(None, 0, "user", "Hi."), (None, 1, "assistant", "Hello."), (-5, None, None, None)]
    return rows


@pytest.mark.parametrize("window", [256, 1, 3])
def test_conversation_repair(spark, tmp_path, window, monkeypatch):
    rows = awkward(random.Random(window), 60, 9)
    rows += [(1000, k, "user" if k % 3 else "assistant", f"{k % 7}." if k % 5 else "dangling") for k in range(150)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, c string, t int")
    table.repartition(4).write.parquet(f"{tmp_path}/conversations.parquet")
    repair = conversation_repair.repair
    monkeypatch.setattr(conversation_repair, "repair", lambda a, b: repair(a, b, window))
    got = queries.op12_conversation_repair(spark, str(tmp_path))
    assert got.columns == COLUMNS and [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"] * 2
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == expected(rows) and got.count() == len(expected(rows))


def test_conversations_of_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = entry.queries()["op12_conversation_repair"](spark, SF)
    assert {r[0]: tuple(r[1:]) for r in got.select(*COLUMNS).collect()} == expected(rows)


def test_every_search_is_least():
    rng = random.Random(3)
    for _ in range(300):
        units = [(rng.choice("suaax"), rng.random() < .2, rng.choice([0, 0, 0, 1, 2])) for _ in range(rng.randint(0, 7))]
        labels = {(0, 0): (0, "")}
        for start in conversation_repair.STATES:
            labels = {(0, start): (0, "")}
            for at in range(len(units) + 1):
                for _ in range(4):
                    for state in conversation_repair.STATES:
                        if (at, state) in labels:
                            cost, text = labels[at, state]
                            for letters, step, to in conversation_repair._forward(units, (at, state), True):
                                labels[to] = min(labels.get(to, (10 ** 9, "")), (cost + step, text + letters))
            ends = [labels[len(units), e] for e in conversation_repair.ENDS if (len(units), e) in labels]
            assert conversation_repair.search(units, start, conversation_repair.ENDS, True) == min(ends)


def test_no_conversations(spark, tmp_path):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    empty.write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op12_conversation_repair(spark, str(tmp_path)).count() == 0


# -- packing


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(fit_packing.VOCABULARY))


def tokens(library, text, capacity):
    """start, length, crc of each piece."""
    ids = library.encode(text or "", add_special_tokens=False).ids + [2]
    cuts = [0, *range(len(ids) % capacity or min(capacity, len(ids)), len(ids), capacity), len(ids)]
    return [(k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]


@pytest.mark.parametrize("capacity", [1024, 64])
def test_packing(documents, corpus, library, capacity):
    rows = corpus + [(2000, "a <|endoftext|> b"), (2001, " " * 300_000 + "x"), (None, "no id"), (None, None)]
    got = fit_packing.pack(documents(rows), capacity)
    want = Counter((i, *piece) for i, t in rows for piece in tokens(library, t, capacity))
    assert found(got, "doc_id", "piece", "start", "length", "ids_crc32") == want
    held = defaultdict(list)
    for r in got.collect():
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= capacity
    total = sum(n for _, _, _, n, _ in want.elements())
    assert len(held) <= -(-total // capacity) * 1.05 + 1


def test_sequences_hold_their_pieces(documents, corpus, library):
    packed = fit_packing.pack(documents(corpus), 128, ids=True).persist()
    parts = {(r.sequence_id, r.offset): r.ids for r in packed.collect()}
    for r in fit_packing.sequences(packed).collect():
        assert len(r.ids) <= 128 and r.starts[0] == 0
        assert [r.ids[a:b] for a, b in zip(r.starts, [*r.starts[1:], None])] == [parts[r.sequence_id, o] for o in r.starts]


def decreasing(sizes, capacity):
    """Sequences of sequential best-fit decreasing."""
    gaps = []
    for size in sorted(sizes, reverse=True):
        fits = [g for g in gaps if g >= size]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else capacity) - size)
    return len(gaps)


@pytest.mark.parametrize("low, high", [(1, 1024), (200, 400), (340, 600), (1, 30)])
def test_rounds_are_as_good_as_one_by_one(low, high):
    sizes = np.random.default_rng(low).integers(low, high, 1500).tolist()
    assert fit_packing.Plan(Counter(sizes)).sequences <= decreasing(sizes, 1024) + 1


def test_the_plan_does_not_grow_with_the_input():
    sizes = Counter(np.random.default_rng(9).integers(1, 1024, 20_000).tolist())
    small = fit_packing.Plan(sizes)
    large = fit_packing.Plan({s: n * 1_000_000 for s, n in sizes.items()})
    assert len(large.rows) < 20_000 and len(large.rows) < 2 * len(small.rows)
    total = sum(s * n for s, n in sizes.items()) * 1_000_000
    assert large.sequences < total / 1024 * 1.03


def test_packing_nothing(documents):
    assert fit_packing.pack(documents([])).count() == 0
    assert fill_in_middle.fill_in_middle(documents([])).count() == 0
