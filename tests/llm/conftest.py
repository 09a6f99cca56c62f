import random

import pytest

# names that operators use for their own columns
EXTRA = "lang string, source string, n_chars long, row_key string, fp long, key long, name string, row long, words string"


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) rows, with columns whose names operators use, too."""
    def make(rows, parts=3):
        full = [(i, t, "en", f"src{(i or 0) % 3}", None, "x", 1, 2, "n", None, None) for i, t in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, {EXTRA}").repartition(parts)
    return make


@pytest.fixture
def corpus():
    """Made-up texts: copies, near copies, shared passages, repetitions, empty, null and long ones."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(("an", "er", "tion", "the", "Ou", "ü", "st")) for _ in range(rng.randint(1, 4)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, rows = prose(40), []
    texts = [prose(rng.randint(1, 120)) for _ in range(30)]
    texts += texts[:6] + [t.upper() for t in texts[:2]] + [t + " more" for t in texts[6:10]]
    texts += [prose(15) + "\n" + passage + " " + prose(9) for _ in range(6)] + [passage, passage + " " + passage]
    texts += [None, "", " \t\n", None, "", "A", "a b", "ab " * 400, "x" * 3000, "xy" * 2000, prose(3000), "é" * 130]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    return rows + [rows[3], rows[3], rows[17], (5, "another text under a used id " * 9), (-4, passage)]
