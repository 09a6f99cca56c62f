"""Substring deduplication by repeated-phrase automata.

A passage is confirmed as recurring when the same words follow each other more than once: passages are counted, and the
counts do not say where. The confirmed passages of a shard become the patterns of one Aho-Corasick automaton
(pyahocorasick), in which every word is a single letter; all stretches of documents that the shard is responsible for
are streamed through it in the order of documents, which locates every occurrence. The first one found of a passage
stays, one in a later document is removed. ``shared_windows`` deals passages and
stretches to shards, so that an automaton's size is bounded whatever the corpus holds.

Windows are judged on the input, not on what is left. Words are the runs between ASCII white space, unchanged; texts
with fewer words than a window, null and empty ones among them, lose nothing. Repetitions inside one document, or in
rows with the same doc_id, count only if a smaller doc_id holds them too. A null doc_id stands after all others.
"""

from collections import Counter

import ahocorasick
import numpy as np
import xxhash
from pyspark.sql import DataFrame

from credara.llm import shared_windows

WINDOW_WORDS = 13
ANCHOR_WORDS = 4


def words(text: bytes) -> list[bytes]:
    return text.split()


def _hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))


def _cut(found: list[bytes], start: int, stop: int) -> bytes:
    return b" ".join(found[start:stop])


def _letter(number: int) -> str:
    return chr(number + 1 if number < 0xD7FF else number + 0x801)  # surrogates are no letters


def locate(stretches: list[shared_windows.Stretch], window: int = WINDOW_WORDS):
    """``stretch, place`` of every occurrence of a passage that a smaller document holds."""
    letters: dict[bytes, str] = {}
    spelled = []
    for s in stretches:
        found = words(s.content)
        for w in found:
            if w not in letters:
                letters[w] = _letter(len(letters))
        spelled.append("".join(map(letters.__getitem__, found)))
    times = Counter(text[i:i + window] for text in spelled for i in range(len(text) - window + 1))
    automaton = ahocorasick.Automaton()
    for passage, n in times.items():
        if n > 1:
            automaton.add_word(passage, len(automaton))
    del times
    if not len(automaton):
        return
    automaton.make_automaton()
    # stretches come by document inside each group, and a passage belongs to one group: its first occurrence is the least
    first: list[int | None] = [None] * len(automaton)
    for s, text in zip(stretches, spelled):
        for last, passage in automaton.iter(text):
            if first[passage] is None:
                first[passage] = s.doc
            elif first[passage] < s.doc:
                yield s, last - window + 1


KIND = shared_windows.Kind(window=WINDOW_WORDS, gram=ANCHOR_WORDS, units=words, hashes=_hashes, cut=_cut, joint=b" ",
                           within_document=False, match=locate)


def remove_repeated(docs: DataFrame, kind: shared_windows.Kind = KIND) -> DataFrame:
    """``doc_id, n, removed, kept``: words of each row, the runs of words removed, and the kept words joined by a space."""
    return shared_windows.repeated_windows(kind, docs)
