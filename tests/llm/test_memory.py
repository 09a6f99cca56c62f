"""Memory that Python workers take: what an executor has for all of them is bounded."""

import re
import time
import tracemalloc
from pathlib import Path

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from credara.llm import bpe_segment_tree, common, toxic_spans


def peak_mb(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_matches_are_learned_some_at_a_time():
    ranks = bpe_segment_tree.read_ranks(public_tokenizers.path(bpe_segment_tree.VOCABULARY))
    coder = bpe_segment_tree.Encoder(ranks, public_tokenizers.PATTERN)
    pieces = [f" {'qzxv' * 5}{i:06d}" for i in range(60_000)]
    assert peak_mb(lambda: coder._learn(pieces)) < 40
    some = pieces[::7_001] + pieces[-1:]
    assert [ids.tolist() for ids in coder.encode_all(some)] == [
        [i for match in coder.split.findall(t) for i in coder.encode_piece(match.encode())] for t in some]


def test_weights_are_learned_some_at_a_time():
    model = toxic_spans.Model(np.arange(1 << toxic_spans.FEATURE_BITS) / 1e5, np.zeros((2, 2)), np.zeros(3))
    words = [f"word{'abcdefghij'[i % 10]}{i}" for i in range(60_000)]
    assert peak_mb(lambda: model._learn(words)) < 15
    assert all(model._known[w] == model.weights[toxic_spans._features(w)].sum() for w in words[::501])


def test_a_worker_gives_back_what_its_task_has_freed(spark):
    def private_mb(pid: int) -> float:
        return int(re.search(r"Private_Dirty:\s+(\d+)", Path(f"/proc/{pid}/smaps_rollup").read_text())[1]) / 1024

    def run(batches):
        import os

        import pyarrow as pa

        for batch in batches:
            # small pieces, of which the last stays with the worker: the allocator cannot shorten its heap by itself
            held = [bytes(2_000) for _ in range(100_000)]
            os.last_piece = held[-1]
            del held
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()], pa.int64())], ["pid"])

    pid = common.map_batches(spark.range(1).coalesce(1), run, "pid long").collect()[0].pid
    deadline = time.time() + 10
    while private_mb(pid) > 100 and time.time() < deadline:
        time.sleep(0.2)
    assert private_mb(pid) < 100


def test_pipeline_operators_bound_their_rows_and_keep_them(spark, documents, corpus):
    docs = documents(corpus)
    model = toxic_spans.Model(np.zeros(1 << toxic_spans.FEATURE_BITS), np.zeros((2, 2)), np.array([-5.0, 0, 0]))
    assert toxic_spans.keep_clean(docs, model).count() == len(corpus)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == common.ROW_BATCH_BYTES
    common.texts(docs)
    coded = bpe_segment_tree.decode(bpe_segment_tree.encode(docs, keep=True))
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == common.ROW_BATCH_BYTES
    assert coded.where(F.coalesce("row.text", F.lit("")) != F.decode("decoded", "UTF-8")).isEmpty()
    assert coded.count() == len(corpus)
