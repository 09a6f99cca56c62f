"""The pipeline's stages against brute-force versions, each on what its predecessor kept."""

import brute
import public_tokenizers
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from credara.llm import bpe_segment_tree, latent_decontamination, toxic_spans

FOLDER = "/root/testdata/sf0.01"


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stages(spark, ws):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, after = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = ws.save(name, stage(spark, docs, FOLDER))
        after[name] = docs
        assert docs.columns == columns or name == "encode"
    start = rows(spark.read.parquet(f"{FOLDER}/documents.parquet"))

    clean = rows(after["toxicity"])
    model = toxic_spans.train(spark.read.parquet(f"{FOLDER}/documents.parquet"), spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert clean == [r for r, s in zip(start, model.scores([t for _, t in start])) if s[0] < 0.5]
    assert len(clean) > 0.88 * len(start)

    single = rows(after["exact_dedup"])
    assert single == [r for r, (i, keep, _, _) in zip(clean, brute.exact(clean)) if i == keep]

    apart = rows(after["near_dedup"])
    assert apart == [r for r, (i, _, least) in zip(single, brute.near_groups(single)) if i == least]

    own = rows(after["decontaminate"])
    items = [" ".join(latent_decontamination.words_of(r.text)) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    holds = lambda t: any(f" {x} " in f" {' '.join(latent_decontamination.words_of(t))} " for x in items)
    assert own == [r for r in apart if not holds(r[1])] and len(own) < len(apart)

    ranks = bpe_segment_tree.read_ranks(public_tokenizers.path(bpe_segment_tree.VOCABULARY))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = {r.doc_id: r.ids for r in after["encode"].collect()}
    assert ids == {i: library.encode_ordinary(t) for i, t in own}


def test_run_returns_the_last_stage(spark):
    got = entry.queries()["pipeline"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert got.count() > 0 and got.where("sha2(text, 256) <> decoded_sha256").isEmpty()


def test_stages_keep_extra_columns_and_take_awkward_rows(spark, documents, corpus, tmp_path):
    spark.read.parquet(f"{FOLDER}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(corpus + [(None, None), (None, "no id")])
    for table in (docs, docs.limit(0)):
        out = table
        for name, stage in corpus_pipeline.STAGES:
            before = out.columns
            out = stage(spark, out, str(tmp_path))
            if name != "encode":
                assert out.columns == before
        n = out.count()
        assert n == 0 if table is not docs else n > 40


def test_every_query_has_its_name():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()
