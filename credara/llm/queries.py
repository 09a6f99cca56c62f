"""Registered queries of the corpus operators, over whole tables, and the SQL that checks some of them."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from credara.llm import (
    block_labeller, block_naming, bpe_segment_tree, conversation_repair, fill_in_middle, fit_packing,
    latent_decontamination, repeated_phrases, run_length_index, secret_ownership, simhash_pivots, token_counts, toxic_spans)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def token_digests(coded: DataFrame, *more: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of encoded and decoded rows."""
    return coded.select(
        "doc_id", *more, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_pivots.near_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "fingerprint", "component_id")


def removed_digests(found: DataFrame, units: str, *more: Column) -> DataFrame:
    """``doc_id``, units, units removed, and the digest of what stays."""
    length = F.aggregate("removed", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    return found.select("doc_id", F.col("n").alias(units), length.alias("n_removed"), *more,
                        F.sha2("kept", 256).alias("kept_sha256"))


def op2_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return removed_digests(repeated_phrases.remove_repeated(_table(spark, sf_dir, "documents")), "n_words")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return token_digests(bpe_segment_tree.decode(bpe_segment_tree.encode(documents)))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op5_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return block_labeller.extract(pages, block_labeller.train(pages)).withColumn(
        "n_chars", F.length("text").cast("long"))


def op6_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = run_length_index.remove_repeated(_table(spark, sf_dir, "documents"))
    return removed_digests(found, "n_bytes", F.size("removed").cast("long").alias("n_spans"))


def op7_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ownership.digests(secret_ownership.scan(_table(spark, sf_dir, "documents")))


def op8_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    model = toxic_spans.train(documents, _table(spark, sf_dir, "labels"))
    return toxic_spans.score(documents, model).select(
        "doc_id", toxic_spans.is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").alias("n_spans"))


def op9_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = latent_decontamination.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("row_key")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = block_naming.exact_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_in_middle.restored(fill_in_middle.fill_in_middle(_table(spark, sf_dir, "documents")))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = _table(spark, sf_dir, "conversations")
    repaired = conversation_repair.repair(conversation_repair.damage(conversations), conversations)
    digests = conversation_repair.digests(repaired.turns).withColumnRenamed("conv_id", "repaired_id")
    found = repaired.summary.join(digests, F.col("conv_id").eqNullSafe(F.col("repaired_id")), "left").drop("repaired_id")
    return found.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)))


def op13_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_packing.pack(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash_near_dedup, op2_repeated_phrases, op3_byte_bpe, op4_token_counts, op5_block_labeller,
        op6_run_length_index, op7_secret_ownership, op8_toxic_spans,
        op9_latent_decontamination, op10_exact_dedup, op11_fill_in_middle, op12_conversation_repair, op13_fit_packing)}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# kind, pattern, group that holds the value, least characters of the value
_SECRETS = (
    ("assign", 0, r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", 1, "AKIA[A-Z0-9]+", 0, 20),
    ("hex", 2, "[0-9a-f]+", 0, 24),
    ("owned", 3, "[A-Za-z0-9+/_-]+", 0, 16))

_MATCHES = " UNION ALL ".join(f"""
    SELECT doc_id, source, '{kind}' AS kind, {number} AS kind_no, unnest(range(1, len(m) + 1)) AS i,
           unnest(m) AS m, unnest(v) AS v, unnest(b[1:len(m)]) AS b, {least} AS least
    FROM (SELECT doc_id, source, regexp_extract_all(text, '{pattern}', 0) AS m,
                 regexp_extract_all(text, '{pattern}', {group}) AS v,
                 string_split_regex(text, '{pattern}') AS b FROM documents)"""
    for kind, number, pattern, group, least in _SECRETS)

ORACLE_SQL: dict[str, str] = {
    "op7_secret_ownership": f"""
        WITH found AS ({_MATCHES}),
        placed AS (SELECT doc_id, source, kind, kind_no, v, least, m,
                          sum(length(b) + length(m)) OVER (PARTITION BY doc_id, kind ORDER BY i)::BIGINT AS stop
                   FROM found),
        valid AS (SELECT doc_id, source, kind, kind_no, v, stop - length(m) AS start, stop FROM placed
                  WHERE length(v) >= least AND (kind_no < 3 OR v ~ '.*[0-9].*' AND v ~ '.*[A-Za-z].*')),
        free AS (SELECT * FROM valid t WHERE kind_no < 3 OR NOT EXISTS (
                 SELECT 1 FROM valid b WHERE b.kind_no < 3 AND b.doc_id = t.doc_id
                 AND b.start < t.stop AND b.stop > t.start)),
        owned AS (SELECT v, count(DISTINCT source) <= 1 AND count(DISTINCT doc_id) <= 3 AS live FROM free GROUP BY v),
        shown AS (SELECT doc_id, kind_no, live, start, kind || ':' || start || ':' || stop AS span
                  FROM free JOIN owned USING (v) WHERE kind_no < 3 OR live),
        by_doc AS (SELECT doc_id, count(*) FILTER (kind_no = 0) AS n_assign, count(*) FILTER (kind_no = 1) AS n_access,
                          count(*) FILTER (kind_no = 2) AS n_hex,
                          string_agg(span, ',' ORDER BY start, kind_no) FILTER (kind_no < 3) AS base,
                          string_agg(span, ',' ORDER BY start, kind_no) AS spans, count(*) FILTER (live) AS n_live
                   FROM shown GROUP BY doc_id)
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
               coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
               coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
        FROM documents LEFT JOIN by_doc USING (doc_id)""",
    "op10_exact_dedup": f"""
        WITH normal AS (SELECT doc_id, {_LOWERED} AS t FROM documents),
        groups AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM normal JOIN groups USING (t)""",
    "op11_fill_in_middle": """
        WITH drawn AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                              sha256('1:' || doc_id) AS h FROM documents),
        numbers AS (SELECT *, ('0x' || h[1:8])::BIGINT % (n + 1) AS a, ('0x' || h[9:16])::BIGINT % (n + 1) AS b,
                           ('0x' || h[17:24])::BIGINT % 100 AS p, ('0x' || h[25:32])::BIGINT % 100 AS q FROM drawn),
        formed AS (SELECT *, least(a, b) AS i, greatest(a, b) AS j,
                          CASE WHEN t = '' OR p >= 90 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                               WHEN q < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
        parts AS (SELECT *, substr(t, 1, i) AS x, substr(t, i + 1, j - i) AS y, substr(t, j + 1) AS z FROM formed)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN i END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN j - i END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y
                      ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
               sha256(t) AS restored_sha256 FROM parts""",
}
