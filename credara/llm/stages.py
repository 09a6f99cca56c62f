"""The pipeline's stages: each applies one operator to ``docs`` and lets its decision take effect.

All stages take any extra columns and hand them on; names that operators use themselves do not clash. A null text counts
as empty, and a null doc_id is a document without a name. Texts are never cut. An empty table stays empty. What stays
of ties and repeated rows is said at each stage.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from credara.llm import block_naming, bpe_segment_tree, common, latent_decontamination, simhash_pivots, toxic_spans
from credara.llm.queries import token_digests


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half stay; the model learns from the labels beside the documents.

    A score of just one half goes. Repeated rows have one score and stay or go together. Documents without an id are
    scored, but not learned from; an empty text is scored like any other.
    """
    model = toxic_spans.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxic_spans.keep_clean(docs, model)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays; one without an id only where no other has one.

    Null and empty texts are equal to each other. Of rows that repeat the same id and text one stays: the least in the
    order of the columns, nulls first.
    """
    return common.keep_rows(docs, block_naming.exact_groups(docs).where("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays; one without an id only where no other
    has one.

    Texts without words are near copies of one another. If the smallest doc_id stands for several texts, the one with
    the least digest stays; of rows that repeat id and text the least in the order of the columns, nulls first.
    """
    return common.keep_rows(docs, simhash_pivots.near_groups(docs).where("kept"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item stay. Repeated rows stay or go together; texts without words stay."""
    found = latent_decontamination.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return common.drop_rows(docs, found)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns of every document that is left, with its token ids and the digests that prove the round trip.

    Every row is encoded, repeated ones as well; an empty text has no ids. Columns of ``docs`` that have the name of one
    that is added give way to it.
    """
    coded = token_digests(bpe_segment_tree.decode(bpe_segment_tree.encode(docs, keep=True)), "ids", "row")
    added = [c for c in coded.columns if c not in ("doc_id", "row")]
    return coded.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in added], *added)
