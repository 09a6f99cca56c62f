"""Helpers shared by the corpus operators.

Operators read only the columns they name, so further columns of the input never clash with theirs. A null text
counts as empty everywhere.
"""

import ctypes
import hashlib
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from credara.sources.workspace import Workspace

# Rows handed to Python at once; texts differ in length by a factor of 10,000.
BATCH_BYTES = "4m"
# The same for operators that hand whole rows back, of which an executor holds several copies on their way.
ROW_BATCH_BYTES = "1m"


_shipped: set[str] = set()


def bound_batches(spark: SparkSession, size: str = BATCH_BYTES) -> None:
    """Keep Arrow batches small, so that a task's memory does not depend on the length of its texts; send this package
    to the executors, once for each application."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).parent.parent
        archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for path in sorted(package.rglob("*.py")):
                out.write(path, path.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)


def release_memory() -> None:
    """Give the system back what this process has freed; allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` whose workers keep no freed memory between tasks: an executor has more of them than tasks, and
    each would keep that of its largest one."""
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()

    return df.mapInArrow(whole, schema)


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and text alone; a null text becomes the empty one."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))


def workspace(df: DataFrame) -> Workspace:
    return Workspace(df.sparkSession)


def row_key(doc_id, text):
    """Identity of a row's key and text, never null; rows that share it differ in other columns at most."""
    return F.sha2(F.concat_ws("\0", F.coalesce(doc_id.cast("string"), F.lit("-")), F.coalesce(text, F.lit(""))), 256)


def row_key_of(doc_id: int | None, text: str) -> str:
    """``row_key`` inside Python tasks."""
    return hashlib.sha256(f"{'-' if doc_id is None else doc_id}\0{text}".encode()).hexdigest()


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with their row key, under a name they do not have."""
    name = "row_key"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, row_key(docs["doc_id"], docs["text"])), name


def keep_rows(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``row_key`` is in ``kept``, all columns. Of rows that repeat id and text one stays: the
    least in the order of the columns, nulls first.

    One shuffle by a key that is spread evenly, whatever the hot sources; repeated rows combine on the map side.
    """
    keyed, name = _keyed(docs)
    kept = kept.select(F.col("row_key").alias(name)).distinct()
    least = F.min(F.struct(*docs.columns)).alias("least")
    return keyed.join(kept, name, "left_semi").groupBy(name).agg(least).select("least.*")


def drop_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``row_key`` is not in ``dropped``, all columns, repeated rows included."""
    keyed, name = _keyed(docs)
    dropped = dropped.select(F.col("row_key").alias(name)).distinct()
    return keyed.join(dropped, name, "left_anti").select(*docs.columns)
