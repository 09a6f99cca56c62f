"""Incremental arrival of credit files: validate each batch, keep its clean rows and its failure log.

Every batch writes its own ``lote=<id>`` folder in overwrite mode, so a batch that is run again after a
failure replaces its own output and nothing is lost or doubled.

An id is taken once: a batch rejects ids that an earlier one has loaded or has rejected as repeated. An id whose row
broke another rule may come again, corrected. What batches have decided about ids is kept by itself, so that a batch
never reads the loaded rows: as runs sorted by the id's hash, one for each batch. Before a batch begins, eight runs of
one level are merged into one of the next, in which an id stands once; so the number of runs grows with the logarithm
of the number of batches, and each id is rewritten as often. A run has as many files as its ids need.
"""

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from credara.operators import quality
from credara.schemas import FAILURE_LOG, RAW
from credara.session import path_exists
from credara.sources.csv_files import blank_na, file_lines, number_rows
from credara.sources.workspace import Workspace

_BATCH = "lote"
_BUCKET = "balde"
# Runs are sorted by this many values of the hash; a batch with ids in few of them reads those row groups.
_BUCKETS = 4096
_FEW = 10
# Runs of one level that are merged, and ids in one file: a file is sorted by one task, and a batch waits for its run.
# Files of merged runs are larger, so that they stay few.
_FAN = 8
_FILE_IDS = 250_000
_MOST_FILE_IDS = 4_000_000
_RUN = re.compile(r"n(\d+)-(\d+)-(\d+)")
_DECIDED = "rid string, copias long, lote long, balde int"


def read_loaded(spark: SparkSession, out: str) -> DataFrame:
    """Clean rows of all batches so far, with their batch number."""
    schema = T.StructType([*RAW.fields, T.StructField("archivo", T.StringType()),
                           T.StructField("fila", T.LongType()), T.StructField(_BATCH, T.LongType())])
    return spark.read.schema(schema).option("basePath", f"{out}/limpios").parquet(f"{out}/limpios/lote=*")


def read_failures(spark: SparkSession, out: str) -> DataFrame:
    schema = T.StructType([*FAILURE_LOG.fields, T.StructField(_BATCH, T.LongType())])
    return spark.read.schema(schema).option("basePath", f"{out}/fallos").parquet(f"{out}/fallos/lote=*")


def runs(spark: SparkSession, out: str) -> list[tuple[int, int, int, str]]:
    """(level, first batch, last batch, folder) of the finished runs, in order; one that a merged run holds is left out."""
    fs = spark._jvm.org.apache.hadoop.fs
    home = fs.Path(f"{out}/ids")
    files = home.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in files.listStatus(home) if files.exists(home) else []:
        name = _RUN.fullmatch(status.getPath().getName())
        if name and files.exists(fs.Path(status.getPath(), "_SUCCESS")):
            found.append((*map(int, name.groups()), f"{out}/ids/{name[0]}"))
    inside = lambda a, b: a[0] < b[0] and b[1] <= a[1] and a[2] <= b[2]
    return sorted((r for r in found if not any(inside(r, other) for other in found)), key=lambda r: r[1])


def read_decided(spark: SparkSession, out: str, before: int | None = None) -> DataFrame:
    """(rid, copias, lote, balde): ids that batches, by default all, have loaded or rejected as repeated."""
    folders = [folder for _, _, last, folder in runs(spark, out) if before is None or last < before]
    return spark.read.schema(_DECIDED).parquet(*folders) if folders else spark.createDataFrame([], _DECIDED)


def run_files(ids: int, level: int) -> int:
    return max(1, -(-ids // min(_FILE_IDS << level, _MOST_FILE_IDS)))


def _write_run(ids: DataFrame, out: str, level: int, first: int, last: int) -> None:
    files = run_files(ids.count(), level)
    order = [_BUCKET, "rid"]
    ids = ids.select("rid", "copias", _BATCH, _BUCKET).repartitionByRange(files, *order).sortWithinPartitions(*order)
    ids.write.mode("overwrite").parquet(f"{out}/ids/n{level}-{first:09d}-{last:09d}")


def merge_runs(ws: Workspace, out: str, before: int) -> None:
    """Merge the runs of batches before ``before`` while a level has enough of them. A run is complete before those it
    replaces are deleted, and until then it counts instead of them; so a merge may break off anywhere."""
    spark = ws.spark
    level = 0
    while True:
        known = [r for r in runs(spark, out) if r[2] < before]
        own = [r for r in known if r[0] == level]
        if len(own) >= _FAN:
            first, last = own[0][1], own[-1][2]
            ids = spark.read.schema(_DECIDED).parquet(*[r[3] for r in own]).groupBy("rid", _BUCKET).agg(
                F.sum("copias").alias("copias"), F.min(_BATCH).alias(_BATCH))
            _write_run(ws.save("tanda", ids), out, level + 1, first, last)
            for *_, folder in own:
                target = spark._jvm.org.apache.hadoop.fs.Path(folder)
                target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        elif not any(r[0] > level for r in known):
            return
        level += 1


def _bucket(rid: str):
    return F.pmod(F.xxhash64(rid), F.lit(_BUCKETS)).cast("int").alias(_BUCKET)


def flagged_with_history(ws: Workspace, raw: DataFrame, decided: DataFrame) -> DataFrame:
    """Flagged identifiers of a batch when earlier batches count too: (rid, copias, previas).

    An id is a duplicate when the batch repeats it or an earlier batch has decided about it. The batch's ids are
    saved first: with their size known they are broadcast to the history scan while small, and where they fall into a
    few buckets only, the scan skips the row groups of others.
    """
    counts = ws.save("lote_ids", quality.identifier_counts(raw).select("rid", "copias", "blancos", _bucket("rid")))
    own = counts.where("copias > 0").select("rid", _BUCKET)
    few = [r[0] for r in own.select(_BUCKET).distinct().limit(_FEW + 1).collect()]
    if len(few) <= _FEW:
        decided = decided.where(F.col(_BUCKET).isin(few))
    known = decided.join(own, ["rid", _BUCKET], "left_semi").groupBy("rid").agg(F.sum("copias").alias("previas"))
    counts = counts.drop(_BUCKET)
    merged = counts.join(known, "rid", "left")
    condemned = ((F.col("copias") > 1) | ((F.col("copias") == 1) & (F.col("blancos") > 0))
                 | ((F.col("copias") > 0) & F.col("previas").isNotNull()))
    return merged.where(condemned).select("rid", "copias", F.coalesce("previas", F.lit(0)).alias("previas"))


def _duplicate_log(flagged: DataFrame) -> DataFrame:
    """One entry per copy in the batch; the message counts the copies of earlier batches as well."""
    known = flagged.withColumn("todas", F.col("copias") + F.col("previas")).where("todas > 1")
    return quality.expand_duplicates(known, "todas")


def process_batch(ws: Workspace, batch: DataFrame, batch_id: int, out: str, na_tokens: bool = True) -> None:
    """Validate one batch of file lines that know their split, and write its clean rows and failures."""
    spark = batch.sparkSession
    # rules, clean rows and log all read the rows: they are put together once
    raw = ws.save("lote", number_rows(ws, batch, per_file=True))
    raw = blank_na(raw) if na_tokens else raw
    flagged = quality.flagged_identifiers(raw).withColumn("previas", F.lit(0).cast("bigint"))
    if batch_id > 0:
        merge_runs(ws, out, batch_id)
        flagged = flagged_with_history(ws, raw, read_decided(spark, out, batch_id))
    flagged = ws.save("lote_marcados", flagged)
    # written once, where it is kept; a batch that is run again replaces it
    loaded_rows = f"{out}/limpios/{_BATCH}={batch_id}"
    clean = quality.clean_rows(raw, flagged)
    clean.write.mode("overwrite").parquet(loaded_rows)
    clean = spark.read.schema(clean.schema).parquet(loaded_rows)
    log = quality.row_failures(raw).unionByName(_duplicate_log(flagged))
    loaded = clean.select(quality.row_identifier(clean).alias("rid"), F.lit(1).cast("bigint").alias("copias"))
    decided = loaded.unionByName(flagged.where("copias > 0").select("rid", "copias")).select(
        "rid", "copias", F.lit(batch_id).cast("bigint").alias(_BATCH), _bucket("rid"))
    _write_run(decided, out, 0, batch_id, batch_id)
    log.write.mode("overwrite").parquet(f"{out}/fallos/{_BATCH}={batch_id}")


def load_new_files(ws: Workspace, folder: str, out: str, files_per_batch: int | None = None,
                   na_tokens: bool = True) -> StreamingQuery:
    """Process the files not seen before in ``folder`` and stop. Call it again after new files arrive.

    Batches without the progress that numbered them would be replaced by the next run, so that is refused.
    """
    if path_exists(ws.spark, f"{out}/limpios") and not path_exists(ws.spark, f"{out}/_avance"):
        raise RuntimeError(f"{out} holds loaded batches but no progress: restore _avance or load into another folder")
    reader = ws.spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (file_lines(reader, folder).writeStream
            .foreachBatch(lambda batch, batch_id: process_batch(ws, batch, batch_id, out, na_tokens))
            .option("checkpointLocation", f"{out}/_avance")
            .trigger(availableNow=True).start())
