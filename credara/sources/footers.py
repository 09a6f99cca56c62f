"""Row counts that read no rows: Parquet footers know them."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Folders = dict[str, tuple[T.StructType, str]]


def _footer_session(spark: SparkSession) -> SparkSession:
    """A session beside this one whose Parquet reader takes aggregates from footers; settings of ``spark`` stay."""
    session = spark.newSession()
    listed = session.conf.get("spark.sql.sources.useV1SourceList").split(",")
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in listed if s != "parquet"))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return session


def counts(spark: SparkSession, folders: Folders) -> DataFrame:
    """(tabla, filas) of Parquet folders: a task reads the footers of its files, no row group. Without any row in its
    files a table has NULL: the reader adds up counts, and there is none to add."""
    session = _footer_session(spark)
    parts = [session.read.schema(schema).parquet(folder).agg(F.count(F.lit(1)).alias("filas"))
             .select(F.lit(table).alias("tabla"), "filas") for table, (schema, folder) in folders.items()]
    return reduce(DataFrame.unionByName, parts)


def row_counts(spark: SparkSession, folders: Folders) -> dict[str, int]:
    """Rows of each Parquet folder."""
    return {r.tabla: r.filas or 0 for r in counts(spark, folders).collect()} if folders else {}
