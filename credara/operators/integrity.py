"""Integrity checks: keys, references, NULLs and row counts. Every check aggregates before it joins."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from credara.schemas import BUSINESS_KEYS, FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS

Tables = dict[str, DataFrame]


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """(clave, filas): key values held by several rows, and the NULL key."""
    return (df.groupBy(F.col(key).alias("clave")).agg(F.count(F.lit(1)).alias("filas"))
            .where((F.col("filas") > 1) | F.col("clave").isNull())
            .withColumn("clave", F.col("clave").cast("string")))


def _key_report(tables: Tables, keys: dict[str, str]) -> DataFrame:
    return _stack([
        key_violations(tables[t], key).agg(
            F.count("clave").alias("claves_repetidas"),
            F.coalesce(F.sum(F.when(F.col("clave").isNull(), F.col("filas"))), F.lit(0)).alias("filas_nulas"))
        .select(F.lit(t).alias("tabla"), F.lit(key).alias("clave"), "claves_repetidas", "filas_nulas")
        for t, key in keys.items() if t in tables])


def check_primary_keys(tables: Tables) -> DataFrame:
    return _key_report(tables, PRIMARY_KEYS)


def check_business_keys(tables: Tables) -> DataFrame:
    """Dimensions should hold one row per business key; a client with two spellings breaks that and fans out
    the fact."""
    return _key_report(tables, BUSINESS_KEYS)


def is_unique(df: DataFrame, key: str) -> bool:
    repeated = key_violations(df, key).where(F.col("clave").isNotNull())
    return repeated.isEmpty()


def orphans(fact: DataFrame, fk: str, dim: DataFrame) -> DataFrame:
    """(fk, filas): non-NULL references without a dimension row. The fact is reduced to its distinct
    references first, so a reference held by a third of the rows joins once."""
    used = fact.where(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("filas"))
    return used.join(dim.select(fk), fk, "left_anti")


def check_foreign_keys(tables: Tables) -> DataFrame:
    fact = tables["marts.fact_originaciones"]
    nulls = fact.agg(*[F.count_if(F.col(fk).isNull()).alias(fk) for fk in FOREIGN_KEYS])
    parts = []
    for fk, dim in FOREIGN_KEYS.items():
        lost = orphans(fact, fk, tables[dim]).agg(F.coalesce(F.sum("filas"), F.lit(0)).alias("huerfanas"))
        parts.append(lost.select(F.lit(fk).alias("columna"), F.lit(dim).alias("dimension"), "huerfanas",
                                 nulls.select(fk).scalar().alias("nulas")))
    return _stack(parts)


def check_not_null(tables: Tables) -> DataFrame:
    parts = []
    for t, columns in NOT_NULL.items():
        if t in tables:
            parts += [tables[t].agg(F.count_if(F.col(c).isNull()).alias("nulas"))
                      .select(F.lit(t).alias("tabla"), F.lit(c).alias("columna"), "nulas") for c in columns]
    return _stack(parts)


def violations(tables: Tables) -> DataFrame:
    """(comprobacion, tabla, columna, filas): what the four checks found, nothing if all holds."""
    one = lambda df, check, table, column, rows: df.select(
        F.lit(check).alias("comprobacion"), F.col(table).alias("tabla"), F.col(column).alias("columna"), rows.alias("filas"))
    keys = F.col("claves_repetidas") + F.col("filas_nulas")
    parts = [one(check_primary_keys(tables), "clave primaria", "tabla", "clave", keys),
             one(check_business_keys(tables), "clave de negocio", "tabla", "clave", keys),
             one(check_foreign_keys(tables), "referencia", "dimension", "columna", F.col("huerfanas") + F.col("nulas")),
             one(check_not_null(tables), "no nulo", "tabla", "columna", F.col("nulas"))]
    return _stack(parts).where("filas > 0")


def enforced(tables: Tables) -> DataFrame:
    """(comprobacion, tabla, columna, filas) of broken constraints that the model declares: primary keys unique and not
    NULL, references that lead somewhere (a NULL one is allowed), required columns filled. Business keys are reported
    by ``violations``, but no constraint."""
    keys = check_primary_keys(tables).select(
        F.lit("clave primaria").alias("comprobacion"), "tabla", F.col("clave").alias("columna"),
        (F.col("claves_repetidas") + F.col("filas_nulas")).alias("filas"))
    parts = [keys, check_not_null(tables).select(F.lit("no nulo").alias("comprobacion"), "tabla", "columna", F.col("nulas").alias("filas"))]
    fact = "marts.fact_originaciones"
    if fact in tables:
        parts += [orphans(tables[fact], fk, tables[dim]).agg(F.coalesce(F.sum("filas"), F.lit(0)).alias("filas"))
                  .select(F.lit("referencia").alias("comprobacion"), F.lit(fact).alias("tabla"), F.lit(fk).alias("columna"), "filas")
                  for fk, dim in FOREIGN_KEYS.items() if dim in tables]
    return _stack(parts).where("filas > 0")


def row_counts(tables: Tables) -> DataFrame:
    return _stack([df.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(t).alias("tabla"), "filas")
                   for t, df in tables.items()])
