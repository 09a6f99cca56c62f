"""Synthetic credits with faults at known rates, generated in parallel and reproducible by seed."""

from datetime import date
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from credara.functions.text import is_blank, to_date, to_double, zero_padded
from credara.schemas import CHANNELS, INDUSTRIES, LATE, MAX_AMOUNT, MIN_AMOUNT, ON_TIME, TERMS

# The fault and status rates of the generated file.
NULL_ID, NULL_AMOUNT, NULL_DATE = 0.02, 0.02, 0.02
NEGATIVE_AMOUNT = 0.015
INVALID_DATE = 0.01
DUPLICATE_ID = 0.01
ON_TIME_SHARE = 0.75
DAYS_BACK = 90

_UNIT = float(1 << 53)


def _draw(seed: int, what: str) -> Column:
    """A number below 2^53 that depends on the row, the seed and the purpose only."""
    return F.shiftrightunsigned(F.xxhash64(F.col("id"), F.lit(seed), F.lit(what)), 11)


def _uniform(seed: int, what: str) -> Column:
    return _draw(seed, what) / F.lit(_UNIT)


def _choice(values: list, seed: int, what: str) -> Column:
    pick = (F.pmod(_draw(seed, what), F.lit(len(values))) + 1).cast("int")
    return F.element_at(F.array(*map(F.lit, values)), pick)


def _multiplier(n: int) -> int:
    """Makes id -> id * m mod n a one-to-one map of 0..n-1 onto itself."""
    m = 611_953
    while gcd(m, n) != 1:
        m += 2
    return m


def from_ids(ids: DataFrame, n: int, seed: int = 2025, as_of: date | None = None) -> DataFrame:
    """Nine raw text columns for the numbers 1..``n`` in column ``id``."""
    as_of = as_of or date.today()
    i = F.col("id")
    original = F.when((_uniform(seed, "dup") < DUPLICATE_ID) & (i > 1),
                      i - 1 - F.pmod(_draw(seed, "dup de"), F.greatest(i - 1, F.lit(1)))).otherwise(i)
    day = (F.pmod(_draw(seed, "dia"), F.lit(28)) + 1)
    month = (F.pmod(_draw(seed, "mes"), F.lit(12)) + 1)
    bad_date = _choice([0, 1, 2], seed, "fecha mala")
    invalid = (F.when(bad_date == 0, zero_padded("2024-13-", day, 2))
               .when(bad_date == 1, "2024-02-30")
               .otherwise(F.concat(zero_padded("", day, 2), zero_padded("/", month, 2), F.lit("/2024"))))
    back = F.pmod(_draw(seed, "fecha"), F.lit(DAYS_BACK + 1)).cast("int")
    valid = F.date_sub(F.lit(as_of), back).cast("string")
    amount = F.round(MIN_AMOUNT + _uniform(seed, "monto") * (MAX_AMOUNT - MIN_AMOUNT), 2).cast("decimal(9,2)")
    amount = F.when(_uniform(seed, "negativo") < NEGATIVE_AMOUNT, -amount).otherwise(amount)
    client = F.pmod((i - 1) * F.lit(_multiplier(n)), F.lit(n)) + 1
    return ids.select(
        F.when(_uniform(seed, "sin id") >= NULL_ID, zero_padded("CRED-", original, 5)).alias("id_credito"),
        F.when(_uniform(seed, "sin fecha") >= NULL_DATE,
               F.when(_uniform(seed, "invalida") < INVALID_DATE, invalid).otherwise(valid)).alias("fecha_originacion"),
        zero_padded("CLI-", client, 5).alias("id_cliente"),
        zero_padded("Cliente ", client, 5).alias("nombre_cliente"),
        _choice(INDUSTRIES, seed, "industria").alias("industria"),
        F.when(_uniform(seed, "sin monto") >= NULL_AMOUNT, amount.cast("string")).alias("monto"),
        _choice(TERMS, seed, "plazo").cast("string").alias("plazo_meses"),
        _choice(CHANNELS, seed, "canal").alias("canal"),
        F.when(_uniform(seed, "estatus") < ON_TIME_SHARE, ON_TIME).otherwise(LATE).alias("estatus_primer_pago"))


def generate(spark: SparkSession, n: int = 5_000, seed: int = 2025, as_of: date | None = None) -> DataFrame:
    return from_ids(spark.range(1, n + 1), n, seed, as_of)


def fault_profile(raw: DataFrame) -> DataFrame:
    """One row: totals and shares of each injected fault. The distinct count is the only shuffle."""
    is_null = {c: is_blank(F.col(c)) for c in ("id_credito", "monto", "fecha_originacion")}
    fecha = F.col("fecha_originacion")
    counts = raw.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_null["id_credito"]).alias("nulos_id_credito"),
        F.count_if(is_null["monto"]).alias("nulos_monto"),
        F.count_if(is_null["fecha_originacion"]).alias("nulos_fecha_originacion"),
        F.count_if(to_double(F.col("monto")) < 0).alias("montos_negativos"),
        F.count_if(~is_null["fecha_originacion"] & to_date(fecha).isNull()).alias("fechas_invalidas"),
        (F.count_if(~is_null["id_credito"])
         - F.count_distinct(F.when(~is_null["id_credito"], F.col("id_credito")))).alias("ids_duplicados"))
    shares = ["nulos_id_credito", "nulos_monto", "nulos_fecha_originacion", "montos_negativos", "fechas_invalidas"]
    return counts.select("*", *[
        (F.round(F.try_divide(F.col(c) * 1000.0, F.col("total"))) / 10.0).alias(f"pct_{c}") for c in shares])
