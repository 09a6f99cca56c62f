"""Staging: filter, type, range-check and deduplicate raw credits."""

from pyspark.sql import Column, DataFrame, functions as F

from credara.functions.text import NUMBER, is_date_shaped, shaped_to_date, strip, to_int
from credara.operators.dedup import keep_first
from credara.schemas import MAX_AMOUNT, MIN_AMOUNT, STAGING


def _select(raw: DataFrame, fecha: Column, monto: Column, plazo: Column) -> DataFrame:
    """Staging columns, keeping ``fila`` for tie-breaking."""
    return raw.select(
        "id_credito", fecha.alias("fecha_originacion"), "id_cliente", "nombre_cliente", "industria",
        monto.alias("monto"), plazo.alias("plazo_meses"), "canal", "estatus_primer_pago",
        *[c for c in ("archivo", "fila") if c in raw.columns])


def stg_gated(clean: DataFrame, fractions: bool = True) -> DataFrame:
    """Staging of rows that passed the strict gate: no empty, unparseable or out-of-range value is left and no
    id appears twice, so dates and amounts are cast without checking again and nothing is shuffled."""
    fecha, monto = strip(F.col("fecha_originacion")).try_cast("date"), F.col("monto").try_cast("double")
    return _select(clean, fecha, monto, to_int(F.col("plazo_meses"), fractions)).select(*STAGING.fieldNames())


def stg_creditos(raw: DataFrame, month_first: bool = False, fractions: bool = True) -> DataFrame:
    """The staging table of unchecked rows: the earliest-dated valid row per id, ties by physical order.

    The shape of dates and amounts is tested once, in the first filter; after it plain casts are enough.
    """
    fecha, monto = strip(F.col("fecha_originacion")), F.col("monto")
    shaped = raw.where((F.col("id_credito") != "") & is_date_shaped(fecha, month_first) & monto.rlike(NUMBER))
    valid = (_select(shaped, shaped_to_date(fecha, month_first), monto.try_cast("double"),
                     to_int(F.col("plazo_meses"), fractions))
             .where(F.col("fecha_originacion").isNotNull() & F.col("monto").between(MIN_AMOUNT, MAX_AMOUNT)))
    tie = [c for c in ("archivo", "fila") if c in valid.columns]
    return keep_first(valid, "id_credito", ["fecha_originacion", *tie]).select(*STAGING.fieldNames())
