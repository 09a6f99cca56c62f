"""Star schema: three dimensions and the origination fact."""

from pyspark.sql import DataFrame, functions as F

from credara.functions import calendar
from credara.operators.integrity import is_unique
from credara.operators.keys import PART, POS, dense_key, dense_key_of_placed, key_from_position
from credara.schemas import FACT_ORIGINACIONES
from credara.sources.workspace import Workspace


def dim_cliente(ws: Workspace, stg: DataFrame) -> DataFrame:
    """Distinct (client, name) pairs: a client with two spellings has two rows."""
    clients = stg.select("id_cliente", "nombre_cliente").distinct()
    return dense_key(ws, clients, ["id_cliente", "nombre_cliente"], "cliente_id")


def dim_industria(ws: Workspace, stg: DataFrame) -> DataFrame:
    names = stg.select(F.col("industria").alias("nombre_industria")).distinct()
    return dense_key(ws, names, ["nombre_industria"], "industria_id")


def dim_tiempo(ws: Workspace, stg: DataFrame) -> DataFrame:
    d = F.col("fecha_originacion")
    return (stg.select(d).distinct()
            .select(calendar.date_key(d).alias("tiempo_id"), d,
                    F.year(d).alias("anio"), F.month(d).alias("mes"), calendar.month_name(d).alias("nombre_mes"),
                    F.dayofmonth(d).alias("dia"), calendar.weekday_number(d).alias("dia_semana"),
                    calendar.weekday_name(d).alias("nombre_dia_semana"), F.quarter(d).alias("trimestre"),
                    calendar.is_weekend(d).alias("es_fin_de_semana")))


def fact_originaciones(ws: Workspace, stg: DataFrame, clientes: DataFrame, tiempos: DataFrame,
                       industrias: DataFrame) -> DataFrame:
    """Credits with their dimension keys; ``originacion_id`` is 1..n in id order.

    No broadcast is forced: the dimensions come from written tables, so Catalyst broadcasts those that are
    small and shuffles for the others, where AQE splits a hot client's partition.

    When ``stg`` was saved in key order with its positions and no client has two rows, each credit stays one
    row and its position is the key. Otherwise the joined rows are sorted and numbered, in the partitions of ``stg``
    where it has them.
    """
    in_parts = {PART, POS} <= set(stg.columns)
    placed = in_parts and is_unique(clientes, "id_cliente")
    if placed:
        stg = key_from_position(stg, "originacion_id")
    joined = (stg
              .join(clientes.select("id_cliente", "cliente_id"), "id_cliente", "left")
              .join(tiempos.select("fecha_originacion", "tiempo_id"), "fecha_originacion", "left")
              .join(industrias.select(F.col("nombre_industria").alias("industria"), "industria_id"),
                    "industria", "left"))
    columns = FACT_ORIGINACIONES.fieldNames()
    order = ["id_credito", "cliente_id"]
    if placed:
        # saved first, because sampling the ranges would compute the joins twice
        return _by_date(ws.save("hechos", joined.select(*columns)))
    if in_parts:
        parts = stg.agg(F.coalesce(F.max(PART), F.lit(0))).first()[0] + 1
        return _by_date(dense_key_of_placed(ws, joined.select(PART, *columns[1:]), parts, order, "originacion_id"))
    return _by_date(dense_key(ws, joined.select(*columns[1:]), order, "originacion_id"))


def _by_date(fact: DataFrame) -> DataFrame:
    """The fact in date order, then by key: a file holds a narrow range of dates, so a period reads few files and row
    groups, and a day with very many credits still spreads over several. The ranges are sampled by a scan of its own,
    so it comes from a saved table."""
    return (fact.repartitionByRange("tiempo_id", "originacion_id")
            .sortWithinPartitions("tiempo_id", "originacion_id"))
