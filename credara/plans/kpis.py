"""Origination and collection KPIs over the star schema.

Facts are aggregated on their surrogate keys first and the few result rows meet the dimension afterwards, so
no KPI joins the full fact and a hot industry or day combines on the map side. KPIs that add up take a fact or a
stored roll-up (``rollup.Rollup``); both give the same states.
"""

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from credara.functions.calendar import in_days
from credara.functions.money import cents, from_cents, mean_from_cents, percent
from credara.operators.percentiles import exact_percentiles
from credara.plans import rollup
from credara.plans.rollup import Rollup
from credara.schemas import LATE_LIMIT_PCT
from credara.sources.workspace import Workspace

GLOBAL = "Global"

Credits = DataFrame | Rollup


def _ticket() -> Column:
    return mean_from_cents(F.col("centavos"), F.col("n")).alias("ticket_promedio")


def _amount(name: str) -> Column:
    return from_cents(F.col("centavos")).alias(name)


def _extreme(column: str, name: str, decimals: int = 2) -> Column:
    return F.round(column, decimals).alias(name)


def in_period(fact: Credits, start: date, end: date) -> Credits:
    """Credits originated from ``start`` to ``end``, both included, by the smart date key: no join."""
    if isinstance(fact, Rollup):
        return fact.in_period(start, end)
    return fact.where(in_days("tiempo_id", start, end))


def by_industry(fact: Credits, dim_industria: DataFrame) -> DataFrame:
    """States per industry name; credits whose industry is unknown drop out, as in an inner join."""
    return (rollup.of(fact).by("industria_id").join(dim_industria, "industria_id")
            .groupBy("nombre_industria").agg(*rollup.merged()))


def total(fact: Credits) -> DataFrame:
    return rollup.of(fact).by().select(
        F.col("n").alias("total_creditos"), _amount("monto_total_originado"), _ticket())


def top_industries(fact: Credits, dim_industria: DataFrame, k: int = 5) -> DataFrame:
    return (by_industry(fact, dim_industria)
            .orderBy(F.desc_nulls_last("centavos"), F.asc_nulls_last("nombre_industria")).limit(k)
            .select("nombre_industria", F.col("n").alias("num_creditos"), _amount("monto_total"), _ticket()))


def ticket_by_segment(fact: Credits) -> DataFrame:
    return (rollup.of(fact).by("segmento")
            .select("segmento", F.col("n").alias("num_creditos"), _amount("monto_total"), _ticket(),
                    _extreme("monto_min", "ticket_minimo"), _extreme("monto_max", "ticket_maximo"))
            .orderBy(F.asc_nulls_last("ticket_promedio")))


def first_payment(fact: Credits) -> DataFrame:
    return rollup.of(fact).by().select(
        F.col("n").alias("total_creditos"), F.col("a_tiempo").alias("pagos_a_tiempo"),
        F.col("tardios").alias("pagos_tardios"), percent(F.col("a_tiempo"), F.col("n")).alias("pct_a_tiempo"),
        percent(F.col("tardios"), F.col("n")).alias("pct_tardio"))


def late_index(fact: Credits, dim_industria: DataFrame, limit_pct: float = LATE_LIMIT_PCT) -> DataFrame:
    """Industries whose share of late first payments, rounded, exceeds the limit."""
    return (by_industry(fact, dim_industria)
            .select("nombre_industria", F.col("n").alias("total_creditos"),
                    F.col("tardios").alias("creditos_morosos"),
                    percent(F.col("tardios"), F.col("n")).alias("indice_mora_pct"))
            .where(F.col("indice_mora_pct") > limit_pct)
            .orderBy(F.desc_nulls_last("indice_mora_pct"), F.asc_nulls_last("nombre_industria")))


def channel_mix(fact: Credits) -> DataFrame:
    everything = rollup.of(fact).by().select("n").scalar()
    return (rollup.of(fact).by("canal")
            .select("canal", F.col("n").alias("num_creditos"), _amount("monto_total"), _ticket(),
                    percent(F.col("n"), everything).alias("pct_del_total"))
            .orderBy(F.desc_nulls_last("monto_total"), F.asc_nulls_last("canal")))


def term_by_industry(fact: Credits, dim_industria: DataFrame) -> DataFrame:
    mean = F.round(F.try_divide(F.col("plazos") * 10.0, F.col("con_plazo"))) / 10.0
    return (by_industry(fact, dim_industria)
            .select("nombre_industria", F.col("n").alias("num_creditos"), mean.alias("plazo_promedio_meses"),
                    "plazo_min", "plazo_max")
            .orderBy(F.desc_nulls_last("plazo_promedio_meses"), F.asc_nulls_last("nombre_industria")))


def channel_tickets(fact: Credits) -> DataFrame:
    return (rollup.of(fact).by("canal")
            .select("canal", F.col("n").alias("num_creditos"), _extreme("monto_min", "ticket_minimo"),
                    _extreme("monto_max", "ticket_maximo"), _ticket())
            .orderBy(F.desc_nulls_last("ticket_promedio"), F.asc_nulls_last("canal")))


def amount_percentiles(ws: Workspace, fact: DataFrame, probs: list[float], per_industry: bool = False) -> DataFrame:
    """Exact percentiles of the amount in cents, for all credits (scope 0) and optionally per industry_id."""
    scope = F.col("industria_id") if per_industry else F.lit(None).cast("bigint")
    scoped = fact.select(scope.alias("ambito"), cents(F.col("monto")).alias("c"))
    return exact_percentiles(ws, scoped, "ambito", "c", probs, total=0)


def percentiles(ws: Workspace, fact: DataFrame, dim_industria: DataFrame) -> DataFrame:
    """A total row, also for no credits, and one row per industry with credits: median, mean, P25, P75."""
    found = amount_percentiles(ws, fact, [0.5, 0.25, 0.75], per_industry=True)
    overall = ws.spark.range(1).select(F.lit(0).cast("bigint").alias("ambito"), F.lit(GLOBAL).alias("nombre"))
    scopes = overall.unionByName(dim_industria.select(F.col("industria_id").alias("ambito"),
                                                      F.col("nombre_industria").alias("nombre")))
    return (scopes.join(found, "ambito", "left").where(F.col("n").isNotNull() | (F.col("ambito") == 0))
            .select(F.col("nombre").alias("ambito"), F.coalesce("n", F.lit(0)).alias("num_creditos"),
                    (F.round("q0") / 100.0).alias("mediana_monto"),
                    mean_from_cents(F.col("total"), F.col("n")).alias("promedio_monto"),
                    (F.round("q1") / 100.0).alias("p25"), (F.round("q2") / 100.0).alias("p75"))
            .orderBy(F.desc_nulls_last("mediana_monto"), F.asc_nulls_last("ambito")))


def by_date(fact: Credits, dim_tiempo: DataFrame, keys: list[str]) -> DataFrame:
    """States per calendar keys; one partial row per day meets the calendar."""
    return (rollup.of(fact).by("tiempo_id").join(dim_tiempo, "tiempo_id")
            .groupBy(*keys).agg(*rollup.merged()))


def monthly(fact: Credits, dim_tiempo: DataFrame) -> DataFrame:
    return (by_date(fact, dim_tiempo, ["anio", "mes", "nombre_mes"])
            .select("anio", "mes", "nombre_mes", F.col("n").alias("num_creditos"), _amount("monto_total"), _ticket(),
                    percent(F.col("a_tiempo"), F.col("n")).alias("pct_pago_a_tiempo"))
            .orderBy("anio", "mes"))
