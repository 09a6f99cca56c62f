"""The dashboard's fifteen panels, over the star schema; those that add up also over a stored roll-up."""

from pyspark.sql import Column, DataFrame, functions as F

from credara.functions.money import from_cents, mean_from_cents, percent
from credara.operators.reductions import threshold_band
from credara.plans import kpis, rollup
from credara.plans.kpis import Credits
from credara.schemas import LATE_LIMIT_PCT, PANEL_SEGMENT_LABELS
from credara.sources.workspace import Workspace

# Where the panel's colour changes. The titles and labels given to columns below are fixed, too.
LATE_BANDS = [(20.0, "yellow"), (30.0, "red")]


def _whole_mean(name: str) -> Column:
    return mean_from_cents(F.col("centavos"), F.col("n"), 0).alias(name)


def _stat(df: DataFrame, label: str, value: Column) -> DataFrame:
    return df.select(F.lit(label).alias("metric"), value.alias("value"))


def total_amount(fact: Credits) -> DataFrame:
    return _stat(rollup.of(fact).by(), "Monto Total", F.round(from_cents(F.col("centavos"))))


def credit_count(fact: Credits) -> DataFrame:
    return _stat(rollup.of(fact).by(), "Total Creditos", F.col("n"))


def average_ticket(fact: Credits) -> DataFrame:
    return _stat(rollup.of(fact).by(), "Ticket Promedio", mean_from_cents(F.col("centavos"), F.col("n"), 0))


def payment_split(fact: Credits) -> DataFrame:
    return rollup.of(fact).by("estatus_primer_pago").select(
        F.col("estatus_primer_pago").alias("metric"), F.col("n").alias("value"))


def top_industries(fact: Credits, dim_industria: DataFrame) -> DataFrame:
    return (kpis.top_industries(fact, dim_industria)
            .select("nombre_industria", F.col("monto_total").alias("Monto Total")))


def late_index(fact: Credits, dim_industria: DataFrame) -> DataFrame:
    return (kpis.late_index(fact, dim_industria, LATE_LIMIT_PCT)
            .select("nombre_industria", F.col("indice_mora_pct").alias("Indice de Mora %")))


def late_bands(fact: Credits, dim_industria: DataFrame) -> DataFrame:
    """The late index with the colour band it is drawn in."""
    index = late_index(fact, dim_industria)
    return index.withColumn("banda", threshold_band(F.col("Indice de Mora %"), LATE_BANDS, "green"))


def segment_ticket(fact: Credits) -> DataFrame:
    return (rollup.of(fact).by("segmento").replace(PANEL_SEGMENT_LABELS, subset="segmento")
            .select("segmento", _whole_mean("Ticket Promedio"), F.col("n").alias("N° Creditos"))
            .orderBy(F.asc_nulls_last("Ticket Promedio")))


def channel_split(fact: Credits) -> DataFrame:
    return (rollup.of(fact).by("canal").select("canal", F.col("n").alias("value"))
            .orderBy(F.desc_nulls_last("value"), F.asc_nulls_last("canal")))


def channel_table(fact: Credits) -> DataFrame:
    return (rollup.of(fact).by("canal")
            .select(F.col("canal").alias("Canal"), F.col("n").alias("Creditos"),
                    F.round("monto_min").alias("Ticket Minimo"), F.round("monto_max").alias("Ticket Maximo"),
                    _whole_mean("Ticket Promedio"))
            .orderBy(F.desc_nulls_last("Ticket Promedio"), F.asc_nulls_last("Canal")))


PERCENTILES = {"Mediana": 0.5, "Percentil 25": 0.25, "Percentil 75": 0.75}


def amount_percentiles(ws: Workspace, fact: DataFrame) -> DataFrame:
    """The percentiles of all panels at once, so that the fact is scanned for them together."""
    return kpis.amount_percentiles(ws, fact, [*PERCENTILES.values()])


def percentile(found: DataFrame, label: str) -> DataFrame:
    """One panel from the common percentiles."""
    place = [*PERCENTILES].index(label)
    return _stat(found.agg(F.max(f"q{place}").alias("q")), label, F.round(F.col("q") / 100.0))


def term_table(fact: Credits, dim_industria: DataFrame) -> DataFrame:
    return kpis.term_by_industry(fact, dim_industria).toDF(
        "Industria", "Creditos", "Plazo Promedio (meses)", "Plazo Min", "Plazo Max")


def amount_by_day(fact: Credits, dim_tiempo: DataFrame) -> DataFrame:
    return (kpis.by_date(fact, dim_tiempo, ["fecha_originacion"])
            .select(F.col("fecha_originacion").alias("time"), from_cents(F.col("centavos")).alias("Monto Total"))
            .orderBy("time"))


def on_time_by_day(fact: Credits, dim_tiempo: DataFrame) -> DataFrame:
    return (kpis.by_date(fact, dim_tiempo, ["fecha_originacion"])
            .select(F.col("fecha_originacion").alias("time"),
                    percent(F.col("a_tiempo"), F.col("n")).alias("% Pago a Tiempo"))
            .orderBy("time"))
