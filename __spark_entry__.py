
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from credara.functions.calendar import in_days
from credara.operators import clustering, dedup, distinct, integrity, keys, quality, reductions
from credara.plans import kpis, panels, pipeline, refresh, rollup, staging
from credara.schemas import RAW_COLUMNS, STAGING, TABLES
from credara.session import size_shuffles
from credara.sources import csv_files, synthetic
from credara.sources.orders_fixture import creditos_raw
from credara.sources.tables import BrokenConstraints, Catalog
from credara.sources.workspace import Workspace
from credara.streaming import arrivals
import oracles

try:
    import corpus_pipeline
    from credara.llm import queries as corpus
except ModuleNotFoundError as missing:
    # the corpus operators and their pipeline are a part that can be left out as a whole, or lack a library
    if missing.name.startswith("credara") and missing.name != "credara.llm":
        raise
    corpus_pipeline = corpus = None

__all__ = ["entry", "queries", "oracle_sql"]


class Warehouse:
    """Landed raw credits and the tables built from them, each built on first use in a session."""

    _open: dict[tuple[str, str], Warehouse] = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Warehouse:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._open:
            cls._open[key] = cls(spark, sf_dir)
        return cls._open[key]

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.ws = spark, sf_dir, Workspace(spark)
        size_shuffles(spark, f"{sf_dir}/orders.parquet")

    @cached_property
    def raw(self) -> DataFrame:
        return self.ws.save("raw", creditos_raw(self.spark, self.sf_dir))

    @cached_property
    def strict(self) -> dict[str, DataFrame]:
        return pipeline.run(self.ws, self.raw, "strict")

    @cached_property
    def staging_only(self) -> dict[str, DataFrame]:
        return pipeline.run(self.ws, self.raw, "staging_only")

    @cached_property
    def percentiles(self) -> DataFrame:
        fact = self.staging_only["marts.fact_originaciones"]
        return self.ws.save("percentiles", panels.amount_percentiles(self.ws, fact))

    @cached_property
    def rollup_strict(self) -> rollup.Rollup:
        return self._rolled_up(self.strict)

    @cached_property
    def rollup_staging_only(self) -> rollup.Rollup:
        return self._rolled_up(self.staging_only)

    def _rolled_up(self, tables: dict[str, DataFrame]) -> rollup.Rollup:
        """Three loads, each with a third of the fact: the second comes twice, wrong at first, the first is closed."""
        fact = tables["marts.fact_originaciones"]
        first, second, third = (fact.where(F.col("originacion_id") % 3 == k) for k in range(3))
        stored = rollup.add_load(self.ws, None, first, 1)
        stored = rollup.add_load(self.ws, stored, third, 2)
        stored = rollup.close_loads(self.ws, stored, 1)
        stored = rollup.add_load(self.ws, stored, second, 2)
        return rollup.Rollup(rollup.add_load(self.ws, stored, third, 3))

    @cached_property
    def clients_by_day(self) -> DataFrame:
        """Bitmaps of clients after three loads, the second of which comes twice."""
        fact, stored = self.strict["marts.fact_originaciones"], None
        for k in (0, 1, 1, 2):
            delta = fact.where(F.col("originacion_id") % 3 == k)
            stored = distinct.add_rows(self.ws, stored, delta, "cliente_id", ["tiempo_id"])
        return stored

    @cached_property
    def clustered_fact(self) -> DataFrame:
        """The fact in boxes of days and industries."""
        fact = self.strict["marts.fact_originaciones"]
        return self.ws.save("hechos_morton", clustering.clustered(fact, ["tiempo_id", "industria_id"], ["originacion_id"]))

    @cached_property
    def flagged(self) -> DataFrame:
        return self.ws.save("flagged", quality.flagged_identifiers(self.raw))


def _table(gate: str, name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: getattr(Warehouse.of(spark, sf_dir), gate)[name]


def _staged(gate: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _table(gate, "staging.stg_creditos")(spark, sf_dir).select(*STAGING.fieldNames())


def _over(gate: str, query: Callable[..., DataFrame], *inputs: str, ws: bool = False, **options):
    """A query over mart tables: ``inputs`` are table names without the namespace."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = Warehouse.of(spark, sf_dir)
        tables = getattr(warehouse, gate)
        first = [warehouse.ws] if ws else []
        return query(*first, *[tables[f"marts.{t}"] for t in inputs], **options)
    return run


def _rolled(gate: str, query: Callable[..., DataFrame], fact: str, *dimensions: str):
    """A query that adds up, over the roll-up in the place of the fact."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = Warehouse.of(spark, sf_dir)
        tables = getattr(warehouse, gate)
        return query(getattr(warehouse, f"rollup_{gate}"), *[tables[f"marts.{t}"] for t in dimensions])
    return run


def _checked(query: Callable[[Warehouse], DataFrame]):
    return lambda spark, sf_dir: query(Warehouse.of(spark, sf_dir))


def _declared(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: df for name, df in tables.items() if not name.startswith("quality.")}


def _share(fact: DataFrame) -> DataFrame:
    return reductions.share_of_total(panels.channel_split(fact), "value")


def _series_mean(fact: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    series = panels.on_time_by_day(fact, dim_tiempo)
    return reductions.series_mean(series, "% Pago a Tiempo").select(F.round("value", 6).alias("value"))


def _series_last(fact: DataFrame, dim_tiempo: DataFrame) -> DataFrame:
    return reductions.series_last(panels.amount_by_day(fact, dim_tiempo), "time", "Monto Total")


def _total_in_period(fact: DataFrame) -> DataFrame:
    return kpis.total(kpis.in_period(fact, date(1995, 3, 1), date(1995, 3, 31)))


def _total_of_industry(warehouse: Warehouse, period: bool) -> DataFrame:
    """One industry, in a quarter or at any time: either filter skips files of the clustered fact."""
    fact = warehouse.clustered_fact
    rows = kpis.in_period(fact, date(1995, 1, 1), date(1995, 3, 31)) if period else fact
    return kpis.total(rows.where(F.col("industria_id") == 2))


def _clients_by_month(warehouse: Warehouse) -> DataFrame:
    months = warehouse.clients_by_day.withColumn("mes", F.expr("cast(tiempo_id div 100 AS int)"))
    return distinct.count_distinct(months, ["mes"], "clientes")


def _clients_in_period(warehouse: Warehouse) -> DataFrame:
    period = in_days("tiempo_id", date(1995, 2, 11), date(1996, 6, 20))
    return distinct.count_distinct(warehouse.clients_by_day.where(period), [], "clientes")


def _stable_keys(order: list[str], name: str):
    """Keys of a first load, the credits before 1995, and of a second one with all credits, where the first ones keep
    theirs: the members of the second load."""
    def run(warehouse: Warehouse) -> DataFrame:
        ws, stg = warehouse.ws, warehouse.strict["staging.stg_creditos"]
        first = keys.extend_keys(ws, None, stg.where(F.col("fecha_originacion") < "1995-01-01"), order, name)
        second = keys.extend_keys(ws, first, stg, order, name)
        return keys.with_keys(stg.select(*order).distinct(), second, order, name)
    return _checked(run)


def _dense_key_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")
    keyed = keys.dense_key(Warehouse.of(spark, sf_dir).ws, orders, ["o_totalprice", "o_orderkey"], "clave")
    return keyed.select("clave", "o_orderkey")


def _dense_key_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    size_shuffles(spark, f"{sf_dir}/lineitem.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    keyed = keys.dense_key(Warehouse.of(spark, sf_dir).ws, lines, order, "clave")
    return keyed.select("clave", "l_orderkey", "l_linenumber", "l_extendedprice")


def _csv_roundtrip(warehouse: Warehouse, na_tokens: bool = True) -> DataFrame:
    """Write the credits as CSV in ``fila`` order, columns turned around and a strange one added, amounts padded and
    some channels spelled as missing; read them back by name with row numbers."""
    folder = warehouse.ws.new_path("csv_files")
    odd = F.when(F.col("fila") % 5 == 0, F.lit("NULL")).otherwise(F.col("canal"))
    rows = warehouse.raw.withColumns({"canal": odd, "monto": F.concat(F.col("monto"), F.lit("  ")), "nota": F.lit("x")})
    rows = rows.repartitionByRange("fila").sortWithinPartitions("fila").select("nota", *reversed(RAW_COLUMNS))
    csv_files.write_csv(rows, folder)
    return csv_files.read_credits(warehouse.ws, folder, na_tokens)


def _csv_file_count(rows: int) -> int:
    return max(2, -(-rows // 1_000_000))


def _csv_line_breaks(warehouse: Warehouse) -> DataFrame:
    """Credits whose names hold line breaks, quotes and delimiters, in files that are read in splits of 200 kB: two files,
    or one for each million credits where there are more."""
    ws, size = warehouse.ws, "spark.sql.files.maxPartitionBytes"
    folder = ws.new_path("csv_breaks")
    odd = F.when(F.col("fila") % 6 == 0, F.concat(F.col("nombre_cliente"), F.lit('\n"S.A.",\n\nb,'))).when(
        F.col("fila") % 10 == 1, F.concat(F.col("nombre_cliente"), F.lit(' "C", s')))
    rows = warehouse.raw.withColumn("nombre_cliente", F.coalesce(odd, "nombre_cliente"))
    rows = rows.repartitionByRange(_csv_file_count(warehouse.raw.count()), "fila").sortWithinPartitions("fila").select(*RAW_COLUMNS)
    csv_files.write_csv(rows, folder)
    before = warehouse.spark.conf.get(size)
    warehouse.spark.conf.set(size, "200000")
    try:
        return csv_files.read_credits(ws, folder, na_tokens=False)
    finally:
        warehouse.spark.conf.set(size, before)


def _catalog(warehouse: Warehouse) -> Catalog:
    folder = warehouse.ws.new_path("catalog")
    return Catalog(warehouse.spark, folder, prefix=f"check_{folder[-8:]}_")


def _table_refresh(warehouse: Warehouse) -> DataFrame:
    """Refresh the whole catalog from the raw credits and audit its rows."""
    catalog = _catalog(warehouse)
    try:
        raw = catalog.save("raw.raw_creditos", warehouse.raw)
        pipeline.run(warehouse.ws, raw, "strict", catalog.save)
        return catalog.audit()
    finally:
        catalog.drop_namespaces()


def _table_reload(warehouse: Warehouse) -> DataFrame:
    """Load some raw credits, empty the table, load others in their place and append the rest."""
    catalog, rows = _catalog(warehouse), warehouse.raw.select(*RAW_COLUMNS)
    odd, even = (warehouse.raw.where(F.col("fila") % 2 == k).select(*RAW_COLUMNS) for k in (1, 0))
    try:
        catalog.save("raw.raw_creditos", rows)
        catalog.truncate_all()
        catalog.save("raw.raw_creditos", odd)
        catalog.append("raw.raw_creditos", even)
        return catalog.read("raw.raw_creditos")
    finally:
        catalog.drop_namespaces()


def _enforced_load(warehouse: Warehouse) -> DataFrame:
    """Publish a star of credits with an industry; then try one in which an industry is missing from its dimension, and
    one of all credits, where it is unknown. Neither may change a table: rows and cents of each, and the version."""
    ws, catalog = warehouse.ws, _catalog(warehouse)

    def load(raw: DataFrame, lost: int) -> None:
        staged = catalog.stage()
        tables = pipeline.run(ws, raw, "strict")
        for name, df in _declared(tables).items():
            if name == "marts.dim_industria":
                df = df.where(F.col("industria_id") > lost)
            staged.save(name, df.select(*TABLES[name].fieldNames()))
        staged.publish(enforce=True)

    complete = ws.save("completos", warehouse.raw.where("industria IS NOT NULL"))
    try:
        load(complete, lost=0)
        for raw, lost in ((complete, 1), (warehouse.raw, 0)):
            try:
                load(raw, lost)
            except BrokenConstraints:
                continue
            raise AssertionError("a broken load was published")
        fact = catalog.read("marts.fact_originaciones").agg(F.round(F.sum("monto"), 2).alias("monto"))
        return catalog.audit().join(fact).withColumn("version", F.lit(catalog.version()).cast("bigint"))
    finally:
        catalog.drop_namespaces()


def _changed_models(warehouse: Warehouse) -> DataFrame:
    """The fact after a load of most credits, one of all, and all again in another order, which builds nothing."""
    ws, raw = warehouse.ws, warehouse.raw
    first = refresh.refresh(ws, raw.where(F.col("fila") % 7 != 0))
    second = refresh.refresh(ws, raw, before=first.built)
    again = refresh.refresh(ws, ws.save("otra_vez", raw.repartition(5, "monto")), before=second.built)
    if again.changed or set(second.changed) != set(first.changed):
        raise AssertionError(f"built again: {again.changed}, built: {second.changed}")
    return again.tables["marts.fact_originaciones"]


def _incremental(warehouse: Warehouse) -> DataFrame:
    """Three file deliveries, loaded one after the other; neighbouring copies of an id come in different ones, and
    every 60th row comes twice in its delivery."""
    inbox, out = warehouse.ws.new_path("entrada"), warehouse.ws.new_path("cargado")
    for delivery in range(3):
        part = warehouse.raw.where(F.col("fila") % 3 == delivery)
        part = part.unionByName(part.where("fila % 60 = 0")).select(*RAW_COLUMNS)
        csv_files.write_csv(part, f"{inbox}/entrega{delivery}")
        arrivals.load_new_files(warehouse.ws, f"{inbox}/*", out).awaitTermination()
    return arrivals.read_loaded(warehouse.spark, out).select(*RAW_COLUMNS, "lote")


def entry(spark: SparkSession) -> DataFrame:
    """Late-payment index per industry, from raw credits through quality gate, staging and star schema."""
    return queries()["kpi_late_index"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _credit_queries() | (corpus.QUERIES | {"pipeline": corpus_pipeline.run} if corpus else {})


def oracle_sql() -> dict[str, str]:
    own = oracles.oracle_sql()
    if corpus:
        own |= corpus.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            own["pipeline"] = corpus_pipeline.ORACLE_SQL
    return own


def _credit_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    fact, tiempo, industria = "fact_originaciones", "dim_tiempo", "dim_industria"
    a, b = "strict", "staging_only"
    # these add up: each is registered over the fact and over its roll-up
    additive = {
        "kpi_total": (a, kpis.total, fact),
        "kpi_total_in_period": (a, _total_in_period, fact),
        "kpi_top5_industries": (a, kpis.top_industries, fact, industria),
        "kpi_segment_ticket": (a, kpis.ticket_by_segment, fact),
        "kpi_first_payment": (a, kpis.first_payment, fact),
        "kpi_late_index": (a, kpis.late_index, fact, industria),
        "kpi_channel_mix": (a, kpis.channel_mix, fact),
        "kpi_term_by_industry": (a, kpis.term_by_industry, fact, industria),
        "kpi_channel_minmax": (a, kpis.channel_tickets, fact),
        "kpi_monthly": (a, kpis.monthly, fact, tiempo),
        "panel_total": (b, panels.total_amount, fact),
        "panel_count": (b, panels.credit_count, fact),
        "panel_ticket": (b, panels.average_ticket, fact),
        "panel_payment_split": (b, panels.payment_split, fact),
        "panel_top5": (b, panels.top_industries, fact, industria),
        "panel_late_index": (b, panels.late_index, fact, industria),
        "panel_segment": (b, panels.segment_ticket, fact),
        "panel_channel": (b, panels.channel_split, fact),
        "panel_channel_table": (b, panels.channel_table, fact),
        "panel_term": (b, panels.term_table, fact, industria),
        "panel_amount_by_day": (b, panels.amount_by_day, fact, tiempo),
        "panel_ontime_by_day": (b, panels.on_time_by_day, fact, tiempo),
        "share_of_total": (b, _share, fact),
        "late_band": (b, panels.late_bands, fact, industria),
        "series_mean": (b, _series_mean, fact, tiempo),
        "series_last": (b, _series_last, fact, tiempo),
    }
    scans = {name: _over(*query) for name, query in additive.items()}
    rolled = {f"rollup_{name}": _rolled(*query) for name, query in additive.items()}
    return scans | rolled | {
        "dq_failure_log": _checked(lambda w: quality.failure_log(w.raw, w.flagged)),
        "dq_counts_by_rule": _checked(lambda w: quality.counts_by_rule(w.raw, w.flagged)),
        "dq_counts_by_family": _checked(lambda w: quality.counts_by_family(quality.counts_by_rule(w.raw, w.flagged))),
        "dq_stats": _checked(lambda w: quality.statistics(w.raw, w.flagged)),
        "dq_clean_split": _checked(lambda w: quality.clean_rows(w.raw, w.flagged)),
        "dq_dedup_first": _checked(lambda w: dedup.keep_first(w.raw, "id_credito", ["fila"])),
        "dq_duplicate_ids": _checked(lambda w: quality.repeated_ids(w.flagged)),
        "stg_strict": _staged(a),
        "stg_staging_only": _staged(b),
        "stg_month_first": _checked(lambda w: staging.stg_creditos(w.raw, month_first=True)),
        "dim_cliente": _table(a, "marts.dim_cliente"),
        "dim_tiempo": _table(a, "marts.dim_tiempo"),
        "dim_industria": _table(a, "marts.dim_industria"),
        "fact_originaciones": _table(a, "marts.fact_originaciones"),
        "fact_staging_only": _table(b, "marts.fact_originaciones"),
        "clustered_fact": _checked(lambda w: w.clustered_fact),
        "kpi_total_industry": _checked(lambda w: _total_of_industry(w, period=False)),
        "kpi_total_industry_in_period": _checked(lambda w: _total_of_industry(w, period=True)),
        "kpi_percentiles": _over(a, kpis.percentiles, fact, industria, ws=True),
        "panel_median": _checked(lambda w: panels.percentile(w.percentiles, "Mediana")),
        "panel_p25": _checked(lambda w: panels.percentile(w.percentiles, "Percentil 25")),
        "panel_p75": _checked(lambda w: panels.percentile(w.percentiles, "Percentil 75")),
        "check_pk": _checked(lambda w: integrity.check_primary_keys(w.strict)),
        "check_business_key": _checked(lambda w: integrity.check_business_keys(w.strict)),
        "check_fk": _checked(lambda w: integrity.check_foreign_keys(w.strict)),
        "check_not_null": _checked(lambda w: integrity.check_not_null(w.strict)),
        "row_counts": _checked(lambda w: integrity.row_counts(_declared(w.strict))),
        "table_refresh": _checked(_table_refresh),
        "table_reload": _checked(_table_reload),
        "enforced_load": _checked(_enforced_load),
        "changed_models": _checked(_changed_models),
        "stable_keys_clients": _stable_keys(["id_cliente", "nombre_cliente"], "cliente_id"),
        "stable_keys_industries": _stable_keys(["industria"], "industria_id"),
        "stable_keys_credits": _stable_keys(["id_credito"], "originacion_id"),
        "dense_key_orders": _dense_key_orders,
        "dense_key_lineitem": _dense_key_lineitem,
        "csv_roundtrip_rownum": _checked(_csv_roundtrip),
        "csv_roundtrip_text": _checked(lambda w: _csv_roundtrip(w, na_tokens=False)),
        "csv_line_breaks": _checked(_csv_line_breaks),
        "distinct_clients_by_month": _checked(_clients_by_month),
        "distinct_clients_in_period": _checked(_clients_in_period),
        "fault_profile": _checked(lambda w: synthetic.fault_profile(w.raw)),
        "incremental_files": _checked(_incremental),
    }
