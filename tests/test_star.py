import datetime as dt

from pyspark.sql import functions as F

from credara.functions import money
from credara.operators import dedup, integrity
from credara.plans import kpis, marts, panels, pipeline, staging
from credara.schemas import DIM_CLIENTE, DIM_INDUSTRIA, DIM_TIEMPO, FACT_ORIGINACIONES, STAGING


def types(df):
    return df.dtypes


def declared(schema):
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def star(ws, df, gate="staging_only"):
    return pipeline.run(ws, ws.save("raw", df), gate)


def test_strict_drops_every_copy_staging_only_keeps_the_earliest(raw, ws):
    df = raw({"id_credito": "A", "fecha_originacion": "2024-03-02", "nombre_cliente": "late"},
             {"id_credito": "A", "fecha_originacion": "2024-03-01", "nombre_cliente": "first"},
             {"id_credito": "A", "fecha_originacion": "2024-03-01", "nombre_cliente": "tie"},
             {"id_credito": "B"}, {"id_credito": " "})
    ids = {g: sorted((r.id_credito, r.nombre_cliente) for r in star(ws, df, g)["staging.stg_creditos"].collect())
           for g in pipeline.GATES}
    assert ids["strict"] == [("B", "Ana")]
    assert ids["staging_only"] == [(" ", "Ana"), ("A", "first"), ("B", "Ana")]


def test_terms(raw):
    terms = [("12.7", 13), ("12.5", 13), ("1e1", 10), ("", None), ("99999999999", None), (None, None), ("x", None), (" 12 ", 12)]
    df = raw(*[{"id_credito": f"t{i}", "plazo_meses": text} for i, (text, _) in enumerate(terms)])
    assert [r.plazo_meses for r in staging.stg_creditos(df).orderBy("id_credito").collect()] == [v for _, v in terms]


def test_terms_without_fractions(raw):
    df = raw({"id_credito": "a", "plazo_meses": "12.7"}, {"id_credito": "b", "plazo_meses": "12"})
    assert sorted(str(r.plazo_meses) for r in staging.stg_creditos(df, fractions=False).collect()) == ["12", "None"]


def test_staging_dates(raw):
    days = [("2024-2-3", dt.date(2024, 2, 3), dt.date(2024, 2, 3)), ("05/03/2024", None, dt.date(2024, 5, 3)),
            ("13/03/2024", None, None), ("2024", None, None), ("2024-03", None, None), ("2024-02-30", None, None)]
    df = raw(*[{"id_credito": text, "fecha_originacion": text} for text, _, _ in days])
    for month_first in (False, True):
        got = {r.id_credito: r.fecha_originacion for r in staging.stg_creditos(df, month_first).collect()}
        assert got == {d[0]: d[1 + month_first] for d in days if d[1 + month_first]}


def test_declared_types(raw, ws):
    for gate in pipeline.GATES:
        tables = star(ws, raw({}), gate)
        assert types(tables["staging.stg_creditos"].select(*STAGING.fieldNames())) == declared(STAGING)
        for name, schema in (("dim_cliente", DIM_CLIENTE), ("dim_tiempo", DIM_TIEMPO), ("dim_industria", DIM_INDUSTRIA),
                             ("fact_originaciones", FACT_ORIGINACIONES)):
            assert types(tables[f"marts.{name}"]) == declared(schema)


def test_calendar(raw, ws):
    df = raw({"id_credito": "a", "fecha_originacion": "2024-03-03"}, {"id_credito": "b", "fecha_originacion": "2024-12-31"})
    days = {r.tiempo_id: tuple(r)[2:] for r in star(ws, df)["marts.dim_tiempo"].collect()}
    assert days == {20240303: (2024, 3, "Marzo", 3, 0, "Domingo", 1, True),
                    20241231: (2024, 12, "Diciembre", 31, 2, "Martes", 4, False)}


def test_a_client_with_two_spellings_fans_out_the_fact(raw, ws):
    df = raw({"id_credito": "a"}, {"id_credito": "b", "nombre_cliente": "Anna"},
             {"id_credito": "c", "id_cliente": "C2", "nombre_cliente": "Bo"})
    tables = star(ws, df)
    fact = sorted((r.originacion_id, r.id_credito, r.cliente_id) for r in tables["marts.fact_originaciones"].collect())
    assert fact == [(1, "a", 1), (2, "a", 2), (3, "b", 1), (4, "b", 2), (5, "c", 3)]
    assert [(r.tabla, r.claves_repetidas) for r in integrity.check_business_keys(tables).collect()] == [
        ("marts.dim_cliente", 1), ("marts.dim_industria", 0)]


def test_both_ways_to_number_the_fact_agree(raw, ws):
    df = raw(*[{"id_credito": f"K{i * 7919 % 1000:04d}", "id_cliente": f"C{i % 50}"} for i in range(1000)])
    tables = star(ws, df)
    stg = tables["staging.stg_creditos"].select(*STAGING.fieldNames())
    again = marts.fact_originaciones(ws, stg, tables["marts.dim_cliente"], tables["marts.dim_tiempo"],
                                     tables["marts.dim_industria"])
    fact = tables["marts.fact_originaciones"]
    assert fact.exceptAll(again).isEmpty() and fact.count() == again.count() == 1000
    assert [r.originacion_id for r in fact.orderBy("id_credito").collect()] == list(range(1, 1001))


def test_unknown_industry_stays_in_totals_only(raw, ws):
    df = raw({"id_credito": "a", "industria": None, "monto": "3000"}, {"id_credito": "b", "monto": "1000"})
    tables = star(ws, df)
    fact, dim = tables["marts.fact_originaciones"], tables["marts.dim_industria"]
    assert [(r.industria_id, r.nombre_industria) for r in dim.orderBy("industria_id").collect()] == [(1, "Salud"), (2, None)]
    assert kpis.total(fact).first().monto_total_originado == 4000.0
    assert [tuple(r) for r in kpis.top_industries(fact, dim).collect()] == [("Salud", 1, 1000.0, 1000.0)]
    assert sorted((r.ambito, r.num_creditos) for r in kpis.percentiles(ws, fact, dim).collect()) == [("Global", 2), ("Salud", 1)]
    nulls = {r.columna: r.nulas for r in integrity.check_foreign_keys(tables).collect()}
    assert nulls == {"cliente_id": 0, "tiempo_id": 0, "industria_id": 1}
    assert {(r.tabla, r.nulas) for r in integrity.check_not_null(tables).collect()} >= {("marts.dim_industria", 1)}


def test_empty_star(raw, ws):
    tables = star(ws, raw({}).limit(0), "strict")
    f, c, t, i = (tables[f"marts.{n}"] for n in ("fact_originaciones", "dim_cliente", "dim_tiempo", "dim_industria"))
    assert tuple(kpis.total(f).first()) == (0, None, None)
    assert tuple(kpis.first_payment(f).first()) == (0, None, None, None, None)
    assert [tuple(r) for r in kpis.percentiles(ws, f, i).collect()] == [("Global", 0, None, None, None, None)]
    assert tuple(panels.percentile(panels.amount_percentiles(ws, f), "Mediana").first()) == ("Mediana", None)
    for df in (kpis.late_index(f, i), kpis.monthly(f, t), kpis.channel_mix(f), kpis.ticket_by_segment(f)):
        assert df.isEmpty()


def test_rounding_half_a_cent_goes_up(raw, ws):
    df = raw({"id_credito": "a", "monto": "1000.00"}, {"id_credito": "b", "monto": "1000.01"})
    tables = star(ws, df)
    fact, dim = tables["marts.fact_originaciones"], tables["marts.dim_industria"]
    assert kpis.total(fact).first().ticket_promedio == 1000.01
    assert {r.mediana_monto for r in kpis.percentiles(ws, fact, dim).collect()} == {1000.01}


def test_segment_limits(raw):
    limits = {"49999.99": "Micro", "50000": "Pequeno", "249999.99": "Pequeno", "250000": "Mediano", "1000000": "Grande",
              "5000000": "Grande"}
    stg = staging.stg_creditos(raw(*[{"id_credito": a, "monto": a} for a in limits]))
    got = stg.select("id_credito", money.segment(F.col("monto"))).collect()
    assert {r[0]: r[1] for r in got} == limits


def test_late_limit_is_strict_on_the_rounded_value(raw, ws):
    rows = [{"id_credito": f"a{i}", "industria": "veinte", "estatus_primer_pago": "Tardío" if i < 1 else "A Tiempo"}
            for i in range(5)]
    rows += [{"id_credito": f"b{i}", "industria": "mas", "estatus_primer_pago": "Tardío" if i < 1 else "A Tiempo"}
             for i in range(4)]
    tables = star(ws, raw(*rows))
    fact, dim = tables["marts.fact_originaciones"], tables["marts.dim_industria"]
    assert [tuple(r) for r in kpis.late_index(fact, dim).collect()] == [("mas", 4, 1, 25.0)]
    assert [tuple(r) for r in panels.late_bands(fact, dim).collect()] == [("mas", 25.0, "yellow")]


def test_period_filter_by_date_key(raw, ws):
    days = ["2024-01-31", "2024-02-01", "2024-02-29", "2024-03-01"]
    tables = star(ws, raw(*[{"id_credito": d, "fecha_originacion": d} for d in days]))
    inside = kpis.in_period(tables["marts.fact_originaciones"], dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert sorted(r.id_credito for r in inside.collect()) == days[1:3]


def test_keep_first_treats_null_as_one_key(spark):
    df = spark.createDataFrame([(None, 3), (None, 2), ("a", 5), ("a", 4)], "k string, fila bigint")
    assert sorted((str(r.k), r.fila) for r in dedup.keep_first(df, "k", ["fila"]).collect()) == [("None", 2), ("a", 4)]


def test_orphans(spark):
    fact = spark.createDataFrame([(1,), (2,), (2,), (None,)], "cliente_id bigint")
    dim = spark.createDataFrame([(1,)], "cliente_id bigint")
    assert [tuple(r) for r in integrity.orphans(fact, "cliente_id", dim).collect()] == [(2, 2)]


def test_fact_with_two_spellings_is_joined_once_and_numbered_in_the_parts_of_staging(raw, ws, spark, monkeypatch):
    rows = [{"id_credito": f"K{i * 7919 % 500:03d}", "id_cliente": f"C{i % 9}", "nombre_cliente": f"n{i % 2 if i % 9 == 4 else 0}"}
            for i in range(500)]
    saved = []
    monkeypatch.setattr(ws, "save", lambda name, df, save=ws.save: saved.append((name, df)) or save(name, df))
    tables = star(ws, raw(*rows), "strict")
    fact = sorted((r.originacion_id, r.id_credito, r.cliente_id) for r in tables["marts.fact_originaciones"].collect())
    clients = {}
    for r in tables["marts.dim_cliente"].collect():
        clients.setdefault(r.id_cliente, []).append(r.cliente_id)
    wanted = sorted((r["id_credito"], c) for r in rows for c in clients[r["id_cliente"]])
    assert len(wanted) > 500 and fact == [(i + 1, *w) for i, w in enumerate(wanted)]
    names = [name for name, _ in saved]
    placed = saved[names.index("orden_originacion_id")][1]._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in placed and "hechos" not in names


def test_fact_of_staging_without_rows(raw, ws):
    tables = star(ws, raw({"monto": "x"}), "strict")
    assert tables["marts.fact_originaciones"].count() == 0 and tables["marts.dim_cliente"].count() == 0
