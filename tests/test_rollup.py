"""KPIs from a stored roll-up: the same rows, in the same order, as from the fact."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from credara.plans import kpis, panels, rollup

FACT = ("originacion_id bigint, tiempo_id int, industria_id bigint, monto double, plazo_meses int, canal string, "
        "estatus_primer_pago string")
DAYS = [dt.date(2024, m, d) for m in (1, 2, 3) for d in (1, 15, 28)]


def day_key(d):
    return d.year * 10000 + d.month * 100 + d.day


@pytest.fixture(scope="module")
def dims(spark):
    industria = spark.createDataFrame([(1, "Salud"), (2, "Campo"), (3, "Salud"), (4, "Sin creditos")],
                                      "industria_id bigint, nombre_industria string")
    tiempo = spark.createDataFrame([(day_key(d), d, d.year, d.month, f"mes {d.month}") for d in DAYS[:-1]],
                                   "tiempo_id int, fecha_originacion date, anio int, mes int, nombre_mes string")
    return industria, tiempo


@pytest.fixture(scope="module")
def fact(spark):
    """NULLs in every column, an industry and a day without a dimension row, ties, and one channel with a third of all."""
    rnd = random.Random(3)
    rows = [(i, rnd.choice([*map(day_key, DAYS), None]), rnd.choice([1, 2, 3, 9, None]),
             rnd.choice([None, 1000.0, 49999.99, 50000.0, 250000.0, round(rnd.uniform(1000, 5e6), 2)]),
             rnd.choice([None, 6, 12, 36]), "Web" if i % 3 == 0 else rnd.choice(["Sucursal", "", None]),
             rnd.choice(["A Tiempo", "Tardío", "otro", None])) for i in range(600)]
    return spark.createDataFrame(rows, FACT).repartition(5)


def additive(credits, dims):
    industria, tiempo = dims
    return {
        "total": kpis.total(credits), "top": kpis.top_industries(credits, industria),
        "segment": kpis.ticket_by_segment(credits), "payment": kpis.first_payment(credits),
        "late": kpis.late_index(credits, industria), "mix": kpis.channel_mix(credits),
        "term": kpis.term_by_industry(credits, industria), "channels": kpis.channel_tickets(credits),
        "monthly": kpis.monthly(credits, tiempo), "period": kpis.total(kpis.in_period(credits, DAYS[1], DAYS[4])),
        "period_monthly": kpis.monthly(kpis.in_period(credits, DAYS[1], DAYS[4]), tiempo),
        "p_total": panels.total_amount(credits), "p_count": panels.credit_count(credits),
        "p_ticket": panels.average_ticket(credits), "p_split": panels.payment_split(credits).orderBy("metric"),
        "p_top": panels.top_industries(credits, industria), "p_late": panels.late_index(credits, industria),
        "p_segment": panels.segment_ticket(credits), "p_channel": panels.channel_split(credits),
        "p_table": panels.channel_table(credits), "p_term": panels.term_table(credits, industria),
        "p_amount": panels.amount_by_day(credits, tiempo), "p_on_time": panels.on_time_by_day(credits, tiempo),
    }


def results(credits, dims):
    return {name: (df.dtypes, [tuple(r) for r in df.collect()]) for name, df in additive(credits, dims).items()}


@pytest.fixture(scope="module")
def expected(fact, dims):
    return results(fact, dims)


def part(fact, k):
    return fact.where(F.col("originacion_id") % 3 == k)


def test_three_loads_give_what_the_fact_gives(fact, dims, expected, ws):
    stored = None
    for load, k in enumerate((2, 0, 1)):
        stored = rollup.add_load(ws, stored, part(fact, k), load)
    assert results(rollup.Rollup(stored), dims) == expected
    for through in (0, 1, 2):
        stored = rollup.close_loads(ws, stored, through)
    assert results(rollup.Rollup(stored), dims) == expected
    assert stored.count() == rollup.states(fact).count()    # it does not grow with the number of loads


def test_totals_of_the_scan_by_hand(fact, expected):
    rows = fact.collect()
    n, late = len(rows), sum(r.estatus_primer_pago == "Tardío" for r in rows)
    total = sum(round(r.monto * 100) for r in rows if r.monto is not None)
    assert expected["total"][1] == [(n, total / 100, pytest.approx(total / n / 100, abs=0.01))]
    assert expected["payment"][1][0][2] == late


def test_a_load_given_again_replaces_itself(fact, dims, expected, ws):
    stored = rollup.add_load(ws, None, part(fact, 0), 1)
    stored = rollup.add_load(ws, stored, part(fact, 2), 2)
    stored = rollup.add_load(ws, stored, part(fact, 2), 3)
    stored = rollup.close_loads(ws, stored, 1)
    stored = rollup.add_load(ws, stored, part(fact, 1), 2)
    stored = rollup.add_load(ws, stored, part(fact, 2), 3)
    assert results(rollup.Rollup(stored), dims) == expected


def test_closed_loads_stay(fact, ws):
    stored = rollup.close_loads(ws, rollup.add_load(ws, None, part(fact, 0), 4), 6)
    for load in (4, 5, 6):
        with pytest.raises(ValueError, match="closed"):
            rollup.add_load(ws, stored, part(fact, 1), load)
    assert rollup.add_load(ws, stored, part(fact, 1), 7).select("carga").distinct().count() == 2


def test_no_credits(fact, dims, ws):
    none = fact.limit(0)
    empty = rollup.add_load(ws, None, none, 1)
    assert results(rollup.Rollup(empty), dims) == results(none, dims)
    stored = rollup.add_load(ws, rollup.add_load(ws, empty, fact, 2), none, 3)
    assert results(rollup.Rollup(stored), dims) == results(fact, dims)


def test_a_period_knows_only_days(fact, ws):
    period = kpis.in_period(rollup.Rollup(rollup.add_load(ws, None, fact, 1)), DAYS[0], DAYS[1])
    with pytest.raises(ValueError, match="canal"):
        kpis.channel_mix(period)


def test_the_fact_is_combined_before_it_is_expanded_and_not_read_again(fact, dims, ws):
    saved = ws.save("fact", fact)
    text = rollup.states(saved)._jdf.queryExecution().executedPlan().toString()
    above, below = text.split("Expand", 1)
    assert below.count("HashAggregate") + below.count("SortAggregate") + below.count("ObjectHashAggregate") >= 2
    stored = rollup.Rollup(rollup.add_load(ws, None, saved, 1))
    for df in additive(stored, dims).values():
        assert all("/rollup-" in file for file in df.inputFiles())
