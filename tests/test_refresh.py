"""Refresh of changed models only."""

import json
from dataclasses import asdict

from pyspark.sql import functions as F

from credara.operators.fingerprints import fingerprint
from credara.plans import pipeline, refresh

STAGING, FACT = "staging.stg_creditos", "marts.fact_originaciones"
ALL = {"quality.flagged", STAGING, FACT, "marts.dim_cliente", "marts.dim_tiempo", "marts.dim_industria"}


def test_fingerprints_see_rows_and_not_their_order(spark):
    make = lambda *rows: spark.createDataFrame(list(rows), "a string, b string, n int")
    rows = [("x", None, 1), ("x", None, 1), ("", "y", 2), (None, None, None)]
    same = fingerprint(make(*rows))
    assert fingerprint(make(*rows[::-1]).repartition(3)) == same
    assert fingerprint(make(*rows).select("n", "b", "a")) == same
    others = [rows[1:], [*rows, rows[0]], [(None, "x", 1), *rows[1:]], [*rows[:3], ("", None, None)], []]
    assert len({same, *(fingerprint(make(*o)) for o in others)}) == 6
    assert fingerprint(make(*rows).withColumnRenamed("a", "c")) != same
    assert fingerprint(make(*rows).withColumn("n", F.col("n").cast("bigint"))) != same
    assert fingerprint(make(*rows).withColumn("place", F.rand()), ("place",)) == same


def test_only_descendants_of_what_changed_are_built(ws, raw, monkeypatch):
    rows = [{"id_credito": f"C{k}", "id_cliente": f"K{k % 3}", "monto": str(2000 + k)} for k in range(12)]
    rows += [{"id_credito": "R", "monto": "-5"}, {"id_credito": "D"}, {"id_credito": "D"}]
    first = refresh.refresh(ws, raw(*rows))
    assert set(first.changed) == ALL
    stored = {name: refresh.Built(**b) for name, b in json.loads(json.dumps({n: asdict(b) for n, b in first.built.items()})).items()}
    assert refresh.refresh(ws, raw(*rows).repartition(4), before=stored).changed == []

    # a rejected row changes: the gate and staging see it, their rows are the same, the star is left alone
    rejected = [*rows[:12], {"id_credito": "R", "monto": "-6"}, *rows[13:]]
    again = refresh.refresh(ws, raw(*rejected), before=stored)
    assert set(again.changed) == {"quality.flagged", STAGING}

    # an amount changes: dimensions are looked at again, and the fact is that of a build from nothing
    rows[4]["monto"] = "7777"
    changed = refresh.refresh(ws, raw(*rows), before=stored)
    assert set(changed.changed) == ALL
    whole = pipeline.run(ws, raw(*rows))
    for name in ALL - {STAGING}:
        assert sorted(map(str, changed.tables[name].collect())) == sorted(map(str, whole[name].collect()))

    monkeypatch.setattr(refresh, "definition", lambda: "another")
    assert set(refresh.refresh(ws, raw(*rows), before=changed.built).changed) == ALL


def test_empty_raw_table(ws, raw):
    none = raw({"id_credito": "A"}).where("fila < 0")
    first = refresh.refresh(ws, none)
    assert first.tables[FACT].count() == 0 and refresh.refresh(ws, none, before=first.built).changed == []
