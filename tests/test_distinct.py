"""Distinct counts from bitmaps against sets."""

import random

import pytest
from pyspark.sql import functions as F

from credara.operators import distinct

KEYS = [None, 0, 1, -1, 32_767, 32_768, 32_769, 65_536, -32_768, 10 ** 12, -10 ** 12]


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(8)
    found = [(rnd.choice([None, *range(20240101, 20240111)]), rnd.choice([*KEYS, rnd.randint(1, 200_000)]))
             for _ in range(900)]
    return found + [(20240105, 7)] * 400 + [(20240199, None)] * 3 + found[:50]


def frame(spark, rows):
    return spark.createDataFrame(rows, "tiempo_id int, cliente_id bigint").repartition(6)


def sets(rows, group):
    out = {}
    for day, key in rows:
        out.setdefault(group(day), set()).update([] if key is None else [key])
    return {g: len(s) for g, s in out.items()}


def counted(stored, by):
    return {r[0]: r[1] for r in distinct.count_distinct(stored, by, "n").collect()}


def test_any_union_of_days(spark, ws, rows):
    stored = None
    for k in (2, 0, 1, 0):    # one part comes twice
        stored = distinct.add_rows(ws, stored, frame(spark, rows[k::3]), "cliente_id", ["tiempo_id"])
    assert counted(stored, ["tiempo_id"]) == sets(rows, lambda d: d)
    weeks = stored.withColumn("semana", F.expr("tiempo_id div 5"))
    assert counted(weeks, ["semana"]) == sets(rows, lambda d: d and d // 5)
    period = stored.where(F.col("tiempo_id").between(20240103, 20240106))
    inside = {k for d, k in rows if d and 20240103 <= d <= 20240106 and k is not None}
    df = distinct.count_distinct(period, [], "n")
    assert [tuple(r) for r in df.collect()] == [(len(inside),)] and df.dtypes == [("n", "bigint")]


def test_no_rows(spark, ws):
    none = distinct.add_rows(ws, None, frame(spark, [(20240101, 1)]).limit(0), "cliente_id", ["tiempo_id"])
    assert [r.n for r in distinct.count_distinct(none, [], "n").collect()] == [0]
    assert distinct.count_distinct(none, ["tiempo_id"], "n").isEmpty()


def test_bits_are_combined_before_the_shuffle_and_the_rows_are_not_read_again(spark, ws, rows):
    saved = ws.save("credits", frame(spark, rows))
    text = distinct.bitmaps(saved, "cliente_id", ["tiempo_id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in text
    stored = distinct.add_rows(ws, None, saved, "cliente_id", ["tiempo_id"])
    assert all("/bitmaps-" in f for f in distinct.count_distinct(stored, [], "n").inputFiles())
