import numpy as np
import pytest
from pyspark.sql import Window, functions as F

from credara.operators import percentiles
from credara.operators.keys import dense_key, extend_keys, with_keys


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_dense_key_equals_row_number(spark, ws, partitions):
    df = spark.range(0, 20_000, 1, partitions).select(
        F.when(F.col("id") % 97 != 0, F.concat(F.lit("k"), F.pmod(F.xxhash64("id"), F.lit(500)))).alias("k"), "id")
    order = [F.col("k").asc_nulls_last(), F.col("id").asc()]
    want = df.withColumn("clave", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    got = dense_key(ws, df, ["k", "id"], "clave")
    assert got.dtypes[0] == ("clave", "bigint")
    assert want.select("clave", "k", "id").exceptAll(got).isEmpty() and got.count() == 20_000


def test_dense_key_with_a_hot_value(spark, ws):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    got = dense_key(ws, df, ["k", "id"], "clave").agg(F.min("clave"), F.max("clave"), F.count_distinct("clave")).first()
    assert tuple(got) == (1, 30_000, 30_000)


def test_dense_key_of_nothing(spark, ws):
    assert dense_key(ws, spark.range(0), ["id"], "clave").isEmpty()


@pytest.mark.parametrize("accuracy", [50, 1000])
def test_exact_percentiles_at_every_accuracy(spark, ws, monkeypatch, accuracy):
    monkeypatch.setattr(percentiles, "_ACCURACY", accuracy)
    rng = np.random.default_rng(7)
    data = {"a": rng.integers(100_000, 500_000_000, 4001), "b": rng.integers(0, 30, 1000), "c": np.array([5]),
            "d": np.concatenate([np.full(3000, 77_777), rng.integers(-1000, 10**12, 2000)])}
    rows = [(g, int(v)) for g, vs in data.items() for v in vs] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v bigint").repartition(8)
    probs = [0.5, 0.25, 0.75, 0.0, 1.0]
    got = percentiles.exact_percentiles(ws, df, "g", "v", probs).collect()
    assert {r.g for r in got} == set(data)
    for r in got:
        assert (r.n, int(r.total)) == (len(data[r.g]), int(data[r.g].sum()))
        for i, p in enumerate(probs):
            assert r[f"q{i}"] == pytest.approx(float(np.percentile(data[r.g], p * 100)), rel=1e-12, abs=1e-9)


def test_many_rows_agree_with_the_built_in_function(spark, ws):
    df = spark.range(1_200_000).select((F.col("id") % 3).alias("g"), F.pmod(F.xxhash64("id"), F.lit(500_000_000)).alias("v"))
    found = percentiles.exact_percentiles(ws, df, "g", "v", [0.5, 0.9])
    assert "percentile(" not in found._jdf.queryExecution().toString()
    # the plan that remains is one scan: the sketch has been read already, and few values are counted one by one
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1
    assert ws.spark.read.parquet(f"{ws.root}/tramos-*").count() == 3
    want = df.groupBy("g").agg(F.percentile("v", [0.5, 0.9]).alias("q")).collect()
    assert {r.g: [r.q0, r.q1] for r in found.collect()} == {r.g: r.q for r in want}


def test_percentiles_with_a_total_and_rows_without_a_group(spark, ws):
    rng = np.random.default_rng(8)
    groups, values = rng.integers(1, 6, 3000), rng.integers(100_000, 500_000_000, 3000)
    rows = [(int(g) if g < 5 else None, int(v)) for g, v in zip(groups, values)]
    df = spark.createDataFrame(rows, "g bigint, v bigint").repartition(4)
    got = {r.g: r for r in percentiles.exact_percentiles(ws, df, "g", "v", [0.5, 0.1], total=0).collect()}
    want = {0: values, **{g: values[groups == g] for g in range(1, 5)}}
    assert set(got) == set(want)
    for g, vs in want.items():
        assert (got[g].n, int(got[g].total)) == (len(vs), int(vs.sum()))
        assert [got[g].q0, got[g].q1] == pytest.approx([float(np.percentile(vs, p)) for p in (50, 10)], rel=1e-12)


def test_brackets_hold_a_small_part_of_a_large_group(spark):
    df = spark.range(400_000).select(F.lit(1).alias("g"), F.pmod(F.xxhash64("id"), F.lit(500_000_000)).alias("v"))
    row = percentiles._brackets(df, [0.25, 0.5, 0.99]).first()
    inside = df.where(" OR ".join(f"v BETWEEN {t.lo} AND {t.hi}" for t in row.tramos)).count()
    assert len(row.tramos) == 3 and inside < 400_000 * 0.04


def test_keys_stay_over_loads(spark, ws):
    make = lambda *rows: spark.createDataFrame(rows, "a string, b string, n int")
    order = ["a", "b"]
    first = extend_keys(ws, None, make(("x", None, 1), ("x", None, 2), ("y", "1", 3), (None, "z", 4)), order, "k")
    second = extend_keys(ws, first, make(("a", "a", 1), ("y", "1", 2), (None, None, 3), ("x", None, 4)), order, "k")
    third = extend_keys(ws, second, make(("b", "0", 1)), order, "k")
    of = lambda known: {(r.a, r.b): r.k for r in known.collect()}
    assert of(first) == {("x", None): 1, ("y", "1"): 2, (None, "z"): 3}
    # a member that does not come again keeps its key for ever
    assert of(second) == of(first) | {("a", "a"): 4, (None, None): 5}
    assert of(third) == of(second) | {("b", "0"): 6} and third.count() == 6
    rows = with_keys(make(("x", None, 7), (None, None, 8), ("new", "", 9)), third, order, "k").collect()
    assert {tuple(r) for r in rows} == {(1, "x", None, 7), (5, None, None, 8), (None, "new", "", 9)}
    assert of(extend_keys(ws, third.limit(0), make(("q", "q", 1)), order, "k")) == {("q", "q"): 1}
    assert extend_keys(ws, first, make().limit(0), order, "k").count() == 3
