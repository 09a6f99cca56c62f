"""Physical plans: what scales must stay in them."""

from datetime import date

from pyspark.sql import functions as F

import __spark_entry__ as entry
from credara.operators import quality
from credara.operators.keys import with_position
from credara.plans import kpis, pipeline, staging
from credara.schemas import RAW_COLUMNS

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def warehouse(spark):
    return entry.Warehouse.of(spark, SF)


def test_dedup_cuts_each_task_before_the_shuffle(spark):
    text = plan(staging.stg_creditos(warehouse(spark).raw))
    assert "row_number()" in text and "Partial" in text and text.count("Exchange") >= 1 and "WindowGroupLimit" in text


def test_row_failures_do_not_shuffle(spark):
    text = plan(quality.row_failures(warehouse(spark).raw))
    assert "Exchange" not in text
    assert "ReadSchema: struct<fila:bigint,id_credito:string,fecha_originacion:string,monto:string>" in text


def test_duplicates_shuffle_only_counts(spark):
    text = plan(quality.flagged_identifiers(warehouse(spark).raw))
    assert "partial_sum" in text and "ReadSchema: struct<fila:bigint,id_credito:string>" in text


def test_clean_split_broadcasts_the_small_saved_side(spark):
    w = warehouse(spark)
    text = plan(quality.clean_rows(w.raw, w.flagged))
    assert "BroadcastHashJoin LeftAnti" in text and "SortMergeJoin" not in text


def test_clean_split_can_do_without_broadcast(spark):
    w = warehouse(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = quality.clean_rows(w.raw, w.flagged)
        assert "BroadcastHashJoin" not in plan(df) and df.count() == 1300
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_keys_are_range_partitioned(spark):
    text = plan(with_position(warehouse(spark).raw, ["id_credito", "fila"]))
    assert "rangepartitioning" in text and "SinglePartition" not in text


def test_kpis_read_only_their_columns_and_aggregate_before_joining(spark):
    t = warehouse(spark).strict
    text = plan(kpis.late_index(t["marts.fact_originaciones"], t["marts.dim_industria"]))
    assert "ReadSchema: struct<industria_id:bigint,estatus_primer_pago:string>" in text
    tree = text[:text.index("\n\n")] if "\n\n" in text else text
    below_the_join = tree[tree.index("BroadcastHashJoin"):]
    assert below_the_join.count("HashAggregate") == 2    # partial and final, before any row meets the dimension


def test_period_filter_reaches_the_scan(spark):
    import datetime as dt
    fact = warehouse(spark).strict["marts.fact_originaciones"]
    text = plan(kpis.total(kpis.in_period(fact, dt.date(1995, 3, 1), dt.date(1995, 3, 31))))
    assert "GreaterThanOrEqual(tiempo_id,19950301)" in text and "LessThanOrEqual(tiempo_id,19950331)" in text


def test_top_k_needs_no_full_sort(spark):
    t = warehouse(spark).strict
    assert "TakeOrderedAndProject" in plan(kpis.top_industries(t["marts.fact_originaciones"], t["marts.dim_industria"]))


def test_a_hot_client_is_split_at_run_time(spark, ws, raw):
    """A client with a third of all credits, joined without broadcast: AQE splits its partition."""
    one = raw({"id_credito": "x"}).drop("fila", "id_credito", "id_cliente", "nombre_cliente")
    rows = spark.range(30_000).selectExpr(
        "concat('K', lpad(id, 6, '0')) AS id_credito", "id + 2 AS fila",
        "CASE WHEN id % 3 = 0 THEN 'HOT' ELSE concat('C', id) END AS id_cliente",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('n', id) END AS nombre_cliente").crossJoin(one)
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.coalescePartitions.enabled": "false",    # several map tasks also for little data
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        tables = pipeline.run(ws, ws.save("raw", rows.select(*RAW_COLUMNS, "fila")), "strict")
        stg = tables["staging.stg_creditos"]
        joined = stg.join(tables["marts.dim_cliente"].select("id_cliente", "cliente_id"), "id_cliente", "left")
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    fact = tables["marts.fact_originaciones"]
    got = fact.join(tables["marts.dim_cliente"], "cliente_id").groupBy("id_cliente").count().where("count > 1").collect()
    assert [tuple(r) for r in got] == [("HOT", 10_000)]
    assert fact.where("originacion_id <> cast(substr(id_credito, 2) AS bigint) + 1").isEmpty()


def test_a_period_reads_few_files(spark, ws, raw, tmp_path):
    rows = [{"id_credito": f"A{i}", "fecha_originacion": f"2024-{1 + i % 12:02d}-{1 + i % 28:02d}"} for i in range(3000)]
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fact = pipeline.run(ws, raw(*rows))["marts.fact_originaciones"]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    ranges = (fact.groupBy(F.input_file_name().alias("file")).agg(F.min("tiempo_id").alias("low"), F.max("tiempo_id").alias("high"))
              .orderBy("low").collect())
    assert len(ranges) > 2 and all(a.high <= b.low for a, b in zip(ranges, ranges[1:]))
    march = kpis.in_period(fact, date(2024, 3, 1), date(2024, 3, 31))
    assert "GreaterThanOrEqual(tiempo_id,20240301)" in march._jdf.queryExecution().executedPlan().toString()
    assert sum(r.low <= 20240331 and r.high >= 20240301 for r in ranges) < len(ranges)
