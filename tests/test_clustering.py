"""Clustering by several columns, and counts from footers."""

import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from credara.operators.clustering import BITS, clustered, morton
from credara.sources import footers
from credara.sources.tables import Catalog
from test_plans import SF, plan

SCHEMA = "day int, kind bigint, n bigint"


def _interleaved(values, bits):
    """Brute force: bit by bit, from the highest."""
    code = 0
    for bit in reversed(range(bits)):
        for v in values:
            code = code << 1 | v >> bit & 1
    return code


def test_morton_interleaves_bits(spark):
    rng = random.Random(1)
    rows = [tuple(rng.randrange(1 << 20) for _ in range(3)) for _ in range(200)] + [(0, 0, 0), ((1 << 20) - 1,) * 3]
    df = spark.createDataFrame(rows, "a bigint, b bigint, c bigint")
    for names in (["a"], ["a", "b"], ["a", "b", "c"]):
        got = df.select("a", "b", "c", morton([F.col(c) for c in names], 20).alias("z")).collect()
        assert all(r.z == _interleaved([r[c] for c in names], 20) for r in got)
    with pytest.raises(ValueError):
        morton([F.col("a")] * 4, BITS)


def _admitting(folder, column, low, high):
    """Share of the rows' files whose statistics let values from ``low`` to ``high`` in."""
    files = [pq.read_metadata(f) for f in glob.glob(f"{folder}/*.parquet")]
    place = files[0].schema.names.index(column)
    ranges = [(f.row_group(g).column(place).statistics.min, f.row_group(g).column(place).statistics.max)
              for f in files for g in range(f.num_row_groups)]
    return sum(a <= high and b >= low for a, b in ranges) / len(ranges), len(ranges)


def test_either_filter_skips_files(spark, tmp_path):
    """A third of the rows has one kind and a third one day: files are still skipped by either column."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, 700).otherwise(F.pmod(F.hash("id"), F.lit(1000))).cast("int").alias("day"),
        F.when(F.col("id") % 3 == 1, 3).otherwise(F.pmod(F.hash("id", F.lit(1)), F.lit(12))).cast("bigint").alias("kind"),
        F.col("id").alias("n"))
    rows.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    clustered(rows, ["day", "kind"], ["n"], files=64).write.parquet(f"{tmp_path}/boxes")
    rows.repartitionByRange(64, "day", "n").sortWithinPartitions("day", "n").write.parquet(f"{tmp_path}/days")
    by_day, files = _admitting(f"{tmp_path}/boxes", "day", 100, 110)
    by_kind, _ = _admitting(f"{tmp_path}/boxes", "kind", 9, 9)
    assert files > 50 and by_day < 0.3 and by_kind < 0.3
    assert _admitting(f"{tmp_path}/days", "kind", 9, 9)[0] > 0.5    # what the order by day alone would read
    assert spark.read.parquet(f"{tmp_path}/boxes").exceptAll(rows).isEmpty() and rows.count() == 60_000
    text = plan(spark.read.parquet(f"{tmp_path}/boxes").where("day BETWEEN 100 AND 110 AND kind = 9"))
    assert "GreaterThanOrEqual(day,100)" in text and "EqualTo(kind,9)" in text.split("PushedFilters")[1]
    sizes = [pq.read_metadata(f).num_rows for f in glob.glob(f"{tmp_path}/boxes/*.parquet")]
    assert max(sizes) < 4 * 60_000 / 64    # the hot day and the hot kind are spread


def test_nulls_one_value_and_empty_tables(spark):
    rows = [(None, 1, 1), (3, None, 2), (None, None, 3), (3, 1, 4), (9, 1, 5), (9, 1, 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(map(tuple, clustered(df, ["day", "kind"], ["n"], 3).collect()), key=str) == sorted(rows, key=str)
    assert clustered(df.where("n < 0"), ["day"], ["n"]).count() == 0
    nothing = spark.createDataFrame([(None, None, 1)], SCHEMA)
    assert clustered(nothing, ["day", "kind"], ["n"]).count() == 1
    widest = [(1, -2**62, 1), (2, 2**62, 2)]
    assert clustered(spark.createDataFrame(widest, SCHEMA), ["day", "kind"], ["n"], 2).count() == 2


def test_clustered_queries_read_pushed_filters(spark):
    text = plan(entry.queries()["kpi_total_industry_in_period"](spark, SF))
    pushed = text.split("PushedFilters")[1].splitlines()[0]
    assert "EqualTo(industria_id,2)" in pushed and "tiempo_id" in pushed


def test_counts_come_from_footers(spark, tmp_path):
    df = spark.range(1000).repartition(5)
    df.write.parquet(f"{tmp_path}/a")
    df.where("id < 0").write.parquet(f"{tmp_path}/none")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    folders = {"a": (df.schema, f"{tmp_path}/a"), "none": (df.schema, f"{tmp_path}/none")}
    assert plan(footers.counts(spark, folders)).count("PushedAggregation: [COUNT(*)]") == 2
    assert footers.row_counts(spark, folders) == {"a": 1000, "none": 0} and footers.row_counts(spark, {}) == {}
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_audit_counts_appended_rows(spark, tmp_path):
    catalog = Catalog(spark, str(tmp_path), "audit_")
    try:
        catalog.create_all()
        raw = entry.Warehouse.of(spark, SF).raw.drop("fila")
        catalog.save("raw.raw_creditos", raw)
        catalog.append("raw.raw_creditos", raw)
        counts = {r.tabla: r.filas for r in catalog.audit().collect()}
        assert counts["raw.raw_creditos"] == 2 * raw.count() and counts["marts.fact_originaciones"] == 0
    finally:
        catalog.drop_namespaces()
