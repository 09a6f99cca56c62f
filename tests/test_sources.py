import csv
import random
from types import SimpleNamespace

import pytest

from credara.operators import integrity, quality
from credara.plans import pipeline
from credara.schemas import RAW_COLUMNS, TABLES
from credara.session import size_shuffles, stored_bytes
from credara.sources import csv_files
from credara.sources.tables import BrokenConstraints, Catalog
from credara.sources.workspace import Workspace, shared_folder

HEADER = ",".join(RAW_COLUMNS)


def line(id_, amount="5000", name="Ana"):
    return f"{id_},2024-03-05,C1,{name},Salud,{amount},12,Web,A Tiempo"


def write(path, lines):
    path.write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")
    return str(path)


def test_row_numbers_of_a_file_read_in_pieces(spark, ws, tmp_path):
    file = write(tmp_path / "mes.csv", [line(f"ID{i}") for i in range(20_000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        df = csv_files.read_credits(ws, file)
        assert df.where("fila != cast(substr(id_credito, 3) AS bigint) + 2").isEmpty() and df.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_several_files_as_one_sequence_or_each_on_its_own(ws, tmp_path):
    write(tmp_path / "a.csv", [line("A0"), line("A1")])
    write(tmp_path / "b.csv", [line("B0"), "", line("")])
    one = csv_files.read_credits(ws, str(tmp_path))
    assert sorted((r.fila, r.id_credito) for r in one.where("id_credito is not null").collect()) == [(2, "A0"), (3, "A1"), (4, "B0")]
    each = csv_files.read_credits(ws, str(tmp_path), per_file=True)
    assert sorted((r.archivo, r.fila) for r in each.collect()) == [("a.csv", 2), ("a.csv", 3), ("b.csv", 2), ("b.csv", 3)]
    assert quality.failure_log(each).first().id_credito == "(b.csv:fila_3)"


def test_na_spellings_and_quotes(ws, tmp_path):
    file = write(tmp_path / "x.csv", [line("NA", "null", '"Pérez, ""Pepe"" S.A."'), line("n/a x", "None")])
    df = csv_files.read_credits(ws, file).orderBy("fila").collect()
    assert [(r.id_credito, r.monto) for r in df] == [(None, None), ("n/a x", None)]
    assert df[0].nombre_cliente == 'Pérez, "Pepe" S.A.'
    plain = csv_files.read_credits(ws, file, na_tokens=False).orderBy("fila").collect()
    assert [(r.id_credito, r.monto) for r in plain] == [("NA", "null"), ("n/a x", "None")]


def test_failure_log_round_trip(spark, raw, tmp_path):
    log = quality.failure_log(raw({"id_credito": "", "monto": 'a"b, c'}))
    csv_files.write_csv(log, str(tmp_path / "fallos"))
    back = csv_files._options(spark.read.schema(log.schema)).csv(str(tmp_path / "fallos"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, log.collect())) and back.count() == 2


def test_catalog_refresh(spark, raw, ws, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "lake"))
    assert set(catalog.missing()) == set(TABLES)
    try:
        catalog.create_all()
        assert catalog.missing() == [] and {r.filas for r in catalog.audit().collect()} == {0}
        for n in (3, 2):
            catalog.truncate_all()
            rows = catalog.save("raw.raw_creditos", raw(*[{"id_credito": f"A{i}"} for i in range(n)]))
            pipeline.run(ws, rows, "staging_only", catalog.save)
            counts = {r.tabla: r.filas for r in catalog.audit().collect()}
            assert counts == {"raw.raw_creditos": n, "staging.stg_creditos": n, "marts.dim_cliente": 1,
                              "marts.dim_tiempo": 1, "marts.dim_industria": 1, "marts.fact_originaciones": n}
        catalog.expire("raw.raw_creditos")
        assert spark.table("raw.raw_creditos").count() == 2
        assert len(list((tmp_path / "lake/raw/raw_creditos").iterdir())) == 1
        catalog.append("marts.dim_industria", catalog.read("marts.dim_industria").selectExpr("industria_id + 1", "'Web'"))
        assert spark.table("marts.dim_industria").count() == 2
    finally:
        for name in ("raw", "staging", "marts"):
            catalog.drop_namespace(name)


def test_a_month_from_file_to_tables(spark, ws, tmp_path):
    file = write(tmp_path / "mes.csv", [line("A"), line("A"), line("B"), line("NA"), line("C", "x")])
    catalog = Catalog(spark, str(tmp_path / "lake"))
    try:
        expected = {"strict": (1, 4), "staging_only": (3, 3)}
        for gate, (rows, faults) in expected.items():
            load = pipeline.load_month(ws, file, catalog, gate, str(tmp_path / gate))
            assert spark.table("marts.fact_originaciones").count() == load.tables["marts.fact_originaciones"].count() == rows
            assert load.statistics.first().total_fallos == faults
            assert load.loaded == (1 if gate == "strict" else 5) and load.models["marts.fact_originaciones"][0] == rows
            assert load.violations.isEmpty()
            for table, schema in TABLES.items():
                assert spark.table(table).columns == schema.fieldNames()
            assert spark.read.option("header", True).csv(str(tmp_path / gate)).count() == faults
    finally:
        for name in ("raw", "staging", "marts"):
            catalog.drop_namespace(name)


def test_broken_constraints_are_reported(spark, ws, tmp_path):
    file = write(tmp_path / "mes.csv", [line("A", name="Ana"), line("B", name="Ana María"), line("C").replace("Salud", "")])
    catalog = Catalog(spark, str(tmp_path / "lake"))
    try:
        found = pipeline.load_month(ws, file, catalog).violations.collect()
        assert {(r.comprobacion, r.tabla, r.filas) for r in found} >= {
            ("clave de negocio", "marts.dim_cliente", 1), ("referencia", "marts.dim_industria", 2)}
    finally:
        for name in ("raw", "staging", "marts"):
            catalog.drop_namespace(name)


def test_workspace_lives_in_the_shared_folder(spark):
    space = Workspace(spark)
    assert space.root.startswith(shared_folder(spark)) and shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    first = space.save("x", spark.range(3))
    space.save("x", spark.range(5))
    assert first.count() == 3
    assert stored_bytes(spark, space.root) > 0
    space.clear()
    with pytest.raises(Exception):
        stored_bytes(spark, space.root)


def test_only_a_local_session_may_lack_a_shared_folder():
    def session(**conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)))
    local = session(**{"spark.master": "local[2]", "spark.app.id": "test-app"})
    assert shared_folder(local) == shared_folder(local)
    assert shared_folder(session(**{"spark.checkpoint.dir": "hdfs://shared/work/"})) == "hdfs://shared/work"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session(**{"spark.master": "yarn"}))


def test_shuffle_partitions_only_grow(spark, monkeypatch):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr("credara.session.stored_bytes", lambda *_: 10**14)
    try:
        assert 10_000 < size_shuffles(spark, "x") < 100_000
        monkeypatch.setattr("credara.session.stored_bytes", lambda *_: 0)
        assert size_shuffles(spark, "x") > 10_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_columns_are_found_by_name(spark, ws, tmp_path):
    names = HEADER.split(",")
    row = dict(zip(names, line("A1").split(",")))
    turned = [*reversed(names), "extra"]
    (tmp_path / "x.csv").write_text("\n".join([",".join(turned), ",".join([*(row[c] for c in turned[:-1]), "?"])]) + "\n")
    got = csv_files.read_credits(ws, str(tmp_path / "x.csv")).first()
    assert got.asDict() == {**row, "fila": 2}


@pytest.mark.parametrize("header", [HEADER.replace("monto", "importe"), HEADER + ",monto"])
def test_missing_and_repeated_columns_fail(spark, ws, tmp_path, header):
    (tmp_path / "x.csv").write_text("\n".join([header, line("A") + ",1" * (header.count(",") - 8)]) + "\n")
    with pytest.raises(ValueError, match="monto"):
        csv_files.read_credits(ws, str(tmp_path / "x.csv"))


@pytest.mark.parametrize("broken", [line("B") + ",more", "B,2024-03-05", 'B,2024-03-05,C1,"An\na,Salud,1,12,Web,A Tiempo',
                                    'B,2024-03-05,C1,"An\na",Salud,1,12,Web'])
def test_malformed_lines_stop_the_load(spark, ws, tmp_path, broken):
    file = write(tmp_path / "x.csv", [line("A"), broken, line("C")])
    with pytest.raises(Exception, match="malformed line"):
        csv_files.read_credits(ws, file).count()


def read_in_splits(spark, ws, path, size, **options):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        return csv_files.read_credits(ws, path, na_tokens=False, **options).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("size, ending", [(300, "\n"), (1000, "\r\n"), (10 ** 9, "\n")])
def test_line_breaks_inside_quotes(spark, ws, tmp_path, size, ending):
    """Against the csv module, with splits that begin inside of quoted fields."""
    rng = random.Random(size)
    parts = ["Ana", " ", '""', "\n", "\n\n", ",", "x" * 90, "é", "\na,b,\"\"", "'"]
    expected = []
    for name in ("a.csv", "b.csv", "c.csv"):
        rows = []
        for k in range(120):
            text = "".join(rng.choices(parts, k=rng.randint(0, 9)))
            rows.append(line(f"{name}{k}", name=rng.choice([f'"{text}"', f'"{text}"', '5" x', "plain"])))
            rows += rng.choice([[], [], [], [""], ["   "]])
        (tmp_path / name).write_bytes((HEADER + ending + ending.join(rows) + rng.choice(["", ending])).encode())
        with open(tmp_path / name, newline="") as file:
            own = [r for r in csv.DictReader(file) if any((v or "").strip() for v in r.values())]
        expected += [(name, i + 2, r["id_credito"], r["nombre_cliente"]) for i, r in enumerate(own)]
    got = read_in_splits(spark, ws, str(tmp_path), size, per_file=True)
    assert sorted((r.archivo, r.fila, r.id_credito, r.nombre_cliente or "") for r in got) == sorted(expected)
    one = read_in_splits(spark, ws, str(tmp_path), size)
    assert sorted((r.fila, r.id_credito) for r in one) == [(k + 2, e[2]) for k, e in enumerate(expected)]


def test_a_record_over_many_splits(spark, ws, tmp_path):
    long = '"' + "line of a note\n" * 400 + '"'
    file = write(tmp_path / "x.csv", [line("A"), line("B", name=long), line("C", name='""'), line("D", name='"d\n"')])
    got = sorted(read_in_splits(spark, ws, file, 500), key=lambda r: r.fila)
    assert [(r.fila, r.id_credito) for r in got] == [(2, "A"), (3, "B"), (4, "C"), (5, "D")]
    assert got[1].nombre_cliente == long[1:-1] and got[3].nombre_cliente == "d\n"


def test_files_in_another_column_order_do_not_mix(spark, ws, tmp_path):
    write(tmp_path / "a.csv", [line("A")])
    swapped = HEADER.replace("id_credito", "?").replace("id_cliente", "id_credito").replace("?", "id_cliente")
    (tmp_path / "b.csv").write_text(swapped + "\n" + line("B") + "\n")
    with pytest.raises(Exception):
        csv_files.read_credits(ws, str(tmp_path)).count()


def test_a_broken_load_changes_nothing(spark, ws, tmp_path):
    good = write(tmp_path / "a.csv", [line("A"), line("B")])
    broken = write(tmp_path / "b.csv", [line("C"), line("D").replace("Salud", "NULL")])
    catalog = Catalog(spark, str(tmp_path / "lake"))
    try:
        pipeline.load_month(ws, good, catalog, enforce=True)
        rows = {t: sorted(map(tuple, df.collect())) for t, df in catalog.read_all().items()}
        before, version = catalog.manifest(), catalog.version()
        assert set(before) == set(TABLES)
        with pytest.raises(BrokenConstraints, match="dim_industria.nombre_industria: 1"):
            pipeline.load_month(ws, broken, catalog, enforce=True)
        assert (catalog.manifest(), catalog.version()) == (before, version)
        assert {t: sorted(map(tuple, df.collect())) for t, df in catalog.read_all().items()} == rows
        assert sorted(r.id_credito for r in spark.table("raw.raw_creditos").collect()) == ["A", "B"]
        done = pipeline.load_month(ws, broken, catalog)
        assert done.violations.where("comprobacion = 'no nulo'").count() == 1 and catalog.version() == version + 1
        # an earlier version can still be read, and names follow the manifest again after they were lost
        assert catalog.read_entry(catalog.manifest(version)["raw.raw_creditos"]).count() == 2
        catalog.drop_namespaces()
        catalog.recover()
        assert sorted(r.id_credito for r in spark.table("raw.raw_creditos").collect()) == ["C", "D"]
    finally:
        catalog.drop_namespaces()


def test_of_two_loads_that_overlap_one_is_refused(spark, raw, ws, tmp_path):
    catalog = Catalog(spark, str(tmp_path / "lake"))
    try:
        first, second = catalog.stage(), catalog.stage()
        for staged, id_ in ((first, "A"), (second, "B")):
            staged.save("raw.raw_creditos", raw({"id_credito": id_}))
        first.publish()
        with pytest.raises(RuntimeError, match="another load"):
            second.publish()
        assert [r.id_credito for r in catalog.read("raw.raw_creditos").collect()] == ["A"]
    finally:
        catalog.drop_namespaces()


def test_constraints_allow_missing_references_and_repeated_names(spark):
    tables = {"marts.dim_industria": spark.createDataFrame([(1, "Salud")], "industria_id long, nombre_industria string"),
              "marts.fact_originaciones": spark.createDataFrame(
                  [(1, "A", 1), (2, "B", None), (2, "C", 7), (None, None, 7)], "originacion_id long, id_credito string, industria_id long")}
    found = {tuple(r) for r in integrity.enforced(tables).collect()}
    fact = "marts.fact_originaciones"
    assert found == {("clave primaria", fact, "originacion_id", 2), ("no nulo", fact, "id_credito", 1), ("referencia", fact, "industria_id", 2)}


def test_files_with_line_breaks_grow_in_number_with_the_credits():
    import __spark_entry__
    assert [__spark_entry__._csv_file_count(n) for n in (0, 150_000, 9_000_000, 54_000_000)] == [2, 2, 9, 54]
