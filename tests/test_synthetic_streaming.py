import datetime as dt

import pytest
from pyspark.sql import functions as F

from credara.schemas import CHANNELS, INDUSTRIES, RAW_COLUMNS, TERMS
from credara.sources import csv_files, synthetic
from credara.streaming import arrivals
from test_sources import line, write

AS_OF = dt.date(2024, 6, 30)


def test_generated_rates_and_domains(spark):
    n = 200_000
    df = synthetic.generate(spark, n, seed=1, as_of=AS_OF).cache()
    p = synthetic.fault_profile(df).first()
    assert p.total == n
    for count, rate in ((p.nulos_id_credito, .02), (p.nulos_monto, .02), (p.nulos_fecha_originacion, .02),
                        (p.montos_negativos, .015), (p.fechas_invalidas, .01), (p.ids_duplicados, .01)):
        assert abs(count / n - rate) < 0.0015
    facts = df.agg(F.count_distinct("id_cliente"), F.avg((F.col("estatus_primer_pago") == "A Tiempo").cast("int")),
                   F.min(F.abs(F.col("monto").cast("double"))), F.max(F.abs(F.col("monto").cast("double")))).first()
    assert facts[0] == n and abs(facts[1] - .75) < .005 and facts[2] >= 1000 and facts[3] <= 5_000_000
    for column, domain in (("industria", INDUSTRIES), ("canal", CHANNELS), ("plazo_meses", map(str, TERMS))):
        assert {r[0] for r in df.select(column).distinct().collect()} == set(domain)
    df.unpersist()


def test_generator_depends_on_the_seed_only(spark):
    a, b, c = (synthetic.generate(spark, 500, seed=s, as_of=AS_OF) for s in (3, 3, 4))
    assert a.repartition(7).exceptAll(b).isEmpty() and not a.exceptAll(c).isEmpty()


def test_one_row(spark):
    assert synthetic.generate(spark, 1, as_of=AS_OF).count() == 1


def test_files_arrive_one_after_another(spark, ws, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()

    def deliver(name, lines):
        write(inbox / name, lines)
        arrivals.load_new_files(ws, str(inbox), out).awaitTermination()

    deliver("1.csv", [line("A"), line("B"), line("B"), line("C", "-5")])
    deliver("2.csv", [line("A"), line("C"), line("D"), line("")])
    loaded = sorted((r.id_credito, r.lote) for r in arrivals.read_loaded(spark, out).collect())
    assert loaded == [("A", 0), ("C", 1), ("D", 1)]
    log = sorted((r.lote, r.id_credito, r.regla, r.motivo) for r in arrivals.read_failures(spark, out).collect())
    assert [x[:3] for x in log] == [(0, "B", "duplicado_id"), (0, "B", "duplicado_id"), (0, "C", "monto_fuera_rango"),
                                    (1, "(2.csv:fila_5)", "nulo_id_credito"), (1, "A", "duplicado_id")]
    assert log[-1][3] == "id_credito=A aparece 2 veces (duplicado)"
    arrivals.load_new_files(ws, str(inbox), out).awaitTermination()
    assert arrivals.read_loaded(spark, out).count() == 3


def test_a_batch_run_again_replaces_its_output(spark, ws, tmp_path):
    out = str(tmp_path / "out")
    file = write(tmp_path / "1.csv", [line("A"), line("B")])
    for _ in range(2):
        batch = arrivals.file_lines(spark.read, file)
        arrivals.process_batch(ws, batch, 0, out)
    assert arrivals.read_loaded(spark, out).count() == 2


def test_lost_progress_is_refused(spark, ws, tmp_path):
    write(tmp_path / "1.csv", [line("A")])
    (tmp_path / "out" / "limpios").mkdir(parents=True)
    with pytest.raises(RuntimeError, match="progress"):
        arrivals.load_new_files(ws, str(tmp_path), str(tmp_path / "out"))


@pytest.mark.parametrize("order", [("1.csv", "2.csv"), ("2.csv", "1.csv")])
def test_an_id_rejected_as_repeated_never_comes_back(spark, ws, tmp_path, order):
    files = {"1.csv": [line("A"), line("B"), line("B")], "2.csv": [line("A"), line("B"), line("C")]}
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    for name in order:
        write(inbox / name, files[name])
        arrivals.load_new_files(ws, str(inbox), out).awaitTermination()
    loaded = sorted((r.id_credito, r.archivo) for r in arrivals.read_loaded(spark, out).collect())
    # the first delivery that holds an id decides about it
    first = {"1.csv": [("A", "1.csv"), ("C", "2.csv")], "2.csv": [("A", "2.csv"), ("B", "2.csv"), ("C", "2.csv")]}
    assert loaded == first[order[0]]
    decided = arrivals.read_decided(spark, out)
    assert decided.where("rid = 'B'").count() == 2 and decided.where(decided.balde.isNull()).isEmpty()


def test_runs_of_decided_ids_stay_few(spark, ws, tmp_path, monkeypatch):
    monkeypatch.setattr(arrivals, "_FAN", 2)
    out, counts = str(tmp_path / "out"), []
    for batch_id in range(7):
        file = write(tmp_path / f"{batch_id}.csv", [line(f"N{batch_id}"), line("A"), line(f"N{max(0, batch_id - 3)}")])
        for _ in range(2 if batch_id == 5 else 1):    # a batch that runs again
            arrivals.process_batch(ws, arrivals.file_lines(spark.read, file), batch_id, out)
        counts.append(len(arrivals.runs(spark, out)))
    assert max(counts) <= 4
    loaded = sorted((r.id_credito, r.lote) for r in arrivals.read_loaded(spark, out).collect())
    assert loaded == [("A", 0), *[(f"N{k}", k) for k in range(1, 7)]]
    # every id that was decided about is there, and batches still count what came before
    decided = {r.rid: r.copias for r in arrivals.read_decided(spark, out).groupBy("rid").agg({"copias": "sum"}).toDF("rid", "copias").collect()}
    assert set(decided) == {"A", *(f"N{k}" for k in range(7))} and decided["N0"] == 5
    assert arrivals.read_failures(spark, out).where("regla = 'duplicado_id' AND id_credito = 'A' AND lote = 6").count() == 1


def test_a_merge_that_broke_off_is_finished(spark, ws, tmp_path, monkeypatch):
    monkeypatch.setattr(arrivals, "_FAN", 2)
    out = str(tmp_path / "out")
    ids = lambda batch: spark.createDataFrame([(f"N{batch}", 1, batch, batch)], arrivals._DECIDED)
    for batch in range(2):
        arrivals._write_run(ids(batch), out, 0, batch, batch)
    # the merged run is there, the runs it replaces as well; another one has begun and has no mark of its end
    arrivals._write_run(ids(0).union(ids(1)), out, 1, 0, 1)
    arrivals._write_run(ids(0), out, 2, 0, 1)
    (tmp_path / "out/ids/n2-000000000-000000001/_SUCCESS").unlink()
    assert [r[:3] for r in arrivals.runs(spark, out)] == [(1, 0, 1)]
    assert arrivals.read_decided(spark, out).count() == 2 and arrivals.read_decided(spark, out, before=1).count() == 0


def test_run_is_sorted_by_as_many_tasks_as_its_ids_need():
    assert [arrivals.run_files(n, 0) for n in (0, 1, 250_000, 250_001, 18_000_000)] == [1, 1, 1, 2, 72]
    assert arrivals.run_files(150_000_000, 1) == 300 and arrivals.run_files(10**10, 6) == 2500


def test_clean_rows_of_a_batch_are_written_once(raw, ws, tmp_path, monkeypatch):
    csv_files.write_csv(raw({"id_credito": "A"}, {"id_credito": "B", "monto": "x"}).select(*RAW_COLUMNS), str(tmp_path / "in/1"))
    saved = []
    monkeypatch.setattr(ws, "save", lambda name, df, save=ws.save: saved.append(name) or save(name, df))
    out = str(tmp_path / "out")
    arrivals.load_new_files(ws, str(tmp_path / "in/*"), out).awaitTermination()
    assert "lote_limpios" not in saved and "lote" in saved
    assert [r.id_credito for r in arrivals.read_loaded(ws.spark, out).collect()] == ["A"]
