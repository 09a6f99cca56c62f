from credara.operators import quality


def log_of(raw):
    return sorted((r.id_credito, r.regla) for r in quality.failure_log(raw).collect())


def messages(raw, rule):
    return sorted(r.motivo for r in quality.failure_log(raw).where(f"regla = '{rule}'").collect())


def test_identifiers_are_stripped_and_blank_ones_tagged(raw):
    df = raw({"id_credito": ""}, {"id_credito": None}, {"id_credito": " \t "}, {"id_credito": " A "},
             {"id_credito": "A"}, {"id_credito": "A\t"}, {"id_credito": "B"})
    assert log_of(df) == [("(fila_2)", "nulo_id_credito"), ("(fila_3)", "nulo_id_credito"),
                          ("(fila_4)", "nulo_id_credito")] + [("A", "duplicado_id")] * 3
    assert messages(df, "duplicado_id") == ["id_credito=A aparece 3 veces (duplicado)"] * 3
    assert [r.id_credito for r in quality.clean_rows(df).collect()] == ["B"]


BAD_AMOUNTS = [
    ("abc", "monto_no_numerico", "El valor 'abc' no se puede interpretar como numero"),
    ("1,000", "monto_no_numerico", "El valor '1,000' no se puede interpretar como numero"),
    ("NAN", "monto_no_numerico", "El valor 'NAN' no se puede interpretar como numero"),
    ("12d", "monto_no_numerico", "El valor '12d' no se puede interpretar como numero"),
    ("0x10", "monto_no_numerico", "El valor '0x10' no se puede interpretar como numero"),
    ("1_000", "monto_no_numerico", "El valor '1_000' no se puede interpretar como numero"),
    (" 12 ", "monto_fuera_rango", "Monto $12.00 por debajo del minimo ($1,000)"),
    ("999.99", "monto_fuera_rango", "Monto $999.99 por debajo del minimo ($1,000)"),
    ("-1234567.891", "monto_fuera_rango", "Monto $-1,234,567.89 por debajo del minimo ($1,000)"),
    ("5000000.01", "monto_fuera_rango", "Monto $5,000,000.01 excede el maximo ($5,000,000)"),
    ("inf", "monto_fuera_rango", "Monto $inf excede el maximo ($5,000,000)"),
    ("-Infinity", "monto_fuera_rango", "Monto $-inf por debajo del minimo ($1,000)"),
    ("  ", "nulo_monto", "El campo monto esta vacio o es nulo"),
]
GOOD_AMOUNTS = ["1000", "5000000", "1e3", " 1500.5 ", "+2000", "2000.", "5e6"]


def test_amounts(raw):
    df = raw(*[{"id_credito": f"bad{i:02d}", "monto": a} for i, (a, _, _) in enumerate(BAD_AMOUNTS)],
             *[{"id_credito": f"good{i}", "monto": a} for i, a in enumerate(GOOD_AMOUNTS)])
    assert sorted(map(tuple, quality.failure_log(df).collect())) == [
        (f"bad{i:02d}", rule, message) for i, (_, rule, message) in enumerate(BAD_AMOUNTS)]
    assert quality.clean_rows(df).count() == len(GOOD_AMOUNTS)


DATES = [
    ("2024-02-29", True), ("3000-01-01", True), (" 2024-03-05 ", True), ("2023-02-29", False), ("2024-02-30", False),
    ("2024-13-05", False), ("05/03/2024", False), ("2024-2-3", False), ("2024/03/05", False),
    ("2024-03-05 10:00:00", False), ("2024", False), ("20240305", False), ("+2024-1-01", False)]


def test_dates(raw):
    df = raw(*[{"id_credito": day, "fecha_originacion": day} for day, _ in DATES])
    assert sorted(r.fecha_originacion for r in quality.clean_rows(df).collect()) == sorted(d for d, ok in DATES if ok)
    assert messages(df, "formato_fecha_invalido") == sorted(
        f"fecha_originacion='{d}' no cumple con el formato YYYY-MM-DD o no es una fecha valida" for d, ok in DATES if not ok)


def test_a_record_with_three_faults_counts_three_hits(raw):
    df = raw({"id_credito": "", "monto": "-5", "fecha_originacion": "2024-13-05"}, {"id_credito": "B"})
    stats = quality.statistics(df).first().asDict()
    assert stats == {"total_registros": 2, "total_fallos": 3, "total_validos": -1, "porcentaje_fallos": 150.0,
                     "registros_fallidos": 1, "registros_limpios": 1}


def test_an_id_that_reads_like_a_failed_rows_tag_is_removed_too(raw):
    df = raw({"id_credito": ""}, {"id_credito": "(fila_2)"}, {"id_credito": "(fila_99)"})
    assert [r.id_credito for r in quality.clean_rows(df).collect()] == ["(fila_99)"]
    assert log_of(df) == [("(fila_2)", "nulo_id_credito")]
    stats = quality.statistics(df).first()
    assert (stats.registros_limpios, stats.total_fallos) == (1, 1)


def test_a_duplicate_condemns_its_valid_copy(raw):
    df = raw({"id_credito": "A"}, {"id_credito": "A", "monto": "-1"}, {"id_credito": "B"})
    assert [r.id_credito for r in quality.clean_rows(df).collect()] == ["B"]
    assert quality.statistics(df).first().registros_limpios == 1


def test_an_id_with_a_third_of_all_rows(spark, raw):
    one = raw({"id_credito": "HOT"})
    hot = spark.range(20_000).crossJoin(one).drop("id")
    rest = spark.range(40_000).selectExpr("concat('R', id) AS id_credito").crossJoin(one.drop("id_credito"))
    df = hot.unionByName(rest)
    log = quality.failure_log(df)
    assert log.count() == 20_000
    assert [r.asDict() for r in log.distinct().collect()] == [
        {"id_credito": "HOT", "regla": "duplicado_id", "motivo": "id_credito=HOT aparece 20000 veces (duplicado)"}]
    assert quality.clean_rows(df).count() == 40_000
    assert quality.statistics(df).first().registros_limpios == 40_000


def test_counts_agree_with_the_log(raw):
    df = raw({"id_credito": ""}, {"id_credito": "A"}, {"id_credito": "A", "monto": "x"}, {"id_credito": "B", "monto": ""},
             {"id_credito": "C", "fecha_originacion": "ayer"})
    by_rule = {r.regla: r.fallos for r in quality.counts_by_rule(df).collect()}
    assert by_rule == {"nulo_id_credito": 1, "duplicado_id": 2, "monto_no_numerico": 1, "nulo_monto": 1,
                       "formato_fecha_invalido": 1}
    families = {r.familia: r.fallos for r in quality.counts_by_family(quality.counts_by_rule(df)).collect()}
    assert families == {"nulos": 2, "duplicados": 2, "monto": 1, "formato_fecha": 1}
    clean, failed = quality.clean_rows(df).count(), quality.failure_log(df).select("id_credito").distinct()
    assert clean + df.withColumn("id_credito", quality.row_identifier(df)).join(failed, "id_credito", "left_semi").count() == 5


def test_empty_input(raw):
    df = raw({}).limit(0)
    log = quality.failure_log(df)
    assert log.dtypes == [("id_credito", "string"), ("regla", "string"), ("motivo", "string")] and log.isEmpty()
    assert quality.clean_rows(df).isEmpty()
    assert quality.statistics(df).first().asDict() == {
        "total_registros": 0, "total_fallos": 0, "total_validos": 0, "porcentaje_fallos": 0.0,
        "registros_fallidos": 0, "registros_limpios": 0}


def test_tags_carry_the_file_when_several_are_checked(raw):
    df = raw({"id_credito": ""}).selectExpr("*", "'marzo.csv' AS archivo")
    assert quality.failure_log(df).first().id_credito == "(marzo.csv:fila_2)"
