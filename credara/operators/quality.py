"""Data-quality rules over raw credits: failure log, counts, statistics and the clean split.

Input: the nine raw text columns plus ``fila``, the physical row number (header = 1), and optionally
``archivo`` when several files are checked together.

Row rules need no shuffle. The duplicate rule is one aggregation by row identifier, which combines on the map
side, so an id held by a third of all rows costs one partial row per task.
"""

from pyspark.sql import Column, DataFrame, functions as F

from credara.functions.text import NUMBER, is_blank, strip, stripped, to_double, to_strict_date, with_thousands
from credara.schemas import MAX_AMOUNT, MIN_AMOUNT

FAMILIES = {
    "nulo_id_credito": "nulos", "nulo_monto": "nulos", "nulo_fecha_originacion": "nulos",
    "monto_no_numerico": "monto", "monto_fuera_rango": "monto",
    "duplicado_id": "duplicados", "formato_fecha_invalido": "formato_fecha",
}

_CHUNK = 100_000


def _tag(df: DataFrame) -> Column:
    """'(fila_N)', with the file name in front of it when several files are checked together."""
    row = F.concat(F.lit("fila_"), F.col("fila").cast("string"), F.lit(")"))
    if "archivo" in df.columns:
        return F.concat(F.lit("("), F.col("archivo"), F.lit(":"), row)
    return F.concat(F.lit("("), row)


def row_identifier(df: DataFrame) -> Column:
    """The stripped id, or the row's tag where it is blank."""
    text = stripped(F.col("id_credito"))
    return F.when(text == "", _tag(df)).otherwise(text)


def _inspected(raw: DataFrame) -> DataFrame:
    """Each text is stripped and parsed once, here; the rules only compare the results."""
    return (raw.withColumns({"_id": stripped(F.col("id_credito")), "_monto": stripped(F.col("monto")),
                             "_fecha": stripped(F.col("fecha_originacion"))})
            .withColumns({"rid": F.when(F.col("_id") == "", _tag(raw)).otherwise(F.col("_id")),
                          "_valor": to_double(F.col("monto")), "_dia": to_strict_date(F.col("fecha_originacion"))}))


def _row_rules() -> list[tuple[str, Column, Column]]:
    """(rule, predicate, message) of every rule that looks at one inspected row only."""
    texts = {"id_credito": F.col("_id"), "monto": F.col("_monto"), "fecha_originacion": F.col("_fecha")}
    value = F.col("_valor")
    # rule names and messages are fixed values: they appear in the failure log as they are
    rules = [(f"nulo_{c}", text == "", F.lit(f"El campo {c} esta vacio o es nulo")) for c, text in texts.items()]
    rules += [
        ("monto_no_numerico", (F.col("_monto") != "") & value.isNull(),
         F.concat(F.lit("El valor '"), F.col("monto"), F.lit("' no se puede interpretar como numero"))),
        ("monto_fuera_rango", value < MIN_AMOUNT,
         F.concat(F.lit("Monto $"), with_thousands(value), F.lit(f" por debajo del minimo (${MIN_AMOUNT:,})"))),
        ("monto_fuera_rango", value > MAX_AMOUNT,
         F.concat(F.lit("Monto $"), with_thousands(value), F.lit(f" excede el maximo (${MAX_AMOUNT:,})"))),
        ("formato_fecha_invalido", (F.col("_fecha") != "") & F.col("_dia").isNull(),
         F.concat(F.lit("fecha_originacion='"), F.col("_fecha"),
                  F.lit("' no cumple con el formato YYYY-MM-DD o no es una fecha valida"))),
    ]
    return rules


def passes_row_rules() -> Column:
    """True where no row rule is broken: an id, a number in range and a real date."""
    monto = F.col("monto")
    in_range = F.when(monto.rlike(NUMBER), monto.try_cast("double").between(MIN_AMOUNT, MAX_AMOUNT)).otherwise(False)
    return (~is_blank(F.col("id_credito")) & in_range
            & to_strict_date(F.col("fecha_originacion")).isNotNull())


def row_failures(raw: DataFrame) -> DataFrame:
    """One row per (record, row rule broken): one scan, no shuffle. Messages are built for hits only."""
    hits = F.array(*[F.when(p, F.struct(F.lit(rule).alias("regla"), msg.alias("motivo")))
                     for rule, p, msg in _row_rules()])
    return (_inspected(raw).select(F.col("rid").alias("id_credito"), F.explode(hits).alias("f"))
            .where(F.col("f").isNotNull())
            .select("id_credito", "f.regla", "f.motivo"))


def identifier_counts(raw: DataFrame) -> DataFrame:
    """Per row identifier: rows, rows with an id, blank rows, broken row rules, rows that break none."""
    broken = sum((F.coalesce(p.cast("int"), F.lit(0)) for _, p, _ in _row_rules()), F.lit(0))
    return (_inspected(raw).select("rid", (F.col("_id") == "").cast("int").alias("blanco"), broken.alias("fallos"))
            .groupBy("rid")
            .agg(F.count(F.lit(1)).alias("filas"),
                 F.sum(1 - F.col("blanco")).alias("copias"),
                 F.sum("blanco").alias("blancos"),
                 F.sum("fallos").alias("fallos"),
                 F.sum((F.col("fallos") == 0).cast("int")).alias("sanas")))


def _condemned() -> Column:
    """A repeated id, or a literal id that reads like the tag of a row without one."""
    return (F.col("copias") > 1) | ((F.col("copias") == 1) & (F.col("blancos") > 0))


def flagged_identifiers(raw: DataFrame) -> DataFrame:
    """Identifiers that condemn rows which break no row rule themselves: (rid, copias)."""
    return (_inspected(raw).select("rid", (F.col("_id") == "").cast("int").alias("blanco"))
            .groupBy("rid")
            .agg(F.sum(1 - F.col("blanco")).alias("copias"), F.sum("blanco").alias("blancos"))
            .where(_condemned())
            .select("rid", "copias"))


def repeated_ids(flagged: DataFrame) -> DataFrame:
    """(clave, filas): stripped ids that several rows hold."""
    return flagged.where("copias > 1").select(F.col("rid").alias("clave"), F.col("copias").alias("filas"))


def _duplicates(flagged: DataFrame, shown: str = "copias") -> DataFrame:
    """One row per duplicated id, with the number of log rows it stands for."""
    return (flagged.where(F.col(shown) > 1)
            .select(F.col("rid").alias("id_credito"), F.lit("duplicado_id").alias("regla"),
                    F.concat(F.lit("id_credito="), F.col("rid"), F.lit(" aparece "),
                             F.col(shown).cast("string"), F.lit(" veces (duplicado)")).alias("motivo"),
                    F.col("copias").alias("veces")))


def expand_duplicates(flagged: DataFrame, shown: str = "copias") -> DataFrame:
    """Log rows of the duplicate rule: ``copias`` per identifier, with ``shown`` in the message."""
    return _repeat(_duplicates(flagged, shown), "veces")


def _repeat(df: DataFrame, times: str) -> DataFrame:
    """Emit each row ``times`` times. Large counts are first cut into chunks that spread over tasks."""
    columns = [c for c in df.columns if c != times]
    full = F.floor((F.col(times) - 1) / _CHUNK)
    chunks = (df.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), full)).alias("_trozo"))
              .withColumn("_n", F.least(F.lit(_CHUNK).cast("bigint"), F.col(times) - F.col("_trozo") * _CHUNK))
              .repartition(columns[0], "_trozo"))
    return (chunks.select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))).alias("_i"))
            .select(*columns))


def failure_log(raw: DataFrame, flagged: DataFrame | None = None) -> DataFrame:
    """(id_credito, regla, motivo): the bag of all rule hits; a record may appear several times.

    All copies of a duplicated id share identifier and message, so their log rows come from the counts
    alone and raw rows are never joined back.
    """
    flagged = flagged_identifiers(raw) if flagged is None else flagged
    return row_failures(raw).unionByName(expand_duplicates(flagged))


def counts_by_rule(raw: DataFrame, flagged: DataFrame | None = None) -> DataFrame:
    """(regla, fallos), without expanding the log."""
    flagged = flagged_identifiers(raw) if flagged is None else flagged
    return (row_failures(raw).select("regla", F.lit(1).cast("bigint").alias("veces"))
            .unionByName(_duplicates(flagged).select("regla", "veces"))
            .groupBy("regla").agg(F.sum("veces").alias("fallos")))


def counts_by_family(by_rule: DataFrame) -> DataFrame:
    """(familia, fallos) from the counts per rule."""
    family = F.when(F.col("regla").startswith("nulo_"), "nulos")
    for rule, name in FAMILIES.items():
        if name != "nulos":
            family = family.when(F.col("regla") == rule, name)
    return by_rule.groupBy(family.alias("familia")).agg(F.sum("fallos").alias("fallos"))


def statistics(raw: DataFrame, flagged: DataFrame | None = None, clean: DataFrame | None = None) -> DataFrame:
    """One row. ``total_fallos`` counts rule hits, so ``total_validos`` = records - hits understates; the
    distinct-record numbers follow it.

    Given the flagged identifiers and the clean rows as saved tables, nothing but single numbers is shuffled.
    """
    flagged = flagged_identifiers(raw) if flagged is None else flagged
    clean = clean_rows(raw, flagged) if clean is None else clean
    broken = sum((F.coalesce(p.cast("int"), F.lit(0)) for _, p, _ in _row_rules()), F.lit(0))
    hits = _inspected(raw).agg(F.count(F.lit(1)).alias("total_registros"), F.coalesce(F.sum(broken), F.lit(0)).alias("_filas"))
    copies = flagged.where("copias > 1").agg(F.coalesce(F.sum("copias"), F.lit(0)))
    totals = hits.select("total_registros", (F.col("_filas") + copies.scalar()).alias("total_fallos"),
                         clean.agg(F.count(F.lit(1))).scalar().alias("registros_limpios"))
    return totals.select(
        "total_registros", "total_fallos",
        (F.col("total_registros") - F.col("total_fallos")).alias("total_validos"),
        F.coalesce(F.try_divide(F.col("total_fallos").cast("double"), F.col("total_registros")) * 100.0,
                   F.lit(0.0)).alias("porcentaje_fallos"),
        (F.col("total_registros") - F.col("registros_limpios")).alias("registros_fallidos"),
        "registros_limpios")


def clean_rows(raw: DataFrame, flagged: DataFrame | None = None) -> DataFrame:
    """Rows whose identifier is not in the failure log.

    Pass ``flagged`` as a saved work table: Catalyst then sees its size, broadcasts it when small and
    otherwise plans a sort-merge anti join whose skewed left side AQE may split.
    """
    flagged = flagged_identifiers(raw) if flagged is None else flagged
    return (raw.where(passes_row_rules())
            .withColumn("rid", strip(F.col("id_credito")))
            .join(flagged.select("rid"), "rid", "left_anti")
            .select(*raw.columns))
