"""DuckDB SQL that computes the same results as the registered queries, straight from the given tables."""

from credara.sources.orders_fixture import SQL as RAW_SQL

_NULLABLE = {c: f"El campo {c} esta vacio o es nulo" for c in ("id_credito", "monto", "fecha_originacion")}
_NUMBER = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|inf|infinity)$"

_RAW_COLUMNS = ("id_credito, fecha_originacion, id_cliente, nombre_cliente, industria, monto, plazo_meses, canal, "
                "estatus_primer_pago")

_CHECKED = {
    "raw": RAW_SQL,
    "ids": rf"""
      SELECT *, trim(coalesce(id_credito, '')) AS tid, trim(coalesce(monto, '')) AS tm,
        trim(coalesce(fecha_originacion, '')) AS tf,
        CASE WHEN trim(coalesce(id_credito, '')) = '' THEN concat('(fila_', fila, ')') ELSE trim(id_credito) END AS rid,
        CASE WHEN regexp_matches(trim(monto), '{_NUMBER}') THEN try_cast(trim(monto) AS DOUBLE) END AS v,
        CASE WHEN regexp_matches(trim(fecha_originacion), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')
             THEN try_cast(trim(fecha_originacion) AS DATE) END AS d
      FROM raw""",
    "copies": "SELECT tid, count(*) AS n FROM ids WHERE tid <> '' GROUP BY tid HAVING count(*) > 1",
    "log": f"""
      SELECT rid AS id_credito, 'nulo_id_credito' AS regla, '{_NULLABLE["id_credito"]}' AS motivo FROM ids WHERE tid = ''
      UNION ALL SELECT rid, 'nulo_monto', '{_NULLABLE["monto"]}' FROM ids WHERE tm = ''
      UNION ALL SELECT rid, 'nulo_fecha_originacion', '{_NULLABLE["fecha_originacion"]}' FROM ids WHERE tf = ''
      UNION ALL SELECT rid, 'monto_no_numerico', concat('El valor ''', monto, ''' no se puede interpretar como numero')
        FROM ids WHERE tm <> '' AND v IS NULL
      UNION ALL SELECT rid, 'monto_fuera_rango', concat('Monto $', format('{{:,.2f}}', v), ' por debajo del minimo ($1,000)')
        FROM ids WHERE v < 1000
      UNION ALL SELECT rid, 'monto_fuera_rango', concat('Monto $', format('{{:,.2f}}', v), ' excede el maximo ($5,000,000)')
        FROM ids WHERE v > 5000000
      UNION ALL SELECT rid, 'duplicado_id', concat('id_credito=', tid, ' aparece ', n, ' veces (duplicado)')
        FROM ids JOIN copies USING (tid)
      UNION ALL SELECT rid, 'formato_fecha_invalido',
          concat('fecha_originacion=''', tf, ''' no cumple con el formato YYYY-MM-DD o no es una fecha valida')
        FROM ids WHERE tf <> '' AND d IS NULL""",
    "clean": "SELECT * FROM ids WHERE NOT EXISTS (SELECT 1 FROM log WHERE log.id_credito = ids.rid)",
}


_ROUNDED = "try_cast(round(try_cast(plazo_meses AS DOUBLE)) AS INTEGER)"
_WHOLE = "CASE WHEN regexp_matches(trim(plazo_meses), '^[0-9]+$') THEN cast(trim(plazo_meses) AS INTEGER) END"


def _staging(source: str, date: str, term: str = _ROUNDED) -> dict[str, str]:
    return {
        "typed": rf"""
          SELECT id_credito, {date} AS fecha_originacion, id_cliente, nombre_cliente, industria,
            CASE WHEN regexp_matches(trim(monto), '{_NUMBER}') THEN try_cast(trim(monto) AS DOUBLE) END AS monto,
            {term} AS plazo_meses, canal, estatus_primer_pago, fila
          FROM {source} WHERE id_credito <> '' AND fecha_originacion <> '' AND monto <> '' """,
        "numbered": """
          SELECT *, row_number() OVER (PARTITION BY id_credito ORDER BY fecha_originacion, fila) AS rn
          FROM typed WHERE fecha_originacion IS NOT NULL AND monto BETWEEN 1000 AND 5000000""",
        "stg": "SELECT * EXCLUDE (fila, rn) FROM numbered WHERE rn = 1",
    }


_ISO = r"""CASE WHEN regexp_matches(trim(fecha_originacion), '^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$')
    THEN try_cast(trim(fecha_originacion) AS DATE) END"""
_MONTH_FIRST = rf"""CASE WHEN regexp_matches(fecha_originacion, '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}$')
    THEN cast(try_strptime(fecha_originacion, '%m/%d/%Y') AS DATE) ELSE {_ISO} END"""

_MARTS = {
    "dim_cliente": """
      SELECT row_number() OVER (ORDER BY id_cliente, nombre_cliente) AS cliente_id, id_cliente, nombre_cliente
      FROM (SELECT DISTINCT id_cliente, nombre_cliente FROM stg)""",
    "dim_tiempo": """
      SELECT cast(strftime(f, '%Y%m%d') AS INTEGER) AS tiempo_id, f AS fecha_originacion,
        cast(year(f) AS INTEGER) AS anio, cast(month(f) AS INTEGER) AS mes,
        ['Enero', 'Febrero', 'Marzo', 'Abril', 'Mayo', 'Junio', 'Julio', 'Agosto', 'Septiembre', 'Octubre',
         'Noviembre', 'Diciembre'][month(f)] AS nombre_mes,
        cast(day(f) AS INTEGER) AS dia, cast(dayofweek(f) AS INTEGER) AS dia_semana,
        ['Domingo', 'Lunes', 'Martes', 'Miercoles', 'Jueves', 'Viernes', 'Sabado'][dayofweek(f) + 1] AS nombre_dia_semana,
        cast(quarter(f) AS INTEGER) AS trimestre, dayofweek(f) IN (0, 6) AS es_fin_de_semana
      FROM (SELECT DISTINCT fecha_originacion AS f FROM stg)""",
    "dim_industria": """
      SELECT row_number() OVER (ORDER BY industria) AS industria_id, industria AS nombre_industria
      FROM (SELECT DISTINCT industria FROM stg)""",
    "fact": """
      SELECT row_number() OVER (ORDER BY stg.id_credito, c.cliente_id) AS originacion_id, stg.id_credito, c.cliente_id,
        t.tiempo_id, i.industria_id, stg.monto, stg.plazo_meses, stg.canal, stg.estatus_primer_pago,
        cast(round(stg.monto * 100) AS BIGINT) AS c
      FROM stg LEFT JOIN dim_cliente c ON stg.id_cliente = c.id_cliente
        LEFT JOIN dim_tiempo t ON stg.fecha_originacion = t.fecha_originacion
        LEFT JOIN dim_industria i ON stg.industria = i.nombre_industria""",
}

# What each group of checks builds before its own query, in order.
SCOPES = {
    "tables": {},
    "checked": _CHECKED,
    "month_first": {**_CHECKED, **_staging("raw", _MONTH_FIRST)},
    "strict": {**_CHECKED, **_staging("clean", _ISO), **_MARTS},
    "staging_only": {**_CHECKED, **_staging("raw", _MONTH_FIRST, _WHOLE), **_MARTS},
    "complete": {**_CHECKED, "raw": f"SELECT * FROM ({RAW_SQL}) WHERE industria IS NOT NULL",
                 **_staging("clean", _ISO), **_MARTS},
}

Check = tuple[str, str]    # (scope, query)


def _checked(body: str) -> Check:
    return "checked", body


def _strict(body: str) -> Check:
    return "strict", body


def _loose(body: str) -> Check:
    return "staging_only", body


_TOTAL = "cast(sum(c) AS DOUBLE) / 100"
_MEAN = "round(cast(sum(c) AS DOUBLE) / count(*)) / 100"
_WHOLE_MEAN = "round(cast(sum(c) AS DOUBLE) / (count(*) * 100))"
_LATE = "cast(sum(CASE WHEN estatus_primer_pago = 'Tardío' THEN 1 ELSE 0 END) AS BIGINT)"
_ON_TIME = "cast(sum(CASE WHEN estatus_primer_pago = 'A Tiempo' THEN 1 ELSE 0 END) AS BIGINT)"
_INDUSTRY = "fact JOIN dim_industria USING (industria_id)"
_DAY = "fact JOIN dim_tiempo USING (tiempo_id)"


def _pct(part: str, whole: str = "count(*)") -> str:
    return f"round(cast({part} AS DOUBLE) * 1000 / {whole}) / 10"


def _quantile(p: float) -> str:
    return f"percentile_cont({p}) WITHIN GROUP (ORDER BY c)"


def _roundtrip(canal: str) -> str:
    return f"""SELECT row_number() OVER (ORDER BY fila) + 1 AS fila, nullif(id_credito, '') AS id_credito,
        nullif(fecha_originacion, '') AS fecha_originacion, id_cliente, nombre_cliente, industria,
        concat(monto, '  ') AS monto, nullif(plazo_meses, '') AS plazo_meses, {canal} AS canal, estatus_primer_pago FROM raw"""


def _segments(labels: list[str]) -> str:
    names = ", ".join(f"'{x}'" for x in labels)
    reached = " + ".join(f"cast(monto >= {bound} AS INTEGER)" for bound in (50_000, 250_000, 1_000_000))
    return f"[{names}][1 + {reached}]"


_SCOPE = f"""count(*) AS num_creditos, round({_quantile(0.5)}) / 100 AS mediana_monto, {_MEAN} AS promedio_monto,
    round({_quantile(0.25)}) / 100 AS p25, round({_quantile(0.75)}) / 100 AS p75"""

_FAMILY = """CASE WHEN starts_with(regla, 'nulo_') THEN 'nulos'
    WHEN regla IN ('monto_no_numerico', 'monto_fuera_rango') THEN 'monto'
    WHEN regla = 'duplicado_id' THEN 'duplicados' ELSE 'formato_fecha' END"""

_LATE_INDEX = f"""SELECT nombre_industria, count(*) AS total_creditos, {_LATE} AS creditos_morosos,
    {_pct(_LATE)} AS indice_mora_pct
  FROM {_INDUSTRY} GROUP BY nombre_industria HAVING {_pct(_LATE)} > 20.0"""

_TOP5 = f"""SELECT nombre_industria, count(*) AS num_creditos, {_TOTAL} AS monto_total, {_MEAN} AS ticket_promedio
  FROM {_INDUSTRY} GROUP BY nombre_industria ORDER BY monto_total DESC, nombre_industria LIMIT 5"""

_TERM = f"""SELECT nombre_industria, count(*) AS num_creditos,
    round(cast(sum(plazo_meses) AS DOUBLE) * 10 / count(plazo_meses)) / 10 AS plazo_promedio_meses,
    min(plazo_meses) AS plazo_min, max(plazo_meses) AS plazo_max
  FROM {_INDUSTRY} GROUP BY nombre_industria"""

_ON_TIME_BY_DAY = f"""SELECT fecha_originacion AS time, {_pct(_ON_TIME)} AS "% Pago a Tiempo"
  FROM {_DAY} GROUP BY fecha_originacion"""

_AMOUNT_BY_DAY = f"""SELECT fecha_originacion AS time, {_TOTAL} AS "Monto Total" FROM {_DAY} GROUP BY fecha_originacion"""

_TABLES = {"raw.raw_creditos": "raw", "staging.stg_creditos": "stg", "marts.dim_cliente": "dim_cliente",
           "marts.dim_tiempo": "dim_tiempo", "marts.dim_industria": "dim_industria",
           "marts.fact_originaciones": "fact"}


def _keys(pairs: list[tuple[str, str, str]]) -> str:
    return "\nUNION ALL ".join(f"""SELECT '{label}' AS tabla, '{key}' AS clave,
      (SELECT count(*) FROM (SELECT {key} FROM {t} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1))
        AS claves_repetidas,
      (SELECT count(*) FROM {t} WHERE {key} IS NULL) AS filas_nulas""" for label, t, key in pairs)


def _nulls(label: str, table: str, column: str) -> str:
    return f"SELECT '{label}' AS tabla, '{column}' AS columna, count(*) AS nulas FROM {table} WHERE {column} IS NULL"


def _fk(fk: str, dim: str) -> str:
    return f"""SELECT '{fk}' AS columna, 'marts.{dim}' AS dimension,
      (SELECT count(*) FROM fact WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {fk} FROM {dim})) AS huerfanas,
      (SELECT count(*) FROM fact WHERE {fk} IS NULL) AS nulas"""


_ROW_COUNTS = "\nUNION ALL ".join(f"SELECT '{label}' AS tabla, count(*) AS filas FROM {t}" for label, t in _TABLES.items())

_LINEITEM = ("l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
             "l_returnflag, l_linestatus, l_shipdate")


def _stable(columns: str, name: str) -> str:
    first = f"SELECT DISTINCT {columns} FROM stg WHERE fecha_originacion < DATE '1995-01-01'"
    return f"""SELECT row_number() OVER (ORDER BY {columns}) AS {name}, {columns} FROM ({first})
      UNION ALL SELECT (SELECT count(*) FROM ({first})) + row_number() OVER (ORDER BY {columns}), {columns}
      FROM (SELECT DISTINCT {columns} FROM stg EXCEPT {first})"""


def checks() -> dict[str, Check]:
    return {
        # quality
        "dq_failure_log": _checked("SELECT * FROM log"),
        "dq_counts_by_rule": _checked("SELECT regla, count(*) AS fallos FROM log GROUP BY regla"),
        "dq_counts_by_family": _checked(f"SELECT {_FAMILY} AS familia, count(*) AS fallos FROM log GROUP BY 1"),
        "dq_stats": _checked("""SELECT r AS total_registros, f AS total_fallos, r - f AS total_validos,
            cast(f AS DOUBLE) / r * 100 AS porcentaje_fallos, r - k AS registros_fallidos, k AS registros_limpios
          FROM (SELECT (SELECT count(*) FROM raw) AS r, (SELECT count(*) FROM log) AS f, (SELECT count(*) FROM clean) AS k)"""),
        "dq_clean_split": _checked(f"SELECT fila, {_RAW_COLUMNS} FROM clean"),
        "dq_dedup_first": _checked(f"""SELECT fila, {_RAW_COLUMNS} FROM
          (SELECT *, row_number() OVER (PARTITION BY id_credito ORDER BY fila) AS rn FROM raw) WHERE rn = 1"""),
        "dq_duplicate_ids": _checked("SELECT tid AS clave, n AS filas FROM copies"),
        # staging and star schema
        "stg_strict": _strict("SELECT * FROM stg"),
        "stg_staging_only": _loose("SELECT * FROM stg"),
        "stg_month_first": ("month_first", "SELECT * FROM stg"),
        "dim_cliente": _strict("SELECT * FROM dim_cliente"),
        "dim_tiempo": _strict("SELECT * FROM dim_tiempo"),
        "dim_industria": _strict("SELECT * FROM dim_industria"),
        "fact_originaciones": _strict("SELECT * EXCLUDE (c) FROM fact"),
        "fact_staging_only": _loose("SELECT * EXCLUDE (c) FROM fact"),
        # KPIs
        "kpi_total": _strict(f"""SELECT count(*) AS total_creditos, {_TOTAL} AS monto_total_originado,
          {_MEAN} AS ticket_promedio FROM fact"""),
        "kpi_total_in_period": _strict(f"""SELECT count(*) AS total_creditos, {_TOTAL} AS monto_total_originado,
          {_MEAN} AS ticket_promedio FROM fact WHERE tiempo_id BETWEEN 19950301 AND 19950331"""),
        "clustered_fact": _strict("SELECT * EXCLUDE (c) FROM fact"),
        "changed_models": _strict("SELECT * EXCLUDE (c) FROM fact"),
        "kpi_total_industry": _strict(f"""SELECT count(*) AS total_creditos, {_TOTAL} AS monto_total_originado,
          {_MEAN} AS ticket_promedio FROM fact WHERE industria_id = 2"""),
        "kpi_total_industry_in_period": _strict(f"""SELECT count(*) AS total_creditos, {_TOTAL} AS monto_total_originado,
          {_MEAN} AS ticket_promedio FROM fact WHERE industria_id = 2 AND tiempo_id BETWEEN 19950101 AND 19950331"""),
        "kpi_top5_industries": _strict(_TOP5),
        "kpi_segment_ticket": _strict(f"""SELECT {_segments(["Micro", "Pequeno", "Mediano", "Grande"])} AS segmento,
            count(*) AS num_creditos, {_TOTAL} AS monto_total, {_MEAN} AS ticket_promedio,
            round(min(monto), 2) AS ticket_minimo, round(max(monto), 2) AS ticket_maximo
          FROM fact GROUP BY 1"""),
        "kpi_first_payment": _strict(f"""SELECT count(*) AS total_creditos, {_ON_TIME} AS pagos_a_tiempo,
          {_LATE} AS pagos_tardios, {_pct(_ON_TIME)} AS pct_a_tiempo, {_pct(_LATE)} AS pct_tardio FROM fact"""),
        "kpi_late_index": _strict(_LATE_INDEX),
        "kpi_channel_mix": _strict(f"""SELECT canal, count(*) AS num_creditos, {_TOTAL} AS monto_total,
            {_MEAN} AS ticket_promedio, {_pct("count(*)", "(SELECT count(*) FROM fact)")} AS pct_del_total
          FROM fact GROUP BY canal"""),
        "kpi_term_by_industry": _strict(_TERM),
        "kpi_channel_minmax": _strict(f"""SELECT canal, count(*) AS num_creditos, round(min(monto), 2) AS ticket_minimo,
            round(max(monto), 2) AS ticket_maximo, {_MEAN} AS ticket_promedio FROM fact GROUP BY canal"""),
        "kpi_percentiles": _strict(f"""SELECT 'Global' AS ambito, {_SCOPE} FROM fact
          UNION ALL SELECT nombre_industria, {_SCOPE} FROM {_INDUSTRY} GROUP BY nombre_industria"""),
        "kpi_monthly": _strict(f"""SELECT anio, mes, nombre_mes, count(*) AS num_creditos, {_TOTAL} AS monto_total,
            {_MEAN} AS ticket_promedio, {_pct(_ON_TIME)} AS pct_pago_a_tiempo
          FROM {_DAY} GROUP BY anio, mes, nombre_mes"""),
        # dashboard panels
        "panel_total": _loose(f"SELECT 'Monto Total' AS metric, round({_TOTAL}) AS value FROM fact"),
        "panel_count": _loose("SELECT 'Total Creditos' AS metric, count(*) AS value FROM fact"),
        "panel_ticket": _loose(f"SELECT 'Ticket Promedio' AS metric, {_WHOLE_MEAN} AS value FROM fact"),
        "panel_payment_split": _loose("SELECT estatus_primer_pago AS metric, count(*) AS value FROM fact GROUP BY 1"),
        "panel_top5": _loose(f"""SELECT nombre_industria, monto_total AS "Monto Total" FROM ({_TOP5})"""),
        "panel_late_index": _loose(f"""SELECT nombre_industria, indice_mora_pct AS "Indice de Mora %" FROM ({_LATE_INDEX})"""),
        "panel_segment": _loose(f"""SELECT
            {_segments(["Micro (<50K)", "Pequeño (50K-250K)", "Mediano (250K-1M)", "Grande (>1M)"])} AS segmento,
            {_WHOLE_MEAN} AS "Ticket Promedio", count(*) AS "N° Creditos" FROM fact GROUP BY 1"""),
        "panel_channel": _loose("SELECT canal, count(*) AS value FROM fact GROUP BY canal"),
        "panel_channel_table": _loose(f"""SELECT canal AS "Canal", count(*) AS "Creditos",
            round(min(monto)) AS "Ticket Minimo", round(max(monto)) AS "Ticket Maximo", {_WHOLE_MEAN} AS "Ticket Promedio"
          FROM fact GROUP BY canal"""),
        "panel_median": _loose(f"SELECT 'Mediana' AS metric, round({_quantile(0.5)} / 100) AS value FROM fact"),
        "panel_p25": _loose(f"SELECT 'Percentil 25' AS metric, round({_quantile(0.25)} / 100) AS value FROM fact"),
        "panel_p75": _loose(f"SELECT 'Percentil 75' AS metric, round({_quantile(0.75)} / 100) AS value FROM fact"),
        "panel_term": _loose(f"""SELECT nombre_industria AS "Industria", num_creditos AS "Creditos",
            plazo_promedio_meses AS "Plazo Promedio (meses)", plazo_min AS "Plazo Min", plazo_max AS "Plazo Max"
          FROM ({_TERM})"""),
        "panel_amount_by_day": _loose(_AMOUNT_BY_DAY),
        "panel_ontime_by_day": _loose(_ON_TIME_BY_DAY),
        # panel reductions
        "share_of_total": _loose(f"""SELECT canal, value, {_pct("value", "(SELECT count(*) FROM fact)")} AS share_pct
          FROM (SELECT canal, count(*) AS value FROM fact GROUP BY canal)"""),
        "late_band": _loose(f"""SELECT nombre_industria, indice_mora_pct AS "Indice de Mora %",
            CASE WHEN indice_mora_pct >= 30 THEN 'red' WHEN indice_mora_pct >= 20 THEN 'yellow' ELSE 'green' END AS banda
          FROM ({_LATE_INDEX})"""),
        "series_mean": _loose(f"""SELECT round(avg("% Pago a Tiempo"), 6) AS value FROM ({_ON_TIME_BY_DAY})"""),
        "series_last": _loose(f"""SELECT arg_max("Monto Total", time) AS value FROM ({_AMOUNT_BY_DAY})"""),
        # integrity
        "check_pk": _strict(_keys([("staging.stg_creditos", "stg", "id_credito"), ("marts.dim_cliente", "dim_cliente", "cliente_id"),
                                   ("marts.dim_tiempo", "dim_tiempo", "tiempo_id"),
                                   ("marts.dim_industria", "dim_industria", "industria_id"),
                                   ("marts.fact_originaciones", "fact", "originacion_id")])),
        "check_business_key": _strict(_keys([("marts.dim_cliente", "dim_cliente", "id_cliente"),
                                             ("marts.dim_industria", "dim_industria", "nombre_industria")])),
        "check_fk": _strict("\nUNION ALL ".join([_fk("cliente_id", "dim_cliente"), _fk("tiempo_id", "dim_tiempo"),
                                                 _fk("industria_id", "dim_industria")])),
        "check_not_null": _strict("\nUNION ALL ".join([
            _nulls("marts.dim_cliente", "dim_cliente", "id_cliente"),
            _nulls("marts.dim_tiempo", "dim_tiempo", "fecha_originacion"),
            _nulls("marts.dim_industria", "dim_industria", "nombre_industria"),
            _nulls("marts.fact_originaciones", "fact", "id_credito")])),
        "row_counts": _strict(_ROW_COUNTS),
        "table_refresh": _strict(_ROW_COUNTS),
        "table_reload": _checked(f"SELECT {_RAW_COLUMNS} FROM raw"),
        "enforced_load": ("complete", f"""SELECT tabla, filas, (SELECT round({_TOTAL}, 2) FROM fact) AS monto,
          cast(1 AS BIGINT) AS version FROM ({_ROW_COUNTS})"""),
        # keys, files
        "stable_keys_clients": _strict(_stable("id_cliente, nombre_cliente", "cliente_id")),
        "stable_keys_industries": _strict(_stable("industria", "industria_id")),
        "stable_keys_credits": _strict(_stable("id_credito", "originacion_id")),
        "dense_key_orders": ("tables", "SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS clave, o_orderkey FROM orders"),
        "dense_key_lineitem": ("tables", f"""SELECT row_number() OVER (ORDER BY {_LINEITEM}) AS clave, l_orderkey, l_linenumber,
          l_extendedprice FROM lineitem"""),
        "csv_roundtrip_rownum": _checked(_roundtrip("CASE WHEN fila % 5 <> 0 THEN canal END")),
        "csv_roundtrip_text": _checked(_roundtrip("CASE WHEN fila % 5 <> 0 THEN canal ELSE 'NULL' END")),
        "csv_line_breaks": _checked("""SELECT row_number() OVER (ORDER BY fila) + 1 AS fila, nullif(id_credito, '') AS id_credito,
            nullif(fecha_originacion, '') AS fecha_originacion, id_cliente,
            CASE WHEN fila % 6 = 0 THEN concat(nombre_cliente, chr(10), '"S.A.",', chr(10), chr(10), 'b,')
                 WHEN fila % 10 = 1 THEN concat(nombre_cliente, ' "C", s') ELSE nombre_cliente END AS nombre_cliente,
            industria, nullif(monto, '') AS monto, nullif(plazo_meses, '') AS plazo_meses, canal, estatus_primer_pago FROM raw"""),
        "distinct_clients_by_month": _strict("""SELECT tiempo_id // 100 AS mes, count(DISTINCT cliente_id) AS clientes
          FROM fact GROUP BY 1"""),
        "distinct_clients_in_period": _strict("""SELECT count(DISTINCT cliente_id) AS clientes FROM fact
          WHERE tiempo_id BETWEEN 19950211 AND 19960620"""),
        "fault_profile": _checked(f"""SELECT *, {_pct("nulos_id_credito", "total")} AS pct_nulos_id_credito,
            {_pct("nulos_monto", "total")} AS pct_nulos_monto,
            {_pct("nulos_fecha_originacion", "total")} AS pct_nulos_fecha_originacion,
            {_pct("montos_negativos", "total")} AS pct_montos_negativos,
            {_pct("fechas_invalidas", "total")} AS pct_fechas_invalidas
          FROM (SELECT count(*) AS total, count(*) FILTER (tid = '') AS nulos_id_credito,
            count(*) FILTER (tm = '') AS nulos_monto, count(*) FILTER (tf = '') AS nulos_fecha_originacion,
            count(*) FILTER (v < 0) AS montos_negativos, count(*) FILTER (tf <> '' AND d IS NULL) AS fechas_invalidas,
            count(*) FILTER (tid <> '') - count(DISTINCT nullif(id_credito, '')) AS ids_duplicados FROM ids)"""),
        "incremental_files": _checked(f"""
          WITH own AS (SELECT *, fila % 3 AS lote FROM ids WHERE tid <> '' AND v BETWEEN 1000 AND 5000000 AND d IS NOT NULL),
          times AS (SELECT fila % 3 AS lote, tid, sum(CASE WHEN fila % 60 = 0 THEN 2 ELSE 1 END) AS n
            FROM ids WHERE tid <> '' GROUP BY 1, 2),
          ok AS (SELECT own.* FROM own JOIN times USING (lote, tid) WHERE n = 1),
          c0 AS (SELECT * FROM ok WHERE lote = 0),
          h0 AS (SELECT tid FROM c0 UNION SELECT tid FROM times WHERE lote = 0 AND n > 1),
          c1 AS (SELECT * FROM ok WHERE lote = 1 AND tid NOT IN (SELECT tid FROM h0)),
          h1 AS (SELECT tid FROM h0 UNION SELECT tid FROM c1 UNION SELECT tid FROM times WHERE lote = 1 AND n > 1),
          c2 AS (SELECT * FROM ok WHERE lote = 2 AND tid NOT IN (SELECT tid FROM h1))
          SELECT {_RAW_COLUMNS.replace("plazo_meses", "nullif(plazo_meses, '') AS plazo_meses")}, lote FROM (SELECT * FROM c0 UNION ALL SELECT * FROM c1 UNION ALL SELECT * FROM c2)"""),
    }


# Registered over the roll-up of the fact, too, with the same result.
ADDITIVE = ["kpi_total", "kpi_total_in_period", "kpi_top5_industries", "kpi_segment_ticket", "kpi_first_payment",
            "kpi_late_index", "kpi_channel_mix", "kpi_term_by_industry", "kpi_channel_minmax", "kpi_monthly",
            "panel_total", "panel_count", "panel_ticket", "panel_payment_split", "panel_top5", "panel_late_index",
            "panel_segment", "panel_channel", "panel_channel_table", "panel_term", "panel_amount_by_day",
            "panel_ontime_by_day", "share_of_total", "late_band", "series_mean", "series_last"]


def oracle_sql() -> dict[str, str]:
    """Each check as one statement over the given tables."""
    def statement(scope: str, body: str) -> str:
        steps = ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in SCOPES[scope].items())
        body = body.strip()
        if not steps:
            return body
        return f"WITH {steps},\n{body[5:]}" if body.startswith("WITH ") else f"WITH {steps}\n{body}"
    found = {name: statement(*check) for name, check in checks().items()}
    return found | {f"rollup_{name}": found[name] for name in ADDITIVE}
