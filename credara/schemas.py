"""Table schemas and fixed values of the credit-origination model."""

from pyspark.sql import types as T

# --- Fixed values: they must equal the published model for results to match. ---

MIN_AMOUNT = 1_000
MAX_AMOUNT = 5_000_000

ON_TIME = "A Tiempo"
LATE = "Tardío"

LATE_LIMIT_PCT = 20.0

MONTHS = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio", "Agosto",
          "Septiembre", "Octubre", "Noviembre", "Diciembre"]

WEEKDAYS = ["Domingo", "Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado"]

# (label, inclusive lower bound, exclusive upper bound or None)
SEGMENTS = [("Micro", None, 50_000), ("Pequeno", 50_000, 250_000),
            ("Mediano", 250_000, 1_000_000), ("Grande", 1_000_000, None)]

PANEL_SEGMENT_LABELS = {"Micro": "Micro (<50K)", "Pequeno": "Pequeño (50K-250K)",
                        "Mediano": "Mediano (250K-1M)", "Grande": "Grande (>1M)"}

# Text that a CSV reader with NA detection turns into NULL.
NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
             "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

INDUSTRIES = ["Comercio", "Manufactura", "Servicios", "Construcción", "Agricultura", "Tecnología",
              "Alimentos y Bebidas", "Salud", "Transporte", "Educación"]

CHANNELS = ["Sucursal", "Web", "App Móvil", "Call Center", "Promotor"]

TERMS = [3, 6, 9, 12, 18, 24, 36, 48, 60]

# --- Schemas: column names, order and types are fixed values as well. ---

RAW_COLUMNS = ["id_credito", "fecha_originacion", "id_cliente", "nombre_cliente", "industria",
               "monto", "plazo_meses", "canal", "estatus_primer_pago"]

RAW = T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS])

STAGING = T.StructType([
    T.StructField("id_credito", T.StringType()),
    T.StructField("fecha_originacion", T.DateType()),
    T.StructField("id_cliente", T.StringType()),
    T.StructField("nombre_cliente", T.StringType()),
    T.StructField("industria", T.StringType()),
    T.StructField("monto", T.DoubleType()),
    T.StructField("plazo_meses", T.IntegerType()),
    T.StructField("canal", T.StringType()),
    T.StructField("estatus_primer_pago", T.StringType()),
])

DIM_CLIENTE = T.StructType([
    T.StructField("cliente_id", T.LongType()),
    T.StructField("id_cliente", T.StringType()),
    T.StructField("nombre_cliente", T.StringType()),
])

DIM_TIEMPO = T.StructType([
    T.StructField("tiempo_id", T.IntegerType()),
    T.StructField("fecha_originacion", T.DateType()),
    T.StructField("anio", T.IntegerType()),
    T.StructField("mes", T.IntegerType()),
    T.StructField("nombre_mes", T.StringType()),
    T.StructField("dia", T.IntegerType()),
    T.StructField("dia_semana", T.IntegerType()),
    T.StructField("nombre_dia_semana", T.StringType()),
    T.StructField("trimestre", T.IntegerType()),
    T.StructField("es_fin_de_semana", T.BooleanType()),
])

DIM_INDUSTRIA = T.StructType([
    T.StructField("industria_id", T.LongType()),
    T.StructField("nombre_industria", T.StringType()),
])

FACT_ORIGINACIONES = T.StructType([
    T.StructField("originacion_id", T.LongType()),
    T.StructField("id_credito", T.StringType()),
    T.StructField("cliente_id", T.LongType()),
    T.StructField("tiempo_id", T.IntegerType()),
    T.StructField("industria_id", T.LongType()),
    T.StructField("monto", T.DoubleType()),
    T.StructField("plazo_meses", T.IntegerType()),
    T.StructField("canal", T.StringType()),
    T.StructField("estatus_primer_pago", T.StringType()),
])

FAILURE_LOG = T.StructType([
    T.StructField("id_credito", T.StringType()),
    T.StructField("regla", T.StringType()),
    T.StructField("motivo", T.StringType()),
])

TABLES = {
    "raw.raw_creditos": RAW,
    "staging.stg_creditos": STAGING,
    "marts.dim_cliente": DIM_CLIENTE,
    "marts.dim_tiempo": DIM_TIEMPO,
    "marts.dim_industria": DIM_INDUSTRIA,
    "marts.fact_originaciones": FACT_ORIGINACIONES,
}

PRIMARY_KEYS = {
    "staging.stg_creditos": "id_credito",
    "marts.dim_cliente": "cliente_id",
    "marts.dim_tiempo": "tiempo_id",
    "marts.dim_industria": "industria_id",
    "marts.fact_originaciones": "originacion_id",
}

BUSINESS_KEYS = {"marts.dim_cliente": "id_cliente", "marts.dim_industria": "nombre_industria"}

# foreign key column of the fact -> dimension that holds it as primary key
FOREIGN_KEYS = {"cliente_id": "marts.dim_cliente", "tiempo_id": "marts.dim_tiempo",
                "industria_id": "marts.dim_industria"}

NOT_NULL = {
    "marts.dim_cliente": ["id_cliente"],
    "marts.dim_tiempo": ["fecha_originacion"],
    "marts.dim_industria": ["nombre_industria"],
    "marts.fact_originaciones": ["id_credito"],
}
