"""Raw credits projected from the order tables, with deterministic faults (one per quality rule).

The expressions run unchanged in Spark SQL and in other SQL engines, so a check can start from the same rows.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F


def _padded(prefix: str, number: str) -> str:
    text = f"cast({number} AS string)"
    return f"concat('{prefix}', lpad({text}, cast(greatest(8, length({text})) AS int), '0'))"


EXPRESSIONS = [
    "o_orderkey + 2 AS fila",
    f"""CASE WHEN o_orderkey % 50 = 7 THEN ''
         WHEN o_orderkey % 101 = 5 THEN {_padded('CRED-', 'o_orderkey - 1')}
         WHEN o_orderkey % 131 = 9 THEN concat('  ', {_padded('CRED-', 'o_orderkey')}, ' ')
         ELSE {_padded('CRED-', 'o_orderkey')} END AS id_credito""",
    """CASE WHEN o_orderkey % 53 = 11 THEN ''
         WHEN o_orderkey % 97 = 13 THEN '2024-02-30'
         WHEN o_orderkey % 89 = 17 THEN '2024-13-05'
         WHEN o_orderkey % 83 = 19 THEN '05/03/2024'
         ELSE cast(cast(o_orderdate AS date) AS string) END AS fecha_originacion""",
    f"{_padded('CLI-', 'c_custkey')} AS id_cliente",
    "CASE WHEN o_orderkey % 401 = 8 THEN concat(c_name, ' S.A.') ELSE c_name END AS nombre_cliente",
    "CASE WHEN o_orderkey % 127 <> 4 THEN n_name END AS industria",
    """CASE WHEN o_orderkey % 47 = 3 THEN ''
         WHEN o_orderkey % 71 = 29 THEN concat('-', cast(cast(o_totalprice * 10 AS decimal(12,2)) AS string))
         WHEN o_orderkey % 211 = 31 THEN '9.50'
         WHEN o_orderkey % 223 = 37 THEN '7500000.00'
         WHEN o_orderkey % 307 = 41 THEN 'abc'
         WHEN o_orderkey % 139 = 10 THEN concat(' ', cast(cast(o_totalprice * 10 AS decimal(12,2)) AS string), ' ')
         ELSE cast(cast(o_totalprice * 10 AS decimal(12,2)) AS string) END AS monto""",
    """CASE WHEN o_orderkey % 113 = 6 THEN '12.5' WHEN o_orderkey % 109 = 7 THEN '' ELSE
         CASE o_orderkey % 9 WHEN 0 THEN '3' WHEN 1 THEN '6' WHEN 2 THEN '9' WHEN 3 THEN '12' WHEN 4 THEN '18'
         WHEN 5 THEN '24' WHEN 6 THEN '36' WHEN 7 THEN '48' ELSE '60' END END AS plazo_meses""",
    "o_orderpriority AS canal",
    "CASE WHEN (o_orderkey * 37) % 100 < n_nationkey + 8 THEN 'Tardío' ELSE 'A Tiempo' END AS estatus_primer_pago",
]

SQL = ("SELECT " + ",\n  ".join(EXPRESSIONS) +
       "\nFROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey")


def creditos_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "customer", "nation"))
    return (orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr(*EXPRESSIONS))
