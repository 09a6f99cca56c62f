"""The same load steps and queries in DuckDB, for comparison with bench.py. Same environment variables.

Each scope's tables are created once, as the star is in Spark, and each query then runs on the tables.
"""

import json
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracles import SCOPES, checks

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count()))


def main():
    seconds = {}
    for scope, steps in SCOPES.items():
        con = duckdb.connect(config={"threads": CPUS})
        for file in os.listdir(SF_DIR):
            con.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF_DIR}/{file}')")
        start = time.perf_counter()
        for name, sql in steps.items():
            con.execute(f"CREATE TABLE {name} AS {sql}")
        if steps:
            seconds[f"load_{scope}"] = round(time.perf_counter() - start, 3)
        for name, (where, body) in checks().items():
            if where == scope:
                start = time.perf_counter()
                con.execute(f"CREATE TEMP TABLE result AS {body}")
                seconds[name] = round(time.perf_counter() - start, 3)
                con.execute("DROP TABLE result")
        con.close()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "cpus": CPUS}))


if __name__ == "__main__":
    main()
