"""Random dirty credits against a plain restatement of the rules, row by row."""

import datetime as dt
import random
import re
from collections import Counter

import pytest

from credara.operators import quality
from credara.plans import pipeline

IDS = ["", None, " ", "A", " A", "A\t", "B", "C", "C ", "D", "E", "(fila_2)", "(fila_5)", "ñ", "ñ\u00a0"]
DATES = ["", None, "2024-03-05", "2024-02-30", " 2024-01-01", "05/03/2024", "2024-2-3", "2023-12-31", "9999-12-31", "x"]
AMOUNTS = ["", None, "1000", "999.99", "5000000", "5000000.01", "-5", "abc", " 2000 ", "3e3", "12d", "inf", "nan", "+4000."]


def number(text):
    if not re.fullmatch(r"\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf|infinity)\s*", text, re.I | re.A):
        return None
    return float(text)


def real_date(text):
    try:
        return bool(re.fullmatch(r"\d{4}-\d{2}-\d{2}", text)) and bool(dt.date.fromisoformat(text))
    except ValueError:
        return False


def expected(rows):
    text = [{k: (v or "").strip() for k, v in r.items()} for r in rows]
    rid = [t["id_credito"] or f"(fila_{i + 2})" for i, t in enumerate(text)]
    copies = Counter(t["id_credito"] for t in text if t["id_credito"])
    log = []
    for i, t in enumerate(text):
        log += [(rid[i], f"nulo_{c}") for c in ("id_credito", "monto", "fecha_originacion") if not t[c]]
        value = number(rows[i]["monto"] or "")
        if t["monto"] and value is None:
            log.append((rid[i], "monto_no_numerico"))
        if value is not None and not 1000 <= value <= 5_000_000:
            log.append((rid[i], "monto_fuera_rango"))
        if copies[t["id_credito"]] > 1:
            log.append((rid[i], "duplicado_id"))
        if t["fecha_originacion"] and not real_date(t["fecha_originacion"]):
            log.append((rid[i], "formato_fecha_invalido"))
    failed = {r for r, _ in log}
    return sorted(log), sorted(i + 2 for i, r in enumerate(rid) if r not in failed)


@pytest.mark.parametrize("seed", range(6))
def test_rules(raw, ws, seed):
    rng = random.Random(seed)
    ids = IDS + [f"U{i}" for i in range(40)]
    rows = [{"id_credito": rng.choice(ids), "fecha_originacion": rng.choice(DATES + ["2024-05-05"] * 20),
             "monto": rng.choice(AMOUNTS + ["2500.5"] * 20)} for _ in range(60)]
    df = ws.save("raw", raw(*rows))
    log, clean = expected(rows)
    assert sorted((r.id_credito, r.regla) for r in quality.failure_log(df).collect()) == log
    assert sorted(r.fila for r in quality.clean_rows(df).collect()) == clean
    stats = quality.statistics(df).first()
    assert (stats.total_fallos, stats.registros_limpios) == (len(log), len(clean))
    assert pipeline.run(ws, df, "strict")["marts.fact_originaciones"].count() == len(clean)
