import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from credara.schemas import RAW_COLUMNS
from credara.session import local_session
from credara.sources.workspace import Workspace

DEFAULTS = {"id_credito": "A", "fecha_originacion": "2024-03-05", "id_cliente": "C1", "nombre_cliente": "Ana",
            "industria": "Salud", "monto": "5000", "plazo_meses": "12", "canal": "Web", "estatus_primer_pago": "A Tiempo"}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", 4, "8g", **{"spark.ui.showConsoleProgress": "false",
                                               "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield session
    session.stop()


@pytest.fixture
def ws(spark):
    return Workspace(spark)


@pytest.fixture
def raw(spark):
    """Raw credits from dicts; missing columns take defaults, ``fila`` counts from 2."""
    def make(*rows, **every):
        schema = ", ".join(f"{c} string" for c in RAW_COLUMNS) + ", fila bigint"
        full = [{**DEFAULTS, **every, **r} for r in rows]
        data = [tuple(r[c] for c in RAW_COLUMNS) + (i + 2,) for i, r in enumerate(full)]
        return spark.createDataFrame(data, schema)
    return make
