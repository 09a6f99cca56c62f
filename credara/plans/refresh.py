"""Refresh that builds only what changed.

A model's signature is made of the fingerprints of its inputs and of the package's code. A model whose signature is that
of its stored table is not built; one that was built to the same rows as before leaves its descendants alone, too. What
is stored is described by plain strings, so a caller can keep it as JSON between sessions.
"""

import hashlib
from dataclasses import dataclass
from functools import cache
from graphlib import TopologicalSorter
from pathlib import Path

import pyspark
from pyspark.sql import DataFrame, types as T

from credara.operators.fingerprints import fingerprint
from credara.operators.keys import PART, POS
from credara.plans.pipeline import MODELS
from credara.sources.workspace import Workspace

# The parts of the package that models are made of; a change in any of them builds everything again.
_CODE = ("functions", "operators", "plans")


@dataclass(frozen=True)
class Built:
    """A stored model: where its rows are, what they were made from and what they are."""

    folder: str
    schema: str
    signature: str
    rows: str

    def read(self, ws: Workspace) -> DataFrame:
        schema = T._parse_datatype_json_string(self.schema)
        return ws.spark.read.schema(schema).parquet(self.folder)


@dataclass(frozen=True)
class Refreshed:
    built: dict[str, Built]
    tables: dict[str, DataFrame]
    changed: list[str]    # models that were built this time


@cache
def definition() -> str:
    """Digest of the code that models are made of."""
    home, digest = Path(__file__).parent.parent, hashlib.sha256(pyspark.__version__.encode())
    for path in sorted([home / "schemas.py", *(p for part in _CODE for p in (home / part).glob("*.py"))]):
        digest.update(str(path.relative_to(home)).encode() + path.read_bytes())
    return digest.hexdigest()


def refresh(ws: Workspace, raw: DataFrame, gate: str = "strict", before: dict[str, Built] | None = None) -> Refreshed:
    """All models from raw credits; those in ``before`` that are still right are taken from there.

    ``raw`` should be a landed table. It is read once for its fingerprint, and again only by models that are built.
    Folders of tables that were replaced stay until the caller deletes them.
    """
    models, before = MODELS[gate], before or {}
    prints = {"raw.raw_creditos": fingerprint(raw)}
    tables, built, changed = {"raw.raw_creditos": raw}, {}, []
    for name in TopologicalSorter({n: [d for d in m.deps if d in models] for n, m in models.items()}).static_order():
        model, old = models[name], before.get(name)
        made_from = "\n".join([definition(), gate, name, *[prints[d] for d in model.deps]])
        signature = hashlib.sha256(made_from.encode()).hexdigest()
        if old and old.signature == signature:
            now = old
        else:
            folder, df = ws.new_path(name), model.build(ws, *[tables[d] for d in model.deps])
            df.write.parquet(folder)
            now = Built(folder, df.schema.json(), signature, "")
            # places tell in which task a row was written; they say nothing that the rows do not
            now = Built(folder, now.schema, signature, fingerprint(now.read(ws), leave_out=(PART, POS)))
            changed.append(name)
        built[name], prints[name], tables[name] = now, now.rows, now.read(ws)
    return Refreshed(built, tables, changed)
