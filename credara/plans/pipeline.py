"""The model registry and the two load paths.

``strict``: quality gate, then staging; every copy of a repeated id is rejected.
``staging_only``: no gate; staging keeps the earliest valid copy of a repeated id.
"""

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame

from credara.operators import integrity, quality
from credara.operators.keys import PART, POS, with_position
from credara.plans import marts, staging
from credara.schemas import RAW_COLUMNS, STAGING, TABLES
from credara.sources.csv_files import read_credits, write_csv
from credara.sources.tables import Catalog
from credara.sources.workspace import Workspace

GATES = ("strict", "staging_only")


@dataclass(frozen=True)
class Model:
    build: Callable[..., DataFrame]    # (workspace, *inputs) -> DataFrame
    deps: tuple[str, ...]


def _stg_from_clean(ws: Workspace, clean: DataFrame) -> DataFrame:
    return with_position(staging.stg_gated(clean), ["id_credito"])


def _stg_from_raw(ws: Workspace, raw: DataFrame) -> DataFrame:
    # the path without a gate reads terms as whole numbers only, and dates in month-first form, too
    return with_position(staging.stg_creditos(raw, month_first=True, fractions=False), ["id_credito"])


_MARTS = {
    "marts.dim_cliente": Model(marts.dim_cliente, ("staging.stg_creditos",)),
    "marts.dim_tiempo": Model(marts.dim_tiempo, ("staging.stg_creditos",)),
    "marts.dim_industria": Model(marts.dim_industria, ("staging.stg_creditos",)),
    "marts.fact_originaciones": Model(marts.fact_originaciones, (
        "staging.stg_creditos", "marts.dim_cliente", "marts.dim_tiempo", "marts.dim_industria")),
}

# Models over raw credits that have passed the gate already.
GATED = {"staging.stg_creditos": Model(_stg_from_clean, ("raw.raw_creditos",)), **_MARTS}

MODELS = {
    "strict": {
        "quality.flagged": Model(lambda ws, raw: quality.flagged_identifiers(raw), ("raw.raw_creditos",)),
        "staging.stg_creditos": Model(
            lambda ws, raw, flagged: _stg_from_clean(ws, quality.clean_rows(raw, flagged)),
            ("raw.raw_creditos", "quality.flagged")),
        **_MARTS},
    "staging_only": {"staging.stg_creditos": Model(_stg_from_raw, ("raw.raw_creditos",)), **_MARTS},
}


def run(ws: Workspace, raw: DataFrame, gate: str = "strict",
        save: Callable[[str, DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """Build every model from raw credits and return all tables by name.

    ``save`` writes a model and returns it read back; by default into the workspace. ``raw`` should be a
    landed table: the strict gate scans it twice.
    """
    return _build(ws, raw, MODELS[gate], save)[0]


def _build(ws: Workspace, raw: DataFrame, models: dict[str, Model],
           publish: Callable[[str, DataFrame], DataFrame] | None) -> tuple[dict[str, DataFrame], dict[str, float]]:
    """All tables, and the seconds each model took.

    Models whose inputs are ready are submitted together, so small dimensions do not wait in line. Row places are
    kept with staging in the workspace; a published staging table has its declared columns only.
    """
    tables, seconds = {"raw.raw_creditos": raw}, {}
    published = {}
    order = TopologicalSorter({name: [d for d in m.deps if d in models] for name, m in models.items()})
    order.prepare()

    def build(name: str) -> tuple[str, DataFrame]:
        model, began = models[name], time.perf_counter()
        built = model.build(ws, *[tables[d] for d in model.deps])
        if publish and {PART, POS} <= set(built.columns):
            built = ws.save(name, built)
            published[name] = publish(name, built.select(*STAGING.fieldNames()))
        else:
            built = (publish or ws.save)(name, built)
        seconds[name] = time.perf_counter() - began
        return name, built

    with ThreadPoolExecutor(max_workers=3) as pool:
        while order.is_active():
            for name, df in pool.map(build, order.get_ready()):
                tables[name] = df
                order.done(name)
    return tables | published, seconds


@dataclass(frozen=True)
class Load:
    """What one load did: the tables, the file's quality statistics, rows loaded, broken constraints, and rows and
    seconds of each model."""

    tables: dict[str, DataFrame]
    statistics: DataFrame
    loaded: int
    violations: DataFrame
    models: dict[str, tuple[int, float]] = field(default_factory=dict)


def load_month(ws: Workspace, csv_path: str, catalog: Catalog, gate: str = "strict",
               report_path: str | None = None, enforce: bool = False) -> Load:
    """Load one monthly file into the catalog.

    The failure log goes to ``report_path`` as CSV. Under the strict gate ``raw.raw_creditos`` holds the rows
    that passed it and NA spellings count as missing; otherwise it holds the file as text. All tables are written, then
    audited, then published together: with ``enforce``, a load that breaks a declared key, reference or required column
    raises ``BrokenConstraints`` and leaves every table as it was. ``violations`` also reports what is no constraint.
    """
    strict = gate == "strict"
    # rules, log, clean rows and statistics all start from the numbered file: it is numbered once
    credits = ws.save("credits", read_credits(ws, csv_path, na_tokens=strict))
    flagged = ws.save("flagged", quality.flagged_identifiers(credits))
    if report_path:
        write_csv(quality.failure_log(credits, flagged), report_path)
    clean = ws.save("clean", quality.clean_rows(credits, flagged))
    raw = clean if strict else credits
    staged = catalog.stage()
    stored = staged.save("raw.raw_creditos", raw.select(*RAW_COLUMNS))
    internal = lambda name, df: staged.save(name, df) if name in TABLES else ws.save(name, df)
    tables, seconds = _build(ws, raw, GATED if strict else MODELS[gate], internal)
    tables["raw.raw_creditos"] = stored
    staged.publish(enforce)
    return Load(tables, ws.save("statistics", quality.statistics(credits, flagged, clean)), stored.count(),
                ws.save("violations", integrity.violations(tables)),
                {name: (tables[name].count(), spent) for name, spent in seconds.items()})
