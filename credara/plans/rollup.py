"""What the additive KPIs need of the fact: states that merge, from a scan or from a roll-up kept up to date.

A state is a row of counts, sums in cents and extremes. States of different rows add up to the state of all, so those
of a load can be computed alone and merged with what earlier loads left. A roll-up holds, for each load, the total and
the states by industry, segment, channel, day and first-payment status: a few thousand rows however many credits there
are. Every KPI and panel that adds up takes either a fact or a roll-up and gives the same result; percentiles do not add
up and need the fact.

A load is known by a number. Given again, it replaces its own states, so that a load tried twice counts once. Closed
loads are merged into one and can't be replaced any more. Only loads that add credits can be rolled up, and their
surrogate keys must mean the same in all loads (``keys.extend_keys``); dates have smart keys.

No loads, or empty ones, give what an empty fact gives. NULL keys are members of their own; credits whose industry or
day is unknown drop out where a KPI names it, as in an inner join.
"""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from credara.functions.calendar import in_days
from credara.functions.money import cents, segment, sum_cents
from credara.schemas import LATE, ON_TIME
from credara.sources.workspace import Workspace

KEYS = ["tiempo_id", "industria_id", "canal", "segmento", "estatus_primer_pago"]
LOAD, CLOSED = "carga", "cerrada"

_MERGE = {"n": F.sum, "centavos": F.sum, "a_tiempo": F.sum, "tardios": F.sum, "monto_min": F.min, "monto_max": F.max,
          "plazos": F.sum, "con_plazo": F.sum, "plazo_min": F.min, "plazo_max": F.max}


def merged() -> list[Column]:
    """States of several rows as one."""
    found = {c: merge(c) for c, merge in _MERGE.items()}
    # an amount of cents stays one type, however often it is merged; no rows are no credits
    found |= {"centavos": found["centavos"].cast("decimal(38,0)"), "n": F.coalesce(found["n"], F.lit(0))}
    return [column.alias(c) for c, column in found.items()]


def _states() -> list[Column]:
    """State of credits. Statuses are counted as NULL for no credits, like the SUM(CASE ...) they stand for."""
    status = F.col("estatus_primer_pago")
    found = {"n": F.count(F.lit(1)), "centavos": sum_cents(cents(F.col("monto"))).cast("decimal(38,0)"),
             "a_tiempo": F.sum(F.when(status == ON_TIME, 1).otherwise(0)),
             "tardios": F.sum(F.when(status == LATE, 1).otherwise(0)),
             "monto_min": F.min("monto"), "monto_max": F.max("monto"),
             "plazos": F.sum("plazo_meses"), "con_plazo": F.count("plazo_meses"),
             "plazo_min": F.min("plazo_meses"), "plazo_max": F.max("plazo_meses")}
    return [column.alias(c) for c, column in found.items()]


def _key(name: str) -> Column:
    return segment(F.col("monto")).alias(name) if name == "segmento" else F.col(name)


@dataclass(frozen=True)
class Scan:
    """States by one key, or of all credits, straight from a fact; unused ones are pruned by the optimizer."""

    fact: DataFrame

    def by(self, key: str | None = None) -> DataFrame:
        return self.fact.groupBy(*([_key(key)] if key else [])).agg(*_states())


@dataclass(frozen=True)
class Rollup:
    """States by one key, or of all credits, from a stored roll-up: the fact is not read."""

    stored: DataFrame
    period: Column | None = None

    def by(self, key: str | None = None) -> DataFrame:
        """In a period, only the total and the days are known."""
        if self.period is not None:
            if key not in (None, "tiempo_id"):
                raise ValueError(f"the roll-up of a period has no states by {key}")
            rows = self.stored.where((F.col("clave") == "tiempo_id") & self.period)
        else:
            rows = self.stored.where(F.col("clave") == (key or "total"))
        return rows.groupBy(*([key] if key else [])).agg(*merged())

    def in_period(self, start: date, end: date) -> "Rollup":
        return Rollup(self.stored, in_days("tiempo_id", start, end))


def of(credits: DataFrame | Rollup) -> Scan | Rollup:
    return credits if isinstance(credits, Rollup) else Scan(credits)


def states(fact: DataFrame) -> DataFrame:
    """The roll-up rows of a fact: ``clave`` names the key whose member a row is about, or says ``total``.

    Credits are combined per member of all keys first, on the map side, so that the grouping sets expand few rows.
    """
    cells = fact.groupBy(*map(_key, KEYS)).agg(*_states())
    masks = {k: (1 << len(KEYS)) - 1 - (1 << len(KEYS) - 1 - i) for i, k in enumerate(KEYS)}
    clave = F.lit("total")
    for key, mask in masks.items():
        clave = F.when(F.grouping_id() == mask, key).otherwise(clave)
    sets = [[], *([F.col(k)] for k in KEYS)]
    return (cells.groupingSets(sets, *map(F.col, KEYS)).agg(clave.alias("clave"), *merged())
            .select("clave", *KEYS, *_MERGE))


def add_load(ws: Workspace, stored: DataFrame | None, delta: DataFrame, load: int) -> DataFrame:
    """The roll-up with the credits of a load; states that the same load left before are replaced."""
    new = states(delta).withColumns({LOAD: F.lit(load).cast("bigint"), CLOSED: F.lit(False)})
    if stored is None:
        return ws.save("rollup", new)
    if not stored.where(F.col(CLOSED) & (F.col(LOAD) >= load)).isEmpty():
        raise ValueError(f"load {load} is closed")
    return ws.save("rollup", stored.where(F.col(LOAD) != load).unionByName(new))


def close_loads(ws: Workspace, stored: DataFrame, through: int) -> DataFrame:
    """The roll-up with all loads up to ``through`` merged into one, so that it does not grow with their number."""
    old = F.col(LOAD) <= through
    closed = (stored.where(old).groupBy("clave", *KEYS).agg(*merged())
              .withColumns({LOAD: F.lit(through).cast("bigint"), CLOSED: F.lit(True)}))
    return ws.save("rollup", stored.where(~old).unionByName(closed))
