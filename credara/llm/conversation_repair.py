"""Conversation structure repair: the cheapest edits that make a conversation well formed.

Rows of a conversation are taken by turn (nulls first), rows of one turn by role and then by the SHA-256 of their text.
A row is kept, given another role or deleted, and rows may be put in, until the roles' initials are ``(s?(ua)+)?``.
Blank rows and rows whose role and text came before have to go; a row that stays although its last character ends no
sentence costs one more.

*The search.* Edits are the links of a lattice whose nodes are (rows used, state of the pattern). Two Dijkstra searches
run on it, forward from the start and in reverse from the ends. When their least open costs add up to more than the
best crossing, all crossings of that cost are complete: of the edit strings joined there the one least in ASCII wins.
Both searches carry the least edit string of each node, which is sound since two strings of equal cost that meet in a
node are never a prefix of one another.

*Long conversations.* Rows are sorted over all tasks by conversation and place, light columns only: no text. A task
reads its rows as a stream. A conversation that ends inside the task and has at most ``WINDOW`` rows is searched at
once. Any other is cut into windows of that many rows; every window is searched for each pair of states at its edges,
which gives a small table of costs, and for each entry the order of its exits by edit string. Tables of neighbouring
windows combine into one of the same size, first inside a task, then over the tasks of a conversation; from the ends
of the conversation the states at all edges follow, and they choose each window's edits. So a conversation that holds
a third of all rows is searched by as many tasks as its rows fill. Between windows rows are only put in before a row,
not after the last: the two are the same edits.

*Texts* are joined to the few columns of the rows that stay, and shuffled once.

Nulls: a null role or text counts as one space; a null conv_id is a conversation like any other; a null turn comes
first. Repeated rows count as often as they come. Roles other than system, user and assistant go by their first
character. Texts of any length are only hashed and joined. A conversation without rows after damage has no edits. An
empty table gives no row.
"""

import hashlib
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from credara.llm import common

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
WHITE = " \t\n\x0b\f\r"
ROLES = {"u": "user", "a": "assistant"}
# States of the pattern: nothing yet, after s, after u, after a.
STATES = range(4)
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
WANTED = ("u", "u", "a", "u")
ENDS = (0, 3)
LEGAL = ("su", "ua", "au")
WINDOW = 256


# -- one window


def _forward(units, node, tail: bool):
    """Links out of a node: letters, cost, next node. A unit is (initial, truncated, rows that have to go)."""
    at, state = node
    if at < len(units):
        initial, truncated, forced = units[at]
        if forced:
            yield DELETE * forced, COST[DELETE] * forced, (at + 1, state)
        else:
            more = TRUNCATED_COST * truncated
            if (state, initial) in STEP:
                yield KEEP, COST[KEEP] + more, (at + 1, STEP[state, initial])
            yield REROLE, COST[REROLE] + more, (at + 1, STEP[state, WANTED[state]])
            yield DELETE, COST[DELETE], (at + 1, state)
    if at < len(units) or tail:
        yield INSERT, COST[INSERT], (at, STEP[state, WANTED[state]])


# states from which the wanted initial, or a given one, leads to a state
_WANTED_FROM = {to: [s for s in STATES if STEP[s, WANTED[s]] == to] for to in STATES}
_FROM = {(initial, to): [s for s in STATES if STEP.get((s, initial)) == to] for initial in "sua" for to in STATES}


def _reversed(units, node, tail: bool):
    """Links into a node: letters, cost, node before."""
    at, state = node
    if at:
        initial, truncated, forced = units[at - 1]
        if forced:
            yield DELETE * forced, COST[DELETE] * forced, (at - 1, state)
        else:
            more = TRUNCATED_COST * truncated
            for before in _FROM.get((initial, state), ()):
                yield KEEP, COST[KEEP] + more, (at - 1, before)
            for before in _WANTED_FROM[state]:
                yield REROLE, COST[REROLE] + more, (at - 1, before)
            yield DELETE, COST[DELETE], (at - 1, state)
    if at < len(units) or tail:
        for before in _WANTED_FROM[state]:
            yield INSERT, COST[INSERT], (at, before)


def search(units, start: int, ends, tail: bool) -> tuple[int, str] | None:
    """Least cost and, of its edit strings, the least from state ``start`` to one of ``ends``."""
    n = len(units)
    # costs and strings so far; a heap entry is (cost, rows used on its side, node): links without cost use a row
    sides = [({(0, start): (0, "")}, [(0, 0, (0, start))], {}),
             ({(n, e): (0, "") for e in ends}, [(0, 0, (n, e)) for e in ends], {})]
    best = 0 if n == 0 and start in ends else None
    while sides[0][1] and sides[1][1]:
        if best is not None and sides[0][1][0][0] + sides[1][1][0][0] > best:
            break
        side = 0 if sides[0][1][0][0] <= sides[1][1][0][0] else 1
        label, heap, settled = sides[side]
        other = sides[1 - side][0]
        cost, _, node = heappop(heap)
        if node in settled or cost > label[node][0]:
            continue
        settled[node] = label[node]
        text = label[node][1]
        for letters, step, to in (_reversed if side else _forward)(units, node, tail):
            reached = (cost + step, letters + text if side else text + letters)
            known = label.get(to)
            if known is None or reached < known:
                label[to] = reached
                if known is None or reached[0] < known[0]:
                    heappush(heap, (reached[0], n - to[0] if side else to[0], to))
            if to in other and (best is None or reached[0] + other[to][0] < best):
                best = reached[0] + other[to][0]
    if best is None:
        return None
    label, back = sides[0][0], sides[1][0]
    found = [label[(n, e)][1] for e in ends if label.get((n, e), (None,))[0] == best]
    for node, (cost, text) in sides[0][2].items():
        for letters, step, to in _forward(units, node, tail):
            if to in back and cost + step + back[to][0] == best:
                found.append(text + letters + back[to][1])
    return best, min(found)


def apply(audit: str, state: int, units) -> list[tuple[str, int | None, str | None]]:
    """(edit, unit, new role) of every letter but deletions; ``units`` as searched, ``state`` at the window's start."""
    out, at, going = [], 0, 0
    for letter in audit:
        if letter == INSERT:
            out.append((letter, None, ROLES[WANTED[state]]))
            state = STEP[state, WANTED[state]]
            continue
        if letter == KEEP:
            out.append((letter, at, None))
            state = STEP[state, units[at][0]]
        elif letter == REROLE:
            out.append((letter, at, ROLES[WANTED[state]]))
            state = STEP[state, WANTED[state]]
        going += 1
        if going >= (units[at][2] or 1):
            at, going = at + 1, 0
    return out


# -- tables of windows


def table(units) -> list[list]:
    """For each entry and exit state: (cost, place among the entry's exits by edit string, edit string) or None."""
    out = []
    for entry in STATES:
        found = [search(units, entry, (x,), tail=False) for x in STATES]
        order = sorted(x[1] for x in found if x)
        out.append([(x[0], order.index(x[1]), x[1]) if x else None for x in found])
    return out


def join(first, second):
    """The table of two neighbouring windows, without edit strings: (cost, place) or None.

    Strings that leave the first window in different states differ there already, and neither is a prefix of the other,
    so places in the two windows decide.
    """
    out = []
    for entry in STATES:
        found = []
        for leave in STATES:
            ways = [(first[entry][m][0] + second[m][leave][0], first[entry][m][1], second[m][leave][1])
                    for m in STATES if first[entry][m] and second[m][leave]]
            found.append(min(ways) if ways else None)
        order = sorted(w[1:] for w in found if w)
        out.append([(w[0], order.index(w[1:])) if w else None for w in found])
    return out


def edges(tables, start: int, ends) -> list[int]:
    """States at all edges of neighbouring windows: from ``start``, along the least cost and string, to one of ``ends``,
    given as a dict of (cost, string) that is added behind an end state."""
    behind = [{s: c for s, c in ends.items()}]
    for t in reversed(tables):
        after, now = behind[-1], {}
        for entry in STATES:
            costs = [t[entry][x][0] + after[x][0] for x in STATES if t[entry][x] and x in after]
            if costs:
                now[entry] = (min(costs), "")
        behind.append(now)
    behind.reverse()
    states = [start]
    for k, t in enumerate(tables):
        after, entry = behind[k + 1], states[-1]
        ways = [(t[entry][x][0] + after[x][0], t[entry][x][1], x) for x in STATES if t[entry][x] and x in after]
        states.append(min(ways)[2])
    return states


@lru_cache
def closing() -> dict[int, tuple[int, str]]:
    """Cost and edits behind the last row of a conversation, for each state."""
    return {s: search((), s, ENDS, tail=True) for s in STATES}


# -- streams


_C = "c struct<has: boolean, id: long>"
_KEY = f"{_C}, t struct<has: boolean, no: long>, role string, said string"
_ROW = "array<struct<t: struct<has: boolean, no: long>, role: string, said: string, initial: string, truncated: boolean, forced: long>>"
_TABLE = "array<struct<cost: long, place: int, audit: string>>"
_WINDOWS = (f"{_C}, part int, no int, whole boolean, cost long, audit string, units {_ROW}, routes {_TABLE}, "
            "blank long, duplicate long, truncated long, illegal long, head string, foot string")

class _Part:
    """Windows of the sorted rows of one task. ``no`` is a window's place; -1 sums up the windows of a conversation."""

    def __init__(self, part: int, window: int):
        self.part, self.window, self.conversation, self.first = part, window, None, True
        self.out = []

    def take(self, row: dict) -> None:
        if self.conversation is not None and row["c"] != self.conversation:
            self.finish(last=False)
        if self.conversation is None:
            self.conversation, self.units, self.tables, self.rows = row["c"], [], [], []
            self.head = self.foot = None
            self.sums = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        initial, n = row["role"][:1], row["n"]
        own = {k: row[k] for k in ("t", "role", "said")}
        stays = 0 if row["blank"] or not row["is_first"] else 1
        if stays:
            self._add((initial, not row["closed"], 0), own)
        if n - stays:
            self._add((initial, False, n - stays), own)
        self.sums["blank"] += n if row["blank"] else 0
        self.sums["duplicate"] += 0 if row["blank"] else n - stays
        self.sums["truncated"] += int(stays and not row["closed"])
        if self.foot is None:
            self.head = initial
        elif self.foot + initial not in LEGAL:
            self.sums["illegal"] += 1
        self.sums["illegal"] += n - 1
        self.foot = initial

    def _add(self, unit, own) -> None:
        # a full window is cut only when a further unit comes, so a conversation of just that length stays whole
        if len(self.units) == self.window:
            self._cut()
        self.units.append(unit)
        self.rows.append(own)

    def _listed(self) -> list[dict]:
        return [own | {"initial": u[0], "truncated": u[1], "forced": u[2]} for u, own in zip(self.units, self.rows)]

    def _cut(self) -> None:
        found = table(self.units)
        routes = [None if x is None else {"cost": x[0], "place": x[1], "audit": x[2]} for row in found for x in row]
        self._emit(no=len(self.tables), whole=False, units=self._listed(), routes=routes)
        self.tables.append([[x and x[:2] for x in row] for row in found])
        self.units, self.rows = [], []

    def _emit(self, **values) -> None:
        self.out.append({"c": self.conversation, "part": self.part, "cost": None, "audit": None, "units": None, "routes": None,
                         "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "head": None, "foot": None} | values)

    def finish(self, last: bool) -> None:
        if self.conversation is None:
            return
        sums = self.sums | {"head": self.head, "foot": self.foot}
        # the first and the last conversation of a task may go on in another one
        if not (self.first or last or self.tables):
            cost, audit = search(self.units, 0, ENDS, tail=True)
            self._emit(no=0, whole=True, cost=cost, audit=audit, units=self._listed(), **sums)
        else:
            self._cut()
            whole = self.tables[0]
            for t in self.tables[1:]:
                whole = join(whole, t)
            routes = [None if x is None else {"cost": x[0], "place": x[1], "audit": None} for row in whole for x in row]
            self._emit(no=-1, whole=False, routes=routes, **sums)
        self.conversation, self.first = None, False


def _windows(placed: DataFrame, window: int) -> DataFrame:
    def run(batches):
        part = _Part(TaskContext.get().partitionId(), window)
        for batch in batches:
            for row in batch.to_pylist():
                part.take(row)
            if len(part.out) >= 500:
                yield _batch(part.out)
                part.out = []
        part.finish(last=True)
        yield _batch(part.out)

    return placed.mapInArrow(run, _WINDOWS)


_STRUCT_C = pa.struct([("has", pa.bool_()), ("id", pa.int64())])
_STRUCT_T = pa.struct([("has", pa.bool_()), ("no", pa.int64())])
_UNIT = pa.struct([("t", _STRUCT_T), ("role", pa.string()), ("said", pa.string()), ("initial", pa.string()),
                   ("truncated", pa.bool_()), ("forced", pa.int64())])
_ROUTE = pa.struct([("cost", pa.int64()), ("place", pa.int32()), ("audit", pa.string())])
_STATES_OF = [("part", pa.int32()), ("no", pa.int32()), ("cost", pa.int64()), ("entry", pa.int32()), ("leave", pa.int32())]
_EDIT_SCHEMA = pa.schema([("c", _STRUCT_C), ("t", _STRUCT_T), ("role", pa.string()), ("said", pa.string()), ("part", pa.int32()),
                          ("no", pa.int32()), ("place", pa.int32()), ("letter", pa.string()), ("new_role", pa.string())])
_SCHEMA = pa.schema([("c", _STRUCT_C), ("part", pa.int32()), ("no", pa.int32()), ("whole", pa.bool_()), ("cost", pa.int64()),
                     ("audit", pa.string()), ("units", pa.list_(_UNIT)), ("routes", pa.list_(_ROUTE)),
                     *((k, pa.int64()) for k in ("blank", "duplicate", "truncated", "illegal")),
                     ("head", pa.string()), ("foot", pa.string())])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _SCHEMA)


def _square(routes):
    """A table without edit strings; a way that does not exist is None or has no cost."""
    ways = [w and w["cost"] is not None and (w["cost"], w["place"]) or None for w in routes]
    return [ways[len(STATES) * e:len(STATES) * (e + 1)] for e in STATES]


def _mapped(frame: DataFrame, rows_of, schema: str, arrow: pa.Schema) -> DataFrame:
    """``rows_of`` gives the dicts that a row becomes."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pylist([out for row in batch.to_pylist() for out in rows_of(row)], arrow)

    return frame.mapInArrow(run, schema)


def _over_tasks(row: dict) -> list[dict]:
    """Entry and exit state of each task's part of a conversation; the whole cost beside the first."""
    parts = row["parts"]
    tables = [_square(p["routes"]) for p in parts]
    states = edges(tables, 0, closing())
    cost = sum(t[e][x][0] for t, e, x in zip(tables, states, states[1:])) + closing()[states[-1]][0]
    return [{"c": row["c"], "part": p["part"], "cost": 0 if k else cost, "entry": e, "leave": x}
            for k, (p, e, x) in enumerate(zip(parts, states, states[1:]))]


def _inside(row: dict) -> list[dict]:
    """The same for the windows of one part."""
    states = edges([_square(w["routes"]) for w in row["windows"]], row["entry"], {row["leave"]: (0, "")})
    return [{"c": row["c"], "part": row["part"], "no": w["no"], "cost": 0 if k else row["cost"], "entry": e, "leave": x}
            for k, (w, e, x) in enumerate(zip(row["windows"], states, states[1:]))]


_EDIT = f"{_KEY}, part int, no int, place int, letter string, new_role string"


def _edits(row: dict) -> list[dict]:
    """What stays of a window: rows kept and changed, and rows put in, which have no key but the conversation's."""
    plain = [(u["initial"], u["truncated"], u["forced"]) for u in row["units"]]
    out = []
    for place, (letter, at, role) in enumerate(apply(row["audit"], row["entry"], plain)):
        own = row["units"][at] if at is not None else {}
        out.append({"c": row["c"], "t": own.get("t"), "role": own.get("role"), "said": own.get("said"),
                    "part": row["part"], "no": row["no"], "place": place, "letter": letter, "new_role": role})
    return out


# -- frames


def _prepared(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with keys that are never null."""
    common.bound_batches(rows.sparkSession)
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                      F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    number = lambda column, name: F.struct(
        F.col(column).isNotNull().alias("has"), F.coalesce(column, F.lit(0)).cast("long").alias(name))
    return own.select(number("conv_id", "id").alias("c"), number("turn", "no").alias("t"), "role", "text",
                      F.sha2("text", 256).alias("said"))


def damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after faults that depend on the conversation and the turn alone: one in twenty turns
    each is dropped, emptied, loses its sentence ends, comes twice or becomes the user's."""
    blank = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    fault = (F.crc32(name) % 20).cast("int")
    text, role = F.coalesce("text", blank), F.coalesce("role", blank)
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).where("fault <> 0")
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(
            F.col("text")).alias("text"), "fault")
    copies = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.withColumn("copy", F.explode(copies)).select("conv_id", "turn", "role", "text")


def _light(ws, rows: DataFrame) -> DataFrame:
    """Rows without their texts, equal ones counted, in order of conversation and place."""
    said = F.rtrim("text", F.lit(WHITE))
    light = (rows.select("c", "t", "role", "said", (said == "").alias("blank"), F.right(said, F.lit(1)).isin([".", "!", "?"]).alias("closed"))
             .groupBy("c", "t", "role", "said", "blank", "closed").agg(F.count(F.lit(1)).alias("n")))
    light = ws.save("turns", light)
    # what was said more than once, and when first: the few keys that matter
    first = (light.groupBy("c", "role", "said").agg(F.min("t").alias("first_t"), F.count(F.lit(1)).alias("times"))
             .where("times > 1").drop("times"))
    marked = light.join(first, ["c", "role", "said"], "left").withColumn(
        "is_first", F.col("first_t").isNull() | (F.col("first_t") == F.col("t"))).drop("first_t")
    order = ["c", "t", "role", "said"]
    return marked.select(*order, "blank", "closed", "n", "is_first").repartitionByRange(*order).sortWithinPartitions(*order)


def _solved(ws, windows: DataFrame) -> DataFrame:
    """``c, part, no, cost, audit, entry, units`` of every window; the cost stands beside a conversation's first."""
    columns = ["c", "part", "no", "cost", "audit", "entry", "units"]
    whole = windows.where("whole").withColumn("entry", F.lit(0)).select(*columns)
    parts = windows.where("no = -1").groupBy("c").agg(F.sort_array(F.collect_list(F.struct("part", "routes"))).alias("parts"))
    parts = ws.save("parts", _mapped(parts, _over_tasks, f"{_C}, part int, cost long, entry int, leave int", pa.schema(
        [("c", _STRUCT_C), *_STATES_OF[:1], *_STATES_OF[2:]])))
    cut = windows.where("NOT whole AND no >= 0")
    numbers = F.struct("no", F.transform("routes", lambda r: F.struct(r["cost"].alias("cost"), r["place"].alias("place"))).alias("routes"))
    inside = (cut.groupBy("c", "part").agg(F.sort_array(F.collect_list(numbers)).alias("windows"))
              .join(parts, ["c", "part"]))
    inside = ws.save("inside", _mapped(inside, _inside, f"{_C}, part int, no int, cost long, entry int, leave int",
                                       pa.schema([("c", _STRUCT_C), *_STATES_OF])))
    chosen = cut.select("c", "part", "no", "units", "routes").join(inside, ["c", "part", "no"]).select(
        "c", "part", "no", F.when(F.col("no") == 0, F.col("cost")).otherwise(F.lit(0)).cast("long").alias("cost"),
        F.get("routes", F.col("entry") * 4 + F.col("leave"))["audit"].alias("audit"), "entry", "units")
    # what is put in behind the last row of a conversation that was cut
    ending = parts.groupBy("c").agg(F.max(F.struct("part", "leave")).alias("last")).select(
        "c", F.col("last.part").alias("part"), F.lit(2**31 - 1).alias("no"), F.lit(0).cast("long").alias("cost"),
        _ending(F.col("last.leave")).alias("audit"), F.col("last.leave").alias("entry"),
        F.expr(f"cast(array() AS {_ROW})").alias("units"))
    return whole.unionByName(chosen).unionByName(ending)


def _ending(state: Column) -> Column:
    return F.element_at(F.array(*[F.lit(closing()[s][1]) for s in STATES]), state + 1)


class Repair:
    """``summary``: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of every conversation of
    ``everything`` (by default those with rows); ``turns``: ``conv_id, place, role, text`` of the repaired rows, where
    places grow along the conversation."""

    def __init__(self, rows: DataFrame, everything: DataFrame | None = None, window: int = WINDOW):
        ws = common.workspace(rows)
        prepared = _prepared(rows)
        light = _light(ws, prepared)
        windows = ws.save("windows", _windows(light, window))
        solved = ws.save("solved", _solved(ws, windows))
        self.summary = self._summary(rows, everything, windows, solved)
        self.turns = self._turns(prepared, solved)

    @staticmethod
    def _summary(rows, everything, windows, solved) -> DataFrame:
        number = F.struct(F.col("conv_id").isNotNull().alias("has"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("id"))
        counted = windows.where("whole OR no = -1")
        edge = F.sort_array(F.collect_list(F.struct("part", "head", "foot")))
        faults = counted.groupBy("c").agg(*[F.sum(k).alias(k) for k in ("blank", "duplicate", "truncated", "illegal")], edge.alias("edge"))
        meet = F.transform(F.sequence(F.lit(1), F.size("edge") - 1), lambda k: (~F.concat(
            F.get("edge", k - 1)["foot"], F.get("edge", k)["head"]).isin(list(LEGAL))).cast("long"))
        meet = F.when(F.size("edge") > 1, F.aggregate(meet, F.lit(0).cast("long"), lambda a, x: a + x)).otherwise(F.lit(0))
        faults = faults.withColumn("illegal", F.col("illegal") + meet).drop("edge")
        turns = rows.groupBy(number.alias("c")).agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.count_distinct("turn").alias("n"))
        gaps = turns.select("c", F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("n"), F.lit(0)).alias("gaps"))
        audits = solved.groupBy("c").agg(F.sum("cost").alias("cost"), F.array_join(
            F.sort_array(F.collect_list(F.struct("part", "no", "audit")))["audit"], "").alias("audit"))
        known = (everything if everything is not None else rows).select(number.alias("c")).distinct()
        zero = lambda k: F.coalesce(k, F.lit(0)).cast("long").alias(k)
        return (known.join(faults, "c", "left").join(gaps, "c", "left").join(audits, "c", "left")
                .select(F.when(F.col("c.has"), F.col("c.id")).alias("conv_id"), zero("gaps"), zero("blank"), zero("duplicate"),
                        zero("truncated"), zero("illegal"), zero("cost"), F.coalesce("audit", F.lit("")).alias("audit")))

    @staticmethod
    def _turns(prepared, solved) -> DataFrame:
        edits = _mapped(solved, _edits, _EDIT, _EDIT_SCHEMA)
        at = F.struct("part", "no", "place").alias("place")
        conv = F.when(F.col("c.has"), F.col("c.id")).alias("conv_id")
        put_in = edits.where(F.col("letter") == INSERT).select(conv, at, F.col("new_role").alias("role"), F.lit("").alias("text"))
        kept = edits.where(F.col("letter") != INSERT).select("c", at, "t", "role", "said", "new_role")
        # of copies one at most stays; they are told apart by nothing
        key = ["c", "t", "role", "said"]
        texts = prepared.dropDuplicates(key).join(kept, key)
        kept = texts.select(conv, "place", F.coalesce("new_role", "role").alias("role"), "text")
        return kept.unionByName(put_in)


def repair(rows: DataFrame, everything: DataFrame | None = None, window: int = WINDOW) -> Repair:
    """Repair the conversations of ``conv_id, turn, role, text`` rows."""
    return Repair(rows, everything, window)


def digests(turns: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: of ``role:text`` lines joined by newlines. A digest is sequential by definition: a
    conversation's rows pass through one task, as a sorted stream of which one batch is held."""
    def run(batches):
        current, out, first = None, None, True
        for batch in batches:
            done = []
            for conv, role, text in zip(batch.column("conv_id").to_pylist(), batch.column("role").to_pylist(), batch.column("text")):
                if first or conv != current:
                    if not first:
                        done.append((current, out.hexdigest()))
                    current, out, first = conv, hashlib.sha256(), False
                else:
                    out.update(b"\n")
                out.update(f"{role}:{text.as_py()}".encode())
            yield _digest_batch(done)
        if not first:
            yield _digest_batch([(current, out.hexdigest())])

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place").select("conv_id", "role", "text")
    return ordered.mapInArrow(run, "conv_id long, repaired_sha256 string")


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string()))],
                                      ["conv_id", "repaired_sha256"])
