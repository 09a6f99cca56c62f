"""Records of CSV files whose quoted fields may hold line breaks, read in splits.

Every split is read as plain lines. For each line two questions are answered on the spot: does a quoted field stay open
at its end if the line starts outside of quotes, and if it starts inside? That makes a line a function on two states,
and so is a whole split: the composition of its lines. Only lines that are not the identity matter. One window over a
split's lines and one over a file's splits settle the state each split starts with; from there on the openings and
closings are known, and with them the lines that belong to one record. Those few lines are put together; all others
are records already and are not moved.

A record's number counts the records of its file. In splits where every line is a record it is the line's place; only
the rows of other splits are numbered by sorting. Lines end in ``\\n`` or ``\\r\\n``; blank lines between records are none.
"""

from pyspark.sql import Column, DataFrame, DataFrameReader, Window, functions as F, types as T

from credara.sources.workspace import Workspace

FILE, BLOCK, ROW, VALUE = "_archivo", "_bloque", "_fila_tarea", "_linea"
OPENS, STAYS, BLANK = "_abre", "_sigue", "_vacia"
NUMBER, BASE, LINE = "_numero", "_base", "_n_linea"

_QUOTED = r'[^"]*+(?:""[^"]*+)*+'
_FIELDS = rf'(?:(?:"{_QUOTED}"[^,]*+|[^",][^,]*+|),)*+'
# a line that leaves a quoted field open, if it starts outside of quotes, or inside
_OPEN_FROM_OUTSIDE = rf'^{_FIELDS}"{_QUOTED}\z'
_OPEN_FROM_INSIDE = rf'^{_QUOTED}(?:\z|"[^,]*+,{_FIELDS}"{_QUOTED}\z)'


def lines(reader: DataFrameReader, path: str | list[str]) -> DataFrame:
    """Lines with their split and what they do to the state; a batch or a stream."""
    text = reader.option("lineSep", "\n").format("text").load(path)
    value = F.col("value")
    quotes = value.contains('"')
    return text.select(
        value.alias(VALUE), F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
        F.when(quotes, value.rlike(_OPEN_FROM_OUTSIDE)).otherwise(False).alias(OPENS),
        F.when(quotes, value.rlike(_OPEN_FROM_INSIDE)).otherwise(True).alias(STAYS), (F.trim(F.rtrim(value, F.lit("\r"))) == "").alias(BLANK))


def landed(ws: Workspace, some: DataFrame) -> DataFrame:
    """Save lines with their place in the task that reads them: places describe that one read."""
    return ws.save("lineas", some.withColumn(ROW, F.monotonically_increasing_id()))


def _before(window) -> Column:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _sum_before(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(_before(window)), F.lit(0))


def _with_state(events: DataFrame, window, outside: str, inside: str, start: Column) -> DataFrame:
    """``_estado``: inside quotes before each event. ``outside`` and ``inside`` are an event's two results; the last one
    before that does not depend on its start settles the state, and every flip since turns it over."""
    flip = (F.col(outside) & ~F.col(inside)).cast("int")
    events = events.withColumn("_vueltas", F.coalesce(F.sum(flip).over(_before(window)), F.lit(0)) % 2 == 1)
    settled = F.when(F.col(outside) == F.col(inside), F.col(outside) != F.col("_vueltas"))
    anchor = F.last(settled, ignorenulls=True).over(_before(window))
    return events.withColumn("_ancla", anchor).withColumn(
        "_estado", F.coalesce("_ancla", start) != F.col("_vueltas"))


def _end(state: Column) -> Column:
    return F.when(state, F.col(STAYS)).otherwise(F.col(OPENS))


def _joined_lines(ws: Workspace, placed: DataFrame) -> DataFrame | None:
    """(file, head, line) of the lines of records that have several; None if there are none."""
    busy = ws.save("con_saltos", placed.where(OPENS).select(FILE).distinct())
    if busy.isEmpty():
        return None
    in_split, of_file = Window.partitionBy(FILE, BLOCK).orderBy(LINE), Window.partitionBy(FILE).orderBy(BLOCK)
    events = (placed.where(F.col(OPENS) | ~F.col(STAYS)).join(busy, FILE, "left_semi")
              .select(FILE, BLOCK, LINE, OPENS, STAYS))
    unknown = F.lit(None).cast("boolean")
    events = ws.save("comillas", _with_state(events, in_split, OPENS, STAYS, unknown))
    # a split as a function: the state after its last event for both starts
    state = lambda start: F.coalesce("_ancla", F.lit(start)) != F.col("_vueltas")
    splits = events.groupBy(FILE, BLOCK).agg(F.max_by(_end(state(False)), LINE).alias("_fuera"),
                                             F.max_by(_end(state(True)), LINE).alias("_dentro"))
    starts = _with_state(splits, of_file, "_fuera", "_dentro", F.lit(False)).select(FILE, BLOCK, F.col("_estado").alias("_inicio"))
    known = events.drop("_estado").join(starts, [FILE, BLOCK]).withColumn("_estado", F.coalesce("_ancla", "_inicio") != F.col("_vueltas"))
    closing = F.when(F.col("_estado") & ~F.col(STAYS), F.col(LINE))
    known = known.withColumn("_cierre", closing)
    later = lambda window: window.rowsBetween(1, Window.unboundedFollowing)
    opened = known.withColumn("_fin", F.first("_cierre", ignorenulls=True).over(later(in_split))).where(
        ~F.col("_estado") & F.col(OPENS))
    ends = known.groupBy(FILE, BLOCK).agg(F.min("_cierre").alias("_cierre"))
    ends = ends.select(FILE, BLOCK, F.first("_cierre", ignorenulls=True).over(later(of_file)).alias("_despues"))
    message = F.concat(F.lit("malformed line in "), F.col(FILE), F.lit(": a quoted field of line "),
                       (F.col(LINE) + 1).cast("string"), F.lit(" is never closed"))
    tail = F.coalesce("_fin", "_despues", F.raise_error(message).cast("bigint"))
    ranges = opened.join(ends, [FILE, BLOCK], "left").select(FILE, F.col(LINE).alias("_cabeza"), tail.alias("_fin"))
    return ws.save("tramos", ranges.select(FILE, "_cabeza", F.explode(F.sequence("_cabeza", "_fin")).alias(LINE)))


def records(ws: Workspace, some: DataFrame) -> DataFrame:
    """(file, text, number in its file, records of earlier files) from landed lines, the header as number 1.

    The split tables are saved, so that Catalyst knows their size and broadcasts them while that is small.
    """
    in_file = Window.partitionBy(FILE).orderBy(BLOCK)
    splits = some.groupBy(FILE, BLOCK).agg(F.min(ROW).alias("_primera"), F.count(F.lit(1)).alias("_lineas"))
    splits = ws.save("particiones", splits.withColumn("_antes", _sum_before("_lineas", in_file)))
    placed = some.join(splits.select(FILE, BLOCK, "_primera", "_antes"), [FILE, BLOCK]).withColumn(
        LINE, F.col("_antes") + F.col(ROW) - F.col("_primera"))
    parts = _joined_lines(ws, placed)
    head = "_cabeza"
    placed = placed.withColumn(head, F.lit(None).cast("bigint")) if parts is None else placed.join(parts, [FILE, LINE], "left")
    is_record = F.when(F.col(head).isNull(), ~F.col(BLANK)).otherwise(F.col(LINE) == F.col(head))

    counts = placed.where(is_record).groupBy(FILE, BLOCK).agg(F.count(F.lit(1)).alias("_registros"))
    counted = splits.join(counts, [FILE, BLOCK], "left").select(
        FILE, BLOCK, F.col("_antes").alias("_lineas_antes"), (F.col("_lineas") == F.coalesce("_registros", F.lit(0))).alias("_entera"),
        F.coalesce("_registros", F.lit(0)).alias("_registros"))
    counted = counted.withColumn("_previos", _sum_before("_registros", in_file))
    # one row a file meets in one order: the header of each is no row
    files = counted.groupBy(FILE).agg(F.greatest(F.sum("_registros") - 1, F.lit(0)).alias("_n"))
    files = files.select(FILE, _sum_before("_n", Window.orderBy(FILE)).alias(BASE))
    counted = ws.save("registros", counted.join(files, FILE))

    own = F.when(F.col(VALUE).endswith("\r"), F.expr(f"left({VALUE}, length({VALUE}) - 1)")).otherwise(F.col(VALUE))
    whole = placed.where(F.col(head).isNull() & ~F.col(BLANK)).select(FILE, BLOCK, LINE, own.alias(VALUE))
    if parts is not None:
        text = F.array_join(F.sort_array(F.collect_list(F.struct(LINE, VALUE)))[VALUE], "\n")
        several = (placed.where(F.col(head).isNotNull()).groupBy(FILE, F.col(head).alias(LINE))
                   .agg(F.min(BLOCK).alias(BLOCK), text.alias(VALUE)))
        whole = whole.unionByName(several.withColumn(VALUE, own))
    numbered = whole.join(counted, [FILE, BLOCK])
    by_place = numbered.where("_entera").withColumn(NUMBER, F.col("_previos") + F.col(LINE) - F.col("_lineas_antes") + 1)
    if not counted.where("NOT _entera").isEmpty():
        order = F.row_number().over(Window.partitionBy(FILE, BLOCK).orderBy(LINE))
        by_place = by_place.unionByName(numbered.where("NOT _entera").withColumn(NUMBER, F.col("_previos") + order))
    return by_place.select(FILE, VALUE, NUMBER, BASE)


def parsed(found: DataFrame, names: list[str], options: dict[str, str], broken: str) -> DataFrame:
    """The fields of each record under ``names``; a header with other names, or a record with too few or too many
    fields, stops the reader."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, broken]])
    fields = F.from_csv(VALUE, schema.simpleString()[len("struct<"):-1].replace(":", " "), {
        **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken, "multiLine": "true"})
    rows = found.withColumn("_campos", fields)
    said = lambda what: F.concat(F.lit("malformed line in "), F.col(FILE), F.lit(f": {what}"), F.col(VALUE))
    own = F.transform(F.array(*[F.col("_campos")[c] for c in names]), lambda c: F.trim(F.ltrim(c, F.lit("\ufeff"))))
    same = own == F.array(*[F.lit(c) for c in names])
    header = F.when(same, False).otherwise(F.raise_error(said("another header: ")).cast("boolean"))
    whole = F.when(F.col("_campos")[broken].isNotNull(), F.raise_error(said("")).cast("boolean")).otherwise(True)
    # a filter, since a projection that nobody reads would not be evaluated
    rows = rows.where(F.when(F.col(NUMBER) == 1, header).otherwise(whole))
    return rows.select(*[F.col("_campos")[c].alias(c) for c in names], FILE, NUMBER, BASE)
