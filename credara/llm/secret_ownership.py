"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Three patterns find the base spans: assignments of secrets, access keys and long hexadecimal runs. A fourth finds
long tokens of letters and digits that no base span covers. The value of every candidate is hashed, and for each hash
the distinct repositories and owners over the whole corpus are counted. A value seen with one owner and in few
repositories looks live; one that many owners have copied is an example, a licence line or a published sample. Base
spans always stay; tokens become spans of kind ``owned`` only if their value looks live.

Positions are code points: the pieces between matches and the matches themselves alternate, so the running sum of
their lengths inside a row gives every end. Only rows with candidates are shuffled, by row; ownership is counted in
steps that combine on the map side, so a value in a third of all rows is no hot key.

The owner defaults to ``source`` and the repository to ``doc_id``. A null owner or repository counts as one unknown
owner or repository; null and empty texts have no spans; repeated rows are scanned each for itself.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from credara.llm import common

# What the scan looks for.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_-]{16,}"
LEAST_ASSIGNED = 6

KINDS = ("assign", "access", "hex", "owned")
MAX_OWNERS = 1
MAX_REPOSITORIES = 3


def _found(text: Column, pattern: str) -> tuple[Column, Column]:
    """Matches of a pattern, and the text between them; rows without a match are tested once and not cut."""
    some = text.rlike(pattern)
    return (F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")),
            F.when(some, F.split(text, pattern, -1)))


def candidates(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """Every row with its matches and the lengths between them, by kind; most lists are empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    listed = []
    for kind, pattern in zip(KINDS, (ASSIGN, ACCESS, HEX, TOKEN)):
        matches, between = _found(text, pattern)
        listed += [matches.alias(kind), F.transform(between, F.length).alias(f"{kind}_between")]
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"), *listed).withColumn(
        "row", F.monotonically_increasing_id())


def _spans(listed: DataFrame) -> DataFrame:
    """``row, owner, repository, kind_no, start, stop, value`` of all candidates."""
    out = None
    for number, kind in enumerate(KINDS):
        one = listed.where(F.size(kind) > 0).select(
            "row", "owner", "repository", F.lit(number).alias("kind_no"), F.col(f"{kind}_between").alias("between"),
            F.posexplode(kind).alias("place", "match"))
        one = one.withColumn("before", F.get("between", "place")).drop("between")
        out = one if out is None else out.unionByName(one)
    in_order = Window.partitionBy("row", "kind_no").orderBy("place")
    size = F.length("match")
    stop = F.sum(F.col("before") + size).over(in_order)
    is_assign = F.col("kind_no") == 0
    value = F.when(is_assign, F.regexp_extract("match", ASSIGN, 1)).otherwise(F.col("match"))
    return (out.withColumn("stop", stop).withColumn("start", F.col("stop") - size).withColumn("value", value)
            .where(~is_assign | (F.length("value") >= LEAST_ASSIGNED))
            .where((F.col("kind_no") != 3) | (F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")))
            .select("row", "owner", "repository", "kind_no", "start", "stop", F.sha2("value", 256).alias("hash")))


def _uncovered(spans: DataFrame) -> DataFrame:
    """Without the tokens that a base span touches."""
    base = F.col("kind_no") < 3
    ahead = Window.partitionBy("row").orderBy("start", "kind_no").rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind_no")).rowsBetween(Window.unboundedPreceding, -1)
    return (spans.withColumn("reach", F.max(F.when(base, F.col("stop"))).over(ahead))
            .withColumn("next", F.min(F.when(base, F.col("start"))).over(back))
            .where(base | ((F.coalesce("reach", F.lit(0)) <= F.col("start"))
                           & (F.coalesce(F.col("next"), F.col("stop")) >= F.col("stop"))))
            .drop("reach", "next"))


def ownership(spans: DataFrame) -> DataFrame:
    """``hash, owners, repositories``: distinct ones over the whole corpus."""
    known = spans.select("hash", F.coalesce("owner", F.lit("")).alias("owner"),
                         F.coalesce("repository", F.lit("")).alias("repository"))
    owners = known.select("hash", "owner").distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("owners"))
    places = known.distinct().groupBy("hash").agg(F.count(F.lit(1)).alias("repositories"))
    return owners.join(places, "hash")


def scan(docs: DataFrame, owner: str = "source", repository: str = "doc_id", max_owners: int = MAX_OWNERS,
         max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """``doc_id, spans``: for each row an array of ``kind, start, stop, owners, repositories, live``, in order."""
    ws = common.workspace(docs)
    listed = ws.save("candidates", candidates(docs, owner, repository))
    spans = ws.save("candidate_spans", _uncovered(_spans(listed)))
    counted = spans.join(ownership(spans), "hash")
    live = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind_no") + 1)
    shown = counted.withColumn("live", live).where((F.col("kind_no") < 3) | F.col("live")).withColumn("kind", kind)
    by_row = shown.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        "start", "kind_no", "kind", "stop", "owners", "repositories", "live"))).alias("spans"))
    return listed.select("row", "doc_id").join(by_row, "row", "left").select("doc_id", "spans")


def digests(scanned: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live`` of scanned rows."""
    spans = F.coalesce(F.col("spans"), F.expr(
        "cast(array() AS array<struct<start:bigint,kind_no:int,kind:string,stop:bigint,owners:bigint,"
        "repositories:bigint,live:boolean>>)"))
    rows = scanned.select("doc_id", spans.alias("all"))
    named = lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])
    count = lambda n: F.size(F.filter("all", lambda s: s["kind_no"] == n)).cast("long")
    base = F.filter("all", lambda s: s["kind_no"] < 3)
    return rows.select(
        "doc_id", *(count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS[:3])),
        F.sha2(F.array_join(F.transform(base, named), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("all", named), ",").alias("spans"),
        F.size(F.filter("all", lambda s: s["live"])).cast("long").alias("n_live"))
