"""Connected components by alternating large and small stars: every round is two aggregations that combine on the
map side and two joins that can be split, so hubs with very many neighbours are no special case."""

from pyspark.sql import DataFrame, functions as F


def _directed(pairs: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller end, once each."""
    return (pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    return _directed(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    near = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _directed(near.unionByName(least.select("a", F.col("least").alias("b"))))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(ws, pairs: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``pairs (a, b)`` that is not its own root; root is the smallest node."""
    edges = ws.save("edges", _directed(pairs))
    state = _state(edges)
    while state[0]:
        # written between the two: each round starts from files
        edges = ws.save("edges", _small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
