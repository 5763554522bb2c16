"""Connected components of a graph given by links between numbers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditloom.session import materialise

# more rounds than any graph of fewer than 2^60 nodes should take
MAX_ROUNDS = 100


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest reachable node) of all nodes in ``links``.

    ``links`` has long columns ``a`` and ``b``, any order, repeats and loops allowed. Each
    round links every larger neighbour of a node, then every smaller one, to the smallest
    neighbour known, until nothing changes; paths shrink by a constant factor per round
    and the number of links never grows. Each round is written, so that no round depends
    on an executor that has gone. Minima are combined before each shuffle; the joins are
    plain equi-joins whose crowded keys Spark splits.
    """
    both = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    loops = both.filter("u = v").select("u")
    edges = materialise(both.filter("u > v").distinct())
    last = None
    for _ in range(MAX_ROUNDS):
        large = _star(_either_way(edges), larger_only=True)
        edges = materialise(_star(large, larger_only=False))
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError("the components did not settle")
    roots = edges.select("v").distinct().selectExpr("v as node", "v as component")
    found = roots.unionByName(edges.selectExpr("u as node", "v as component"))
    alone = loops.distinct().join(found, F.col("u") == F.col("node"), "left_anti")
    return found.unionByName(alone.selectExpr("u as node", "u as component"))


def _either_way(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.selectExpr("v as u", "u as v"))


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Links from the neighbours of each node u to the smallest of them and u itself.

    With ``larger_only`` the neighbours on both sides are given and those above u are
    linked; without, only neighbours below u are given, and they and u are linked.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) as m")
    if larger_only:
        linked = edges.filter("v > u").join(least, "u").selectExpr("v as u", "m as v")
    else:
        linked = edges.join(least, "u").selectExpr("v as u", "m as v").unionByName(
            least.selectExpr("u", "m as v")
        )
    return linked.filter("u > v").distinct()
