"""Connected components of an edge table, by alternating star steps. All state lives in tables of the shared folder."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalens.llm.common import parked


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least of itself and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    up = both.where("b > a")
    return up.join(least, up["a"] == least["n"]).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours and itself to the least of them. Edges go from ``a`` down to ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n")
    moved = edges.join(least, edges["a"] == least["n"]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) of all nodes of ``edges`` (a, b). Loops and repeated edges do no harm; no edges, no rows."""
    now = parked(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = parked(_small_star(_large_star(now)), "stars")
        last, state = state, _state(now)
        if state == last:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
