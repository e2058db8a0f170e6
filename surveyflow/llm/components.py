"""Connected components of a graph whose edges are rows.

Large-star and small-star rounds (Kiveris et al., 2014): every round ties the neighbours of a node
to the smallest of them, until each component is a star around its smallest node. Minima are partial
aggregates and attach by a plain join, which Spark can split where a node has very many neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyflow.llm.common import stored


def _star(links: DataFrame) -> DataFrame:
    """Rows (a, b): ties of each node's neighbours b, and itself, to the smallest among b and a."""
    smallest = links.groupBy("a").agg(F.min("b").alias("least"))
    return links.join(smallest, "a").withColumn("least", F.least("least", "a"))


def _stamp(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node that has an edge to another one.

    ``edges``: two columns of one orderable type, in either direction, repeats allowed, nulls and
    loops without effect. ``component`` is the smallest node of the component. Each round is a
    stored table, so that lineage stays short and lost executors cost one round at most.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns[:2])
    links = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter((a != b) & a.isNotNull() & b.isNotNull())
    links = stored(links.select("a", "b").distinct(), name)
    stamp = _stamp(links)
    while True:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        small = _star(large).select(F.explode(F.array("a", "b")).alias("a"), F.col("least").alias("b")).filter("a != b").distinct()
        links = stored(small, name)
        last, stamp = stamp, _stamp(links)
        if stamp == last:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
