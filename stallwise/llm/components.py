"""Connected components of a link table by alternating star contractions.

Every round replaces the links of a node by links to the smallest node it knows:
first for its larger neighbours, then for its smaller ones (large-star and
small-star, Kiveris et al. 2014). Both are a minimum per node, which aggregates
map-side, and an equi-join whose skewed partitions Spark splits; the largest node
set of a component never meets in one task. The joins ask for a merge join, as files of
links are far smaller than the rows that a broadcast holds. Each round is written to the shared
folder, so lineage stays short and lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.sources.staging import stage


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` for every node that is not the smallest of its component.

    ``links`` has long columns ``a`` and ``b``; direction, repeats, self links and
    links with a null end do not matter. No links give no rows.
    """
    current = stage(
        links.where("a <> b").selectExpr("greatest(a, b) AS hi", "least(a, b) AS lo").distinct(), "links"
    )
    before = None
    while (state := _state(current)) != before:
        before = state
        current = stage(_small_star(_large_star(current)), "links")
    return current.selectExpr("hi AS node", "lo AS component")


def _state(links: DataFrame) -> tuple:
    """Number and order-free digest of the links: equal when a round changed nothing."""
    return tuple(links.agg(F.expr("count(1)"), F.expr("bit_xor(xxhash64(hi, lo))"), F.expr("sum(CAST(hash(hi, lo) AS BIGINT))")).first())


def _large_star(links: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to the smallest node around it."""
    both = links.selectExpr("hi AS x", "lo AS y").unionAll(links.selectExpr("lo AS x", "hi AS y"))
    smallest = both.groupBy("x").agg(F.expr("least(x, min(y)) AS m"))
    return both.where("y > x").join(smallest.hint("merge"), "x").selectExpr("y AS hi", "m AS lo").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link every node and its smaller neighbours to the smallest of them."""
    smallest = links.groupBy("hi").agg(F.expr("min(lo) AS m"))
    moved = links.join(smallest.hint("merge"), "hi").where("lo <> m").selectExpr("lo AS hi", "m AS lo")
    return moved.unionAll(smallest.selectExpr("hi", "m AS lo")).distinct()
