"""Connected components of a graph given by links, with every step a join or an aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.skew import left_lookup
from tapeworks.llm.columns import stage

# A node with more rows than this, and more than a ten-thousandth of all, is looked up by broadcast.
HOT_ROWS = 200


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def _round(links: DataFrame, rows: int) -> DataFrame:
    """Hangs every node's larger neighbours on its smallest, then each node and its smaller neighbours likewise."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("rows"))
    least = least.withColumn("low", F.least("low", "u"))
    large = left_lookup(both.filter("v > u"), least, ["u"], "rows", HOT_ROWS) \
        .select(F.col("v").alias("u"), F.col("found.low").alias("v")).distinct()
    large = stage(large, "links", 2 * rows)
    least = large.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("rows"))
    rest = left_lookup(large, least, ["u"], "rows", HOT_ROWS).filter("v > found.low") \
        .select(F.col("v").alias("a"), F.col("found.low").alias("b"))
    return least.select(F.col("u").alias("a"), F.col("low").alias("b")).union(rest).distinct()


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, root) for each node of the links (a, b): root is the smallest node of its component.

    ``rows`` is the number of links at most, if known; it only sizes files.

    A link may come in either direction and more than once; links of a node with itself and with null say nothing.
    Nodes are integers. Neither links nor components are ever brought together in one task.
    """
    ordered = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = stage(ordered, "links", rows)
    before, after = None, _state(links)
    while after != before and after[0]:
        links = stage(_round(links, after[0]), "links", 2 * after[0])
        before, after = after, _state(links)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def with_roots(nodes: DataFrame, node: str, links: DataFrame, rows: int | None = None) -> DataFrame:
    """nodes, one row each, with ``root``: the smallest node reachable, itself where nothing links to it."""
    found = components(links, rows).select(F.col("node").alias("__node"), "root")
    return nodes.join(found, F.col(node) == F.col("__node"), "left") \
        .select(*nodes.columns, F.coalesce("root", node).alias("root"))


def smallest_member(nodes: DataFrame, member: str, name: str) -> DataFrame:
    """nodes with the smallest ``member`` of all nodes of their root, as ``name``."""
    least = nodes.groupBy("root").agg(F.min(member).alias(name), F.count("*").alias("members"))
    return left_lookup(nodes, least, ["root"], "members", HOT_ROWS).select(*nodes.columns, f"found.{name}")
