"""Lines of command of any depth, by a recursive query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import equi

MOST_LEVELS = 100


def ancestors(edges: DataFrame, node: str, parent: str, most: int = MOST_LEVELS) -> DataFrame:
    """Every pair of a ``node`` and an ``ancestor`` with their ``distance``; the nodes in between are in ``path``.

    ``edges`` holds a parent per node (a node without one, or with a null, is a top). A line that
    comes back to one of its own nodes ends there: ``closes`` marks that pair. More than ``most``
    levels raise.
    """
    pairs = edges.select(F.col(node).alias("node"), F.col(parent).alias("parent")).where("node is not null and parent is not null")
    return edges.sparkSession.sql(f"""
        WITH RECURSIVE up(node, ancestor, distance, path, closes) MAX RECURSION LEVEL {int(most)} AS (
            SELECT node, parent, 1, array(node), node = parent FROM {{pairs}}
            UNION ALL
            SELECT up.node, e.parent, up.distance + 1, array_append(up.path, up.ancestor),
                   array_contains(array_append(up.path, up.ancestor), e.parent)
            FROM up JOIN {{pairs}} e ON e.node = up.ancestor WHERE NOT up.closes)
        SELECT * FROM up""", pairs=pairs)


def reporting_lines(edges: DataFrame, node: str, parent: str, most: int = MOST_LEVELS) -> DataFrame:
    """One row per node: its ``line`` of ancestors, the nearest first, their number ``depth``, the ``top`` above
    it (itself for a top) and whether its line runs ``in_cycle``. A list is no longer than the levels."""
    up = ancestors(edges, node, parent, most)
    lines = up.groupBy("node").agg(
        F.array_sort(F.collect_list(F.when(~F.col("closes"), F.struct("distance", "ancestor")))).alias("pairs"),
        F.bool_or("closes").alias("in_cycle"))
    lines = lines.select("node", F.transform("pairs", lambda p: p["ancestor"]).alias("line"), "in_cycle")
    people = edges.select(F.col(node).alias("node")).where("node is not null").distinct()
    out = equi(people, lines, ["node"], "left").withColumns({
        "line": F.coalesce("line", F.array().cast(lines.schema["line"].dataType)), "in_cycle": F.coalesce("in_cycle", F.lit(False))})
    top = F.when(~F.col("in_cycle"), F.coalesce(F.try_element_at("line", F.lit(-1)), F.col("node")))
    return out.select(F.col("node").alias(node), "line", F.size("line").alias("depth"), top.alias("top"), "in_cycle")
