"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import written

LINKS_PER_FILE = 250_000


def _large_star(links: DataFrame, files: int) -> DataFrame:
    """Every node ties its greater neighbours to the least of its neighbourhood."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
                    .coalesce(files), "least")
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame, files: int) -> DataFrame:
    """Every node ties its lesser neighbours and itself to the least of them (links run from greater to lesser)."""
    least = written(links.groupBy("a").agg(F.min("b").alias("m")).coalesce(files), "least")
    tied = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _settled(links: DataFrame) -> bool:
    """Whether every node has one link, and to a node that has none."""
    several = links.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
    inner = links.join(links.select(F.col("b").alias("a")).distinct(), "a", "left_semi").select("a")
    return several.unionByName(inner).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``a``, ``root``: the least node of the component, for every linked node but the roots.

    ``links`` has numbers ``a`` and ``b``; links of a node to itself say nothing. Each round is
    written to the shared folder. Aggregations are partial and joins can be split, so a node
    with very many links is no bottleneck; the driver sees one bit per round.
    """
    links = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), "links")
    files = -(-links.count() // LINKS_PER_FILE) or 1  # few links make few files, however many partitions a shuffle has
    while not _settled(links):
        links = written(_small_star(written(_large_star(links, files).coalesce(files), "large-star"), files)
                        .coalesce(files), "small-star")
    return links.select("a", F.col("b").alias("root"))
