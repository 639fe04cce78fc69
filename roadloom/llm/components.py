"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.llm.base import stable


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each id of ``links`` (a, b) can reach.

    Every round takes the smallest label among the neighbours and then follows that label once more, so chains
    shrink by half or better.  Nothing but one sum per round reaches the driver.
    """
    edges = stable(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .filter("a <> b").distinct())
    labels = edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("component"))
    total = None
    while True:
        labels = stable(labels)
        now = labels.agg(F.sum(F.col("component").cast("decimal(38,0)")), F.count("*")).first()
        if not now[1] or now[0] == total:
            return labels
        total = now[0]
        seen = (edges.join(labels, edges["b"] == labels["id"]).groupBy(F.col("a").alias("n")).agg(F.min("component").alias("m")))
        near = labels.join(seen, F.col("id") == F.col("n")).select("id", F.least("component", "m").alias("near"))
        above = near.select(F.col("id").alias("up"), F.col("near").alias("top"))
        labels = near.join(above, F.col("near") == F.col("up")).select("id", F.least("near", "top").alias("component"))
