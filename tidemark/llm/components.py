"""Connected components of a table of links, by smallest labels that travel along links and through labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import Staging


def components(links: DataFrame, staging: Staging) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for each node of ``links`` (long columns ``a`` and ``b``).

    Each round takes the smallest label among the neighbours, then the label of that label, so the longest chain is
    about halved. Rounds are written to the shared folder; only the number of changes comes to the driver.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = both.unionAll(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
    edges = staging.put(both.distinct(), "edges")
    labels = staging.put(edges.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("root")), "labels0")
    step = 0
    while True:
        step += 1
        heard = (
            edges.join(labels.withColumnRenamed("node", "other"), "other")
            .groupBy("node")
            .agg(F.min("root").alias("near"))
        )
        moved = labels.join(heard, "node").select(
            "node", F.col("root").alias("was"), F.least("root", "near").alias("root")
        )
        through = moved.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        fresh = moved.join(through, "root").select("node", "was", F.least("root", "beyond").alias("root"))
        fresh = staging.put(fresh, f"labels{step}")
        changed = fresh.filter("root <> was").limit(1).count()
        staging.release(f"labels{step - 1}")
        labels = fresh.select("node", "root")
        if not changed:
            return labels
