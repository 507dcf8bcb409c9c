"""Connected components of a link table, without collecting links."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verity.llm.common import Staging


def components(links: DataFrame, staging: Staging, name: str = "components") -> DataFrame:
    """``id, component`` of every id that occurs in ``links(a, b)``;
    ``component`` is the smallest id reachable.

    Every round takes the smallest label among the neighbours and then the
    label's own label (pointer jumping), so a label travels twice as far each
    time; rounds run until nothing changes. The neighbours' minimum is
    pre-aggregated before its shuffle, so a node with very many links is no
    burden. Null ends and loops link nothing; repeated links count once.
    """
    both = links.filter("a <> b").select("a", "b").unionAll(links.filter("a <> b").select("b", "a")).distinct()
    edges = staging.write(both.toDF("a", "b"), f"{name}-edges")
    labels = staging.write(edges.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
                           .select("id", F.least("id", "m").alias("component")), f"{name}-0")
    n = 0
    while True:
        near = (edges.join(labels.withColumnRenamed("id", "b"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near")))
        step = (labels.withColumnRenamed("component", "old").join(near, "id")
                .select("id", "old", F.least("old", "near").alias("next")))
        jump = labels.select(F.col("id").alias("next"), F.col("component").alias("far"))
        n += 1
        new = staging.write(step.join(jump, "next", "left").select(
            "id", F.least("next", "far").alias("component"), (F.col("old") != F.least("next", "far")).alias("changed")),
            f"{name}-{n}")
        staging.drop(f"{name}-{n - 1}")
        done = new.filter("changed").isEmpty()
        labels = new.drop("changed")
        if done:
            staging.drop(f"{name}-edges")
            return labels
