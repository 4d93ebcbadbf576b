"""Connected components of a table of links, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyforge.sources.storage import materialize

LINKS_PER_TASK = 100_000


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``v`` and ``label`` (the smallest vertex that can be reached) for every vertex of ``links`` (columns ``a``, ``b``).

    Each round takes the smallest label around a vertex, then the label of that label, so labels run along chains in
    a number of rounds that grows with the logarithm of their length. Rounds are written to the shared folder; nothing
    is collected. Links may repeat, and join a vertex to itself. No links give an empty table.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct()
    around = materialize(both, f"{name}-links")
    # Few links need few tasks; with many, each shuffle partition stays a task.
    tasks = 1 + around.count() // LINKS_PER_TASK
    start = around.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "v")
    labels = materialize(start.coalesce(tasks), name)
    while True:
        near = around.join(labels, around.b == labels.v).groupBy("a").agg(F.min("label").alias("near"))
        least = labels.join(near, labels.v == near.a, "left").select(
            "v", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label")
        )
        up = labels.select(F.col("v").alias("u"), F.col("label").alias("further"))
        moved = materialize(
            least.join(up, least.label == up.u, "left")
            .select("v", "old", F.least("label", F.coalesce("further", "label")).alias("label"))
            .coalesce(tasks),
            name,
        )
        labels = moved.select("v", "label")
        if moved.where("old != label").isEmpty():
            return labels
