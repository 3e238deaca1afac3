"""Connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondera.sources.tables import staged


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id and label, the smallest id of its component, for each of ``nodes`` (id). edges: a, b.

    Labels fall in rounds: every edge offers each end the other's label, then labels are
    replaced by their own labels, so chains shorten by halves. A round's labels are
    staged; the driver only asks whether any label changed. Nodes without an edge take no
    part in the rounds.
    """
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a != b").distinct(), "edges")
    touched = both.select(F.col("a").alias("id")).distinct()
    labels = staged(nodes.select("id").distinct().join(touched, "id", "left_semi").withColumn("label", F.col("id")), "labels")
    while True:
        offers = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("label").alias("offer"))
        lower = labels.join(offers.withColumnRenamed("a", "id"), "id", "left").select("id", "label", F.least("label", F.coalesce("offer", "label")).alias("new"))
        up = labels.select(F.col("id").alias("new"), F.col("label").alias("further"))
        jumped = lower.join(up, "new", "left").select("id", F.least("new", F.coalesce("further", "new")).alias("label"), (F.col("label") != F.least("new", F.coalesce("further", "new"))).alias("changed"))
        jumped = staged(jumped, "labels")
        labels = jumped.select("id", "label")
        if jumped.filter("changed").isEmpty():
            every = nodes.select("id").distinct().join(labels, "id", "left")
            return every.select("id", F.coalesce("label", "id").alias("label"))
