"""Connected components by minimum labels and label jumping, one written table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.llm.frames import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of the (a, b) edges; comp is the smallest node of its component.

    Each round a node takes the smallest label among its own and its
    neighbours', then the label of that label. Neighbours' labels are
    pre-aggregated, so a node with very many edges costs a row for each task.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                         .select("node", F.least("node", "m").alias("comp")), "labels")
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("comp").alias("m"))
                .withColumnRenamed("a", "node"))
        step = labels.join(near, "node").select("node", F.least("comp", "m").alias("comp"), F.col("comp").alias("old"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        new = materialize(step.join(jump, "comp")
                          .select("node", F.least("comp", "further").alias("comp"), "old"), "labels")
        if new.where("comp <> old").isEmpty():
            return new.select("node", "comp")
        labels = new.select("node", "comp")
