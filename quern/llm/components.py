"""Connected components of large graphs, by DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): each node of edges (a, b) with the least node that its edges lead to.

    Every round each node takes the least label around it, then the label of its label, so
    that labels travel twice as far each time.  A round writes its labels to the shared
    folder and reads them again: the plans stay short, and both sides of each join are plain
    tables, so that Spark can split the rows of a node with very many edges.  Loops are
    dropped and edges may repeat; rows with a null are left out; no edges, no rows.
    """
    spark = edges.sparkSession
    held = edges.where("a is not null and b is not null and a <> b")
    pairs, pairs_path = materialise(held.unionByName(held.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    rows = pairs.count()  # no fewer than there are nodes
    labels, path = materialise(pairs.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("node"), F.least("a", "least").alias("component")), "labels", rows)
    while True:
        jumped, jumped_path = materialise(
            labels.alias("x").join(labels.alias("y"), F.col("x.component") == F.col("y.node")).select("x.node", F.col("y.component").alias("component")),
            "jumped",
            rows,
        )
        around = pairs.join(jumped.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("least"))
        after, after_path = materialise(
            jumped.join(around.withColumnRenamed("a", "node"), "node").select("node", F.least("component", "least").alias("component"), (F.col("least") < F.col("component")).alias("moved")),
            "labels",
            rows,
        )
        moved = after.where("moved").limit(1).count()
        discard(spark, path, jumped_path)
        labels, path = after.select("node", "component"), after_path
        if not moved:
            break
    discard(spark, pairs_path)
    return labels
