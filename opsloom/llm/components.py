"""Connected components of a distributed graph."""
from pyspark.sql import DataFrame, functions as F

from opsloom.llm.common import settled


def components(edges: DataFrame, a="a", b="b") -> DataFrame:
    """(node, label): the smallest node reachable from each node of an edge list.

    First the edges are thinned: each node is tied to the smallest of its smaller neighbours, and so are its other smaller neighbours;
    many ways to the same few small nodes become one each. Then each round takes the smallest label among a node's neighbours, and the
    label of that label (pointer jumping), until nothing changes. Labels and edges stay distributed; sides of joins are written
    before, so that adaptive execution can split a node with very many edges, and the minimum is combined before it is shuffled. No edges: no rows.
    """
    down = settled(edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct())
    least = settled(down.groupBy("v").agg(F.min("u").alias("m")))
    thin = down.join(least, "v").where("u <> m").select(F.col("m").alias("u"), F.col("u").alias("v")).union(least.select(F.col("m").alias("u"), "v")).distinct()
    thin = settled(thin)
    both = settled(thin.union(thin.select(F.col("v").alias("u"), F.col("u").alias("v"))))
    labels = settled(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("near")).select(
        "node", F.least("node", "near").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("v"), F.col("label").alias("l")), "v").groupBy(
            F.col("u").alias("node")).agg(F.min("l").alias("l"))
        nearer = settled(labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "l").alias("label")))
        jump = nearer.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = settled(nearer.join(jump, "label").select("node", "old", F.least("label", "next").alias("label")))
        changed = after.where("old <> label").limit(1).count()
        labels = after.drop("old")
        if not changed:
            return labels
