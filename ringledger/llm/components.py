"""Connected components of a graph given as links between long keys."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringledger.operators.staging import staged


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every key in ``links`` (columns ``a, b``): the smallest key reachable.

    Each round takes the smallest label among the neighbours and then the label of that
    label, so the reach of a label doubles; rounds go on until none changes. Every round is
    written to the shared folder, which cuts lineage and survives lost executors; the driver
    reads one flag per round. Self links and repeated links do no harm; nulls are dropped. No
    links give no rows.
    """
    whole = links.where("a is not null and b is not null")
    both = whole.select("a", "b").union(whole.select(F.col("b"), F.col("a")))
    edges = staged(both.distinct(), "links")
    labels = staged(edges.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("a"), F.min("b")).alias("label")
    ), "labels")
    while True:
        near = labels.select(F.col("node").alias("b"), F.col("label").alias("seen"))
        lowest = edges.join(near, "b").groupBy(F.col("a").alias("node")).agg(
            F.min("seen").alias("low")
        )
        hooked = labels.join(lowest, "node").select(
            "node", "label", F.least("label", "low").alias("low")
        )
        beyond = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        moved = staged(hooked.join(beyond, "low").select(
            "node", F.col("far").alias("label"), (F.col("far") < F.col("label")).alias("moved")
        ), "labels")
        labels = moved.select("node", "label")
        if moved.where("moved").isEmpty():
            return labels
