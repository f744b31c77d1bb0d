"""Connected components by repeated contraction, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` for every node of ``edges``; the label is one node of the component.

    Each round points every node at its smallest neighbour (or itself), follows
    the pointer once more and contracts the edges; the rest shrinks by a factor
    each round. Every round is written to the shared folder. Null ends and loops
    are not edges.
    """
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    e = staged(e.union(e.select("b", "a")).distinct(), "edges")
    labels = None
    while True:
        to = e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("to"))
        if labels is not None and e.isEmpty():
            return labels
        to = staged(to, "pointers")
        jump = staged(to.join(to.select(F.col("node").alias("to"), F.col("to").alias("next")), "to")
                      .select("node", F.col("next").alias("to")), "jumps")
        if labels is None:
            labels = jump.select("node", F.col("to").alias("label"))
        else:
            labels = staged(labels.join(jump.select(F.col("node").alias("label"), "to"), "label", "left")
                            .select("node", F.coalesce("to", "label").alias("label")), "labels")
        e = staged(e.join(jump.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
                   .join(jump.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
                   .where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
