"""Connected components of a link table, without bringing links or components to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoweave.llm.common import stage, unstage

ROWS = 500_000


def connected(links: DataFrame) -> DataFrame:
    """(node, comp) for every node that occurs in the links (columns ``a`` and ``b``); comp is the least node reachable.

    Each round takes the least label of all neighbours, a sum that is combined before the shuffle, and then the label
    of that label, so long chains shrink by halves. Every round is written to the shared folder. It ends when a round
    changes nothing. Empty links give an empty result. Tables of labels have a file for each ``ROWS`` links, so that rounds over few
    links are few tasks, whatever the number of shuffle partitions.
    """
    files = 1 + links.count() // ROWS
    both = stage(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct().coalesce(files), "edges")
    labels = stage(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp")).coalesce(files), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("m"))
        step = labels.select("node", "comp").join(near.withColumnRenamed("a", "node"), "node").select("node", F.col("comp").alias("was"), F.least("comp", "m").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        new = stage(step.join(jump, "comp", "left").select("node", "was", F.least("comp", F.coalesce("further", "comp")).alias("comp")).coalesce(files), "labels")
        unstage(labels)
        labels = new
        if new.filter("comp <> was").isEmpty():
            unstage(both)
            return new.select("node", "comp")
