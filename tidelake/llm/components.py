"""Connected components of a stored edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``links`` (a long, b long) -> (node, comp): comp is the smallest node reachable.  Each
    round takes the least label among neighbours, then replaces a label by that label's own, so
    long chains halve; tables are written between rounds, nothing is collected but a count."""
    both = stored(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                    .select("node", F.least("node", "m").alias("comp")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "comp"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near")))
        step = labels.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "near").alias("c"))
        step = stored(step, "labels")
        jump = step.select(F.col("node").alias("c"), F.col("c").alias("comp"))
        after = stored(step.join(jump, "c").select("node", "old", "comp"), "labels")
        changed = after.where("comp <> old").limit(1).count()
        labels = after.select("node", "comp")
        if not changed:
            return labels
