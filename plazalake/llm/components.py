"""Connected components of a link table, by minima and joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plazalake.llm.common import written

#: The number of rounds grows with the logarithm of the longest path; this is a guard.
MOST_ROUNDS = 100


def component_roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the smallest node reachable.

    Each node points to a smaller one of its component, or itself. A round moves every
    pointer to the smallest pointer among its neighbours', hooks the old target on it,
    and then follows pointers twice. A table is written each round, so lost executors cost one
    round at most; no list of neighbours is ever built.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.where("a <> b").distinct(), "links")
    to = written(
        edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")),
        "roots",
    )
    for _ in range(MOST_ROUNDS):
        ends = to.select(F.col("node").alias("b"), F.col("root").alias("b_root"))
        seen = edges.join(ends, "b").groupBy("a").agg(F.min("b_root").alias("seen"))
        near = to.join(seen, F.col("node") == F.col("a")).select(
            "node", "root", F.least("root", "seen").alias("least")
        )
        # What a tree's members see is also offered to the tree's root.
        hooks = near.groupBy(F.col("root").alias("node")).agg(F.min("least").alias("hook"))
        hooked = near.join(hooks, "node", "left").select(
            "node", "root", F.least("least", "hook").alias("next")
        )
        hooked = written(hooked, "roots")
        target = hooked.select(F.col("node").alias("next"), F.col("next").alias("beyond"))
        moved = written(
            hooked.join(target, "next").select("node", F.col("root").alias("old"), F.col("beyond").alias("root")),
            "roots",
        )
        to = moved.select("node", "root")
        if moved.where("old <> root").isEmpty():
            return to
    raise RuntimeError("components did not settle")
