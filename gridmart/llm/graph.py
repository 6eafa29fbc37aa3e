"""Connected components by label spreading and pointer jumping, in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: the smallest node that each node of ``edges`` reaches (itself included).

    Each round every node takes the smallest root among its own and its neighbours', then that
    root's root. Roots only fall, so a round that changes none ends it; stars and the like take two
    or three rounds, a chain of n nodes about log n. Rounds are written to the shared folder.
    """
    pairs = edges.select(F.col(a).alias("node"), F.col(b).alias("other"))
    pairs = pairs.where("node <> other")
    both = stored(pairs.unionByName(pairs.select(F.col("other").alias("node"), F.col("node").alias("other"))).dropDuplicates(), "edges")
    roots = stored(
        both.groupBy("node").agg(F.least("node", F.min("other")).alias("root")), "roots"
    )
    while True:
        seen = both.join(roots.select(F.col("node").alias("other"), "root"), "other")
        near = seen.groupBy("node").agg(F.min("root").alias("near"))
        lower = roots.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root")
        )
        # hooking: a root takes the smallest root that any node pointing at it has seen
        hooked = lower.groupBy(F.col("old").alias("node")).agg(F.min("root").alias("hook"))
        lower = lower.join(hooked, "node", "left").select(
            "node", "old", F.least("root", F.coalesce("hook", "root")).alias("root")
        )
        lower = stored(lower, "roots")
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("up"))
        jumped = lower.join(jump, "root").select("node", "old", F.col("up").alias("root"))
        jumped = stored(jumped, "roots")
        if jumped.where("root <> old").isEmpty():
            return jumped.select("node", "root")
        roots = jumped.select("node", "root")
