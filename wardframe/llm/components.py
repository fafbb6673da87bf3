"""Connected components of a link table, by contraction.

In each round every node takes the first id among itself and its neighbours,
links are rewritten to those ids and merged, and the round's renaming is kept.
The order of ids is that of a hash, another one in each round, so the number of
nodes that still have links falls by a constant factor per round, also along
chains. At the end the renamings are applied one after the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardframe.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """Rows (node, root) for every node of ``links``, which has columns a and b.

    Two nodes have the same root if a path of links joins them. Links may
    repeat and run in either direction; a link from a node to itself is none.
    Each round is written to the shared folder, and only the number of links
    left reaches the driver. A node with very many links is split over tasks by
    the joins, whose other side has one row per node.
    """
    ids = links.select("a", "b").filter("a <> b")
    pairs = stored(
        ids.unionByName(ids.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    renamings = []
    while not pairs.isEmpty():
        turn = F.lit(len(renamings))
        own, other = [F.struct(F.xxhash64(c, turn).alias("h"), F.col(c).alias("id")) for c in "ab"]
        first = pairs.groupBy("a").agg(F.min(other).alias("first"))
        renamed = stored(
            first.select(F.col("a").alias("node"), F.least(own, "first")["id"].alias("root")), "renamed"
        )
        renamings.append(renamed)
        ends = []
        for side in ("a", "b"):
            ends.append(renamed.withColumnsRenamed({"node": side, "root": f"{side}_root"}))
        pairs = stored(
            pairs.join(ends[0], "a")
            .join(ends[1], "b")
            .filter("a_root <> b_root")
            .select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
            .distinct(),
            "links",
        )
    if not renamings:
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = renamings[0]
    for later in renamings[1:]:
        later = later.select(F.col("node").alias("root"), F.col("root").alias("later"))
        found = found.join(later, "root", "left").select(
            "node", F.coalesce("later", "root").alias("root")
        )
    return found
