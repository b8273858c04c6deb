"""Connected components of an edge table, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.sources.shared import discard, stage

#: Far more than any graph needs whose components halve each round.
MOST_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id of its component) for every id in ``edges(a long, b long)``.

    Each round every root takes the smallest root next to it as its parent, parents
    are followed to their end, and edges inside one tree go. Edges with a null end
    or with both ends equal link nothing. What a round leaves is a table in the
    shared folder, so nothing grows on the driver and no lineage builds up.
    """
    pairs = edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct()
    pairs = stage(pairs, "edges")
    parents: list[DataFrame] = []
    for _ in range(MOST_ROUNDS):
        if pairs.isEmpty():
            break
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stage(
            both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("up")), "parents"
        )
        parent = _rooted(parent)
        parents.append(parent)
        a = parent.select(F.col("id").alias("a"), F.col("up").alias("ra"))
        b = parent.select(F.col("id").alias("b"), F.col("up").alias("rb"))
        before, pairs = pairs, stage(
            pairs.join(a, "a").join(b, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(),
            "edges",
        )
        discard(before)
    else:
        raise RuntimeError("components did not settle")
    discard(pairs)
    if not parents:
        return edges.sparkSession.createDataFrame([], "id long, component long")
    result = parents[0].withColumnRenamed("up", "component")
    for parent in parents[1:]:
        up = parent.select(F.col("id").alias("component"), "up")
        result = result.join(up, "component", "left").select("id", F.coalesce("up", "component").alias("component"))
    if len(parents) == 1:
        return result
    result = stage(result, "components")
    for parent in parents:
        discard(parent)
    return result


def _rooted(parent: DataFrame) -> DataFrame:
    """Follow parents to the root of each tree; the way halves with each step."""
    for _ in range(MOST_ROUNDS):
        over = parent.select(F.col("id").alias("up"), F.col("up").alias("top"))
        jumped = stage(
            parent.join(over, "up").select("id", F.col("top").alias("up"), (F.col("top") != F.col("up")).alias("moved")), "parents"
        )
        discard(parent)
        parent = jumped.select("id", "up")
        if jumped.where("moved").isEmpty():
            return parent
    raise RuntimeError("parents did not settle")
