"""Exact order statistics in two passes, without a shuffle of all distinct values.

A KLL sketch of each feature gives a value range for every rank that is asked for.
The second pass counts rows below, between and inside these ranges, and keeps values
only inside them: some thousandths of the rows for each rank. Whether a range holds
its rank is known from the counts; if one doesn't, all are widened and counted again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.constants import PSI_BUCKETS, PSI_EPSILON
from txlake.operators.drift import _strictly_rising
from txlake.operators.ordered import unpivoted
from txlake.sources import shared

#: Size of a sketch, and how far from its answer a rank is looked for at first, as a share of all rows.
SKETCH_K = 8192
MARGIN = 0.002
RANGES = "feature STRING, lows ARRAY<DOUBLE>, highs ARRAY<DOUBLE>"
ASKED = "feature STRING, slot INT, inside BIGINT, rank BIGINT"


def _ranges(cells: DataFrame, ranks: dict[str, list[int]], totals: dict[str, int], margin: float) -> dict[str, list[tuple]]:
    """For each feature ranges that don't overlap, in order; an open end is infinite."""
    sketch = F.kll_sketch_agg_double("value", F.lit(SKETCH_K))
    shares = sorted({min(max(r / n + d, 0.0), 1.0) for f, n in totals.items() for r in ranks[f] for d in (-margin, margin)})
    rows = cells.where(~F.isnan("value")).groupBy("feature").agg(sketch.alias("sketch"))
    at = F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, shares)))
    found: dict[str, list[tuple]] = {}
    known = {r.feature: dict(zip(shares, r.at, strict=True)) for r in rows.select("feature", at.alias("at")).collect()}
    for feature, n in totals.items():
        value = known.get(feature, {})
        ends = []
        for r in ranks[feature]:
            low, high = r / n - margin, r / n + margin
            ends.append((value.get(low, float("-inf")) if low > 0 else float("-inf"), value.get(high, float("nan")) if high < 1 else float("nan")))
        merged: list[tuple] = []
        for low, high in sorted(ends, key=lambda e: e[0]):
            if merged and _reaches(merged[-1][1], low):
                merged[-1] = (merged[-1][0], _higher(merged[-1][1], high))
            else:
                merged.append((low, high))
        found[feature] = merged
    return found


def _reaches(high: float, low: float) -> bool:
    return high != high or low <= high  # NaN stands last, as in Spark


def _higher(a: float, b: float) -> float:
    return a if a != a or a >= b else b


def _counted(cells: DataFrame, ranges: dict[str, list[tuple]]) -> DataFrame:
    """``feature, slot, value, n``: the slot-th range with its values, and with a null value what lies behind it."""
    table = [(f, [x[0] for x in r], [x[1] for x in r]) for f, r in ranges.items()]
    ends = cells.sparkSession.createDataFrame(table, RANGES)
    slot = F.size(F.filter("lows", lambda low: low <= F.col("value")))
    rows = cells.join(F.broadcast(ends), "feature").withColumn("slot", slot)
    inside = (F.col("slot") > 0) & (F.col("value") <= F.get("highs", F.col("slot") - 1))
    kept = rows.select("feature", "slot", F.when(inside, F.col("value")).alias("value"))
    return kept.groupBy("feature", "slot", "value").agg(F.count(F.lit(1)).alias("n"))


def values_at_ranks(cells: DataFrame, ranks_of: Callable[[int], Sequence[int]], margin: float = MARGIN) -> DataFrame:
    """``feature, total, rank, value``: the values at 0-based ranks of each feature of ``cells(feature, value)``.

    ``ranks_of`` names the ranks for a number of rows. Nulls are left out, NaN sorts
    last; a feature without values has no rows. What comes to the driver are a few
    numbers for each feature and rank.
    """
    spark = cells.sparkSession
    cells = cells.where("value IS NOT NULL").select("feature", F.col("value").cast("double").alias("value"))
    totals = {r.feature: r.n for r in cells.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    ranks = {f: sorted({r for r in ranks_of(n) if 0 <= r < n}) for f, n in totals.items()}
    while True:
        counted = shared.stage(_counted(cells, _ranges(cells, ranks, totals, margin)), "ranges")
        sums = counted.groupBy("feature", "slot").agg(
            F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("inside"),
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("behind"),
        )
        held: dict[str, list[tuple]] = {}
        for r in sums.orderBy("feature", "slot").collect():
            held.setdefault(r.feature, []).append((r.slot, r.inside, r.behind))
        asked, whole = [], True
        for feature, wanted in ranks.items():
            for rank in wanted:
                below, met = 0, False
                for slot, inside, behind in held[feature]:
                    if below <= rank < below + inside:
                        asked.append((feature, slot, rank - below, rank))
                        met = True
                    below += inside + behind
                whole = whole and met
        if whole:
            break
        shared.discard(counted)
        margin = min(1.0, 4 * margin)
    order = Window.partitionBy("feature", "slot").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.where("value IS NOT NULL").withColumn("so_far", F.sum("n").over(order))
    wanted = F.broadcast(spark.createDataFrame(asked, ASKED))  # one row for each feature and rank
    found = placed.join(wanted, ["feature", "slot"]).where(F.col("so_far") > F.col("inside"))
    sizes = F.broadcast(spark.createDataFrame(list(totals.items()), "feature STRING, total BIGINT"))
    return found.groupBy("feature", "rank").agg(F.min("value").alias("value")).join(sizes, "feature").select("feature", "total", "rank", "value")


def deciles(df: DataFrame, features: Sequence[str], places: int = 6) -> DataFrame:
    """``ordered.deciles`` by value ranges: ``feature, decile, value``, interpolated between neighbouring ranks."""

    def position(q: int, last: Column) -> Column:
        return F.lit(q / 10) * last

    def ranks_of(n: int) -> list[int]:
        at = [(q / 10) * (n - 1) for q in range(11)]
        return [int(x) for x in at] + [-int(-x // 1) for x in at]

    found = shared.stage(values_at_ranks(unpivoted(df, features), ranks_of), "ranks")
    lines = F.explode(F.array(*[F.struct(F.lit(q).alias("decile"), position(q, F.col("total") - 1).alias("at")) for q in range(11)]))
    wanted = found.select("feature", "total").distinct().select("feature", lines.alias("d")).select("feature", "d.decile", "d.at")
    low = found.select("feature", F.col("rank").alias("low_rank"), F.col("value").alias("low"))
    high = found.select("feature", F.col("rank").alias("high_rank"), F.col("value").alias("high"))
    wanted = wanted.withColumn("low_rank", F.floor("at")).withColumn("high_rank", F.ceil("at"))
    both = wanted.join(low, ["feature", "low_rank"]).join(high, ["feature", "high_rank"])
    value = F.col("low") + (F.col("high") - F.col("low")) * (F.col("at") - F.floor("at"))
    return both.select("feature", "decile", F.round(value, places).alias("value"))


def quantile_edges(reference: DataFrame, features: Sequence[str], buckets: int = PSI_BUCKETS) -> DataFrame:
    """``feature, total, edges``: the PSI edges of ``drift.feature_drift``, rising strictly."""

    def ranks_of(n: int) -> list[int]:
        return [min(n - 1, round(i / buckets * (n - 1))) for i in range(buckets)] + [n - 1]

    found = values_at_ranks(unpivoted(reference, features), ranks_of)
    last = F.col("total") - 1
    places = F.array(*[F.least(last, F.bround(F.lit(i / buckets) * last).cast("long")) for i in range(buckets)], last)
    by_rank = found.groupBy("feature", "total").agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("at"))
    edges = F.transform(places, lambda r: F.element_at("at", r))
    return by_rank.select("feature", "total", _strictly_rising(edges).alias("edges"))


def population_stability_index(
    reference: DataFrame, live: DataFrame, features: Sequence[str], buckets: int = PSI_BUCKETS
) -> DataFrame:
    """``feature, psi`` like ``drift.feature_drift``; both sides are only counted by bucket. An empty side gives 0."""
    edges = shared.stage(quantile_edges(reference, features, buckets), "edges")

    def counts(side: DataFrame, name: str) -> DataFrame:
        cells = unpivoted(side, features).where("value IS NOT NULL").join(F.broadcast(edges), "feature")
        above = [(F.col("value") > F.get("edges", F.lit(i))).cast("int") for i in range(1, buckets)]
        return cells.groupBy("feature", reduce(add, above, F.lit(0)).alias("bucket")).agg(F.count(F.lit(1)).alias(name))

    slots = edges.select("feature", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket"))
    both = slots.join(counts(reference, "ref"), ["feature", "bucket"], "left").join(counts(live, "live"), ["feature", "bucket"], "left")
    both = both.where("ref IS NOT NULL OR live IS NOT NULL").fillna(0, ["ref", "live"])
    of_feature = Window.partitionBy("feature")
    for name in ("ref", "live"):
        share = F.col(name) / F.nullif(F.sum(name).over(of_feature), F.lit(0))
        both = both.withColumn(f"{name}_share", F.when(share.isNotNull(), F.greatest(share, F.lit(PSI_EPSILON))))
    term = (F.col("live_share") - F.col("ref_share")) * F.log(F.col("live_share") / F.col("ref_share"))
    measured = both.groupBy("feature").agg(F.sum(term).alias("psi"))
    asked = live.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, features))).alias("feature"))
    return asked.join(measured, "feature", "left").select("feature", F.coalesce("psi", F.lit(0.0)).alias("psi"))
