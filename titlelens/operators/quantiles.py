"""Exact interpolated quantiles without holding any group's values in one place.

The built-in `percentile` keeps a map of all distinct values of a group in one buffer.  Here a
mergeable sketch first puts an edge to both sides of each quantile.  A second pass counts the
values in narrow bins between the edges, and the running counts tell which bin holds a wanted
rank.  A third pass tallies the values of those few bins; they are binned once more, and only
the values of one bin of a bin are put in order.  Ordered sets are bins (at most `BINS` for each
edge of a group), or some hundred-thousandth of the group's values near a quantile.  The passes
read the given frame each time, so a frame that is costly to compute should be stored before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titlelens.functions.hints import broadcast_if_small

BINS = 256
# So many values fit the buffers of the built-in function, whichever groups they are in.
HELD_VALUES = 1 << 20


def _bin(v: Column, low: Column, high: Column) -> Column:
    """The equal-width bin of a value between two others; never falls as the value rises."""
    place = F.floor(F.try_divide(v - low, high - low) * BINS)
    return F.coalesce(F.greatest(F.least(place, F.lit(BINS - 1)), F.lit(0)), F.lit(0))


def _ranked(rows: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """With [_start, _stop), the 0-based ranks of each row's `_rows` values within its group."""
    upto = Window.partitionBy(*by).orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (rows.withColumn("_stop", F.sum("_rows").over(upto))
            .withColumn("_start", F.col("_stop") - F.col("_rows")))


def _holding(rows: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """The row of each target that holds its rank, and the rank within that row."""
    held = (F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_stop"))
    return _ranked(rows, [*by, "_target"], order).filter(held).withColumn(
        "_rank", F.col("_rank") - F.col("_start"))


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str],
              max_groups: int | None = None, exact: bool = True, element: bool = False,
              accuracy: int = 10_000, also: Mapping[str, Column] | None = None,
              rows: int | None = None) -> DataFrame:
    """Per group the array `quantiles`, in the order of `probs`, and the aggregates in `also`.

    Covers all groups, or the `max_groups` largest (equal sizes in key order); only then are the
    groups' edges broadcast, if few enough.  `value` must be a double; its nulls count only in
    `also`, which may hold sums, means and the like that come as fixed-width numbers.  The keys
    must not be null.  Interpolates linearly between neighbours, or takes the lower `element`;
    with `exact=False` it returns the sketch's own elements.  `rows` says how many rows there
    are, if that is known: of few enough, the built-in functions find the same in one pass.
    """
    probs, by, also = list(probs), list(by), dict(also or {})
    carried = [aggregate.alias(name) for name, aggregate in also.items()]

    def largest(groups: DataFrame) -> DataFrame:
        if max_groups is None:
            return groups
        return groups.orderBy(F.desc("_n"), *by).limit(max_groups)

    def small(groups: DataFrame, times: int = 1) -> DataFrame:
        return groups if max_groups is None else broadcast_if_small(groups, max_groups * times)

    if not exact:
        sketch = F.percentile_approx(value, probs, accuracy).alias("quantiles")
        groups = df.groupBy(*by).agg(F.count(value).alias("_n"), sketch, *carried)
        return largest(groups).select(*by, "quantiles", *also)

    if rows is not None and rows <= HELD_VALUES:
        kind = "percentile_disc" if element else "percentile"
        order = f"WITHIN GROUP (ORDER BY `{value}`)"
        each = [F.expr(f"{kind}({p}) {order}" if element else f"{kind}(`{value}`, {p})")
                for p in probs]
        groups = df.groupBy(*by).agg(F.count(value).alias("_n"),
                                     F.array(*each).alias("quantiles"), *carried)
        return largest(groups).select(*by, "quantiles", *also)

    margin = 3 / accuracy  # three sketch errors to each side
    wanted = sorted({min(max(p + side, 0.0), 1.0) for p in probs for side in (-margin, margin)})
    groups = largest(df.groupBy(*by).agg(
        F.count(value).alias("_n"), F.percentile_approx(value, wanted, accuracy).alias("_edges"),
        *carried))
    edges = groups.select(*by, "_n", "_edges")

    def position(i: int) -> Column:
        if element:
            return F.greatest(F.ceil(F.col("_n") * probs[i]), F.lit(1)) - 1
        return (F.col("_n") - 1) * probs[i]

    # Two targets per quantile: the neighbours to both sides of its position.
    ranks = F.array(*[rounding(position(i)).cast("bigint") for i in range(len(probs))
                      for rounding in (F.floor, F.ceil)])
    targets = range(2 * len(probs))
    v = F.col(value)
    values = df.select(*by, value).filter(v.isNotNull())

    beyond = reduce(add, [(v >= F.col("_edges")[j]).cast("int") for j in range(len(wanted))])
    inner = _bin(v, F.get("_edges", F.col("_part") - 1), F.get("_edges", F.col("_part")))
    bins = (values.join(small(edges), by).withColumn("_part", beyond)
            .groupBy(*by, "_n", (F.col("_part") * BINS + inner).alias("_bin"))
            .agg(F.count("*").alias("_rows"), F.min(v).alias("_low"), F.max(v).alias("_high")))
    placed = _ranked(bins, by, "_bin").select(
        *by, "_start", "_stop", "_low", "_high", F.posexplode(ranks).alias("_target", "_rank"))
    first = placed.filter((F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_stop"))
                          ).select(*by, "_target", "_low", "_high",
                                   (F.col("_rank") - F.col("_start")).alias("_rank"))

    # The values of the bins found, counted; a bin of one value needs no look inside.
    spans = first.groupBy(*by).agg(*[
        F.max(F.when(F.col("_target") == t, F.col(side))).alias(f"{side}{t}")
        for t in targets for side in ("_low", "_high")])
    inside = reduce(or_, [F.coalesce(v.between(F.col(f"_low{t}"), F.col(f"_high{t}")), F.lit(False))
                          for t in targets])
    tally = (values.join(small(spans), by).filter(inside).groupBy(*by, v.alias("_v"))
             .agg(F.count("*").alias("_rows")))

    def within(spans: DataFrame) -> DataFrame:
        return tally.join(small(spans, len(targets)), by).filter(
            F.col("_v").between(F.col("_low"), F.col("_high")))

    again = (within(first).groupBy(*by, "_target", "_rank", _bin(
        F.col("_v"), F.col("_low"), F.col("_high")).alias("_bin"))
        .agg(F.sum("_rows").alias("_rows"), F.min("_v").alias("_low"), F.max("_v").alias("_high")))
    second = _holding(again, by, "_bin").select(*by, "_target", "_rank", "_low", "_high")
    found = _holding(within(second), by, "_v").groupBy(*by).agg(*[
        F.max(F.when(F.col("_target") == t, F.col("_v"))).alias(f"_v{t}") for t in targets])

    def between_neighbours(i: int) -> Column:
        lower, upper, at = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}"), position(i)
        return F.when(lower == upper, lower).otherwise(
            lower * (F.ceil(at) - at) + upper * (at - F.floor(at)))

    # A group without values keeps its row.
    return groups.drop("_edges").join(small(found), by, "left").select(
        *by, F.array(*map(between_neighbours, range(len(probs)))).alias("quantiles"), *also)
