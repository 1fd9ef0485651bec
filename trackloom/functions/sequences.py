"""Islands, runs and flips over ordered rows, with window functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Lengths of the stretches that islands() cuts time into, in seconds and in frames; they change no result.
STRETCH_SEC, STRETCH_FRAMES = 64.0, 1024
#: What islands() needs beside the columns of its input.
_STRETCH, _COPY, _OPENS, _BASE = "_stretch", "_copy", "_opens", "_base"


def _in_stretches(df: DataFrame, keys: list[str], start: str, end: str, gap: float, ties: list[str], stretch: float) -> DataFrame:
    """df with _stretch, _opens and the running number of openings in the stretch as `island`; 0 goes on from the stretch before.

    Each stretch of time is a window of its own, in which intervals from earlier stretches that reach into it lie as
    copies, so whether an interval opens an island is known there. An interval is copied to every stretch it
    reaches: stretches should not be far shorter than intervals.
    """
    at = lambda c: F.floor(c / F.lit(stretch)).cast("long")
    low = at(F.col(start))
    high = F.greatest(low, at(F.col(end) + gap))
    spread = df.withColumn(_STRETCH, F.explode_outer(F.sequence(low, high))).withColumn(_COPY, F.coalesce(F.col(_STRETCH) > low, F.lit(False)))
    order = Window.partitionBy(*keys, _STRETCH).orderBy(start, end, *ties)
    reached = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(~F.col(_COPY) & (reached.isNull() | (F.col(start) > reached + gap)), 1).otherwise(0)
    marked = spread.withColumn(_OPENS, opens)
    return marked.withColumn("island", F.sum(_OPENS).over(order.rowsBetween(Window.unboundedPreceding, 0))).where(~F.col(_COPY)).drop(_COPY)


def islands(df: DataFrame, keys: list[str], start: str, end: str, gap: float, ties: list[str], stretch: float) -> DataFrame:
    """Numbers the groups of intervals that overlap or lie within `gap` of what came before; column `island`, from 1 for each key.

    A prefix scan, so that a key with most of the rows is shared by all tasks: openings are found stretch by
    stretch, their numbers, a row for each stretch, are added up along each key and joined back. df is read twice.
    The length of the stretches changes no result. Intervals without a start are islands of their own only where
    they come first.
    """
    marked = _in_stretches(df, keys, start, end, gap, ties, stretch)
    along = Window.partitionBy(*keys).orderBy(_STRETCH).rowsBetween(Window.unboundedPreceding, -1)
    sums = marked.groupBy(*keys, _STRETCH).agg(F.sum(_OPENS).alias(_OPENS))
    other = {k: f"_{k}_{i}" for i, k in enumerate([*keys, _STRETCH])}
    base = sums.select(*[F.col(k).alias(v) for k, v in other.items()], F.coalesce(F.sum(_OPENS).over(along), F.lit(0)).alias(_BASE))
    same = [F.col(k).eqNullSafe(F.col(v)) for k, v in other.items()]
    both = marked.join(base, same)
    return both.select(*df.columns, (F.col("island") + F.col(_BASE)).cast("long").alias("island"))


def merged_islands(df: DataFrame, keys: list[str], start: str, end: str, gap: float, ties: list[str], stretch: float, parts: dict[str, Column], whole: dict[str, Column]) -> DataFrame:
    """(keys, island, *whole): aggregates of the islands that islands() numbers, with df read once.

    parts aggregate the rows of an island within a stretch, whole the parts of an island. Only parts are numbered
    along a key: they lie more than `gap` apart or in different stretches, so a key's length bounds how many there
    are, whatever the number of rows.
    """
    local = _in_stretches(df, keys, start, end, gap, ties, stretch).groupBy(*keys, _STRETCH, "island").agg(*[c.alias(k) for k, c in parts.items()])
    opened = F.sum(F.when(F.col("island") > 0, 1).otherwise(0)).over(Window.partitionBy(*keys).orderBy(_STRETCH, "island"))
    numbered = local.withColumn(_BASE, opened.cast("long"))
    return numbered.groupBy(*keys, F.col(_BASE).alias("island")).agg(*[c.alias(k) for k, c in whole.items()])


def runs(df: DataFrame, keys: list[str], order: str, state: str) -> DataFrame:
    """One row for each run of equal states: keys, state, first, last, n."""
    w = Window.partitionBy(*keys).orderBy(order)
    changed = F.when(F.lag(state).over(w).eqNullSafe(F.col(state)), 0).otherwise(1)
    numbered = df.withColumn("_changed", changed).withColumn("_run", F.sum("_changed").over(w))
    out = numbered.groupBy(*keys, "_run").agg(F.first(state).alias(state), F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("n"))
    return out.drop("_run")


def flips(df: DataFrame, keys: list[str], order: str, state: str, min_hits: int) -> DataFrame:
    """Where the state changes for good: runs shorter than min_hits are dropped, equal neighbours are one again, and the first run is no change."""
    long = runs(df, keys, order, state).where(F.col("n") >= min_hits)
    before = F.lag(state).over(Window.partitionBy(*keys).orderBy("first"))
    return long.withColumn("_before", before).where(F.col("_before").isNotNull() & (F.col("_before") != F.col(state))).select(*keys, F.col("first").alias(order), state)
