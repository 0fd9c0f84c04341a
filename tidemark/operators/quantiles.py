"""Exact percentiles of groups of any size, at fixed memory: the interval that holds the wanted rank is cut into bins, counted with
partial aggregation, and narrowed to the one bin that holds the rank, until few enough values are left to be sorted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stored

BINS, FEW, PASSES = 256, 4096, 40


def exact_percentile(df: DataFrame, keys: list[str], value: str, q: float, name: str, bins: int = BINS, few: int = FEW) -> DataFrame:
    """Rows (keys, name): each group's q-th percentile, linear between ranks. Nulls and NaN don't count; a group without values is
    left out. A task holds the counts of its groups' bins, and in the end at most `few` values of a group; only a group whose
    values PASSES narrowings can't tell apart is sorted as it is."""
    rows = stored(df.select(*keys, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v")))
    rank = F.floor(q * (F.col("_n") - 1)).cast("long")
    first = rows.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    # _lo and _hi bound the values that may have the rank, _size of them after _below smaller ones; _after is the next larger value
    state = stored(first.select(*keys, "_n", "_lo", "_hi", rank.alias("_rank"), F.lit(0).cast("long").alias("_below"), F.col("_n").alias("_size"), F.lit(None).cast("double").alias("_after")))
    wide = (F.col("_size") > few) & (F.col("_lo") < F.col("_hi"))
    for _ in range(PASSES):
        if not state.where(wide).limit(1).count():
            break
        state = stored(_narrowed(rows, state.where(wide), keys, bins).unionByName(state.where(~wide)))
    return _read(rows, state, keys, q, name)


def _match(rows: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that may have their group's rank, with its state."""
    renamed = state.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in state.columns if c not in keys])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(renamed, same).where(F.col("_v").between(F.col("_lo"), F.col("_hi"))).drop(*[f"_k{i}" for i in range(len(keys))])


def _narrowed(rows: DataFrame, state: DataFrame, keys: list[str], bins: int) -> DataFrame:
    share = (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    nth = F.coalesce(F.least(F.floor(share * bins).cast("int"), F.lit(bins - 1)), F.lit(0))
    carried = ["_n", "_rank", "_below", "_after"]
    counted = _match(rows, state, keys).groupBy(*keys, nth.alias("_bin")).agg(F.count("*").alias("_size"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), *[F.first(c).alias(c) for c in carried])
    w = Window.partitionBy(*keys).orderBy("_bin")  # a row a bin
    before = F.coalesce(F.sum("_size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = counted.withColumns({"_smaller": F.col("_below") + before, "_next": F.coalesce(F.lead("_lo").over(w), F.col("_after"))})
    held = placed.where((F.col("_rank") >= F.col("_smaller")) & (F.col("_rank") < F.col("_smaller") + F.col("_size")))
    return held.select(*keys, "_n", "_lo", "_hi", "_rank", F.col("_smaller").cast("long").alias("_below"), "_size", F.col("_next").alias("_after"))


def _read(rows: DataFrame, state: DataFrame, keys: list[str], q: float, name: str) -> DataFrame:
    """The values at the rank and the next one, where few are left by sorting them."""
    one = state.where("_lo = _hi").select(*keys, "_n", "_rank", F.col("_lo").alias("_at"), F.when(F.col("_rank") + 1 < F.col("_below") + F.col("_size"), F.col("_lo")).otherwise(F.col("_after")).alias("_then"))
    left = _match(rows, state.where("_lo < _hi"), keys).withColumn("_nth", F.col("_below") + F.row_number().over(Window.partitionBy(*keys).orderBy("_v")) - 1)
    some = left.groupBy(*keys).agg(F.first("_n").alias("_n"), F.first("_rank").alias("_rank"), F.max(F.when(F.col("_nth") == F.col("_rank"), F.col("_v"))).alias("_at"), F.coalesce(F.max(F.when(F.col("_nth") == F.col("_rank") + 1, F.col("_v"))), F.first("_after")).alias("_then"))
    part = q * (F.col("_n") - 1) - F.col("_rank")
    return one.unionByName(some).select(*keys, F.when(part > 0, F.col("_at") + (F.col("_then") - F.col("_at")) * part).otherwise(F.col("_at")).alias(name))
