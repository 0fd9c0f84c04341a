"""Aggregate states that can be kept and merged: counts, sums, distinct counts (HyperLogLog) and quantiles (KLL) of a delivery per key,
a few kilobytes a key whatever the number of rows. A summary of many deliveries merges their states and reads no row again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12  # 4096 registers: a distinct count is within 1.6 % in two of three cases, within 5 % in 99.7 %
KLL_K = 200  # a quantile's rank is within 1.7 % of the asked one in 99 % of cases


def states(df: DataFrame, keys: list[str], sums: list[str] = (), distinct: list[str] = (), ranked: list[str] = ()) -> DataFrame:
    """Rows (keys, n, sums, d_<column>, q_<column>) of one delivery; nulls count in n alone."""
    sketches = [F.hll_sketch_agg(c, LG_K).alias(f"d_{c}") for c in distinct] + [F.kll_sketch_agg_double(F.col(c).cast("double"), KLL_K).alias(f"q_{c}") for c in ranked]
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in sums], *sketches)


def merged(parts: DataFrame, keys: list[str], sums: list[str] = (), distinct: list[str] = (), ranked: list[str] = ()) -> DataFrame:
    """One state per key out of several; merging merged ones changes nothing."""
    sketches = [F.hll_union_agg(f"d_{c}").alias(f"d_{c}") for c in distinct] + [F.kll_merge_agg_double(f"q_{c}").alias(f"q_{c}") for c in ranked]
    return parts.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in sums], *sketches)


def figures(state: DataFrame, distinct: list[str] = (), ranked: list[str] = (), quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
    """The states read out: distinct_<column>, and p<percent>_<column> for each quantile."""
    out = {f"distinct_{c}": F.hll_sketch_estimate(f"d_{c}") for c in distinct}
    out |= {f"p{round(100 * q)}_{c}": F.kll_sketch_get_quantile_double(f"q_{c}", F.lit(q)) for c in ranked for q in quantiles}
    return state.withColumns(out).drop(*[f"d_{c}" for c in distinct], *[f"q_{c}" for c in ranked])
