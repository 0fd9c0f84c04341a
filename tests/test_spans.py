"""Series in spans, exact percentiles and mergeable states against plain Python over whole series."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import quantiles, sketches, spans


def bars_of(spark, n=400, keys=("a", None), seed=3):
    rng = random.Random(seed)
    rows = [(k, i * 3, None if rng.random() < 0.1 else rng.gauss(100, 5), rng.choice("xyz") if rng.random() < 0.2 else "x") for k in keys for i in range(n)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, t long, x double, s string").withColumn("own_column", F.lit(1))


def in_order(rows, key):
    return sorted((r for r in rows if r[0] == key), key=lambda r: r[1])


def spanned(df, length, period=100):
    placed = spans.positioned(df, "k", "t", F.floor(F.col("t") / period))
    return placed.withColumn("span", spans.span_of("pos", length))


@pytest.mark.parametrize("length", [1, 7, 64, 1000])
def test_scans_equal_whole_series(spark, length):
    rows, df = bars_of(spark)
    out = spanned(df, length)
    out = spans.running_sums(out, "k", "pos", {"total": F.col("x"), "count": F.lit(1)})
    out = spans.ewm_means(out, "k", "pos", {"fast": (F.col("x"), 3), "slow": (F.col("x"), 30)})
    out = spans.run_lengths(out, "k", "pos", ["s"])
    got = {(r.k, r.t): r for r in out.collect()}
    assert len(got) == len(rows)
    for key in ("a", None):
        mine = in_order(rows, key)
        total, run, before, means = 0.0, 0, None, {"fast": [None, 0, 3], "slow": [None, 0, 30]}
        for i, (_, t, x, s) in enumerate(mine):
            r = got[(key, t)]
            total += x or 0.0
            run = run + 1 if s == before else 1
            before = s
            assert r.pos == i + 1 == r["count"] and r.run_length == run and r.total == pytest.approx(total, rel=1e-12)
            for name, m in means.items():
                if x is not None:
                    a = 2 / (m[2] + 1)
                    m[0], m[1] = x if m[0] is None else a * x + (1 - a) * m[0], m[1] + 1
                assert (r[name] is None) == (m[1] < m[2]) and (r[name] is None or r[name] == pytest.approx(m[0], rel=1e-9))


@pytest.mark.parametrize("length", [5, 64, 1000])
def test_halo_and_sorted_window(spark, length):
    rows, df = bars_of(spark)
    n = 23
    placed = spans.positioned(df, "k", "t", F.floor(F.col("t") / 100))
    w = spans.in_span("k", "pos")
    rolled = spans.with_halo(placed, "pos", n - 1, length).withColumn("most", F.max("x").over(w.rowsBetween(-(n - 1), 0))).where("own")
    counted = spans.trailing_below(placed, "k", "pos", {"below": "x"}, n, length)
    got, most = {(r.k, r.t): r.below for r in counted.collect()}, {(r.k, r.t): r.most for r in rolled.collect()}
    assert len(got) == len(most) == len(rows)
    for key in ("a", None):
        xs = [r[2] for r in in_order(rows, key)]
        for i, (_, t, x, _) in enumerate(in_order(rows, key)):
            last = [v for v in xs[max(0, i - n + 1) : i + 1] if v is not None]
            assert most[(key, t)] == (max(last) if last else None)
            assert got[(key, t)] == (None if x is None else sum(v < x for v in last))


def test_one_long_series_is_many_tasks(spark):
    n = 1_000_000
    df = spark.range(n).select(F.lit("one").alias("k"), F.col("id").alias("t"), (F.sin(F.col("id") / 50) + F.pmod(F.hash("id"), F.lit(1000)) / 1000).alias("x"))
    placed = spans.positioned(df, "k", "t", F.floor(F.col("t") / 50_000)).withColumn("span", spans.span_of("pos", 1024))
    out = spans.ewm_means(placed, "k", "pos", {"m": (F.col("x"), 26)})
    got = out.where("pos % 99991 = 0 or pos = 1000000").select("pos", "m").collect()
    x = df.orderBy("t").toPandas()["x"]
    want = x.ewm(span=26, adjust=False).mean()
    assert len(got) == 11 and all(r.m == pytest.approx(want[r.pos - 1], rel=1e-9) for r in got)
    assert placed.groupBy("k", "span").count().agg(F.max("count")).first()[0] == 1024  # no task holds more rows of a key at once


def test_sorted_window_splits_and_shrinks():
    rng = random.Random(1)
    w, last = spans.SortedWindow(3000), []
    for i in range(9000):
        x = rng.choice([rng.random(), 0.5, float("inf")])
        w.add(x)
        last = [*last[-2999:], x]
        if i % 500 == 0:
            assert w.below(0.5) == sum(v < 0.5 for v in last) and w.below(2.0) == sum(v < 2 for v in last)
    assert len(w.parts) > 2 and sum(map(len, w.parts)) == 3000


def test_percentiles_of_groups_of_all_kinds(spark):
    rng = np.random.default_rng(1)
    groups = {"even": rng.random(3000), "heavy": rng.normal(size=2001) ** 9, "few": rng.integers(0, 3, 4000).astype(float), "one": [5.0], "two": [1.0, 2.0], None: rng.random(50), "same": [7.0] * 900, "wide": 10.0 ** rng.integers(-300, 300, 800)}
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("even", None), ("nothing", None), ("even", float("nan"))]
    df = spark.createDataFrame(rows, "g string, x double")
    for q in (0.0, 0.333, 0.5, 0.55, 1.0):
        got = {r.g: r.p for r in quantiles.exact_percentile(df, ["g"], "x", q, "p", bins=8, few=10).collect()}
        assert got == pytest.approx({g: np.percentile(np.array(v), 100 * q) for g, v in groups.items()}, rel=1e-12)
    assert quantiles.exact_percentile(df.limit(0), ["g"], "x", 0.5, "p").count() == 0


def test_percentile_of_one_group_of_ten_million(spark):
    df = spark.range(10_000_000).select(F.lit(1).alias("g"), F.pmod(F.col("id") * 7919, F.lit(10_000_000)).cast("double").alias("x"))
    assert quantiles.exact_percentile(df, ["g"], "x", 0.55, "p").collect()[0].p == pytest.approx(0.55 * 9_999_999)


def test_states_merge_like_their_rows(spark):
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), F.pmod(F.hash("id"), F.lit(5000)).alias("d"), F.col("id").cast("double").alias("v"))
    names = {"sums": ["v"], "distinct": ["d"], "ranked": ["v"]}
    parts = [sketches.states(df.where(F.col("v") % 2 == i), ["g"], **names) for i in (0, 1)]
    both = sketches.merged(parts[0].unionByName(parts[1]), ["g"], **names)
    got = {r.g: r for r in sketches.figures(both, ["d"], ["v"], (0.1, 0.5, 0.9)).collect()}
    for r in df.groupBy("g").agg(F.count("*").alias("n"), F.sum("v").alias("v"), F.count_distinct("d").alias("d")).collect():
        assert (got[r.g].n, got[r.g].v) == (r.n, r.v) and abs(got[r.g].distinct_d - r.d) <= 0.08 * r.d
        assert [abs(got[r.g][f"p{p}_v"] / 20_000 - p / 100) < 0.03 for p in (10, 50, 90)] == [True] * 3
    assert sketches.figures(sketches.merged(parts[0].limit(0), ["g"], **names), ["d"], ["v"]).count() == 0
