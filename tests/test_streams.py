"""Streams of signals, bars and trades against plain batch results, with late, repeated and shuffled deliveries."""

import datetime as dt
import random

import pytest

from tidemark.streaming import bars

SCHEMA = "ticker string, ts timestamp, kind string, trade_id string, side string, target double, stop double, high double, low double, close double"
START = dt.datetime(2024, 1, 1)


def at(h):
    return START + dt.timedelta(hours=h)


def bar(ticker, h, high, low, close):
    return (ticker, at(h), "bar", None, None, None, None, high, low, close)


def signal(ticker, h, trade_id, side, target, stop):
    return (ticker, at(h), "signal", trade_id, side, target, stop, None, None, None)


def deliver(spark, tmp_path, deliveries, schema, build):
    """Rows that the stream gives over all deliveries, a run each, state kept in the checkpoint."""
    src, got = str(tmp_path / "in"), []
    for rows in deliveries:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        stream = build(bars.read(spark, src, spark.read.parquet(src).schema))
        bars.run_available(stream, str(tmp_path / "c"), lambda b, _: got.extend(b.collect()))
    return got


def test_trades_close_over_a_stream(spark, tmp_path):
    deliveries = [
        [signal("a", 0, "t1", "LONG", 11.0, 9.0), bar("a", 1, 10.5, 9.5, 10.0), signal("b", 0, "t2", "SHORT", 9.0, 11.0)],
        [bar("a", 2, 12.0, 8.0, 10.0), bar("b", 1, 10.5, 9.5, 10.0), bar("b", 2, 11.5, 9.5, 11.0), signal("b", 2, "t3", "LONG", 20.0, 5.0)],
        [bar("b", 3, 12.0, 11.0, 11.5), bar("b", 4, 12.0, 11.0, 11.7), bar("b", 5, 12.0, 11.0, 11.8)],
        [bar("c", 9, 1.0, 1.0, 1.0)],  # takes the watermark past them
    ]
    got = deliver(spark, tmp_path, deliveries, SCHEMA, lambda s: bars.closed_trades(s, hold=3))
    assert sorted((r.trade_id, r.exit_type, r.exit_price, r.bars_held) for r in got) == [("t1", "TARGET", 11.0, 2), ("t2", "STOP", 11.0, 2), ("t3", "TIME", 11.8, 3)]
    assert {r.trade_id: r.exit_ts for r in got} == {"t1": at(2), "t2": at(2), "t3": at(5)}


def outcome(sig, series, hold, longest):
    n, last, d = 0, None, 1 if sig[4] == "LONG" else -1
    for b in sorted(series, key=lambda b: b[1]):
        if not sig[1] < b[1] <= sig[1] + dt.timedelta(hours=longest):
            continue
        n, last = n + 1, b[9]
        best, worst = (b[7], b[8]) if d > 0 else (b[8], b[7])
        if d * (best - sig[5]) >= 0:
            return sig[3], b[1], "TARGET", sig[5], n
        if d * (worst - sig[6]) <= 0:
            return sig[3], b[1], "STOP", sig[6], n
        if n == hold:
            return sig[3], b[1], "TIME", last, n
    return sig[3], sig[1] + dt.timedelta(hours=longest), "EXPIRED", last, n


@pytest.mark.parametrize("shards", [1, 3])
def test_trades_do_not_depend_on_the_order_of_arrival(spark, tmp_path, shards):
    rng = random.Random(shards)
    series, signals = {}, []
    for t in ("a", "b", "hot"):
        p, series[t] = 100.0, []
        for h in range(60):
            p += rng.uniform(-1, 1)
            if rng.random() < 0.8 and not (t == "b" and h > 20):  # b stops trading: its last trades expire
                series[t].append(bar(t, h, p + rng.random(), p - rng.random(), p))
        for i in range(25 if t == "hot" else 6):
            h, d = rng.uniform(0, 50 if t != "b" else 20), rng.choice([1, -1])
            signals.append(signal(t, h, f"{t}{i}", "LONG" if d > 0 else "SHORT", 100.0 + 3 * d, 100.0 - 4 * d))
    rows = [b for s in series.values() for b in s] + signals
    want = sorted(outcome(s, series[s[0]], 8, 30) for s in signals)
    rows.sort(key=lambda r: r[1] + dt.timedelta(hours=rng.uniform(0, 4)))  # late by less than the watermark allows
    cut = len(rows) // 3
    odd = [(None, at(1), "bar", None, None, None, None, 1.0, 1.0, 1.0), ("a", None, "bar", None, None, None, None, 1.0, 1.0, 1.0), ("a", at(1), "signal", None, "LONG", 1.0, 1.0, None, None, None), ("a", at(1), "note", "x", None, None, None, None, None, None)]
    deliveries = [rows[:cut] + odd, rows[cut - 8 : 2 * cut], rows[2 * cut :], [bar("z", 99, 1.0, 1.0, 1.0)], [bar("a", 3, 999.0, 0.0, 1.0), bar("z", 100, 1.0, 1.0, 1.0)]]  # eight rows twice, one far too late
    got = deliver(spark, tmp_path, deliveries, SCHEMA, lambda s: bars.closed_trades(s, hold=8, late="5 hours", longest="30 hours", shards=shards))
    assert sorted((r.trade_id, r.exit_ts, r.exit_type, r.exit_price, r.bars_held) for r in got) == want
    assert {w[2] for w in want} == {"TARGET", "STOP", "TIME", "EXPIRED"}


def test_signals_join_bars_as_in_batch(spark, tmp_path):
    one, two = "ticker string, t_end timestamp, trade_id string, close double", "ticker string, ts timestamp, high double, low double, close double"
    rng = random.Random(5)
    price = lambda t, h: (t, at(h), 10.0 + h, 9.0 - h, rng.random())
    sig = [("a", at(1.5), "s1", 1.0), ("a", at(6.2), "s2", 2.0), ("b", at(2), "s3", 3.0), ("q", at(3), "s4", 4.0), (None, at(3), "s5", 5.0)]
    prices = [price(t, h) for h in range(16) for t in ("a", "b")]
    late = [p for p in prices if p[0] == "a" and p[1] == at(4)]
    first = [p for p in prices if p[1] <= at(5) and p not in late]
    second = [p for p in prices if at(5) < p[1] <= at(10)] + late  # late, within the watermark
    third = [p for p in prices if p[1] > at(10)] + [("a", at(2), 0.0, 0.0, 0.0)]  # beyond it: the lesser watermark, the signals', is past 2:00
    end = [("z", at(60), 1.0, 1.0, 1.0)]
    a, b = str(tmp_path / "signals"), str(tmp_path / "bars")
    got, hits = [], []
    for part, near in [(sig[:3], first), (sig[3:], second), ([], third), ([("z", at(60), "end", 0.0)], end), ([("z", at(61), "end2", 0.0)], [("z", at(61), 1.0, 1.0, 1.0)])]:
        spark.createDataFrame(part, one).coalesce(1).write.mode("append").parquet(a)
        spark.createDataFrame(near, two).coalesce(1).write.mode("append").parquet(b)
        join = lambda: bars.signals_with_bars(bars.read(spark, a, spark.read.parquet(a).schema), bars.read(spark, b, spark.read.parquet(b).schema), "4 hours", "4 hours", "2 hours")
        bars.run_available(join(), str(tmp_path / "c"), lambda d, _: got.extend(d.collect()))
        bars.run_available(bars.first_hits(join(), "2 hours"), str(tmp_path / "d"), lambda d, _: hits.extend(d.collect()))
    have = sorted((r.trade_id, r.ts or at(0), r.close, r.bar_close or 0.0) for r in got if not r.trade_id.startswith("end"))
    want = [(s[2], p[1], s[3], p[4]) for s in sig for p in prices if s[0] == p[0] and s[1] < p[1] <= s[1] + dt.timedelta(hours=4)]
    want += [(s, at(0), c, 0.0) for s, c in (("s4", 4.0), ("s5", 5.0))]
    assert have == sorted(want)
    by = {}
    for s, ts, _, close in want[:-2]:
        by.setdefault((s, START + (ts - START) // dt.timedelta(hours=2) * dt.timedelta(hours=2)), []).append((ts, close))
    assert sorted((r.trade_id, r.from_ts, r.bars, r.first_close, r.last_close) for r in hits) == sorted((*k, len(v), min(v)[1], max(v)[1]) for k, v in by.items())


def test_replaced_epochs_go(spark, tmp_path):
    path = str(tmp_path / "t")
    merge = bars.keep_newest(path, ["k"], "v", buckets=4)
    for epoch in range(3):
        merge(spark.createDataFrame([(k, epoch * 10 + k) for k in range(0, 12, epoch + 1)], "k int, v int"), epoch)
    before = sorted(map(tuple, bars.read_merged(spark, path).select("k", "v").collect()))
    assert bars.prune_epochs(spark, path) > 0 and bars.prune_epochs(spark, path) == 0
    assert sorted(map(tuple, bars.read_merged(spark, path).select("k", "v").collect())) == before
    assert [(k, v) for k, v in before][:4] == [(0, 20), (1, 1), (2, 12), (3, 23)]
