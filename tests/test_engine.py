"""Kernels against closed forms and hand-made series, sources and streams on small tables, queries against their SQL."""

import datetime as dt

import duckdb
import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.functions import dates, pricing, text
from tidemark.operators import rows, series
from tidemark.plans import models, registry, star, validation
from tidemark.sources import io
from tidemark.streaming import bars

D = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{D}/{t}.parquet'")
    return c


def plain(v):
    return repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_its_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, D)
    res = duck.execute(registry.ORACLES[name])
    names = [x[0] for x in res.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted(tuple(plain(r[names.index(c)]) for c in sorted(names)) for r in res.fetchall())
    have = sorted(tuple(plain(r[c]) for c in sorted(names)) for r in got.collect())
    assert have == want


def test_entry_and_registry(spark):
    assert entry.entry(spark).limit(1).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_closed_form_prices(spark):
    s, k, t, r, v = (F.lit(float(x)) for x in (100, 100, 1, 0.05, 0.2))
    call, put = F.lit("Call"), F.lit("Put")
    x = one(spark, c=pricing.price(call, s, k, t, r, v), p=pricing.price(put, s, k, t, r, v), d=pricing.delta(call, s, k, t, r, v), g=pricing.gamma(s, k, t, r, v), vg=pricing.vega(s, k, t, r, v), th=pricing.theta(call, s, k, t, r, v), rh=pricing.rho(call, s, k, t, r, v))
    assert [x.c, x.p, x.d, x.g, x.vg, x.th, x.rh] == pytest.approx([10.450584, 5.573526, 0.636831, 0.018762, 0.375240, -0.017573, 0.532325], abs=2e-5)
    y = one(spark, dead=pricing.price(call, s, k, F.lit(0.0), r, v), far=pricing.price(put, s, F.lit(2000.0), t, r, v), q=pricing.price_with_yield(call, s, k, t, r, v, F.lit(0.0)), ok=pricing.is_valid(s, F.lit(0.05), t, v))
    assert y.dead == 0 and y.far == 1900 and y.q == pytest.approx(10.450584, abs=1e-4) and y.ok is False


def test_implied_volatility_reprices(spark):
    df = star.priced(registry_chain(spark)).where("iv_ok")
    assert df.count() > 1000
    assert df.agg(F.max(F.abs(F.col("repriced") - F.col("last_price")))).first()[0] < 1e-4
    none = [pricing.implied_vol(F.lit(kind), *(F.lit(x) for x in args)) for kind, *args in (("Call", 150.0, 100.0, 100.0, 1.0, 0.05), ("Call", 0.0, 100.0, 100.0, 1.0, 0.05), ("Put", 5.0, 100.0, 105.0, 0.0, 0.05), ("Put", 5.0, 100.0, 105.0, 0.01, 0.0))]
    assert [x is None for x in one(spark, **{f"x{i}": c for i, c in enumerate(none)})] == [True] * 4  # dear, free, expired, worth its exercise alone
    null = spark.createDataFrame([(None,)], "p double").select(pricing.implied_vol(F.lit("Call"), F.col("p"), F.lit(100.0), F.lit(100.0), F.lit(1.0), F.lit(0.05)).alias("v"))
    assert null.first().v is None


def registry_chain(spark):
    from tidemark.sources import adapters

    return adapters.load(spark, D, "option_chain").drop("delta", "gamma", "vega")


def test_calendar_helpers(spark):
    days = [(dt.date(2025, 12, 1),), (dt.date(2025, 12, 19),), (dt.date(2025, 12, 20),), (dt.date(2024, 2, 29),)]
    df = spark.createDataFrame(days, "d date").select(dates.third_friday(F.col("d")).alias("f"), dates.next_opex(F.col("d")).alias("n"), dates.week_friday(F.col("d")).alias("w"), dates.dow0(F.col("d")).alias("o"), dates.quarter_end(F.col("d")).alias("q"))
    x = df.collect()
    assert [r.f for r in x] == [dt.date(2025, 12, 19)] * 3 + [dt.date(2024, 2, 16)]
    assert x[2].n == dt.date(2026, 1, 16) and x[2].w == dt.date(2025, 12, 19) and x[0].o == 1 and x[3].q == dt.date(2024, 3, 31)
    at = spark.createDataFrame([("2024-03-31 02:30:00",), ("2024-10-27 02:30:00",), ("2024-10-27 12:00:00",)], "s string").select(F.to_timestamp("s").alias("t"))
    z = at.select(dates.is_gap_time(F.col("t"), "Europe/Amsterdam").alias("g"), dates.is_double_time(F.col("t"), "Europe/Amsterdam").alias("d")).collect()
    assert [(r.g, r.d) for r in z] == [(True, False), (False, True), (False, False)]


def test_dutch_texts(spark):
    cases = ["1.234,56", "12,5", "-1.000,00", "n.v.t.", "", "12.5%"]
    got = [r[0] for r in spark.createDataFrame([(c,) for c in cases], "t string").select(text.parse_number(F.col("t"))).collect()]
    assert got == [1234.56, 12.5, -1000.0, None, None, 125.0]
    x = one(spark, e=text.parse_expiry(F.lit("December 2025 (AEX / AH)")), b=text.parse_expiry(F.lit("nonsense")), d=text.parse_date(F.lit("31-12-2025")), t=text.call_put_totals(F.lit("12.345 (7.000 Calls, 5.345 Puts)")), m=text.market_of(F.lit("AD.AS")), i=text.parse_integer(F.lit("1.234")))
    assert (x.e.expiry_date, x.e.symbol) == (dt.date(2025, 12, 19), "AH") and x.b.expiry_date is None and x.d == dt.date(2025, 12, 31)
    assert tuple(x.t) == (12345, 7000, 5345) and x.m == "NL" and x.i == 1234


def test_row_operators(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 5, "y")], "k string, v int, t string")
    new = spark.createDataFrame([("a", 2, "n"), ("b", 4, "o"), ("c", 1, "p")], "k string, v int, t string")
    assert {tuple(r) for r in rows.upsert(old, new, ["k"], "v").collect()} == {("a", 2, "n"), ("b", 5, "y"), ("c", 1, "p")}
    assert {tuple(r) for r in rows.insert_absent(old, new, ["k"]).collect()} == {("a", 1, "x"), ("b", 5, "y"), ("c", 1, "p")}
    assert rows.replace_range(old, new, ["k"]).count() == 3
    assert [r.v for r in rows.nth_by(old.union(new), ["k"], [F.desc("v")], 2).orderBy("k").collect()] == [1, 4]


def test_series_operators(spark):
    values = [1.0, 2.0, None, 4.0, 3.0, 5.0]
    df = spark.createDataFrame([("k", i, v) for i, v in enumerate(values)], "k string, i int, x double")
    got = [r.e for r in series.ewm(df, "k", "i", {"e": ("x", 3)}).orderBy("i").collect()]
    state, n, want = None, 0, []
    for v in values:
        if v is not None:
            state, n = (v if state is None else 0.5 * v + 0.5 * state), n + 1
        want.append(state if n >= 3 else None)
    assert got == pytest.approx(want)
    isl = [r.island for r in series.islands(df, "k", "i", F.coalesce(F.col("x") >= 2, F.lit(False))).orderBy("i").collect()]
    assert isl == [None, 1, None, 2, 2, 2]
    ev = spark.createDataFrame([("k", 1, 10.0), ("k", 4, 40.0)], "k string, at int, amount double")
    asof = series.next_and_previous(df, ev, "k", "i", "at", "ev", "amount").orderBy("i").collect()
    assert [(r.ev_next, r.ev_prev, r.ev_value) for r in asof] == [(1, None, 10.0), (1, None, 10.0), (4, 1, 40.0), (4, 1, 40.0), (4, 1, 40.0), (None, 4, None)]


def test_sources(spark, tmp_path):
    page = "<section><h2>December 2025 (AEX / AH)</h2><table><tr><td>1,10</td><td>1,20</td><td>30,00</td><td>n.v.t.</td><td>0,15</td></tr><tr><th>x</th></tr></table></section>"
    got = io.chain_from_pages(spark.createDataFrame([(1, page)], "id int, html string")).collect()
    assert {(r.option_type, r.strike, r.bid, r.ask, str(r.expiry_date)) for r in got} == {("Call", 30.0, 1.1, 1.2, "2025-12-19"), ("Put", 30.0, None, 0.15, "2025-12-19")}
    body = '{"ticker":"AD.AS","timestamp":[0,3600],"open":[1.0,null],"high":[2.0,2.0],"low":[1.0,1.0],"close":[1.5,1.5],"volume":[5,6],"adj_close":[null,null]}'
    b = io.bars_from_json(spark.createDataFrame([(body,)], "body string")).collect()
    assert len(b) == 1 and b[0].adj_close == 1.5 and b[0].market == "NL"
    df = spark.createDataFrame([("A", 1), ("B", 2)], "t string, v int")
    io.write_as_of(df, str(tmp_path / "v"), "2024-01-01", "t")
    io.write_as_of(df.where("t = 'A'").withColumn("v", F.lit(9)), str(tmp_path / "v"), "2024-01-02", "t")
    assert {(r.t, r.v) for r in io.read_newest_version(spark, str(tmp_path / "v"), "t").collect()} == {("A", 9), ("B", 2)}


@pytest.mark.parametrize("name, searched", [("price_pages", ["(?s)<td[^>]*>", "[Cc]alls?", "regexp_extract(regexp_replace("]), ("chain_pages", ["(?s)<td[^>]*>"])])
def test_pages_are_searched_once_and_by_all_tasks(spark, name, searched):
    df = registry.QUERIES[name](spark, D)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    times = {x: plan.count(x) for x in searched}
    assert times == {x: 4 if x == "[Cc]alls?" else 1 for x in searched}  # that one in the page, then a number each in what was found
    per_task = df.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(r["count"] for r in per_task) < 0.5 * df.count()


def test_price_tables_of_odd_pages(spark):
    cells = ["<a href='#'> hot\n <b>bo</b>lt </a>", "NL1", "€ 1.234,50", "N.V.T.", *["-"] * 6, "1.000", " ", ""]
    row = lambda c: "<tr class=x>" + "".join(f"<td class=x>{x}</td>" for x in c) + "</tr>"
    totals = "<p>Totaal <b>3.000</b> (<i>1.000</i> Calls, 2.000 Puts)</p><p>9 (8 Calls, 1 Put)</p>"
    pages = spark.createDataFrame([(1, totals + row(cells) + row(cells[:12]) + row([*cells, "x"]) + row(["", "", "12,5", *cells[3:]])), (2, "<table></table>"), (3, None), (4, row(cells))], "id int, html string")
    got = {(r.id, r.name, r.isin, r.last, r.previous, r.volume, r.open_interest, r.time) for r in io.price_table_from_pages(pages).collect()}
    assert got == {(1, "hot bolt", "NL1", 1234.5, None, 1000, None, None), (1, None, None, 12.5, None, 1000, None, None), (4, "hot bolt", "NL1", 1234.5, None, 1000, None, None)}
    assert {tuple(r) for r in io.overview_from_pages(pages).collect()} == {(1, 3000, 1000, 2000), (2, None, None, None), (3, None, None, None), (4, None, None, None)}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_versions_and_buckets_need_neither_old_files_nor_exchanges(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 5).cast("string").alias("t"), F.col("id").alias("v"))
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        io.write_as_of(df, str(tmp_path / "v"), day, "t")
    newest = io.read_newest_version(spark, str(tmp_path / "v"), "t")
    assert "dynamicpruning" in plan_of(newest) and sorted(r.v for r in newest.collect()) == list(range(100))
    for name, n in (("bucketed_a", 1000), ("bucketed_b", 700)):
        rows = spark.range(n).select((F.col("id") % 50).alias("k"), F.col("id").alias("at"))
        io.write_bucketed(rows, name, str(tmp_path / name), ["k"], ["k", "at"], 4)
    a, b = spark.table("bucketed_a"), spark.table("bucketed_b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.groupBy("k").agg(F.count("*").alias("n")).join(b.groupBy("k").agg(F.max("at").alias("last")), "k")
        windowed = a.withColumn("nth", F.row_number().over(Window.partitionBy("k").orderBy("at")))
        assert "SortMergeJoin" in plan_of(joined) and "Exchange" not in plan_of(joined) + plan_of(windowed)
        assert {(r.k, r.n, r.last) for r in joined.collect()} == {(k, 20, 650 + k) for k in range(50)} and windowed.where("nth = 20").count() == 50
        spark.conf.set("spark.sql.unionOutputPartitioning", "false")
        assert a.select("k").unionByName(b.select("k")).groupBy("k").count().count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.unionOutputPartitioning")
        spark.sql("DROP TABLE bucketed_a")
        spark.sql("DROP TABLE bucketed_b")


def test_dense_ids_follow_the_highest(spark):
    rng = np.random.default_rng(1)
    new = spark.createDataFrame([(int(x), "n") for x in rng.permutation(500)], "k long, s string").repartition(7)
    old = spark.createDataFrame([(900 + i, "o", i + 1) for i in range(40)], "k long, s string, id long")
    got = {r.k: r.id for r in rows.continue_ids(old, new, ["k"], "id").collect()}
    assert got == {900 + i: i + 1 for i in range(40)} | {k: 41 + k for k in range(500)}
    assert rows.continue_ids(old.limit(0), new.limit(0), ["k"], "id").count() == 0


def test_streams_match_batch(spark, tmp_path):
    events = spark.read.parquet(f"{D}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    src = str(tmp_path / "in")
    events.repartition(3).write.parquet(src)
    stream = bars.read(spark, src, events.schema, 1)
    bars.run_available(bars.hourly_bars(stream, "event_type", "ts", "value", late="4000 days"), str(tmp_path / "c1"), name="hourly", mode="complete")
    batch = bars.hourly_bars(events, "event_type", "ts", "value")
    key = lambda df: sorted((r.event_type, str(r.ts), round(r.open, 9), r.ticks) for r in df.collect())
    assert key(spark.table("hourly")) == key(batch)
    bars.run_available(bars.read(spark, src, events.schema, 1), str(tmp_path / "c2"), bars.keep_newest(str(tmp_path / "t"), ["user_id"], "ts"))
    newest = bars.read_merged(spark, str(tmp_path / "t")).select("user_id", "ts")
    want = events.groupBy("user_id").agg(F.max("ts").alias("ts"))
    assert sorted(map(tuple, newest.collect())) == sorted(map(tuple, want.collect()))
    bars.run_available(bars.read(spark, src, events.schema, 1), str(tmp_path / "c3"), bars.keep_states(str(tmp_path / "s"), ["event_type"], ["value"]))
    states = {r.event_type: (r.n, round(r.value, 6)) for r in bars.read_states(spark, str(tmp_path / "s"), ["event_type"], ["value"]).collect()}
    bars.run_available(bars.read(spark, src, events.schema, 1), str(tmp_path / "c4"), bars.keep_states(str(tmp_path / "s2"), ["event_type"], ["value"], ["user_id"], ["value"]))
    kept = {r.event_type: r for r in bars.read_states(spark, str(tmp_path / "s2"), ["event_type"], ["value"], ["user_id"], ["value"]).collect()}
    for r in events.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.percentile_approx("value", [0.45, 0.55], 10000).alias("around")).collect():
        assert kept[r.event_type].n == r.n and abs(kept[r.event_type].distinct_user_id - r.users) <= 0.08 * r.users
        assert r.around[0] <= kept[r.event_type].p50_value <= r.around[1]
    assert states == {r.event_type: (r.n, round(r.v, 6)) for r in events.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("v")).collect()}


def test_reports_pages_json_and_bundles(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long")
    io.write_report(df, str(tmp_path / "c"), "csv")
    io.write_report(df, str(tmp_path / "j"), "json")
    assert io.read_csv(spark, str(tmp_path / "c"), df.schema).count() == 2 and spark.read.json(str(tmp_path / "j")).agg(F.sum("v")).first()[0] == 3
    with pytest.raises(ValueError):
        io.write_report(df, str(tmp_path / "x"), "xls")
    bodies = spark.createDataFrame([('{"series": "S", "dates": ["2025-01-01", "2025-01-02"], "values": [2.5, null]}',), ('["A", "B"]',), ('{"tickers": ["C"]}',), ('{"D": {"x": 1}}',)], "body string")
    assert [(r.series, str(r.curve_date), r.rate) for r in io.points_from_json(bodies.limit(1)).collect()] == [("S", "2025-01-01", 0.025)]
    assert sorted(r.ticker for r in io.tickers_from_json(bodies.where("body not like '%series%'")).collect()) == ["A", "B", "C", "D"]
    df.createOrReplaceTempView("facts_here")
    facts = {r.name: (r.present, r.n_rows, r.n_columns) for r in io.facts_of_tables(spark, ["facts_here", "facts_gone"]).collect()}
    assert facts == {"facts_here": (True, 2, 2), "facts_gone": (False, 0, 0)}
    df.union(spark.createDataFrame([("a", 9)], df.schema)).write.parquet(str(tmp_path / "o"))
    io.rewrite_newest(spark, str(tmp_path / "o"), str(tmp_path / "n"), ["k"], "v")
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "n")).collect())) == [("a", 9), ("b", 2)]
    io.empty(str(tmp_path / "n"), spark)
    assert spark.read.parquet(str(tmp_path / "n")).count() == 0
    models.write_bundle(spark, str(tmp_path / "b"), ["x", "y"], {"long": 0.55}, {"auc": 0.7})
    assert models.read_bundle(spark, str(tmp_path / "b")) == {"features": ["x", "y"], "config": {"long": 0.55}, "metrics": {"auc": 0.7}}


def test_session_hours_and_lists(spark):
    from tidemark.plans import sessions

    at = [("2024-07-01 15:30:00", "US", True), ("2024-07-01 15:29:00", "US", False), ("2024-07-01 22:00:00", "US", False), ("2024-07-01 17:30:00", "NL", True), ("2024-07-01 17:31:00", "NL", False), ("2024-03-31 02:30:00", "NL", False), ("2024-10-27 02:30:00", "DE", False), ("2024-03-18 14:30:00", "US", True), ("2024-07-01 12:00:00", "XX", False)]
    df = spark.createDataFrame(at, "s string, market string, want boolean").withColumn("ts", F.to_timestamp("s"))
    assert all(r.want == r.got for r in df.select("want", sessions.in_session(F.col("ts"), F.col("market")).alias("got")).collect())
    assert sessions.of_universe(df, ["US"], "market").count() == 4 and sessions.of_universe(df, None).count() == 9


def test_the_solver_finds_the_volatility(spark):
    grid = [(c, s, k, t, v) for c in (True, False) for s in (60.0, 100.0, 140.0) for k in (80.0, 100.0, 120.0) for t in (0.02, 0.5, 3.0) for v in (0.08, 0.3, 1.2, 4.0)]
    rows = [("Call" if c else "Put", s, k, t, float(bs(c, s, k, t, 0.03, v)), v) for c, s, k, t, v in grid]
    df = spark.createDataFrame(rows, "kind string, s double, k double, t double, paid double, v double")
    got = df.withColumn("iv", pricing.implied_vol(*(F.col(c) for c in ("kind", "paid", "s", "k", "t")), F.lit(0.03))).collect()
    solved = [r for r in got if r.iv is not None]
    assert len(solved) > 150 and all(abs(float(bs(r.kind == "Call", r.s, r.k, r.t, 0.03, r.iv)) - r.paid) < 3e-5 for r in solved)
    assert all(abs(r.iv - r.v) < 1e-5 for r in solved if r.t >= 0.5 and r.v in (0.3, 1.2) and 0.8 <= r.s / r.k <= 1.25)  # where the price depends on it


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_queries_without_sql_run(spark, name, monkeypatch):
    monkeypatch.setattr(validation, "BOOSTING_ROUNDS", 3)  # the fit itself is tried in the bench
    rows = registry.QUERIES[name](spark, D.replace("sf0.001", "sf0.01")).collect()
    assert rows
    if name == "model_ablation":
        by = {r.model: r for r in rows}
        assert set(by) == {"share", "all", *(f"without {f}" for f in validation.MODEL_FEATURES)} and len({r.n for r in rows}) == 1


def bs(call, s, k, t, r, v):
    from math import erf, exp, log, sqrt

    a = (log(s / k) + (r + v * v / 2) * t) / (v * sqrt(t))
    n = lambda x: (1 + erf(x / sqrt(2))) / 2
    c = s * n(a) - k * exp(-r * t) * n(a - v * sqrt(t))
    return max(c if call else c - s + k * exp(-r * t), (s - k) if call else (k - s), 0)


def test_smile_events_and_tenors(spark):
    from tidemark.plans import strategies as st

    cases = [("Put", 0.95, -0.1, 0.2 + 0.025 * 1.05), ("Put", 0.95, 0.1, 0.225), ("Put", 0.85, 0.0, 0.24), ("Put", 0.9, None, 0.25), ("Put", 1.2, -0.1, 0.2), ("Call", 1.05, -0.1, 0.195), ("Call", 1.3, 0.0, 0.19), ("Call", 0.8, 0.0, 0.2)]
    df = spark.createDataFrame(cases, "kind string, m double, r double, want double")
    assert all(abs(r.got - r.want) < 1e-12 for r in df.select("want", st.skewed(F.lit(0.2), F.col("kind"), F.col("m"), F.col("r")).alias("got")).collect())
    days = [(7, None, 0.025), (14, None, 0.0), (0, 0, 0.0), (1, 1, 0.05 * 13 / 14 + 0.015 * 6 / 7), (15, 8, 0.0), (None, 3, 0.015 * 4 / 7), (None, None, 0.0)]
    df = spark.createDataFrame(days, "e int, x int, want double")
    assert all(abs(r.got - r.want) < 1e-12 for r in df.select("want", st.event_rise(F.col("e"), F.col("x")).alias("got")).collect())
    got = spark.range(1).select(st.at_tenor(F.lit(0.06), 120, F.lit(1)).alias("low"), st.at_tenor(F.lit(0.2), 120, F.lit(120)).alias("same")).first()
    assert got.low == 0.05 and got.same == 0.2
    state = spark.createDataFrame([("a", dt.date(2024, 1, d), 100.0) for d in (1, 2)] + [("b", dt.date(2024, 1, 1), 50.0)], "ticker string, trade_date date, close double")
    none = spark.createDataFrame([], "ticker string, earnings_date date, ex_dividend_date date")
    rows_ = st.volatility_smiles(st.calibrated_state(state), none, none).collect()  # too few returns: the stated volatility, no event
    assert len(rows_) == 3 and all(0.2 < r.simulated_iv < 0.5 and r.rise == 0 and r.days_to_exdiv is None for r in rows_)
    assert st.volatility_smiles(st.calibrated_state(state.limit(0)), none, none).count() == 0
